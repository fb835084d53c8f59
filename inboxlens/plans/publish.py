"""All-or-nothing publishing of a build's tables.

A build writes into folders (or catalog tables) that only its own run uses. One
small file, the manifest, names a run's tables; the newest manifest is the
current build. A manifest is written under another name and then renamed, to a
name no other run has, so readers see it whole or not at all, and no table that
a reader may have open is touched: also on stores whose rename of a folder is
many copies. Two runs at once publish one after the other.

    <target>/_builds/<number>-<run>.json     the manifests
    <target>/_runs/<run>/<table>             outputs, shared ones under _int/
    <target>_stg/_runs/<run>/<table>         staged tables

With a database the tables are ``<database>.<table>__<run>`` (staged ones in
``<database>_stg``), the manifests lie in the database's folder, and the views
``<database>.<table>`` are moved to the new build after it is published: a
convenience, one after the other; ``read_build`` gives the tables of one build.

A run that fails deletes what it wrote. Publishing deletes all but the newest
``keep`` builds, and what runs left that were killed ``stale_hours`` ago or more.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import asdict, dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..functions.sql import lit, q
from .comments import commented, table_comment

KEEP = 2
STALE_HOURS = 48
COMPRESSION = "zstd"  # of Parquet tables: the hex keys in most of them are half as large as by snappy
_RUN = re.compile(r"r(\d{14})_[0-9a-f]{8}")


class Files:
    """Files and folders of the root's Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def read(self, file: str) -> str:
        stream = self._fs.open(self._path(file))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, file: str, text: str) -> None:
        stream = self._fs.create(self._path(file), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def rename(self, source: str, target: str) -> None:
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot rename {source} to {target}")

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


@dataclass(frozen=True)
class Build:
    """A published build: where its tables are and how to read them. ``schemas``
    of tables in folders: a partitioned table without rows has no file to tell its
    own, and an account named ``007`` would be read as a number."""

    number: int
    run: str
    tables: dict[str, str]
    fmt: str = "parquet"
    database: str | None = None
    schemas: dict[str, dict] = field(default_factory=dict)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        if self.database:
            return spark.table(self.tables[name])
        reader = spark.read.format(self.fmt)
        if name in self.schemas:
            reader = reader.schema(StructType.fromJson(self.schemas[name]))
        return reader.load(self.tables[name])


def _root(spark: SparkSession, target: str, database: str | None) -> str:
    return (spark.catalog.getDatabase(database).locationUri if database else target).rstrip("/")


def _published(files: Files, root: str) -> list[str]:
    """Manifest names, the oldest first."""
    return [n for n in files.names(f"{root}/_builds") if n.endswith(".json") and not n.startswith(".")]


def current_build(spark: SparkSession, target: str = "", database: str | None = None) -> Build | None:
    """The newest published build under ``target`` (or in ``database``)."""
    root = _root(spark, target, database)
    files = Files(spark, root)
    names = _published(files, root)
    return Build(**json.loads(files.read(f"{root}/_builds/{names[-1]}"))) if names else None


def read_build(spark: SparkSession, target: str = "", database: str | None = None) -> dict[str, DataFrame]:
    """The tables of the current build, all of one run, by name."""
    build = current_build(spark, target, database)
    if build is None:
        raise FileNotFoundError(f"no build is published under {database or target}")
    return {name: build.read(spark, name) for name in build.tables}


class Run:
    """The tables of a build while it is written; ``with`` deletes them if it fails."""

    def __init__(self, spark: SparkSession, target: str, database: str | None = None, fmt: str = "parquet",
                 keep: int = KEEP, stale_hours: float = STALE_HOURS):
        if keep < 1:
            raise ValueError("keep at least one build")
        self.spark, self.database, self.fmt = spark, database, fmt
        self.schemas: dict[str, dict] = {}
        self.keep, self.stale_hours = keep, stale_hours
        if database:
            for schema in (database, f"{database}_stg"):
                spark.sql(f"CREATE DATABASE IF NOT EXISTS {q(schema)}")
        self.target = target.rstrip("/")
        self.root = _root(spark, target, database)
        self.files = Files(spark, self.root)
        self.run = f"r{datetime.now(timezone.utc):%Y%m%d%H%M%S}_{uuid.uuid4().hex[:8]}"

    def location(self, name: str) -> str:
        if self.database:
            return f"{self.database}{'_stg' if name.startswith('stg_') else ''}.{name}__{self.run}"
        base = f"{self.target}_stg" if name.startswith("stg_") else self.target
        return f"{base}/_runs/{self.run}/{'_int/' if name.startswith('int_') else ''}{name}"

    def save(self, name: str, df: DataFrame, partition_column: str | None = None) -> None:
        df = commented(name, df)
        w = df.write.mode("overwrite").format(self.fmt)
        if self.fmt == "parquet":
            w = w.option("compression", COMPRESSION)
        if partition_column:
            w = w.partitionBy(partition_column)
        if self.database:
            w.saveAsTable(self.location(name))
            if comment := table_comment(name):
                self.spark.sql(f"COMMENT ON TABLE {self.location(name)} IS :comment", args={"comment": comment})
        else:
            w.save(self.location(name))
        self.schemas[name] = json.loads(df.schema.json())

    def build(self, number: int, names: list[str]) -> Build:
        return Build(number, self.run, {n: self.location(n) for n in names}, self.fmt, self.database,
                     {n: self.schemas[n] for n in names if n in self.schemas})

    def read(self, name: str) -> DataFrame:
        return self.build(0, [name]).read(self.spark, name)

    def publish(self, names: list[str]) -> Build:
        """Make the run's tables the current build."""
        published = _published(self.files, self.root)
        number = int(published[-1].split("-")[0]) + 1 if published else 1
        build = self.build(number, names)
        hidden = f"{self.root}/_builds/.{self.run}.tmp"
        self.files.write(hidden, json.dumps(asdict(build)))
        self.files.rename(hidden, f"{self.root}/_builds/{number:09d}-{self.run}.json")
        return build

    def tidy(self, build: Build) -> None:
        """Views on the published build; older builds and abandoned runs go."""
        if self.database:
            for name, location in build.tables.items():
                schema = location.split(".")[0]
                if self.spark.catalog.tableExists(f"{schema}.{name}") and \
                        self.spark.catalog.getTable(f"{schema}.{name}").tableType != "VIEW":
                    self.spark.sql(f"DROP TABLE {q(schema)}.{q(name)}")  # of a build before there were manifests
                comment = table_comment(name)
                told = f" COMMENT {lit(comment)}" if comment else ""
                self.spark.sql(f"CREATE OR REPLACE VIEW {q(schema)}.{q(name)}{told} AS SELECT * FROM {location}")
        names = _published(self.files, self.root)
        for old in names[:-self.keep]:
            self.files.delete(f"{self.root}/_builds/{old}")  # first, so that no manifest names what is gone
            self._delete(old.removesuffix(".json").split("-", 1)[1])
        held = {n.removesuffix(".json").split("-", 1)[1] for n in names} | {self.run}
        oldest = f"{datetime.now(timezone.utc) - timedelta(hours=self.stale_hours):%Y%m%d%H%M%S}"
        for run in self._runs() - held:
            if _RUN.fullmatch(run)[1] < oldest:
                self._delete(run)

    def _schemas(self) -> list[str]:
        return [self.database, f"{self.database}_stg"]

    def _tables(self) -> list[tuple[str, str]]:
        return [(s, r.tableName) for s in self._schemas() for r in self.spark.sql(f"SHOW TABLES IN {q(s)}").collect()]

    def _runs(self) -> set[str]:
        if self.database:
            found = {t.rpartition("__")[2] for _, t in self._tables()}
        else:
            found = {n for base in (self.target, f"{self.target}_stg") for n in self.files.names(f"{base}/_runs")}
        return {n for n in found if _RUN.fullmatch(n)}

    def _delete(self, run: str) -> None:
        if self.database:
            for schema, table in self._tables():
                if table.endswith(f"__{run}"):
                    self.spark.sql(f"DROP TABLE IF EXISTS {q(schema)}.{q(table)}")
        else:
            for base in (self.target, f"{self.target}_stg"):
                self.files.delete(f"{base}/_runs/{run}")
        self.files.delete(f"{self.root}/_builds/.{run}.tmp")

    def __enter__(self) -> "Run":
        return self

    def __exit__(self, kind, *_) -> None:
        # a run whose manifest stands is a build, whatever failed afterwards
        if kind is not None and not any(n.endswith(f"-{self.run}.json") for n in _published(self.files, self.root)):
            self._delete(self.run)
