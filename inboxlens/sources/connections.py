"""Scan, union and conform the raw source tables of one or more connections."""

from __future__ import annotations

import json
from collections.abc import Collection, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import utc_sql
from ..functions.sql import alias, q
from ..options import Options
from . import schemas


# Formats whose rows know the file they are from.
_FILES = ("parquet", "orc", "csv", "json")
# Table entry of an account that does not sync the table: it has no rows.
ABSENT = object()


@dataclass(frozen=True)
class Connection:
    """One connected account: a name (becomes ``source_relation``) and where
    each raw table lives.  A table entry is a DataFrame, a catalog table name,
    a path (read with ``fmt``) or ``ABSENT``."""

    name: str
    tables: Mapping[str, object] = field(default_factory=dict)
    fmt: str = "parquet"
    # Reader options (e.g. {"header": "true"} for CSV) and, per table, a DDL
    # schema to read with instead of inferring one.
    reader_options: Mapping[str, str] = field(default_factory=dict)
    schemas: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def from_directory(cls, name: str, root: str, overrides: Mapping[str, str] | None = None,
                       fmt: str = "parquet", suffix: str = "",
                       reader_options: Mapping[str, str] | None = None,
                       table_schemas: Mapping[str, str] | None = None,
                       absent: Collection[str] = ()) -> "Connection":
        """Tables stored as ``root/<table><suffix>``; ``overrides`` renames single
        tables, ``absent`` names those the account does not have."""
        overrides = dict(overrides or {})
        tables = {t: ABSENT if t in absent else f"{root.rstrip('/')}/{overrides.get(t, t)}{suffix}"
                  for t in schemas.SOURCE_TABLES}
        return cls(name, tables, fmt, dict(reader_options or {}), dict(table_schemas or {}))

    @classmethod
    def from_catalog(cls, name: str, database: str,
                     overrides: Mapping[str, str] | None = None,
                     absent: Collection[str] = ()) -> "Connection":
        """Tables registered in the catalog as ``database.<table>``."""
        overrides = dict(overrides or {})
        tables = {t: ABSENT if t in absent else f"{database}.{overrides.get(t, t)}"
                  for t in schemas.SOURCE_TABLES}
        return cls(name, tables, fmt="table")

    def read(self, spark: SparkSession, table: str) -> DataFrame | None:
        """The raw table, or None if the account does not have it."""
        if table not in self.tables:
            raise KeyError(f"connection {self.name!r} has no {table!r} table; give it (ABSENT if the "
                           "account does not sync it), or switch the feature off in Options")
        ref = self.tables[table]
        if ref is ABSENT:
            return None
        if isinstance(ref, DataFrame):
            return ref
        if self.fmt == "table":
            return spark.table(str(ref))
        return self.reader(spark, table).load(str(ref))

    def reader(self, spark: SparkSession, table: str) -> DataFrameReader:
        reader = spark.read.format(self.fmt).options(**self.reader_options)
        return reader.schema(self.schemas[table]) if table in self.schemas else reader

    def folder(self, table: str) -> str | None:
        """Where the table's files are, if it is given as one path of plain files."""
        ref = self.tables.get(table)
        return ref if isinstance(ref, str) and self.fmt in _FILES and not set(ref) & set("*?[]{}") else None


def enabled_tables(options: Options) -> list[str]:
    off = set()
    if not options.using_automations:
        off |= set(schemas.AUTOMATION_TABLES)
    if not options.using_segments:
        off |= set(schemas.SEGMENT_TABLES)
    if not options.using_unsubscribes:
        off |= set(schemas.UNSUBSCRIBE_TABLES)
    return [t for t in schemas.SOURCE_TABLES if t not in off]


_INTEGRAL = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
_EXACT_IN_DOUBLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.FloatType(), T.DoubleType())
_DATES = (T.DateType(), T.TimestampNTZType())


def common_type(types: Collection[T.DataType], declared: T.DataType | None = None) -> T.DataType:
    """One type that holds every value of ``types``, whatever their order.

    Equal types stay.  Types that differ become string if the column is
    declared as string; else the widest integer, double (where exact), or
    zone-free timestamp among them and the declared type; else string."""
    found = set(types)
    if len(found) == 1:
        return found.pop()
    if declared == T.StringType():
        return declared
    for family in (_INTEGRAL, _EXACT_IN_DOUBLE, _DATES):
        if found <= set(family):
            wide = found | ({declared} & set(family))
            return family[-1] if family is _EXACT_IN_DOUBLE else max(wide, key=family.index)
    return T.StringType()


def _zone_free(df: DataFrame) -> DataFrame:
    """Zoned timestamps as UTC wall-clock times, so that no result depends on
    the session time zone."""
    if not any(f.dataType == T.TimestampType() for f in df.schema.fields):
        return df
    return df.selectExpr(*[alias(utc_sql(q(f.name)), f.name) if f.dataType == T.TimestampType()
                           else q(f.name) for f in df.schema.fields])


def union_connections(frames: list[tuple[str | None, DataFrame]], options: Options,
                      table: str = "") -> DataFrame:
    """UNION ALL by column name of one raw table across connections.

    Every row gets ``source_relation``, the connection's name (None: the frame
    has the column already).  A column absent from a connection is NULL there; a
    column whose type differs between connections takes their ``common_type``,
    so no value is narrowed and the order of the connections does not matter.
    """
    frames = [(conn, _zone_free(df)) for conn, df in frames]
    names: dict[str, str] = {}
    types: dict[str, list[T.DataType]] = {}
    for _, df in frames:
        for f in df.schema.fields:
            names.setdefault(f.name.lower(), f.name)
            types.setdefault(f.name.lower(), []).append(f.dataType)
    target = {key: common_type(found, schemas.declared_type(table, key))
              for key, found in types.items() if key != "source_relation"}
    parts = []
    for conn, df in frames:
        have = {f.name.lower(): f for f in df.schema.fields}
        cols = []
        for key, dtype in target.items():
            f = have.get(key)
            value = "NULL" if f is None else q(f.name)
            cols.append(alias(value if f is not None and f.dataType == dtype
                              else f"CAST({value} AS {dtype.simpleString()})", names[key]))
        if conn is None:
            parts.append(df.selectExpr(q("source_relation"), *cols))
        else:
            # the name goes in as a value, not as SQL text (no quoting concerns)
            parts.append(df.selectExpr(*cols).select(F.lit(_relation(conn, options)).alias("source_relation"), "*"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _relation(conn: str, options: Options) -> str:
    return conn if options.source_casing else conn.lower()


_NO_HOST = ":///"  # file:///x and file:/x name the same folder


def _folder(spark: SparkSession, path: str) -> str:
    """The path of a folder as it stands in the paths of its files."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = found.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(found)
    return listed.getPath().toUri().toString().replace(_NO_HOST, ":/")


def scan_accounts(spark: SparkSession, accounts: list[tuple[Connection, str]], table: str,
                  options: Options) -> list[tuple[None, DataFrame]]:
    """One raw table of many accounts in folders of their own, by one scan for
    each file schema there is, whatever the number of accounts.

    The account of a row is that of its file's folder: the listed folders, a row
    an account, are looked up by broadcast (as many rows as accounts are listed).
    Schemas are read folder by folder, several at a time."""
    def schema(entry: tuple[Connection, str]) -> T.StructType:
        conn, path = entry
        return conn.reader(spark, table).load(path).schema

    with ThreadPoolExecutor(min(16, len(accounts))) as pool:
        found = list(pool.map(schema, accounts))
    groups: dict[tuple, list[tuple[Connection, str, str]]] = {}
    for (conn, path), fields in zip(accounts, found):
        folder = _folder(spark, path)
        kind = (conn.fmt, tuple(sorted(conn.reader_options.items())), fields.json(), folder.count("/"))
        groups.setdefault(kind, []).append((conn, path, folder))
    out = []
    for (_, _, fields, depth), members in groups.items():
        paths = list(dict.fromkeys(path for _, path, _ in members))
        rows = members[0][0].reader(spark, table).schema(T.StructType.fromJson(json.loads(fields))).load(paths)
        listed = {f"{x}{i}": v for i, (c, _, folder) in enumerate(members) for x, v in (("f", folder), ("a", _relation(c.name, options)))}
        folders = spark.sql(f"SELECT * FROM VALUES {', '.join(f'(:f{i}, :a{i})' for i in range(len(members)))} AS t(__folder, __account)", args=listed)
        file = F.replace("_metadata.file_path", F.lit(_NO_HOST), F.lit(":/"))
        account = F.coalesce("__account", F.raise_error(F.concat(F.lit("file of no listed folder: "), "__at")))
        rows = (rows.withColumn("__at", F.substring_index(file, "/", depth + 1)).join(F.broadcast(folders), F.col("__at") == F.col("__folder"), "left")
                .select(account.alias("source_relation"), *[F.col(q(f.name)) for f in rows.schema.fields if f.name.lower() != "source_relation"]))
        out.append((None, rows))
    return out


class SourceTables(dict):
    """Raw tables keyed by table name, remembering the connections they hold
    (empty when not known up front, e.g. partitioned storage) and, for each
    table, the ``source_relation`` values that have it."""

    def __init__(self, tables: dict[str, DataFrame], connections: list[str],
                 accounts: Mapping[str, list[str]] | None = None):
        super().__init__(tables)
        self.connections = list(connections)
        self.accounts = dict(accounts or {})


def read_sources(spark: SparkSession, connections: list[Connection],
                 options: Options = Options()) -> SourceTables:
    """Raw tables of all connections, unioned per table, keyed by table name.

    Accounts whose table is a folder of files share one scan per file schema
    (``scan_accounts``); the other tables are a scan each.  A table that some
    connections mark ABSENT has the others' rows; it is an error if all of them
    do."""
    out, accounts = {}, {}
    for table in enabled_tables(options):
        listed = [(c, folder) for c in connections if (folder := c.folder(table)) is not None]
        together = listed if len(listed) > 1 else []
        done = {id(c) for c, _ in together}
        frames = [(c.name, df) for c in connections if id(c) not in done and (df := c.read(spark, table)) is not None]
        if together:
            frames += scan_accounts(spark, together, table, options)
        if not frames:
            raise KeyError(f"no connection has a {table!r} table; switch the feature off in Options")
        out[table] = union_connections(frames, options, table)
        accounts[table] = [_relation(c.name, options) for c in connections if c.tables.get(table) is not ABSENT]
    return SourceTables(out, [c.name for c in connections], accounts)


def conform(df: DataFrame, table: str, options: Options,
            extra: list[tuple[str, str]] | None = None) -> DataFrame:
    """Keep the declared columns of ``table`` (matched case-insensitively),
    fill absent ones with a typed NULL, drop the rest; keep source_relation."""
    have = {c.lower(): c for c in df.columns}
    cols = [q("source_relation")]
    for name, dtype in schemas.declared_columns(table, options.synced_column,
                                                options.deleted_column, extra):
        real = have.get(name.lower())
        cols.append(alias(q(real), name) if real is not None
                    else alias(f"CAST(NULL AS {dtype.simpleString()})", name))
    return df.selectExpr(*cols)


def read_with_text_partition(spark: SparkSession, path: str, fmt: str,
                             partition_column: str) -> DataFrame:
    """Read a table partitioned by ``partition_column`` keeping the folder
    value as text: type inference would turn an account named ``007`` into
    the number 7.  The inferred schema is read first, then the table is read
    with that column declared as string."""
    inferred = spark.read.format(fmt).load(path).schema
    fields = [T.StructField(f.name, T.StringType(), True)
              if f.name.lower() == partition_column.lower() else f for f in inferred.fields]
    return spark.read.format(fmt).schema(T.StructType(fields)).load(path)


def read_partitioned_sources(spark: SparkSession, root: str, options: Options = Options(),
                             fmt: str = "parquet", overrides: Mapping[str, str] | None = None,
                             partition_column: str = "source_relation") -> SourceTables:
    """Raw tables of any number of accounts stored together, partitioned by
    account: ``root/<table>/<partition_column>=<account>/...``.

    One scan per table whatever the number of accounts (the plan does not
    grow with them); the account comes from partition discovery, so a
    filter on ``source_relation`` prunes the other accounts' files.  Every
    key of the build then includes ``source_relation``."""
    overrides = dict(overrides or {})
    out = {}
    for table in enabled_tables(options):
        path = f"{root.rstrip('/')}/{overrides.get(table, table)}"
        df = read_with_text_partition(spark, path, fmt, partition_column)
        part = next((c for c in df.columns if c.lower() == partition_column.lower()), None)
        if part is None:
            raise ValueError(f"{path} is not partitioned by {partition_column}")
        sr = f"CAST({q(part)} AS STRING)"
        if not options.source_casing:
            sr = f"lower({sr})"
        out[table] = _zone_free(df.selectExpr(alias(sr, "source_relation"),
                                              *[q(c) for c in df.columns if c != part]))
    return SourceTables(out, [])
