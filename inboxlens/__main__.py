"""Batch job: build and write every table, optionally run the checks.

    python -m inboxlens --connection shop_eu=s3://lake/raw_eu \\
        --catalog shop_us=raw_us --target s3://lake/marts/email --check

Uses the session of the cluster it runs on (``getOrCreate``); checks read
the stored tables and are written next to them under ``_checks``.
"""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import SparkSession

from . import Connection, Options, PassThrough, build, read_sources
from .sources import read_partitioned_sources
from .operators import quality
from .plans import OUTPUTS, read_build
from .plans.publish import KEEP, STALE_HOURS
from .plans.write import write_build
from .session import RECOMMENDED_CONF


def _pairs(items: list[str]) -> list[tuple[str, str]]:
    out = []
    for item in items:
        name, sep, where = item.partition("=")
        if not sep or not name or not where:
            raise SystemExit(f"expected NAME=LOCATION, got {item!r}")
        out.append((name, where))
    return out


def _pass_through(items: list[str]) -> tuple[PassThrough, ...]:
    """NAME, or NAME with any of alias=, type= and sql= (last) behind colons."""
    out = []
    for item in items:
        item, _, sql = item.partition(":sql=")
        name, *rest = item.split(":")
        given = dict(_pairs(rest))
        if not set(given) <= {"alias", "type"}:
            raise SystemExit(f"expected NAME[:alias=A][:type=T][:sql=EXPRESSION], got {item!r}")
        out.append(PassThrough(name, given.get("alias"), sql or None, given.get("type", "string")))
    return tuple(out)


def _table_names(items: list[str]) -> tuple[dict[str, str], dict[str, dict[str, str]]]:
    """Names of all accounts (TABLE=NAME), and of single ones (ACCOUNT.TABLE=NAME)."""
    every, single = {}, {}
    for key, name in _pairs(items):
        account, dot, table = key.rpartition(".")
        (single.setdefault(account, {}) if dot else every)[table] = name
    return every, single


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="inboxlens", description=__doc__.split("\n\n")[0])
    p.add_argument("--connection", action="append", default=[], metavar="NAME=PATH",
                   help="raw tables stored as PATH/<table> (Parquet unless --format)")
    p.add_argument("--catalog", action="append", default=[], metavar="NAME=DATABASE",
                   help="raw tables registered as DATABASE.<table>")
    p.add_argument("--partitioned", metavar="ROOT",
                   help="raw tables of all accounts under ROOT/<table>/source_relation=<account>/")
    p.add_argument("--format", default="parquet", help="format of path connections")
    p.add_argument("--reader-option", action="append", default=[], metavar="KEY=VALUE",
                   help="option of the file reader (repeatable), e.g. header=true for csv")
    p.add_argument("--table-name", action="append", default=[], metavar="[ACCOUNT.]TABLE=NAME",
                   help="raw table stored under another name (repeatable), in all accounts or in "
                        "one, e.g. list=lists_v2 or shop_eu.list=lists_v2")
    p.add_argument("--absent", action="append", default=[], metavar="ACCOUNT=TABLE",
                   help="raw table that the account does not sync (repeatable)")
    p.add_argument("--member-column", action="append", default=[],
                   metavar="NAME[:alias=A][:type=T][:sql=EXPRESSION]",
                   help="extra member column carried to the outputs (repeatable)")
    p.add_argument("--target", required=True, help="output root (or catalog name with --database)")
    p.add_argument("--database", help="save outputs as catalog tables in this database")
    p.add_argument("--no-automations", action="store_true")
    p.add_argument("--no-segments", action="store_true")
    p.add_argument("--no-unsubscribes", action="store_true")
    p.add_argument("--source-casing", action="store_true")
    p.add_argument("--no-staging", action="store_true", help="do not write staged tables")
    p.add_argument("--partition-by-source", action="store_true")
    p.add_argument("--parallel-jobs", type=int, default=4)
    p.add_argument("--keep", type=int, default=KEEP, help="published builds that stay")
    p.add_argument("--stale-hours", type=float, default=STALE_HOURS,
                   help="age at which tables of killed runs are swept")
    p.add_argument("--recommended-conf", action="store_true",
                   help="apply inboxlens.session.RECOMMENDED_CONF to the session")
    p.add_argument("--check", action="store_true", help="run the declared tests and freshness")
    p.add_argument("--warn-after-hours", type=int, default=quality.WARN_AFTER_HOURS)
    p.add_argument("--error-after-hours", type=int, default=quality.ERROR_AFTER_HOURS)
    p.add_argument("--as-of", type=datetime.fromisoformat, metavar="TIME",
                   help="time that freshness is judged at (ISO, UTC unless it names a zone); now if left out")
    p.add_argument("--synced-column", default=Options().synced_column)
    p.add_argument("--reconcile-with", metavar="TARGET",
                   help="compare every output with the newest build under TARGET (or in that database)")
    p.add_argument("--reconcile-exclude", action="append", default=[], metavar="COLUMN",
                   help="column left out of the comparison (repeatable)")
    return p.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict[str, str]:
    a = parse(argv)
    if not a.connection and not a.catalog and not a.partitioned:
        raise SystemExit("give --partitioned, or at least one --connection or --catalog")
    if a.partitioned and (a.connection or a.catalog):
        raise SystemExit("--partitioned reads all accounts; do not combine it with connections")
    spark = spark or SparkSession.builder.appName("inboxlens").getOrCreate()
    if a.recommended_conf:
        for k, v in RECOMMENDED_CONF.items():
            spark.conf.set(k, v)
    options = Options(using_automations=not a.no_automations, using_segments=not a.no_segments,
                      using_unsubscribes=not a.no_unsubscribes, source_casing=a.source_casing,
                      synced_column=a.synced_column, member_pass_through=_pass_through(a.member_column))
    names, own_names = _table_names(a.table_name)
    absent: dict[str, list[str]] = {}
    for account, table in _pairs(a.absent):
        absent.setdefault(account, []).append(table)
    unknown = (set(own_names) | set(absent)) - {n for n, _ in _pairs(a.connection + a.catalog)}
    if unknown:
        raise SystemExit(f"no such account: {', '.join(sorted(unknown))}")
    if a.partitioned:
        raw = read_partitioned_sources(spark, a.partitioned, options, fmt=a.format,
                                       overrides=names)
    else:
        named = lambda n: {**names, **own_names.get(n, {})}
        conns = [Connection.from_directory(n, w, named(n), fmt=a.format, absent=absent.get(n, ()),
                                           reader_options=dict(_pairs(a.reader_option)))
                 for n, w in _pairs(a.connection)]
        conns += [Connection.from_catalog(n, w, named(n), absent=absent.get(n, ()))
                  for n, w in _pairs(a.catalog)]
        raw = read_sources(spark, conns, options)
    written = write_build(spark, raw, a.target, options, staging=not a.no_staging,
                          database=a.database, partition_by_source=a.partition_by_source,
                          max_parallel_jobs=a.parallel_jobs, keep=a.keep, stale_hours=a.stale_hours)
    checks: dict[str, str] = {}

    def save(df, name: str) -> None:
        loc = f"{a.database}._checks_{name}" if a.database \
            else f"{a.target.rstrip('/')}/_checks/{name}"
        if a.database:
            df.write.mode("overwrite").saveAsTable(loc)
        else:
            df.write.mode("overwrite").parquet(loc)
        checks[f"_checks_{name}"] = loc

    if a.check:
        # staged tables not written are checked from their (cheap) lazy plans
        staged = {n: df for n, df in build(raw, options).items() if n.startswith("stg_")}
        stored = {**staged, **{n: written.build.read(spark, n) for n in written}}
        save(quality.run_tests(stored, not_null=written.not_null), "tests")
        save(quality.freshness(raw, options.synced_column, a.as_of, a.warn_after_hours,
                               a.error_after_hours), "freshness")
        tests = spark.table(checks["_checks_tests"]) if a.database else spark.read.parquet(checks["_checks_tests"])
        print(f"inboxlens: {tests.where('failures > 0').count()} of the declared tests have failures")
    if a.reconcile_with:
        # the newest build under another root (or in another database)
        earlier = read_build(spark, a.reconcile_with, a.reconcile_with if a.database else None)
        for name in OUTPUTS:
            if name in written and name in earlier:
                exclude = quality.RECONCILE_EXCLUDE.get(name, []) + a.reconcile_exclude
                save(quality.reconcile(earlier[name], written.build.read(spark, name), exclude=exclude),
                     f"reconcile_{name}")
    return {**written, **checks}


if __name__ == "__main__":
    main()
