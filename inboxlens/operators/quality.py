"""Data checks: NOT NULL, UNIQUE, source freshness, two-build reconcile.

Each check is a distributed query returning the violating rows or one
summary row per check; nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import utc_sql

SR = "source_relation"

# Generic tests declared on the models (model, column).
NOT_NULL_TESTS = [
    ("stg_automation_activities", "activity_id"), ("stg_automation_emails", "automation_email_id"),
    ("stg_automation_recipients", "automation_recipient_id"), ("stg_automations", "automation_id"),
    ("stg_campaign_recipients", "email_id"), ("stg_campaign_activities", "activity_id"),
    ("stg_campaigns", "campaign_id"), ("stg_lists", "list_id"), ("stg_members", "member_id"),
    ("stg_segments", "segment_id"), ("stg_unsubscribes", "unsubscribe_id"),
    ("lists", "list_id"), ("members", "member_id"), ("campaigns", "campaign_id"),
    ("campaign_recipients", "email_id"), ("campaign_activities", "activity_id"),
    ("automations", "automation_id"), ("automation_emails", "automation_email_id"),
    ("automation_activities", "activity_id"), ("segments", "segment_id"),
]
UNIQUE_TESTS = [
    ("stg_automation_activities", "activity_id"), ("stg_automation_emails", "automation_email_id"),
    ("stg_automation_recipients", "automation_recipient_id"), ("stg_automations", "automation_id"),
    ("stg_campaign_recipients", "email_id"), ("stg_campaign_activities", "activity_id"),
    ("stg_campaigns", "campaign_id"), ("stg_lists", "list_id"), ("stg_segments", "segment_id"),
    ("stg_unsubscribes", "unsubscribe_id"),
]
# Source freshness limits, hours.
WARN_AFTER_HOURS = 72
ERROR_AFTER_HOURS = 168
# Columns left out when comparing two builds of a model (free-form JSON).
RECONCILE_EXCLUDE = {"automations": ["trigger_settings"]}
# Groups of rows that a reconcile compares by their fingerprints.
BUCKETS = 1 << 14
# Labels of the two sides in a reconcile.
LEFT_LABEL = "from prod"
RIGHT_LABEL = "from dev"


def not_null_violations(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is NULL."""
    return df.where(F.col(column).isNull())


def unique_violations(df: DataFrame, column: str, per_source: bool = True) -> DataFrame:
    """Key values (within one ``source_relation`` unless ``per_source`` is
    False) that occur more than once, with their count.

    Nearly all keys occur once, so combining them in the map tasks would only fill
    those with a table of all their keys. They are dealt out first, to as many
    tasks as the session has shuffle partitions however small these are, and
    each counts its own share."""
    keys = [SR, column] if per_source and SR in df.columns else [column]
    shares = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.where(F.col(column).isNotNull()).select(*keys).repartition(shares, *keys).groupBy(*keys) \
        .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def _summary(model: str, test: str, column: str, failures: DataFrame) -> DataFrame:
    return failures.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(model).alias("model"), F.lit(test).alias("test"), F.lit(column).alias("column_name"),
        "failures")


def run_tests(models: dict[str, DataFrame], kind: str = "all",
              not_null: Mapping[tuple[str, str], int] | None = None) -> DataFrame:
    """One row per declared test on the models present: model, test,
    column_name, failures (violating rows for not_null, duplicated keys for
    unique).  ``not_null``: failures of (model, column) that are known already,
    counted while the tables were written; they cost no scan."""
    known, parts = dict(not_null or {}), []
    spark = next(iter(models.values())).sparkSession
    if kind in ("all", "not_null"):
        tests = [t for t in NOT_NULL_TESTS if t[0] in models]
        counted = [(m, "not_null", c, known[m, c]) for m, c in tests if (m, c) in known]
        if counted:
            parts.append(spark.createDataFrame(counted, "model string, test string, column_name string, failures long"))
        parts += [_summary(m, "not_null", c, not_null_violations(models[m], c))
                  for m, c in tests if (m, c) not in known]
    if kind in ("all", "unique"):
        parts += [_summary(m, "unique", c, unique_violations(models[m], c))
                  for m, c in UNIQUE_TESTS if m in models]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _expected(raw: dict[str, DataFrame], latest: DataFrame) -> DataFrame:
    """``latest`` for every (source_table, source_relation) that should have data.

    Known for listed connections; for partitioned storage each account that
    any table holds is expected in all of them. Which those are comes from
    ``latest`` (a row per table and account) itself: no table is scanned for it."""
    known = getattr(raw, "accounts", None)
    if known:
        accounts = latest.sparkSession.createDataFrame([(t, a) for t, names in known.items() for a in names],
                                                       f"source_table string, {SR} string")
        return accounts.join(latest, ["source_table", SR], "left")
    held = F.map_from_entries(F.collect_list(F.struct("source_table", "max_loaded_at")))  # an entry per table
    tables = F.explode(F.array(*[F.lit(t) for t in raw])).alias("source_table")
    return (latest.groupBy(SR).agg(held.alias("_held")).select(tables, SR, "_held")
            .select("source_table", SR, F.expr("_held[source_table]").alias("max_loaded_at")))


def freshness(raw: dict[str, DataFrame], synced_column: str, as_of: datetime | None = None,
              warn_after_hours: int = WARN_AFTER_HOURS,
              error_after_hours: int = ERROR_AFTER_HOURS) -> DataFrame:
    """Per raw table and connection: latest sync time and a status
    (pass / warn / error; error when no sync time is known, as in an empty
    table).  ``as_of`` is in UTC (an aware time is converted) and defaults to
    the current time."""
    if as_of is None:
        now = F.expr(utc_sql("current_timestamp()"))
    else:
        if as_of.tzinfo is not None:
            as_of = as_of.astimezone(timezone.utc).replace(tzinfo=None)
        # From text, so neither the Python nor the session time zone shifts it.
        now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    parts = []
    for table, df in raw.items():
        cols = {c.lower(): c for c in df.columns}
        synced = F.col(f"`{cols[synced_column.lower()]}`").cast("timestamp_ntz") \
            if synced_column.lower() in cols else F.lit(None).cast("timestamp_ntz")
        parts.append(df.groupBy(SR).agg(F.max(synced).alias("max_loaded_at"))
                     .select(F.lit(table).alias("source_table"), SR, "max_loaded_at"))
    latest = reduce(lambda a, b: a.unionByName(b), parts)
    out = _expected(raw, latest)
    age_ok = lambda h: F.col("max_loaded_at") >= now - F.make_dt_interval(F.lit(0), F.lit(h))
    status = F.when(F.col("max_loaded_at").isNull(), F.lit("error")) \
        .when(age_ok(warn_after_hours), F.lit("pass")) \
        .when(age_ok(error_after_hours), F.lit("warn")).otherwise(F.lit("error"))
    return out.select("*", status.alias("status"))


def _fingerprints(df: DataFrame, cols: Sequence[str], buckets: int) -> DataFrame:
    """``df`` with ``_bucket``, a number that equal rows share, and two hashes of the row."""
    # a hash passes over NULLs: where they are is hashed too
    values = [x for c in cols for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    hashes = [F.xxhash64(F.lit(seed), *values).alias(f"_h{seed}") for seed in (0, 1)]
    return df.select(*[F.col(f"`{c}`") for c in cols], *hashes).withColumn("_bucket", F.pmod("_h0", F.lit(buckets)))


def differing_buckets(left: DataFrame, right: DataFrame, cols: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """``_bucket`` of the rows in which two tables differ, at most ``buckets`` rows.

    A bucket's fingerprint is its number of rows and the sums of two hashes of
    them, whatever their order. They are added up in the map tasks, so that a
    row per bucket and task is shuffled. Different rows with the same 128 bits
    would go unseen."""
    def prints(df: DataFrame, side: str) -> DataFrame:
        sums = [F.sum(F.col(f"_h{i}").cast("decimal(20,0)")).alias(f"_s{i}") for i in (0, 1)]
        return (_fingerprints(df, cols, buckets).groupBy("_bucket").agg(*sums, F.count("*").alias("_n"))
                .select("_bucket", F.struct("_n", "_s0", "_s1").alias(side)))

    both = prints(left, "_left").join(prints(right, "_right"), "_bucket", "full")
    return both.where(~F.col("_left").eqNullSafe(F.col("_right"))).select("_bucket")


def reconcile(left: DataFrame, right: DataFrame, exclude: Sequence[str] = (),
              left_label: str = LEFT_LABEL, right_label: str = RIGHT_LABEL, buckets: int = BUCKETS) -> DataFrame:
    """Rows of ``left`` not in ``right`` and rows of ``right`` not in
    ``left`` (set difference, duplicates removed), tagged in column
    ``source``.  Empty when the two builds agree.

    In two levels: the fingerprints of ``buckets`` groups of rows tell where the
    builds differ; only the rows of those groups are shuffled and compared, by
    one aggregation over both sides.  Builds that agree shuffle fingerprints
    only.  Rows that compare as equal but hash unlike (of unlike types, say)
    make their groups differ, never the result."""
    cols = [c for c in left.columns if c not in set(exclude)]
    where = F.broadcast(differing_buckets(left, right, cols, buckets))  # ``buckets`` rows at most
    names = [F.col(f"`{c}`") for c in cols]
    sides = [_fingerprints(df, cols, buckets).join(where, "_bucket", "left_semi").select(*names, F.lit(i).alias("_side"))
             for i, df in enumerate((left, right))]
    both = sides[0].unionByName(sides[1]).groupBy(*names).agg(
        F.min("_side").alias("_first"), F.max("_side").alias("_last"))
    label = F.when(F.col("_first") == 0, F.lit(left_label)).otherwise(F.lit(right_label))
    return both.where("_first = _last").select(*names, label.alias("source"))
