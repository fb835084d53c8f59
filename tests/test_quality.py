from datetime import datetime as T, timedelta, timezone

from helpers import build_from
from pyspark.sql import functions as F
from seed_rows import CAMPAIGN, L1, seed_tables

from inboxlens import ABSENT, Connection, read_sources
from inboxlens.operators import quality
from inboxlens.sources import read_partitioned_sources


def test_not_null_and_unique(spark):
    extra = {"campaign": [(None, L1, None, None, None, None)],
             "campaign_recipient_activity": [
                 ("click", CAMPAIGN, "bo", T(2022, 3, 4, 23, 1, 0), L1, "https://other")]}
    out = build_from(spark, seed_tables(spark, extra))
    res = {(r.model, r.test, r.column_name): r.failures for r in quality.run_tests(out).collect()}
    assert res[("stg_campaigns", "not_null", "campaign_id")] == 1
    assert res[("campaigns", "not_null", "campaign_id")] == 1
    # two clicks in the same second on different urls share an activity_id
    assert res[("stg_campaign_activities", "unique", "activity_id")] == 1
    assert res[("stg_lists", "unique", "list_id")] == 0
    assert len(res) == 30


def test_freshness_status(spark):
    t = seed_tables(spark)
    t["member"] = t["member"].selectExpr("*", "timestamp_signup as _synced")
    raw = read_sources(spark, [Connection("a", t)])
    res = {r.source_table: (r.max_loaded_at, r.status)
           for r in quality.freshness(raw, "_synced", T(2022, 4, 2)).collect()}
    assert res["member"] == (T(2022, 3, 31, 6, 0), "pass")
    assert res["campaign"] == (None, "error")
    late = {r.source_table: r.status
            for r in quality.freshness(raw, "_synced", T(2022, 4, 5)).collect()}
    assert late["member"] == "warn"
    assert {r.status for r in quality.freshness(raw, "_synced", T(2022, 4, 9)).collect()} == {"error"}


def test_reconcile(spark):
    a = build_from(spark, seed_tables(spark))["campaigns"]
    assert quality.reconcile(a, a).count() == 0
    extra = {"campaign_recipient_activity": [("open", CAMPAIGN, "fay", T(2022, 3, 7), L1, None)]}
    b = build_from(spark, seed_tables(spark, extra))["campaigns"]
    r = quality.reconcile(a, b).collect()
    assert sorted((x.source, x.opens) for x in r) == [("from dev", 8), ("from prod", 7)]
    assert quality.reconcile(a, b, exclude=["opens", "unique_opens"]).count() == 0


def test_freshness_ignores_session_time_zone(spark):
    t = seed_tables(spark)
    t["member"] = t["member"].selectExpr("*", "timestamp_signup as _synced")
    raw = read_sources(spark, [Connection("a", t)])
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        got = []
        for tz in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            got.append({r.source_table: r.status for r in
                        quality.freshness(raw, "_synced", T(2022, 4, 3, 6, 0)).collect()}["member"])
        assert got == ["pass"] * 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_freshness_of_zoned_times_and_empty_tables(spark):
    t = seed_tables(spark)
    old = spark.conf.get("spark.sql.session.timeZone")
    got = []
    try:
        for zone in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            t["member"] = spark.sql("select timestamp'2022-03-31 06:00:00 UTC' as _synced, 'x' as id")
            t["list"] = t["list"].limit(0)
            raw = read_sources(spark, [Connection("a", t), Connection("B", {**t, "segment": ABSENT})])
            as_of = T(2022, 4, 3, 8, 0, tzinfo=timezone(timedelta(hours=2)))
            rows = quality.freshness(raw, "_synced", as_of).collect()
            got.append({(r.source_table, r.source_relation): r.status for r in rows})
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got[0] == got[1] == got[2]
    assert got[0]["member", "a"] == got[0]["member", "b"] == "pass"  # exactly 72 hours
    assert got[0]["list", "a"] == "error" and ("segment", "b") not in got[0]
    assert len(got[0]) == 23


def test_freshness_of_partitioned_accounts(spark, tmp_path):
    from inboxlens.sources import read_partitioned_sources
    for name, df in seed_tables(spark).items():
        both = df.selectExpr("*", "'x' as source_relation")
        if name != "unsubscribe":
            both = both.union(df.selectExpr("*", "'y' as source_relation"))
        both.write.partitionBy("source_relation").parquet(str(tmp_path / name))
    raw = read_partitioned_sources(spark, str(tmp_path))
    got = {(r.source_table, r.source_relation): r.status for r in quality.freshness(raw, "_synced").collect()}
    assert len(got) == 24 and got["unsubscribe", "y"] == "error"


def test_builds_that_agree_shuffle_their_fingerprints_only(spark):
    """A row per bucket, side and map task reaches the comparison of fingerprints;
    none of the rows do."""
    from test_plans import _shuffled
    rows = spark.range(0, 200_000, 1, 4).selectExpr("id", "repeat(cast(id as string), 20) as text", "if(id % 3 = 0, null, id) as n")
    same = rows.orderBy("text").repartition(5)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        prints = _shuffled(quality.differing_buckets(rows, same, rows.columns, 16), "hashpartitioning(_bucket")
        compared = _shuffled(quality.reconcile(rows, same, buckets=16), "hashpartitioning(id, text, n")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert len(prints) == 2 and max(sum(p) for p in prints) < 16 * 8 * 100  # bytes
    assert sum(map(sum, compared)) == 0


def test_reconcile_finds_any_single_difference(spark):
    from pyspark.sql import functions as F
    rows = spark.sql("select id, cast(null as int) as a, 1 as b, 'x' as t from range(300)")
    with_one = lambda sql: rows.where("id <> 7").unionByName(rows.where("id = 7").selectExpr(*sql.split(", ")))
    for sql in ("id, 1 as a, cast(null as int) as b, t", "id, a, 2 as b, t", "id, a, b, '' as t", "id, a, b, cast(null as string) as t",
                "id + 1000 as id, a, b, t"):
        got = quality.reconcile(rows, with_one(sql), buckets=5).collect()
        assert sorted(r.source for r in got) == ["from dev", "from prod"], sql
    # rows that occur more than once are one row, and unlike types compare by value
    twice = rows.unionByName(rows.where("id = 7"))
    assert quality.reconcile(rows, twice).count() == quality.reconcile(twice, rows).count() == 0
    assert quality.reconcile(rows, rows.withColumn("id", F.col("id").cast("int"))).count() == 0
    empty = rows.limit(0)
    assert quality.reconcile(empty, empty).count() == 0 and quality.reconcile(rows, empty).count() == 300


def test_unique_is_per_connection(spark):
    from inboxlens import build
    t = seed_tables(spark)
    out = build(read_sources(spark, [Connection("a", t), Connection("b", t)]))
    res = {(r.model, r.column_name): r.failures for r in quality.run_tests(out, "unique").collect()}
    assert res[("stg_lists", "list_id")] == 0
    assert quality.unique_violations(out["stg_lists"], "list_id", per_source=False).count() == 2


def test_freshness_of_stored_accounts_reads_each_table_once(spark, tmp_path):
    """Which accounts there are comes from the same scan as their latest sync times."""
    for name, df in seed_tables(spark).items():
        for i, account in ((1, "acct_a"), (9, "acct_b")):
            if (name, account) != ("segment", "acct_a"):
                df.withColumn("_synced", F.lit(T(2024, 1, i)).cast("timestamp_ntz")).write.parquet(
                    str(tmp_path / name / f"source_relation={account}"))
    got = quality.freshness(read_partitioned_sources(spark, str(tmp_path)), "_synced", T(2024, 1, 10))
    status = {(r.source_table, r.source_relation): r.status for r in got.collect()}
    assert len(status) == 24 and status["member", "acct_a"] == "error" and status["member", "acct_b"] == "pass"
    assert status["segment", "acct_a"] == "error"  # an account without rows in a table
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan[:plan.find("== Initial Plan ==")].count("FileScan parquet") == 12


def test_unique_test_fills_no_table_of_keys_before_the_shuffle(spark):
    """The keys are dealt out as they are, to all shuffle partitions, and each repeated one is still found once."""
    rows = [("a", f"k{i}") for i in range(50)] + [("a", "k1"), ("a", "k1"), ("b", "k1"), ("a", None), ("a", None), (None, "n"), (None, "n")]
    found = quality.unique_violations(spark.createDataFrame(rows, "source_relation string, key string"), "key")
    plan = found._jdf.queryExecution().executedPlan().toString()
    shuffled = plan[plan.index("Exchange hashpartitioning"):]
    assert f", {spark.conf.get('spark.sql.shuffle.partitions')}), REPARTITION_BY_NUM" in shuffled
    assert "Aggregate" not in shuffled
    assert sorted(map(str, found.collect())) == ["Row(source_relation='a', key='k1', n_records=3)", "Row(source_relation=None, key='n', n_records=2)"]
