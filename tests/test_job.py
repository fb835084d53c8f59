import pytest
from seed_rows import seed_tables

from inboxlens.__main__ import main
from inboxlens.session import RECOMMENDED_CONF


def test_job_builds_writes_and_checks(spark, tmp_path):
    raw_root = tmp_path / "raw"
    for name, df in seed_tables(spark).items():
        df.write.parquet(str(raw_root / ("lists_v2" if name == "list" else name)))
    target = tmp_path / "marts"
    written = main(["--connection", f"acct={raw_root}", "--target", str(target), "--check",
                    "--no-staging", "--table-name", "list=lists_v2"], spark=spark)
    camp = spark.read.parquet(written["campaigns"]).first()
    assert (camp.source_relation, camp.sends, camp.unique_opens) == ("acct", 8, 5)
    tests = spark.read.parquet(written["_checks_tests"])
    assert tests.count() == 30 and tests.where("failures > 0").count() == 0
    fresh = spark.read.parquet(written["_checks_freshness"]).collect()
    assert {r.status for r in fresh} == {"error"}  # seeds carry no sync time


def test_job_reconciles_with_previous_build(spark, tmp_path):
    from pyspark.sql import functions as F
    raw_root = tmp_path / "raw"
    tables = seed_tables(spark)
    for name, df in tables.items():
        df.write.parquet(str(raw_root / name))
    first = main(["--connection", f"acct={raw_root}", "--target", str(tmp_path / "v1"),
                  "--no-staging"], spark=spark)
    # a second build over changed raw events
    raw2 = tmp_path / "raw2"
    for name, df in tables.items():
        if name == "campaign_recipient_activity":
            df = df.where(F.col("action") == "open")
        df.write.parquet(str(raw2 / name))
    second = main(["--connection", f"acct={raw2}", "--target", str(tmp_path / "v2"),
                   "--no-staging", "--reconcile-with", str(tmp_path / "v1")], spark=spark)
    diff = spark.read.parquet(second["_checks_reconcile_campaigns"]).collect()
    assert sorted((r.source, r.clicks) for r in diff) == [("from dev", 0), ("from prod", 3)]
    assert spark.read.parquet(second["_checks_reconcile_automations"]).count() == 0
    assert second["_checks_reconcile_segments"].endswith("v2/_checks/reconcile_segments")
    assert first["campaigns"] != second["campaigns"]


def test_job_reads_partitioned_accounts(spark, tmp_path):
    from pyspark.sql import functions as F
    root = tmp_path / "raw"
    for name, df in seed_tables(spark).items():
        df.withColumn("source_relation", F.lit("x")).unionByName(
            df.withColumn("source_relation", F.lit("y"))) \
            .write.partitionBy("source_relation").parquet(str(root / name))
    written = main(["--partitioned", str(root), "--target", str(tmp_path / "m"), "--no-staging",
                    "--partition-by-source"], spark=spark)
    camps = spark.read.parquet(written["campaigns"])
    assert sorted((r.source_relation, r.sends) for r in camps.collect()) == [("x", 8), ("y", 8)]


def test_job_flags(spark, tmp_path):
    for account in ("x", "y"):
        for name, df in seed_tables(spark).items():
            if name == "member":
                df = df.selectExpr("*", "timestamp_signup as _synced")
            if (account, name) != ("y", "unsubscribe"):
                df.write.parquet(str(tmp_path / account / ("people" if (account, name) == ("y", "member") else name)))
    old = {k: spark.conf.get(k) for k in RECOMMENDED_CONF}
    try:
        written = main(["--connection", f"x={tmp_path}/x", "--connection", f"y={tmp_path}/y",
                        "--target", str(tmp_path / "m"), "--recommended-conf", "--check", "--no-staging",
                        "--table-name", "y.member=people", "--absent", "y=unsubscribe",
                        "--member-column", "merge_fname:alias=first_name", "--member-column", "points:type=bigint",
                        "--member-column", "status:alias=st:sql=upper(status)",
                        "--warn-after-hours", "1", "--error-after-hours", "10", "--as-of", "2022-03-31T12:00:00"], spark=spark)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    members = spark.read.parquet(written["members"])
    assert dict(members.dtypes)["points"] == "bigint" and members.count() == 16
    assert {(r.st, r.first_name) for r in members.collect()} >= {("SUBSCRIBED", "Ana"), ("UNSUBSCRIBED", None)}
    fresh = {(r.source_table, r.source_relation): r.status for r in spark.read.parquet(written["_checks_freshness"]).collect()}
    assert fresh["member", "x"] == fresh["member", "y"] == "warn" and ("unsubscribe", "y") not in fresh


def test_job_rejects_unknown_accounts(spark, tmp_path):
    with pytest.raises(SystemExit, match="no such account: z"):
        main(["--connection", f"x={tmp_path}", "--target", "t", "--absent", "z=list"], spark=spark)
