import pytest
from helpers import build_from
from seed_rows import seed_tables

from inboxlens import OUTPUTS, Connection, Options, PassThrough, read_build, read_sources
from inboxlens.__main__ import main
from inboxlens.plans.comments import column_comment, table_comment
from inboxlens.plans.write import write_build


def comments(df):
    return {f.name: f.metadata.get("comment") for f in df.schema.fields}


def test_every_column_of_the_model_has_a_comment(spark):
    for name, df in build_from(spark, seed_tables(spark)).items():
        if not name.startswith("int_"):
            assert table_comment(name), name
        assert [c for c in df.columns if not column_comment(name, c)] == [], name


def test_comments_follow_the_columns_meaning():
    assert column_comment("members", "campaign_unique_opens") == "Distinct members that opened, campaigns only"
    assert column_comment("campaign_activities", "time_since_send_hours") == "Whole hours crossed from the campaign's send to the event"
    assert column_comment("stg_automation_activities", "activity_id") != column_comment("campaign_activities", "activity_id")
    assert column_comment("members", "favourite_colour") is None


def test_folder_build_reads_back_with_comments(spark, tmp_path):
    raw = read_sources(spark, [Connection("a", seed_tables(spark))])
    write_build(spark, raw, str(tmp_path / "m"), staging=False)
    stored = read_build(spark, str(tmp_path / "m"))
    for name in OUTPUTS:
        assert all(comments(stored[name]).values()), name


@pytest.mark.parametrize("two_part", [False, True])
def test_catalog_in_and_out(spark, two_part):
    """Raw tables read by database or catalog.database; tables and views of the build carry comments."""
    for db in ("raw_t", "told", "told_stg"):
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    spark.sql("CREATE DATABASE raw_t")
    try:
        for name, df in seed_tables(spark).items():
            df.write.saveAsTable(f"raw_t.{name}")
        place = "spark_catalog.raw_t" if two_part else "raw_t"
        main(["--catalog", f"acct={place}", "--target", "told", "--database", "told", "--member-column", "merge_fname"], spark=spark)
        stored = read_build(spark, database="told")
        assert stored["campaigns"].first().sends == 8
        for df in (stored["campaigns"], spark.table("told.campaigns"), spark.table("told_stg.stg_members")):
            kept = comments(df)
            assert kept.pop("merge_fname", None) is None and all(kept.values())
        told = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED told.campaigns").collect()}
        assert told["Comment"] == table_comment("campaigns")
        assert column_comment("campaigns", "sends") == {r.col_name: r.comment for r in spark.sql("DESCRIBE told.campaigns").collect()}["sends"]
    finally:
        for db in ("raw_t", "told", "told_stg"):
            spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
