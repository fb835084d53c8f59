import hashlib
from datetime import datetime

from pyspark.sql import functions as F

from inboxlens.functions import boundary_diff, surrogate_key


def test_boundary_diff_counts_crossed_boundaries(spark):
    df = spark.createDataFrame(
        [(datetime(2022, 3, 4, 22, 58, 40), datetime(2022, 3, 4, 23, 58, 59)),
         (datetime(2022, 3, 4, 22, 58, 40), datetime(2022, 3, 8, 5, 30, 15)),
         (datetime(2022, 3, 4, 22, 58, 40), datetime(2022, 3, 4, 22, 57, 0)),
         (datetime(2020, 1, 1, 0, 0, 0), None)],
        "a timestamp_ntz, b timestamp_ntz")
    out = df.select(*[boundary_diff(u, "a", "b").alias(u) for u in ("minute", "hour", "day")]).collect()
    assert [tuple(r) for r in out] == [(60, 1, 0), (4712, 79, 4), (-1, 0, 0), (None, None, None)]


def test_boundary_diff_ignores_session_time_zone(spark):
    df = spark.createDataFrame([(datetime(2021, 3, 14, 1, 30), datetime(2021, 3, 14, 3, 10))],
                               "a timestamp_ntz, b timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        res = []
        for tz in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            res.append(tuple(df.select(boundary_diff("minute", "a", "b"),
                                       boundary_diff("hour", "a", "b")).first()))
        assert res == [(100, 2)] * 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_surrogate_key_matches_md5_text(spark):
    df = spark.createDataFrame([("a", None, 3)], "x string, y string, z int")
    got = df.select(surrogate_key("x", "y", "z")).first()[0]
    want = hashlib.md5(b"a-_dbt_utils_surrogate_key_null_-3").hexdigest()
    assert got == want


def test_surrogate_key_timestamp_text(spark):
    df = spark.createDataFrame([(datetime(2020, 1, 1, 0, 0, 0, 120000),)], "t timestamp_ntz")
    got = df.select(surrogate_key("t", F.lit("x"))).first()[0]
    assert got == hashlib.md5(b"2020-01-01 00:00:00.12-x").hexdigest()


def test_boundary_diff_column_and_name_forms_agree(spark):
    df = spark.createDataFrame([(datetime(2022, 3, 4, 23, 59, 59), datetime(2022, 3, 5, 0, 0, 1))],
                               "a timestamp_ntz, b timestamp_ntz")
    for u in ("minute", "hour", "day"):
        by_name, by_col = df.select(boundary_diff(u, "a", "b"),
                                    boundary_diff(u, F.col("a"), F.col("b"))).first()
        assert by_name == by_col == 1
