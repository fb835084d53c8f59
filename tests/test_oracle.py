"""Spark plans against the DuckDB oracle SQL on the small driver tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import digest  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = ["campaign_recipients", "campaigns", "members", "lists", "segments", "automation_emails",
         "int_automation_activities_by_member", "campaigns_two_sources", "lists_all_off",
         "campaigns_mixed_types_two_sources", "lists_one_account_without_unsubscribes",
         "stg_campaigns", "stg_members", "dq_unique", "dq_freshness_empty_table",
         "dq_reconcile_campaigns", "dq_reconcile_automations", "campaign_recipients_gaps",
         "stg_rejects_garbled_times", "campaign_activities_garbled_times", "members_passthrough"]


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("driver tables not present")
    c = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "orders", "lineitem", "events"):
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    s_rows = [tuple(r) for r in sdf.collect()]
    assert sorted(sdf.columns) == sorted(d_cols)
    assert digest(sdf.columns, s_rows)[0] == digest(d_cols, d_rows)[0]


def test_every_query_has_oracle():
    from inboxlens.plans.registry import spark_queries
    assert set(spark_queries()) <= set(E.oracle_sql())


def test_fixtures_are_whole(spark, con):
    """No raw row is cut, in either account, and no staged column is all NULL."""
    from pyspark.sql import functions as F

    from inboxlens import Options
    from inboxlens.operators.staging import stage_all
    from inboxlens.plans.registry import TWO, sources
    raw = sources(spark, SF, conns=TWO)
    one = lambda sql: con.execute(sql).fetchone()[0]
    events = "from events join customer on user_id = c_custkey where event_type"
    sends = "(select distinct l_suppkey, o_custkey from lineitem join orders on l_orderkey = o_orderkey)"
    expected = {
        "list": one("select count(*) from region"), "automation": one("select count(*) from nation"),
        "segment": one("select count(*) from nation"), "segment_member": one("select count(*) from customer"),
        "member": one("select count(*) + count(*) filter (where c_custkey % 10 = 0) from customer"),
        "unsubscribe": one(f"select count(*) {events} = 'signup'")}
    got = {t: {r[0]: r[1] for r in df.groupBy("source_relation").count().collect()} for t, df in raw.items()}
    for table, n in expected.items():
        assert got[table] == {"conn_a": n, "conn_b": n}, table
    for pair, n in ((("campaign", "automation_email"), one("select (select count(*) from supplier) + (select count(*) from nation)")),
                    (("campaign_recipient", "automation_recipient"), one(f"select count(*) from {sends}")),
                    (("campaign_recipient_activity", "automation_recipient_activity"),
                     one(f"select count(*) {events} in ('view', 'click', 'error')"))):
        for account in ("conn_a", "conn_b"):
            assert sum(got[t][account] for t in pair) == n, pair
    staged = stage_all(raw, Options())
    assert staged.pop("stg_rejects").count() == 0  # all times parse
    for name, df in staged.items():
        filled = df.select([F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first().asDict()
        assert all(filled.values()), (name, [c for c, n in filled.items() if not n])


@pytest.mark.parametrize("name", ["dq_not_null_gaps", "dq_unique_gaps", "dq_reconcile_segments"])
def test_checks_with_something_to_find(spark, con, name):
    """Failing keys and changed rows: a check that always says 0 would not match."""
    rows = E.queries()[name](spark, SF).collect()
    found = [r for r in rows if name == "dq_reconcile_segments" or r.failures]
    assert len(found) >= {"dq_not_null_gaps": 8, "dq_unique_gaps": 3, "dq_reconcile_segments": 10}[name]
    expected = con.execute(E.oracle_sql()[name]).fetchall()
    assert len(rows) == len(expected)
    if name != "dq_reconcile_segments":
        assert sorted(map(tuple, rows)) == sorted(expected)


def test_pass_through_keeps_every_member(spark, tmp_path):
    """Members without an id have their pass-through columns too, and none comes more often than it is stored."""
    rows = {
        "region": "select * from (values (0::int, 'AFRICA'), (1, 'ASIA')) t(r_regionkey, r_name)",
        "nation": "select * from (values (0::int, 'KENYA', 0::int), (1, 'INDIA', 1)) t(n_nationkey, n_name, n_regionkey)",
        "customer": "select * from (values (10::bigint, 0::int, 1.5::double), (10, 1, 2.5), (11, 1, 9500.0), (null, 0, 3.5), "
                    "(null, 1, 4.5)) t(c_custkey, c_nationkey, c_acctbal)",
        "supplier": "select * from (values (1::bigint, 'Supplier 1', 0::int), (2, 'Supplier 2', 1)) t(s_suppkey, s_name, s_nationkey)",
        "orders": "select * from (values (1::bigint, 10::bigint, timestamp '2024-01-01'), (2, 11, timestamp '2024-01-02')) "
                  "t(o_orderkey, o_custkey, o_orderdate)",
        "lineitem": "select * from (values (1::bigint, 1::bigint), (1, 2), (2, 2)) t(l_orderkey, l_suppkey)",
        "events": "select * from (values (1::bigint, timestamp '2024-01-03', 10::bigint, 'view'), (2, timestamp '2024-01-04', 11, 'signup')) "
                  "t(event_id, ts, user_id, event_type)"}
    con = duckdb.connect()
    for t, sql in rows.items():
        con.execute(f"copy ({sql}) to '{tmp_path}/{t}.parquet' (format parquet)")
        con.execute(f"create view {t} as select * from read_parquet('{tmp_path}/{t}.parquet')")
    df = E.queries()["members_passthrough"](spark, str(tmp_path))
    res = con.execute(E.oracle_sql()["members_passthrough"])
    cols, expected = [c[0] for c in res.description], res.fetchall()
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(expected) == 7  # five customers, and two of them on a second list
    assert sum(r[cols.index("member_id")] is None for r in expected) == 2
    assert digest(df.columns, got)[0] == digest(cols, expected)[0]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "unique_opens" in df.columns
