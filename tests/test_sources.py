import re

from pyspark.sql import functions as F

from helpers import build_from, metrics, rows_by
from seed_rows import CAMPAIGN, L1, seed_tables

from inboxlens import ABSENT, OUTPUTS, Connection, Options, PassThrough, build, read_sources
from inboxlens.sources import union_connections
from inboxlens.sources.fixtures import fixture_sources


def test_two_connections_keep_results_apart(spark):
    t = seed_tables(spark)
    raw = read_sources(spark, [Connection("Acct_A", t), Connection("acct_b", t)])
    out = build(raw)
    single = build_from(spark, t, name="acct_a")
    for name in ("campaigns", "lists", "members", "automations", "segments"):
        both = sorted(tuple(r) for r in out[name].where("source_relation = 'acct_a'").collect())
        one = sorted(tuple(r) for r in single[name].collect())
        assert both == one, name
        assert out[name].count() == 2 * single[name].count()


def test_source_casing(spark):
    t = seed_tables(spark)
    kept = build_from(spark, t, Options(source_casing=True), name="Acct_A")
    assert {r[0] for r in kept["lists"].select("source_relation").collect()} == {"Acct_A"}
    folded = build_from(spark, t, name="Acct_A")
    assert {r[0] for r in folded["lists"].select("source_relation").collect()} == {"acct_a"}


def union(spark, table, *frames):
    dfs = [(n, spark.createDataFrame(rows, ddl)) for n, rows, ddl in frames]
    both = [union_connections(order, Options(), table) for order in (dfs, dfs[::-1])]
    assert dict(both[0].dtypes) == dict(both[1].dtypes)
    cols = sorted(both[0].columns)
    got = [sorted(map(tuple, u.select(cols).collect()), key=repr) for u in both]
    assert got[0] == got[1]  # whatever the order of the accounts
    return dict(both[0].dtypes), got[0]


def test_union_never_narrows(spark):
    types, rows = union(spark, "campaign", ("a", [(1, 7)], "id int, segment_id int"),
                        ("b", [("x1", 2**40)], "id string, segment_id bigint"))
    assert types == {"source_relation": "string", "id": "string", "segment_id": "bigint"}
    assert rows == [("1", 7, "a"), ("x1", 2**40, "b")]
    types, rows = union(spark, "campaign", ("a", [(1, 1.5)], "wait_time int, own float"),
                        ("b", [("soon", 2)], "wait_time string, own int"))
    assert types["wait_time"] == "string" and types["own"] == "double"
    # undeclared: the wider type; where none holds both exactly, text
    types, rows = union(spark, "campaign", ("a", [(2**53 + 1, True)], "own bigint, flag boolean"),
                        ("b", [(0.5, "no")], "own double, flag string"))
    assert types["own"] == "string" and types["flag"] == "string"
    assert sorted(r[1] for r in rows) == ["0.5", str(2**53 + 1)]
    types, _ = union(spark, "list", ("a", [(1,)], "id bigint"), ("b", [(2,)], "id int"))
    assert types["id"] == "string"  # declared as text


def test_accounts_without_a_table(spark):
    import pytest
    t = seed_tables(spark)
    less = {**t, "unsubscribe": ABSENT}
    raw = read_sources(spark, [Connection("a", t), Connection("b", less)])
    out = build(raw)
    unsubs = {r.source_relation: r.automation_unsubscribes for r in out["lists"].collect() if r.list_id == L1}
    assert unsubs == {"a": 1, "b": 0}
    assert raw.accounts["unsubscribe"] == ["a"] and raw.accounts["list"] == ["a", "b"]
    with pytest.raises(KeyError, match="no connection has"):
        read_sources(spark, [Connection("b", less)])


def test_zoned_timestamps_do_not_depend_on_the_session_zone(spark, tmp_path):
    t = seed_tables(spark)
    old = spark.conf.get("spark.sql.session.timeZone")
    got = []
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        for name, df in t.items():  # wall-clock times as instants of UTC
            df.selectExpr(*[f"cast(`{f.name}` as timestamp) as `{f.name}`"
                            if f.dataType.simpleString() == "timestamp_ntz" else f"`{f.name}`"
                            for f in df.schema.fields]).write.parquet(str(tmp_path / name))
        for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            raw = read_sources(spark, [Connection.from_directory("conn_a", str(tmp_path))])
            out = build(raw)
            got.append([sorted(map(tuple, out[n].collect()), key=repr) for n in (
                "stg_unsubscribes", "stg_automation_activities", "campaign_activities", "members")])
            assert dict(out["stg_unsubscribes"].dtypes)["unsubscribe_timestamp"] == "timestamp_ntz"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    plain = build_from(spark, t)
    assert got[0] == got[1] == got[2]
    assert got[0][2] == sorted(map(tuple, plain["campaign_activities"].collect()), key=repr)


def test_absent_columns_are_typed_nulls(spark):
    out = build_from(spark, seed_tables(spark))
    types = dict(out["campaigns"].dtypes)
    assert types["winner_criteria"] == "string" and types["test_size"] == "bigint"
    assert types["create_timestamp"] == "timestamp_ntz" and types["authenticate"] == "boolean"
    assert out["campaigns"].where(F.col("archive_url").isNotNull()).count() == 0


def test_switches_remove_models_and_columns(spark):
    t = seed_tables(spark)
    off = Options(using_automations=False, using_segments=False, using_unsubscribes=False)
    out = build_from(spark, {k: v for k, v in t.items()
                             if k not in ("automation", "automation_email", "automation_recipient",
                                          "automation_recipient_activity", "segment",
                                          "segment_member", "unsubscribe")}, off)
    assert set(OUTPUTS) - set(out) == {"automation_activities", "automation_emails", "automations",
                                       "segments"}
    assert not [c for c in out["lists"].columns if c.startswith("automation_") or c.endswith("unsubscribes")]
    assert "was_unsubscribed" not in out["campaign_recipients"].columns
    assert metrics(rows_by(out["campaigns"], "campaign_id")[CAMPAIGN], unsub=False) == (8, 7, 3, 5, 2)
    no_seg = build_from(spark, t, Options(using_segments=False))
    assert "segments" not in no_seg and "int_campaign_activities_by_segment" not in no_seg
    assert "int_automation_activities_by_segment" in no_seg


def test_pass_through_columns(spark):
    o = Options(member_pass_through=(PassThrough("merge_fname", alias="first_name"),
                                     PassThrough("merge_lname"),
                                     PassThrough("status", alias="st", transform_sql="upper(status)")))
    out = build_from(spark, seed_tables(spark), o)
    m = out["members"]
    assert {"first_name", "merge_lname", "st"} <= set(m.columns)
    assert {r.first_name for r in m.collect()} >= {"Ana", "Cy", None}
    assert {r.st for r in m.collect()} == {"SUBSCRIBED", "UNSUBSCRIBED"}
    assert dict(m.dtypes)["merge_lname"] == "string"


def test_empty_inputs_give_empty_outputs(spark):
    t = {k: v.limit(0) for k, v in seed_tables(spark).items()}
    out = build_from(spark, t)
    for name in OUTPUTS:
        assert out[name].count() == 0, name


def test_connection_from_directory(spark, tmp_path):
    t = seed_tables(spark)
    for name, df in t.items():
        df.write.parquet(str(tmp_path / name))
    raw = read_sources(spark, [Connection.from_directory("dir", str(tmp_path))])
    out = build(raw)
    assert metrics(rows_by(out["campaigns"], "campaign_id")[CAMPAIGN]) == (8, 7, 3, 5, 2, 0)
    assert rows_by(out["lists"], "list_id")[L1]["count_members"] == 7


def test_location_overrides_and_catalog(spark, tmp_path):
    t = seed_tables(spark)
    for name, df in t.items():
        stored = "mc_" + name if name == "member" else name
        df.write.parquet(str(tmp_path / stored))
    raw = read_sources(spark, [Connection.from_directory("d", str(tmp_path),
                                                         overrides={"member": "mc_member"})])
    assert rows_by(build(raw)["lists"], "list_id")[L1]["count_members"] == 7
    for name, df in t.items():
        df.createOrReplaceGlobalTempView(f"inboxlens_t_{name}")
    conn = Connection.from_catalog("cat", "global_temp",
                                   overrides={n: f"inboxlens_t_{n}" for n in t})
    out = build(read_sources(spark, [conn]))
    assert metrics(rows_by(out["campaigns"], "campaign_id")[CAMPAIGN]) == (8, 7, 3, 5, 2, 0)


def test_partitioned_storage_of_many_accounts(spark, tmp_path):
    from inboxlens.sources import read_partitioned_sources
    t = seed_tables(spark)
    for name, df in t.items():
        both = df.withColumn("source_relation", F.lit("Acct_A")).unionByName(
            df.withColumn("source_relation", F.lit("acct_b")))
        both.write.partitionBy("source_relation").parquet(str(tmp_path / name))
    out = build(read_partitioned_sources(spark, str(tmp_path)))
    listed = build(read_sources(spark, [Connection("acct_a", t), Connection("acct_b", t)]))
    for name in ("campaigns", "members", "lists", "automations", "segments"):
        got = sorted(tuple(r) for r in out[name].select(*listed[name].columns).collect())
        want = sorted(tuple(r) for r in listed[name].collect())
        assert got == want, name
    one = out["campaigns"].where("source_relation = 'acct_b'")
    assert one.count() == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    # the account filter prunes partitions of the scans
    assert re.search(r"PartitionFilters: \[[^\]]*lower\(source_relation#\d+\) = acct_b", plan)


def test_pass_through_name_clash_is_rejected(spark):
    import pytest
    for column in (PassThrough("status"), PassThrough("x", alias="campaign_sends"),
                   PassThrough("automation_opens")):
        with pytest.raises(ValueError, match="duplicate"):
            build_from(spark, seed_tables(spark), Options(member_pass_through=(column,)))


def test_pass_through_takes_any_type(spark):
    o = Options(member_pass_through=(PassThrough("points", datatype="bigint"),
                                     PassThrough("born", datatype="date"),
                                     PassThrough("tags", datatype="array<string>")))
    types = dict(build_from(spark, seed_tables(spark), o)["members"].dtypes)
    assert (types["points"], types["born"], types["tags"]) == ("bigint", "date", "array<string>")


def test_clear_errors_for_missing_inputs(spark, tmp_path):
    import pytest
    from inboxlens.sources import read_partitioned_sources
    t = seed_tables(spark)
    del t["unsubscribe"]
    with pytest.raises(KeyError, match="no 'unsubscribe' table"):
        read_sources(spark, [Connection("a", t)])
    off = Options(using_unsubscribes=False)
    raw = read_sources(spark, [Connection("a", t)], off)
    assert "stg_unsubscribes" not in build(raw, off)
    with pytest.raises(ValueError, match="raw tables missing: unsubscribe"):
        build(raw)
    for name, df in seed_tables(spark).items():
        df.write.parquet(str(tmp_path / name))
    with pytest.raises(ValueError, match="not partitioned by source_relation"):
        read_partitioned_sources(spark, str(tmp_path))


def test_csv_sources_with_header_and_schemas(spark, tmp_path):
    t = seed_tables(spark)
    for name, df in t.items():
        df.write.option("header", "true").csv(str(tmp_path / name))
    # timestamps typed through per-table schemas; everything else read as text
    ddl = {name: ", ".join(f"`{f.name}` {'timestamp_ntz' if f.dataType.simpleString() == 'timestamp_ntz' else 'string'}"
                           for f in df.schema.fields) for name, df in t.items()}
    conn = Connection.from_directory("csv", str(tmp_path), fmt="csv",
                                     reader_options={"header": "true"}, table_schemas=ddl)
    out = build(read_sources(spark, [conn]))
    assert metrics(rows_by(out["campaigns"], "campaign_id")[CAMPAIGN]) == (8, 7, 3, 5, 2, 0)
    lists = rows_by(out["lists"], "list_id")
    assert lists[L1]["count_members"] == 7
    assert str(lists[L1]["most_recent_signup_timestamp"]) == "2022-03-30 17:45:12"


def test_connection_names_with_quotes_survive(spark):
    name = "O'Brien \\ Co"
    out = build_from(spark, seed_tables(spark), Options(source_casing=True), name=name)
    assert {r[0] for r in out["campaigns"].select("source_relation").collect()} == {name}
    folded = build_from(spark, seed_tables(spark), name=name)
    assert {r[0] for r in folded["lists"].select("source_relation").collect()} == {name.lower()}


def test_odd_column_names_are_quoted(spark):
    t = seed_tables(spark)
    t["member"] = t["member"].selectExpr("*", "merge_fname AS `first name`",
                                         "status AS `odd``name`")
    o = Options(member_pass_through=(PassThrough("first name", alias="first"),
                                     PassThrough("odd`name", alias="odd name")))
    m = build_from(spark, t, o)["members"]
    assert {"first", "odd name"} <= set(m.columns)
    assert {r["odd name"] for r in m.collect()} == {"subscribed", "unsubscribed"}
    assert "first name" not in m.columns


def test_many_listed_accounts_are_one_scan_a_table(spark, tmp_path):
    """200 folders, two file schemas in one of the five tables: 6 scans, the rows of the union."""
    import shutil
    from inboxlens.sources import read_sources as read
    names = [f"acct_{i}" for i in range(200)]
    off = Options(using_automations=False, using_segments=False, using_unsubscribes=False)
    for table, df in seed_tables(spark).items():
        if table in ("list", "member") or table.startswith("campaign"):
            df.coalesce(1).write.parquet(str(tmp_path / "acct_0" / table))
    other = tmp_path / "other"
    spark.read.parquet(str(tmp_path / "acct_0" / "list")).withColumn("list_rating", F.lit("five")).drop("visibility").coalesce(1).write.parquet(str(other))
    for name in names[1:]:
        shutil.copytree(tmp_path / "acct_0", tmp_path / name)
    for name in names[150:]:
        shutil.rmtree(tmp_path / name / "list")
        shutil.copytree(other, tmp_path / name / "list")
    conns = [Connection.from_directory(n, str(tmp_path / n)) for n in names]
    raw = read(spark, conns, off)
    scans = {t: len(re.findall("FileScan", df._jdf.queryExecution().executedPlan().toString())) for t, df in raw.items()}
    assert sum(scans.values()) == 6 and scans["list"] == 2
    few = conns[148:152]  # against the union of frames, a scan each
    together = read(spark, few, off)
    apart = read(spark, [Connection(c.name, {t: c.read(spark, t) for t in raw}) for c in few], off)
    for table in raw:
        assert dict(together[table].dtypes) == dict(apart[table].dtypes), table
        columns = apart[table].columns
        assert sorted(map(repr, together[table].select(columns).collect())) == sorted(map(repr, apart[table].collect())), table
    counts = {r.source_relation: r["count"] for r in raw["campaign_recipient"].groupBy("source_relation").count().collect()}
    assert counts == {n: 8 for n in names}
    assert raw.accounts["list"] == names
    assert {r.list_rating for r in raw["list"].where("source_relation = 'acct_199'").collect()} == {"five"}


def test_folders_with_odd_names_shared_and_nested(spark, tmp_path):
    from inboxlens.sources import read_sources as read
    tables = seed_tables(spark)
    roots = {"a b": tmp_path / "a b%", "deep": tmp_path / "x" / "y" / "deep", "twin": tmp_path / "a b%"}
    for root in {str(r): r for r in roots.values()}.values():
        for table, df in tables.items():
            df.write.parquet(str(root / table / "part=1" if table == "member" else root / table))
    raw = read(spark, [Connection.from_directory(n, f"{r}/") for n, r in roots.items()])
    for table, df in tables.items():
        n = df.count()
        assert {r.source_relation: r["count"] for r in raw[table].groupBy("source_relation").count().collect()} == ({x: n for x in roots} if n else {})


def test_times_that_do_not_parse_are_rejected_not_fatal(spark):
    t = seed_tables(spark)
    t["campaign"] = t["campaign"].withColumn("send_time", F.lit("soon"))
    t["campaign_recipient_activity"] = t["campaign_recipient_activity"].withColumn(
        "timestamp", F.when(F.col("member_id") == "bo", "31/12/2022").otherwise(F.col("timestamp").cast("string")))
    out = build_from(spark, t)
    rejects = out["stg_rejects"].collect()
    bad = t["campaign_recipient_activity"].where("member_id = 'bo'").count()
    assert {(r.source_table, r.column_name, r.raw_value) for r in rejects} == {
        ("campaign", "send_time", "soon"), ("campaign_recipient_activity", "timestamp", "31/12/2022")}
    assert len(rejects) == 1 + bad and {r.row_key for r in rejects if r.source_table == "campaign"} == {CAMPAIGN}
    assert all(r.row_key.endswith(f"-{CAMPAIGN}-bo") for r in rejects if r.source_table != "campaign")
    assert out["stg_campaigns"].first().send_timestamp is None
    assert out["campaign_activities"].where("activity_timestamp is null").count() == bad
    assert build_from(spark, seed_tables(spark))["stg_rejects"].count() == 0


def test_sends_of_the_fixtures_are_made_distinct_as_numbers(spark, tmp_path):
    """Before the members join them; a customer stored twice, or on two lists, gives each send once a list."""
    rows = {"region": "VALUES (0, 'A') t(r_regionkey, r_name)",
            "nation": "VALUES (0, 'X', 0), (1, 'Y', 1) t(n_nationkey, n_name, n_regionkey)",
            "customer": "VALUES (10L, 0, 1D), (10L, 0, 2D), (10L, 1, 2D), (11L, 1, 3D), (null, 1, 3D) t(c_custkey, c_nationkey, c_acctbal)",
            "supplier": "VALUES (2L, 'S', 0) t(s_suppkey, s_name, s_nationkey)",
            "orders": "VALUES (1L, 10L, timestamp_ntz'2024-01-01'), (2L, 10L, timestamp_ntz'2024-01-01'), (3L, 11L, timestamp_ntz'2024-01-01'), "
                      "(4L, null, timestamp_ntz'2024-01-01') t(o_orderkey, o_custkey, o_orderdate)",
            "lineitem": "VALUES (1L, 2L), (2L, 2L), (3L, 2L), (3L, 2L), (4L, 2L) t(l_orderkey, l_suppkey)",
            "events": "VALUES (1L, timestamp_ntz'2024-01-01', 10L, 'view') t(event_id, ts, user_id, event_type)"}
    sends = fixture_sources({t: spark.sql(f"SELECT * FROM {v}") for t, v in rows.items()})["campaign_recipient"]
    got = sorted((r.campaign_id, r.member_id, r.list_id) for r in sends.collect())
    assert got == [("2", "10", "0"), ("2", "10", "1"), ("2", "11", "1")]
    plan = sends._jdf.queryExecution().analyzed().toString()
    assert re.findall(r"Deduplicate \[(.*?)\]", re.sub(r"#\d+L?", "", plan))[0] == "sk, o_custkey"


def test_raw_tables_of_accounts_are_written_side_by_side(spark, tmp_path, monkeypatch):
    """Each of the first two writes waits until the other has begun."""
    from threading import Barrier

    from inboxlens.plans import registry
    both, begun = Barrier(2, timeout=20), []

    class Table:
        write = property(lambda self: self)

        def parquet(self, path):
            begun.append(path)
            if len(begun) <= 2:
                both.wait()

    monkeypatch.setattr(registry, "load_driver_tables", lambda *_: {})
    monkeypatch.setattr(registry, "fixture_sources", lambda *_: {"campaign": Table(), "list": Table()})
    monkeypatch.setattr(registry, "read_sources", lambda *_: None)
    monkeypatch.setattr(registry, "build", lambda _: {"campaigns": "built"})
    assert registry._one_scan("campaigns")(spark, str(tmp_path)) == "built"
    assert sorted("/".join(p.split("/")[-2:]) for p in begun) == ["conn_a/campaign", "conn_a/list", "conn_b/campaign", "conn_b/list"]
