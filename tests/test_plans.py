"""Physical-plan properties the design relies on at scale (static plans,
AQE and broadcasts off, i.e. the worst case where every join shuffles)."""

import re

import pytest

from seed_rows import seed_tables

from inboxlens import Connection, Options, build, read_sources
from inboxlens.functions import surrogate_key


@pytest.fixture()
def static(spark):
    keys = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold",
            "spark.sql.requireAllClusterKeysForCoPartition")
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def plan(df) -> str:
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def exchanges(p: str) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", p)


def stored(spark, tmp_path, conns=("a",)):
    for name, df in seed_tables(spark).items():
        df.write.parquet(str(tmp_path / name))
    return read_sources(spark, [Connection.from_directory(c, str(tmp_path)) for c in conns])


def test_two_phase_rollup_has_no_expand_and_spreads_hot_keys(static, tmp_path):
    m = build(stored(static, tmp_path))
    p = plan(m["int_campaign_activities_by_list"])
    assert "Expand" not in p
    assert any({"list_id", "member_id"} == set(e.split(", ")) for e in exchanges(p))
    native = build(stored(static, tmp_path / "n"), Options(distinct_strategy="native"))
    assert "Expand" in plan(native["int_campaign_activities_by_list"])


def test_lists_read_the_rollup_by_member(spark, tmp_path):
    """With hubs stored, lists do not read the per-send table at all."""
    from inboxlens.plans.build import HUBS
    hubs = {n: df for n, df in build(stored(spark, tmp_path / "raw")).items() if n in HUBS}
    for n, df in hubs.items():
        df.write.parquet(str(tmp_path / n))
    m = build(stored(spark, tmp_path / "raw2"), materialize=lambda n, _: spark.read.parquet(str(tmp_path / n)))
    read = {f.split("/")[-2] for f in m["lists"].inputFiles()}
    assert "int_campaign_activities_by_member" in read and "campaign_recipients" not in read


def test_scans_read_only_needed_columns(static, tmp_path):
    m = build(stored(static, tmp_path))
    p = plan(m["int_campaign_activities_by_campaign"])
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    assert schemas and all("url" not in s and "title" not in s for s in schemas)


def test_single_connection_keeps_constants_out_of_shuffles(static, tmp_path):
    m = build(stored(static, tmp_path))
    for name in ("members", "lists", "campaign_recipients"):
        assert all("source_relation" not in e and "'" not in e for e in exchanges(plan(m[name])))
    two = build(stored(static, tmp_path / "two", conns=("a", "b")))
    assert any("source_relation" in e for e in exchanges(plan(two["members"])))


def test_events_are_combined_before_their_one_shuffle_per_send(static, tmp_path):
    p = plan(build(stored(static, tmp_path))["int_campaign_activities_by_email"])
    assert [e for e in exchanges(p) if "email_id" in e] == ["email_id"]
    below = p[p.index("Exchange hashpartitioning(email_id"):].split("\n")[1]
    assert "partial_collect_set" in below


def _shuffled(df, of: str) -> list[list[int]]:
    """Bytes per reduce task of each shuffle of the final plan that ``of`` names."""
    found = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            walk(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            if name == "ShuffleQueryStageExec" and of in re.sub(r"#\d+L?", "", node.plan().simpleString(200)):
                found.append(list(node.mapStats().get().bytesByPartitionId()))
            walk(node.plan())
        else:
            children = node.children()
            for i in range(children.size()):
                walk(children.apply(i))

    query = df._jdf.queryExecution()
    query.executedPlan().execute().count()
    walk(query.executedPlan())
    return found


def _median(sizes: list[int]) -> int:
    return sorted(sizes)[len(sizes) // 2]


def test_a_hot_send_key_is_a_row_per_task(spark):
    """A third of all events share one key, those without a member: no reduce task
    reads more than twice the median, before and after AQE."""
    from inboxlens.plans.campaign import activities_by_email
    from inboxlens.plans.scope import Scope
    events = spark.range(0, 600_000, 1, 8).selectExpr(
        "'a' as source_relation", "if(id % 3 = 0, 'none', md5(cast(id as string))) as email_id",
        "if(id % 3 = 0, null, cast(id as string)) as member_id", "if(id % 2 = 0, 'open', 'click') as action_type",
        "timestamp_ntz'2024-01-01 00:00:00' as activity_timestamp", *[f"id as time_since_send_{u}s" for u in ("minute", "hour", "day")])
    out = activities_by_email(events, scope=Scope(by_source=False))
    sizes = _shuffled(out, "hashpartitioning(email_id")
    assert len(sizes) == 1 and max(sizes[0]) <= 2 * _median(sizes[0])
    hot = out.where("email_id = 'none'").first()
    assert (hot.opens, hot.clicks, hot.unique_opens, hot.unique_clicks, hot.time_to_open_minutes) == (100_000, 100_000, 0, 0, 0)
    assert out.count() == 400_001 and out.where("unique_opens + unique_clicks = 1").count() == 400_000


def test_sends_are_shuffled_once_for_both_per_send_joins(static, tmp_path):
    raw = stored(static, tmp_path)
    for all_keys in ("true", "false"):  # Spark's default, and the recommended setting
        static.conf.set("spark.sql.requireAllClusterKeysForCoPartition", all_keys)
        tree = build(raw)["campaign_recipients"]._jdf.queryExecution().executedPlan()
        # exchanges on the path from the result down to the scan of the sends
        found, node = [], tree
        while node.children().nonEmpty():
            text = re.sub(r"#\d+L?", "", node.simpleString(200))
            found += re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", text)
            node = node.children().head()
        assert found == ["_key", "campaign_id"]


def hot_sends(spark, hot: int, rest: int):
    """Sends of which ``hot`` have no member; the others are one per member."""
    return spark.range(0, hot + rest, 1, 16).selectExpr(
        f"'camp' as campaign_id", f"if(id < {hot}, null, cast(id as string)) as member_id", "'l' as list_id",
        "cast(null as string) as combination_id", "'a' as source_relation").withColumn("email_id", surrogate_key(
            "source_relation", "campaign_id", "member_id"))


def test_shares_follow_the_frequency_of_a_key(spark, monkeypatch):
    from inboxlens.plans import campaign
    monkeypatch.setattr(campaign, "HOT_KEYS", 64)
    for hot, shares in ((50_000, 22), (100_000, 32), (300_000, 48)):  # n * 64 / total
        (found,) = campaign.hot_keys(hot_sends(spark, hot, 100_000)).collect()
        assert abs(found._shares - shares) <= 1
    assert campaign.hot_keys(hot_sends(spark, 800, 100_000)).count() == 0  # less than one in 64
    assert campaign.hot_keys(hot_sends(spark, 0, 0)).count() == 0


@pytest.mark.parametrize("partitions", [8, 2000])
def test_sends_without_a_member_are_dealt_out(spark, partitions):
    """They share one key per campaign; shares spread them over the tasks, and the
    few event rows that match them are repeated."""
    from inboxlens.plans import campaign
    from inboxlens.plans.scope import Scope
    sends = hot_sends(spark, 150_000, 300_000)
    campaigns = spark.sql("select 'a' as source_relation, 'camp' as campaign_id, 's' as segment_id, timestamp_ntz'2024-01-01 00:00:00' as send_timestamp")
    none = surrogate_key("source_relation", "campaign_id", "member_id")
    events = spark.sql("select 'a' as source_relation, 'camp' as campaign_id, explode(array(null, '200000', '200000', '-1')) as member_id, 'open' as action_type, "
                       "timestamp_ntz'2024-01-01 00:00:00' as activity_timestamp, 5 as time_since_send_minutes, 0 as time_since_send_hours, "
                       "0 as time_since_send_days").withColumn("email_id", none)
    unsub = spark.sql("select 'a' as source_relation, 'camp' as campaign_id, explode(array(null, '200000', '200001')) as member_id, 'l' as list_id")
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        for k in list(old)[1:]:
            spark.conf.set(k, "-1")  # the worst case, every lookup shuffled
        by_email = campaign.activities_by_email(events, scope=Scope(by_source=False))
        out = campaign.campaign_recipients(sends, campaigns, by_email, unsub, Scope(by_source=False))
        sizes = max(_shuffled(out, "hashpartitioning(_key"), key=sum)  # that of the sends
        rows = {(r.member, r.opens, r.unique_opens, r.was_unsubscribed): r["count"] for r in out.selectExpr(
            "if(member_id is null, 'none', if(opens + int(was_unsubscribed) > 0, member_id, 'other')) as member", "opens", "unique_opens",
            "was_unsubscribed").groupBy("member", "opens", "unique_opens", "was_unsubscribed").count().collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert rows == {("none", 1, 0, False): 150_000, ("200000", 2, 1, True): 1, ("200001", 0, 0, True): 1, ("other", 0, 0, False): 299_998}
    # with 2000 tasks a share, one in 1024 of the sends, is about two tasks' worth; two can meet in a task
    assert len(sizes) == partitions and max(sizes) <= (2 if partitions == 8 else 8) * _median(sizes)


def test_hot_campaign_is_split_by_aqe_skew_join(spark, tmp_path):
    """All events of the example account belong to one campaign.  With the
    campaign table too big to broadcast, AQE splits that hot partition of
    the events -> campaigns join instead of giving it to one task."""
    from pyspark.sql import functions as F
    t = seed_tables(spark)
    t["campaign_recipient_activity"] = t["campaign_recipient_activity"] \
        .crossJoin(spark.range(500).select(F.col("id").alias("_n"))) \
        .withColumn("timestamp", F.expr("timestamp + make_interval(0, 0, 0, 0, 0, 0, _n)")) \
        .drop("_n").repartition(16)
    for name, df in t.items():
        df.write.parquet(str(tmp_path / name))
    conf = {"spark.sql.adaptive.enabled": "true",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.files.maxPartitionBytes": "4KB",
            "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = build(read_sources(spark, [Connection.from_directory("a", str(tmp_path))]))[
            "campaign_activities"]
        assert len(df.collect()) == 10 * 500
        p = df._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in p and "SortMergeJoin(skew=true)" in p
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
