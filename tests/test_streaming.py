from helpers import build_from
from seed_rows import ROWS, seed_tables

from inboxlens.operators.staging import stg_automation_emails, stg_automations, stg_campaigns
from inboxlens.sources import union_connections
from inboxlens import Options
from inboxlens.streaming import append_to, automation_event_stream, campaign_event_stream


def _stream(spark, tmp_path, table):
    src = tmp_path / f"in_{table}"
    seed_tables(spark)[table].write.parquet(str(src))
    return spark.readStream.schema(ROWS[table][0]).parquet(str(src))


def test_campaign_event_stream_matches_batch(spark, tmp_path):
    t = seed_tables(spark)
    camps = stg_campaigns(union_connections([("conn_a", t["campaign"])], Options()))
    events = campaign_event_stream([("conn_a", _stream(spark, tmp_path, "campaign_recipient_activity"))],
                                   camps)
    out = tmp_path / "out"
    q = append_to(spark, events, str(out), "camp_events", available_now=True,
                  checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.read.parquet(str(out)).select(*events.columns).collect())
    want = sorted(tuple(r) for r in build_from(spark, t)["campaign_activities"].collect())
    assert got == want and len(got) == 10


def test_automation_event_stream_matches_batch(spark, tmp_path):
    t = seed_tables(spark)
    o = Options()
    emails = stg_automation_emails(union_connections([("conn_a", t["automation_email"])], o))
    autos = stg_automations(union_connections([("conn_a", t["automation"])], o))
    events = automation_event_stream(
        [("conn_a", _stream(spark, tmp_path, "automation_recipient_activity"))], emails, autos)
    out = tmp_path / "out"
    q = append_to(spark, events, str(out), "auto_events", available_now=True,
                  checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.read.parquet(str(out)).select(*events.columns).collect())
    want = sorted(tuple(r) for r in build_from(spark, t)["automation_activities"].collect())
    assert got == want and len(got) == 7


def test_two_account_event_stream(spark, tmp_path):
    t = seed_tables(spark)
    o = Options()
    camps = stg_campaigns(union_connections([("a", t["campaign"]), ("b", t["campaign"])], o))
    src = _stream(spark, tmp_path, "campaign_recipient_activity")
    events = campaign_event_stream([("a", src), ("b", src)], camps)
    out = tmp_path / "out2"
    q = append_to(spark, events, str(out), "two_acct_events", available_now=True,
                  checkpoint=str(tmp_path / "ckpt2"))
    q.awaitTermination(120)
    got = spark.read.parquet(str(out))
    assert got.count() == 20
    per = {r.source_relation: r.n for r in got.groupBy("source_relation")
           .agg({"time_since_send_minutes": "count"}).withColumnRenamed(
               "count(time_since_send_minutes)", "n").collect()}
    assert per == {"a": 10, "b": 10}  # every event found its own account's campaign
