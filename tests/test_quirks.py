"""Behaviours kept on purpose; each test fails if one is 'fixed' by accident."""

from datetime import datetime as T

from helpers import build_from, metrics, rows_by
from seed_rows import AUTO1, CAMPAIGN, L1, L2, MAIL1, MAIL2, seed_tables

from inboxlens import Options


def test_segment_unique_counts_are_zero_or_one(spark):
    # Give an automation a segment: its two members both opened.
    extra_auto = {"automation": [("999", L1, 7, None, None, None)],
                  "automation_email": [("e999", "999", None)],
                  "automation_recipient": [("e999", "ivy", L1), ("e999", "jon", L1)],
                  "automation_recipient_activity": [
                      ("open", "e999", "ivy", T(2022, 5, 1), L1),
                      ("open", "e999", "jon", T(2022, 5, 1), L1),
                      ("click", "e999", "jon", T(2022, 5, 1), L1)],
                  "segment": [(7, L1, 2, "vip", "static")]}
    out = build_from(spark, seed_tables(spark, extra_auto))
    seg = rows_by(out["int_automation_activities_by_segment"], "segment_id")[7]
    assert (seg["opens"], seg["unique_opens"], seg["clicks"], seg["unique_clicks"]) == (2, 1, 1, 1)
    s = rows_by(out["segments"], "segment_id")[7]
    assert metrics(s, "automation_") == (2, 2, 1, 1, 1, 0)


def test_member_with_sends_but_no_activity_gets_nothing(spark):
    extra = {"automation_recipient": [(MAIL1, "bo", L1)]}
    out = build_from(spark, seed_tables(spark, extra))
    by_member = rows_by(out["int_automation_activities_by_member"], "member_id")
    assert by_member["bo"]["list_id"] is None and by_member["bo"]["sends"] == 1
    m = rows_by(out["members"], "member_id", "list_id")[("bo", L1)]
    assert metrics(m, "automation_") == (0,) * 6
    fixed = build_from(spark, seed_tables(spark, extra), Options(fix_member_list_id=True))
    m = rows_by(fixed["members"], "member_id", "list_id")[("bo", L1)]
    assert m["automation_sends"] == 1


def test_campaign_unsubscribes_count_on_automation_side_by_list_and_member(spark):
    extra = {"unsubscribe": [(CAMPAIGN, "bo", L1, "spam", T(2022, 3, 9))]}
    out = build_from(spark, seed_tables(spark, extra))
    lists = rows_by(out["lists"], "list_id")
    assert lists[L1]["campaign_unsubscribes"] == 1
    # the campaign unsubscribe is also in the automation count of its list
    assert lists[L1]["automation_unsubscribes"] == 2
    camp = rows_by(out["campaigns"], "campaign_id")[CAMPAIGN]
    assert camp["unsubscribes"] == 1
    rec = rows_by(out["campaign_recipients"], "member_id")["bo"]
    assert rec["was_unsubscribed"] is True
    # but not in the automation count of any automation
    autos = rows_by(out["automations"], "automation_id")
    assert autos[AUTO1]["unsubscribes"] == 1


def test_repeated_unsubscribes_do_not_multiply_sends(spark):
    extra = {"unsubscribe": [(CAMPAIGN, "bo", L1, None, T(2022, 3, 9)),
                             (CAMPAIGN, "bo", L1, None, T(2022, 3, 10))]}
    out = build_from(spark, seed_tables(spark, extra))
    assert out["campaign_recipients"].count() == 8
    assert rows_by(out["campaigns"], "campaign_id")[CAMPAIGN]["sends"] == 8


def test_activity_without_send_is_lost(spark):
    # automation email MAIL2 gets an event from a member with no send of it
    extra = {"automation_recipient_activity": [("open", MAIL2, "bo", T(2022, 5, 1), L1)]}
    out = build_from(spark, seed_tables(spark, extra))
    e = rows_by(out["automation_emails"], "automation_email_id")[MAIL2]
    assert metrics(e) == (1, 1, 1, 1, 1, 0)  # the open counts (email has a send)...
    m = rows_by(out["members"], "member_id", "list_id")[("bo", L1)]
    assert m["automation_opens"] == 0  # ...but not for the member without a send


def test_campaign_event_without_send_is_not_counted(spark):
    extra = {"campaign_recipient_activity": [("open", CAMPAIGN, "ivy", T(2022, 3, 7), L1, None)]}
    out = build_from(spark, seed_tables(spark, extra))
    assert metrics(rows_by(out["campaigns"], "campaign_id")[CAMPAIGN]) == (8, 7, 3, 5, 2, 0)
    assert out["campaign_activities"].count() == 11


def test_bounces_count_nowhere(spark):
    extra = {"campaign_recipient_activity": [("bounce", CAMPAIGN, "fay", T(2022, 3, 7), L1, None)]}
    out = build_from(spark, seed_tables(spark, extra))
    r = rows_by(out["campaign_recipients"], "member_id")["fay"]
    assert (r["opens"], r["clicks"], r["was_opened"]) == (0, 0, False)


def test_null_member_is_not_a_distinct_member(spark):
    extra = {"campaign_recipient": [(CAMPAIGN, None, L1)],
             "campaign_recipient_activity": [("open", CAMPAIGN, None, T(2022, 3, 7), L1, None)]}
    out = build_from(spark, seed_tables(spark, extra))
    c = rows_by(out["campaigns"], "campaign_id")[CAMPAIGN]
    # the NULL-member send matches its event through the key placeholder
    assert (c["sends"], c["opens"], c["unique_opens"]) == (9, 8, 5)
    for strategy in ("two_phase", "native"):
        o = build_from(spark, seed_tables(spark, extra), Options(distinct_strategy=strategy))
        assert rows_by(o["int_campaign_activities_by_list"], "list_id")[L1]["unique_opens"] == 5
    assert L2 not in rows_by(out["int_campaign_activities_by_list"], "list_id")


def test_send_key_ignores_list(spark):
    # one campaign sent to one member on two lists: both sends share email_id
    # and therefore the member's events
    extra = {"campaign_recipient": [(CAMPAIGN, "bo", L2)]}
    out = build_from(spark, seed_tables(spark, extra))
    rows = [r for r in out["campaign_recipients"].collect() if r.member_id == "bo"]
    assert len(rows) == 2 and rows[0].email_id == rows[1].email_id
    assert [r.opens for r in rows] == [1, 1]
    c = rows_by(out["campaigns"], "campaign_id")[CAMPAIGN]
    assert (c["sends"], c["opens"], c["unique_opens"]) == (9, 8, 5)


def test_soft_deleted_rows_are_kept(spark):
    t = seed_tables(spark)
    t["list"] = t["list"].selectExpr("*", "id = 'list-cake' AS _deleted")
    out = build_from(spark, t)
    assert out["lists"].count() == 2
    assert "_deleted" not in out["lists"].columns
