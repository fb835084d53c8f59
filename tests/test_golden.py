"""Golden values on the example account."""

from datetime import datetime

import pytest

from helpers import build_from, metrics, rows_by
from seed_rows import AUTO1, AUTO2, CAMPAIGN, L1, L2, MAIL1, MAIL2, seed_tables


@pytest.fixture(scope="module")
def out(spark):
    return build_from(spark, seed_tables(spark))


def test_campaigns(out):
    r = rows_by(out["campaigns"], "campaign_id")
    assert metrics(r[CAMPAIGN]) == (8, 7, 3, 5, 2, 0)


def test_automations_and_emails(out):
    a = rows_by(out["automations"], "automation_id")
    assert metrics(a[AUTO1]) == (2, 3, 3, 2, 2, 1)
    assert metrics(a[AUTO2]) == (1, 0, 1, 0, 1, 0)
    e = rows_by(out["automation_emails"], "automation_email_id")
    assert metrics(e[MAIL1]) == (2, 3, 3, 2, 2, 1)
    assert metrics(e[MAIL2]) == (1, 0, 1, 0, 1, 0)
    assert e[MAIL1]["list_id"] == L1


def test_lists(out):
    r = rows_by(out["lists"], "list_id")
    assert r[L1]["count_members"] == 7
    assert r[L1]["most_recent_signup_timestamp"] == datetime(2022, 3, 30, 17, 45, 12)
    assert metrics(r[L1], "campaign_") == (8, 7, 3, 5, 2, 0)
    assert metrics(r[L1], "automation_") == (2, 3, 3, 2, 2, 1)
    assert r[L2]["count_members"] == 1
    assert metrics(r[L2], "campaign_") == (0,) * 6
    assert metrics(r[L2], "automation_") == (1, 0, 1, 0, 1, 0)


def test_members(out):
    r = rows_by(out["members"], "member_id", "list_id")
    assert metrics(r[("jon", L1)], "campaign_") == (0,) * 6
    assert metrics(r[("jon", L1)], "automation_") == (1, 1, 2, 1, 1, 1)
    assert metrics(r[("ivy", L1)], "automation_") == (1, 2, 1, 1, 1, 0)
    assert metrics(r[("ivy", L2)], "automation_") == (1, 0, 1, 0, 1, 0)
    assert metrics(r[("bo", L1)], "campaign_") == (1, 1, 2, 1, 1, 0)
    assert metrics(r[("eli", L1)], "campaign_") == (1, 2, 1, 1, 1, 0)
    assert metrics(r[("cy", L1)], "campaign_") == (1, 2, 0, 1, 0, 0)
    for m in ("ana", "di"):
        assert metrics(r[(m, L1)], "campaign_") == (1, 1, 0, 1, 0, 0)
        assert metrics(r[(m, L1)], "automation_") == (0,) * 6
    assert len(r) == 8


def test_segments(out):
    r = rows_by(out["segments"], "segment_id")
    s = r[71]
    assert s["list_name"] == "Rye & Co" and s["member_count"] == 2
    assert metrics(s, "campaign_") == (0,) * 6 and metrics(s, "automation_") == (0,) * 6
    cols = out["segments"].columns
    assert cols.index("list_name") == cols.index("created_timestamp") + 1


def test_campaign_recipients(out):
    rows = out["campaign_recipients"].collect()
    assert len(rows) == 8
    assert sum(r.was_opened for r in rows) == 5
    assert sum(r.was_clicked for r in rows) == 2
    assert sum(r.was_unsubscribed for r in rows) == 0
    assert all(r.segment_id is None for r in rows)


def test_time_to_open(out):
    r = rows_by(out["campaign_recipients"], "member_id")
    # sent 22:58:40; boundaries crossed, not whole units
    want = {"ana": (1, 0, 0, datetime(2022, 3, 4, 22, 59, 10)),
            "bo": (2, 1, 0, datetime(2022, 3, 4, 23, 0, 5)),
            "eli": (60, 1, 0, datetime(2022, 3, 4, 23, 58, 59)),
            "cy": (72, 2, 1, datetime(2022, 3, 5, 0, 10, 0)),
            "di": (4712, 79, 4, datetime(2022, 3, 8, 5, 30, 15))}
    for k, (mi, h, d, first) in want.items():
        row = r[k]
        assert (row["time_to_open_minutes"], row["time_to_open_hours"],
                row["time_to_open_days"], row["first_open_timestamp"]) == (mi, h, d, first), k
    assert r["fay"]["time_to_open_minutes"] is None
    assert r["fay"]["opens"] == 0 and r["fay"]["was_opened"] is False


def test_output_columns(out):
    assert out["campaign_recipients"].columns == [
        "source_relation", "campaign_id", "member_id", "combination_id", "list_id", "email_id",
        "segment_id", "send_timestamp", "opens", "unique_opens", "clicks", "unique_clicks",
        "was_opened", "was_clicked", "first_open_timestamp", "time_to_open_minutes",
        "time_to_open_hours", "time_to_open_days", "was_unsubscribed"]
    assert out["lists"].columns[-14:-12] == ["count_members", "most_recent_signup_timestamp"]
    assert out["members"].columns[-12:] == [
        f"{p}_{m}" for p in ("campaign", "automation")
        for m in ("sends", "opens", "clicks", "unique_opens", "unique_clicks", "unsubscribes")]
    assert out["campaign_activities"].columns[-4:] == [
        "send_timestamp", "time_since_send_minutes", "time_since_send_hours", "time_since_send_days"]
    assert out["automation_activities"].columns[-2:] == ["automation_id", "segment_id"]
    # undeclared raw columns are dropped unless passed through
    assert "merge_fname" not in out["members"].columns
