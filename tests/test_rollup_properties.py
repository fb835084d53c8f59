"""Distinct-member rollups: both strategies equal a brute-force count on
random data with NULL members, NULL keys and repeated events."""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from inboxlens.operators.rollups import engagement_counts, recipient_rollup

events = st.lists(st.tuples(st.sampled_from(["k1", "k2", None]),
                            st.sampled_from(["m1", "m2", "m3", None]),
                            st.sampled_from(["open", "click", "bounce"])),
                  min_size=0, max_size=25)
sends = st.lists(st.tuples(st.sampled_from(["k1", "k2", None]),
                           st.sampled_from(["m1", "m2", "m3", None]),
                           st.integers(0, 3), st.integers(0, 2),
                           st.booleans(), st.booleans(), st.booleans()),
                 min_size=0, max_size=25)


def brute_events(rows):
    g = defaultdict(lambda: [None, None, set(), set()])
    for k, m, a in rows:
        r = g[k]
        if a == "open":
            r[0] = (r[0] or 0) + 1
            if m is not None:
                r[2].add(m)
        if a == "click":
            r[1] = (r[1] or 0) + 1
            if m is not None:
                r[3].add(m)
    return {k: (v[0], v[1], len(v[2]), len(v[3])) for k, v in g.items()}


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(events)
def test_engagement_counts(spark, rows):
    df = spark.createDataFrame(rows, "k string, member_id string, action_type string")
    want = brute_events(rows)
    for strategy in ("two_phase", "native"):
        got = {r.k: (r.opens, r.clicks, r.unique_opens, r.unique_clicks)
               for r in engagement_counts(df, ["k"], strategy=strategy).collect()}
        assert got == want, strategy


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(sends)
def test_recipient_rollup(spark, rows):
    df = spark.createDataFrame(rows, "k string, member_id string, opens int, clicks int, "
                                     "was_opened boolean, was_clicked boolean, "
                                     "was_unsubscribed boolean")
    g = defaultdict(lambda: [0, 0, 0, set(), set(), set()])
    for k, m, o, c, wo, wc, wu in rows:
        r = g[k]
        r[0] += 1
        r[1] += o
        r[2] += c
        for flag, s in ((wo, r[3]), (wc, r[4]), (wu, r[5])):
            if flag and m is not None:
                s.add(m)
    want = {k: (v[0], v[1], v[2], len(v[3]), len(v[4]), len(v[5])) for k, v in g.items()}
    for strategy in ("two_phase", "native"):
        got = {r.k: (r.sends, r.opens, r.clicks, r.unique_opens, r.unique_clicks, r.unsubscribes)
               for r in recipient_rollup(df, ["k"], strategy=strategy).collect()}
        assert got == want, strategy
