"""Aggregations: engagement pivots, recipient rollups, row counts.

Distinct-member measures ("unique opens") are computed in one of three
exact ways, chosen per call:

* the distinct key is one of the group keys: every group holds one value of
  it, so the distinct count is 0 or 1 -> ``max(flag)``; one aggregation;
* ``two_phase`` (default): aggregate by (keys, distinct key) first, then by
  keys, counting the sub-groups that carry the flag.  Both phases combine
  map-side before their shuffle, so a hot key (one list holding a third of
  all sends) is spread over tasks by the first shuffle and shrinks to one
  row per task before the second;
* ``native``: ``COUNT(DISTINCT CASE ...)``; Spark plans it with an Expand
  that multiplies rows by the number of distinct expressions plus one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sql import q

STRATEGIES = ("two_phase", "native")


def _carried(cols: Sequence[str]) -> list[Column]:
    # Columns known to be constant within each group (e.g. the connection
    # name when there is only one): carried through without being a key.
    return [F.expr(f"any_value({q(c)}) AS {q(c)}") for c in cols]


def _e(sql: str, name: str) -> Column:
    return F.expr(f"{sql} AS {q(name)}")


def _present_flag(cond: str) -> str:
    # Distinct count of a value that is constant within the group: 0 or 1.
    return f"CAST(max(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


def engagement_counts(activities: DataFrame, keys: Sequence[str], *,
                      distinct_key: str = "member_id", action_col: str = "action_type",
                      open_mins: Mapping[str, str] | None = None,
                      strategy: str = "two_phase", carry: Sequence[str] = (),
                      few_per_key: bool = False) -> DataFrame:
    """Per group of ``keys``: opens, clicks (count of events, NULL if none),
    unique_opens, unique_clicks (distinct non-NULL ``distinct_key`` among open
    / click events) and, for each ``open_mins`` entry out -> column, the
    minimum of that column over open events.  Other actions (bounce) count
    nowhere.  ``carry`` columns are constant per group and passed through.

    ``few_per_key``: a group has a handful of distinct keys at most (a send key
    has one member, or a few where keys collide).  They are then gathered in a
    set, so that one aggregation, combined map-side, and one shuffle do: a group
    with very many events reaches it as one row per task."""
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    keys = list(keys)
    open_mins = dict(open_mins or {})
    is_open = f"{q(action_col)} = 'open'"
    is_click = f"{q(action_col)} = 'click'"
    dk = q(distinct_key)
    # SUM(CASE WHEN ... THEN 1 END): NULL when no row matches, like the SQL models.
    opens = _e(f"sum(CASE WHEN {is_open} THEN 1 END)", "opens")
    clicks = _e(f"sum(CASE WHEN {is_click} THEN 1 END)", "clicks")
    mins = [_e(f"min(CASE WHEN {is_open} THEN {q(src)} END)", out) for out, src in open_mins.items()]
    kept = _carried(carry)

    if distinct_key in keys:
        return activities.groupBy(*keys).agg(
            opens, clicks,
            _e(_present_flag(f"{is_open} AND {dk} IS NOT NULL"), "unique_opens"),
            _e(_present_flag(f"{is_click} AND {dk} IS NOT NULL"), "unique_clicks"),
            *mins, *kept)

    if strategy == "native":
        return activities.groupBy(*keys).agg(
            opens, clicks,
            _e(f"count(DISTINCT CASE WHEN {is_open} THEN {dk} END)", "unique_opens"),
            _e(f"count(DISTINCT CASE WHEN {is_click} THEN {dk} END)", "unique_clicks"),
            *mins, *kept)

    if few_per_key:
        members = lambda cond: f"CAST(cardinality(collect_set(CASE WHEN {cond} THEN {dk} END)) AS BIGINT)"
        return activities.groupBy(*keys).agg(
            opens, clicks, _e(members(is_open), "unique_opens"), _e(members(is_click), "unique_clicks"),
            *mins, *kept)

    part = activities.groupBy(*keys, distinct_key).agg(
        _e(f"sum(CASE WHEN {is_open} THEN 1 END)", "_opens"),
        _e(f"sum(CASE WHEN {is_click} THEN 1 END)", "_clicks"),
        _e(f"bool_or({is_open})", "_any_open"),
        _e(f"bool_or({is_click})", "_any_click"),
        *[_e(f"min(CASE WHEN {is_open} THEN {q(src)} END)", f"_min_{out}")
          for out, src in open_mins.items()],
        *kept)
    return part.groupBy(*keys).agg(
        _e("sum(_opens)", "opens"), _e("sum(_clicks)", "clicks"),
        _e(f"count_if(_any_open AND {dk} IS NOT NULL)", "unique_opens"),
        _e(f"count_if(_any_click AND {dk} IS NOT NULL)", "unique_clicks"),
        *[_e(f"min({q('_min_' + out)})", out) for out in open_mins], *kept)


def recipient_rollup(recipients: DataFrame, keys: Sequence[str], *,
                     unsubscribes: bool = True, strategy: str = "two_phase",
                     carry: Sequence[str] = ()) -> DataFrame:
    """Per group of ``keys`` over per-send rows: sends (rows), opens, clicks
    (sums), unique_opens / unique_clicks / unsubscribes (distinct members
    whose send was opened / clicked / unsubscribed)."""
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    keys = list(keys)
    flags = [("unique_opens", "was_opened"), ("unique_clicks", "was_clicked")]
    if unsubscribes:
        flags.append(("unsubscribes", "was_unsubscribed"))
    kept = _carried(carry)
    sends = _e("count(1)", "sends")
    opens = _e("sum(opens)", "opens")
    clicks = _e("sum(clicks)", "clicks")

    if "member_id" in keys:
        return recipients.groupBy(*keys).agg(
            sends, opens, clicks,
            *[_e(_present_flag(f"{q(flag)} AND member_id IS NOT NULL"), out) for out, flag in flags],
            *kept)

    if strategy == "native":
        return recipients.groupBy(*keys).agg(
            sends, opens, clicks,
            *[_e(f"count(DISTINCT CASE WHEN {q(flag)} THEN member_id END)", out)
              for out, flag in flags],
            *kept)

    part = recipients.groupBy(*keys, "member_id").agg(
        _e("count(1)", "_sends"), _e("sum(opens)", "_opens"), _e("sum(clicks)", "_clicks"),
        *[_e(f"bool_or({q(flag)})", f"_any_{out}") for out, flag in flags], *kept)
    return part.groupBy(*keys).agg(
        _e("sum(_sends)", "sends"), _e("sum(_opens)", "opens"), _e("sum(_clicks)", "clicks"),
        *[_e(f"count_if({q('_any_' + out)} AND member_id IS NOT NULL)", out) for out, _ in flags],
        *kept)


def sum_members(by_member: DataFrame, keys: Sequence[str], names: Sequence[str],
                carry: Sequence[str] = ()) -> DataFrame:
    """Coarser rollup of one that has ``member_id`` among its keys: its unique
    counts are 0 or 1 per member (0 for NULL), so all metrics add up exactly."""
    return by_member.groupBy(*keys).agg(*[_e(f"sum({q(n)})", n) for n in names], *_carried(carry))


def count_rows(df: DataFrame, keys: Sequence[str], name: str,
               carry: Sequence[str] = ()) -> DataFrame:
    """COUNT(*) per group, combined map-side before the shuffle."""
    return df.groupBy(*keys).agg(_e("count(1)", name), *_carried(carry))


def latest_per_group(df: DataFrame, keys: Sequence[str], count_name: str,
                     max_col: str, max_name: str, carry: Sequence[str] = ()) -> DataFrame:
    """COUNT(*) and MAX(col) per group."""
    return df.groupBy(*keys).agg(_e("count(1)", count_name), _e(f"max({q(max_col)})", max_name),
                                 *_carried(carry))
