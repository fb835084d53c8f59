"""Members, lists and segments with campaign and automation metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.enrich import SR, attach, attach_metrics
from ..operators.rollups import latest_per_group
from .campaign import metric_names
from .scope import Scope


def members(stg_members: DataFrame, campaign_by_member: DataFrame,
            automation_by_member: DataFrame | None, unsubscribes: bool,
            scope: Scope = Scope()) -> DataFrame:
    names = metric_names(unsubscribes)
    df = attach_metrics(stg_members, campaign_by_member, ["member_id", "list_id"], names,
                        prefix="campaign_", by_source=scope.by_source)
    if automation_by_member is not None:
        df = attach_metrics(df, automation_by_member, ["member_id", "list_id"], names,
                            prefix="automation_", by_source=scope.by_source)
    return df


def members_by_list(stg_members: DataFrame, scope: Scope = Scope()) -> DataFrame:
    """Member rows and latest signup per list.

    Counted on the staged members: the members output has exactly one row per
    staged member (both metric tables it joins are unique on the join key),
    so the result is the same without building that output first."""
    df = latest_per_group(stg_members, scope.keys("list_id"), "count_members",
                          "signup_timestamp", "most_recent_signup_timestamp", carry=scope.carry)
    return df.select(SR, "list_id", "count_members", "most_recent_signup_timestamp")


def lists(stg_lists: DataFrame, by_list_members: DataFrame, campaign_by_list: DataFrame,
          automation_by_list: DataFrame | None, unsubscribes: bool,
          scope: Scope = Scope()) -> DataFrame:
    names = metric_names(unsubscribes)
    bs = scope.by_source
    df = attach(stg_lists, by_list_members, [("list_id", "list_id")],
                [("count_members", "count_members"),
                 ("most_recent_signup_timestamp", "most_recent_signup_timestamp")],
                fill={"count_members": 0}, by_source=bs)
    df = attach_metrics(df, campaign_by_list, ["list_id"], names, prefix="campaign_", by_source=bs)
    if automation_by_list is not None:
        df = attach_metrics(df, automation_by_list, ["list_id"], names, prefix="automation_",
                            by_source=bs)
    return df


def segments(stg_segments: DataFrame, campaign_by_segment: DataFrame, stg_lists: DataFrame,
             automation_by_segment: DataFrame | None, unsubscribes: bool,
             scope: Scope = Scope()) -> DataFrame:
    names = metric_names(unsubscribes)
    bs = scope.by_source
    df = attach(stg_segments, stg_lists, [("list_id", "list_id")], [("list_name", "name")],
                by_source=bs)
    df = attach_metrics(df, campaign_by_segment, ["segment_id"], names, prefix="campaign_",
                        by_source=bs)
    if automation_by_segment is not None:
        df = attach_metrics(df, automation_by_segment, ["segment_id"], names,
                            prefix="automation_", by_source=bs)
    return df
