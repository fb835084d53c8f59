"""Automation side: activities, sends and unsubscribes tagged with their
automation and segment, the five rollups, automation emails and automations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.enrich import SR, attach, attach_metrics
from ..operators.rollups import count_rows, engagement_counts
from .campaign import metric_names
from .scope import Scope


def email_owner(stg_emails: DataFrame, stg_automations: DataFrame,
                scope: Scope = Scope()) -> DataFrame:
    """automation_email_id -> owning automation's id and segment (NULL when
    the automation row is missing).  Built on the two small dimension tables
    once, so each large table joins one dimension instead of two."""
    df = attach(stg_emails.select(SR, "automation_email_id", "automation_id"),
                stg_automations, [("automation_id", "automation_id")],
                [("_automation_id", "automation_id"), ("_segment_id", "segment_id")],
                by_source=scope.by_source)
    return df.select(SR, "automation_email_id", F.col("_automation_id").alias("automation_id"),
                     F.col("_segment_id").alias("segment_id"))


def automation_activities(stg_activities: DataFrame, owner: DataFrame,
                          scope: Scope = Scope()) -> DataFrame:
    return attach(stg_activities, owner, [("automation_email_id", "automation_email_id")],
                  [("automation_id", "automation_id"), ("segment_id", "segment_id")],
                  by_source=scope.by_source)


def automation_recipients(stg_recipients: DataFrame, owner: DataFrame,
                          scope: Scope = Scope()) -> DataFrame:
    return attach(stg_recipients, owner, [("automation_email_id", "automation_email_id")],
                  [("segment_id", "segment_id"), ("automation_id", "automation_id")],
                  by_source=scope.by_source)


def automation_unsubscribes(stg_unsubscribes: DataFrame, owner: DataFrame,
                            scope: Scope = Scope()) -> DataFrame:
    """Every unsubscribe, with automation and segment when its campaign_id is
    an automation email; campaign unsubscribes keep NULLs there."""
    return attach(stg_unsubscribes, owner, [("campaign_id", "automation_email_id")],
                  [("segment_id", "segment_id"), ("automation_id", "automation_id")],
                  by_source=scope.by_source)


# rollup name -> (group keys, unsubscribe columns giving those keys,
#                 distinct key of unique opens/clicks, NOT NULL filter)
ROLLUPS = {
    "automation": (["automation_id"], ["automation_id"], "member_id", None),
    "email": (["automation_email_id"], ["campaign_id"], "member_id", None),
    "list": (["list_id"], ["list_id"], "member_id", None),
    "member": (["member_id", "list_id"], ["member_id", "list_id"], "member_id", None),
    # Distinct over segment_id (the group key itself): unique opens and
    # clicks of a segment are 0 or 1, as in the source models.
    "segment": (["segment_id"], ["segment_id"], "segment_id", "segment_id"),
}


def automation_rollup(by: str, activities: DataFrame, recipients: DataFrame,
                      unsubscribes: DataFrame | None, strategy: str = "two_phase",
                      fix_member_list_id: bool = False, scope: Scope = Scope()) -> DataFrame:
    """Sends, events and unsubscribes by ``by``, starting from sends: keys
    without sends get no row; events and unsubscribes of such keys are lost.

    By member, list_id comes from the event side unless
    ``fix_member_list_id``: a member with sends but no events gets list_id
    NULL and so matches no member row downstream (sends and unsubscribes
    included)."""
    keys, unsub_keys, distinct_key, not_null = ROLLUPS[by]
    bs = scope.by_source
    if not_null:
        activities = activities.where(F.col(not_null).isNotNull())
        recipients = recipients.where(F.col(not_null).isNotNull())
        if unsubscribes is not None:
            unsubscribes = unsubscribes.where(F.col(not_null).isNotNull())
    sends = count_rows(recipients, scope.keys(*keys), "sends", carry=scope.carry)
    events = engagement_counts(activities, scope.keys(*keys), distinct_key=distinct_key,
                               strategy=strategy)
    event_cols = ["opens", "clicks", "unique_opens", "unique_clicks"]
    lifted = [] if (by != "member" or fix_member_list_id) else ["list_id"]
    df = attach(sends, events, [(k, k) for k in keys],
                [(f"_ev_{k}", k) for k in lifted] + [(c, c) for c in event_cols], by_source=bs)
    cols = [SR] + [F.col(f"_ev_{k}").alias(k) if k in lifted else F.col(k) for k in keys] \
        + event_cols + ["sends"]
    if unsubscribes is not None:
        unsub = count_rows(unsubscribes.select(
            SR, *[F.col(u).alias(k) for u, k in zip(unsub_keys, keys)]), scope.keys(*keys),
            "unsubscribes")
        df = attach(df, unsub, [(k, k) for k in keys], [("unsubscribes", "unsubscribes")],
                    by_source=bs)
        cols.append("unsubscribes")
    return df.select(*cols)


def automation_emails(stg_emails: DataFrame, stg_automations: DataFrame, by_email: DataFrame,
                      unsubscribes: bool, scope: Scope = Scope()) -> DataFrame:
    df = attach(stg_emails, stg_automations, [("automation_id", "automation_id")],
                [("list_id", "list_id"), ("segment_id", "segment_id")], by_source=scope.by_source)
    return attach_metrics(df, by_email, ["automation_email_id"], metric_names(unsubscribes),
                          by_source=scope.by_source)


def automations(stg_automations: DataFrame, by_automation: DataFrame,
                unsubscribes: bool, scope: Scope = Scope()) -> DataFrame:
    return attach_metrics(stg_automations, by_automation, ["automation_id"],
                          metric_names(unsubscribes), by_source=scope.by_source)
