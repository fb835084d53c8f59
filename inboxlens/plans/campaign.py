"""Campaign side: activities with time since send, per-send metrics (the hub
every campaign rollup reads), rollups by campaign / list / member / segment
and the campaigns output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import boundary_diff, surrogate_key
from ..operators.enrich import SR, attach, attach_metrics
from ..operators.rollups import engagement_counts, recipient_rollup, sum_members
from .scope import Scope

# A send key with more than one in HOT_KEYS of all sends is dealt out into shares
# of about that size; there are HOT_KEYS of them at most.
HOT_KEYS = 1024
# Keys that the frequency sketch tracks: it finds every key with more than about
# 7 / TRACKED of all sends, less than half of what makes a key hot.
TRACKED = 16384

METRICS = ("sends", "opens", "clicks", "unique_opens", "unique_clicks", "unsubscribes")


def metric_names(unsubscribes: bool) -> list[str]:
    return [m for m in METRICS if unsubscribes or m != "unsubscribes"]


def campaign_activities(stg_activities: DataFrame, stg_campaigns: DataFrame,
                        scope: Scope = Scope()) -> DataFrame:
    """Every campaign event with its campaign's send time and the minute /
    hour / day boundaries crossed since then (negative if before; NULL if the
    campaign is unknown or unsent)."""
    df = attach(stg_activities, stg_campaigns, [("campaign_id", "campaign_id")],
                [("send_timestamp", "send_timestamp")], by_source=scope.by_source)
    return df.select(
        "*",
        *[boundary_diff(u, "send_timestamp", "activity_timestamp").alias(f"time_since_send_{u}s")
          for u in ("minute", "hour", "day")])


def activities_by_email(activities: DataFrame, strategy: str = "two_phase",
                        scope: Scope = Scope()) -> DataFrame:
    """Per send (email_id): event counts, distinct members, first open and
    the shortest time to open, plus opened / clicked flags.

    The events are combined in their map tasks and shuffled once, by send, so
    that a key with very many events (those without a member share one per
    campaign) is a row per task."""
    mins = {"first_open_timestamp": "activity_timestamp",
            "time_to_open_minutes": "time_since_send_minutes",
            "time_to_open_hours": "time_since_send_hours",
            "time_to_open_days": "time_since_send_days"}
    df = engagement_counts(activities, scope.keys("email_id"), strategy=strategy,
                           open_mins=mins, carry=scope.carry, few_per_key=True)
    return df.select(SR, "email_id", "opens", "clicks", "unique_opens", "unique_clicks", *mins,
                     F.coalesce(F.col("opens") > 0, F.lit(False)).alias("was_opened"),
                     F.coalesce(F.col("clicks") > 0, F.lit(False)).alias("was_clicked"))


def hot_keys(sends: DataFrame) -> DataFrame:
    """``_hot`` and ``_shares`` of the send keys that hold more than one in
    HOT_KEYS of ``sends``: the shares follow a key's measured frequency.

    One pass with a frequency sketch that is merged map-side: a row of at most
    HOT_KEYS keys, whatever the number of sends. An estimate that is off only
    deals a key out more or less finely."""
    top = sends.agg(F.expr(f"approx_top_k(email_id, {HOT_KEYS}, {TRACKED})").alias("top"), F.count("*").alias("total"))
    return (top.select(F.explode("top").alias("key"), "total")
            .select(F.col("key.item").alias("_hot"), F.ceil(F.col("key.count") * HOT_KEYS / F.col("total")).cast("int").alias("_shares"))
            .where("_shares > 1"))


def _share(key: str, share: str) -> Column:
    """The join key of one share of a send key; ordinary keys are one share."""
    return F.expr(f"if(_shares is null, {key}, concat({key}, '-', {share}))")


def _every_share(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Rows to look up by send key, once for each share of it (``_key``)."""
    df = df.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")  # HOT_KEYS rows at most
    df = df.withColumn("_share", F.explode(F.sequence(F.lit(0), F.coalesce("_shares", F.lit(1)) - 1)))
    return df.withColumn("_key", _share(key, "_share")).drop("_hot", "_shares", "_share")


def campaign_recipients(stg_recipients: DataFrame, stg_campaigns: DataFrame,
                        by_email: DataFrame, stg_unsubscribes: DataFrame | None,
                        scope: Scope = Scope()) -> DataFrame:
    """One row per send with its campaign's segment and send time, its
    engagement (zeros when none) and whether the member unsubscribed from
    that campaign on that list.  Only events of a recorded send count.

    Both per-send joins are on one key, so the sends are shuffled once. It is
    the send key, and for hot ones (all of a campaign's sends without a member
    have the same) the key and a share, which the rows take in turn; the few
    rows that match a hot key are repeated for each of its shares."""
    bs = scope.by_source
    columns = stg_recipients.columns
    hot = hot_keys(stg_recipients)
    sends = (stg_recipients.withColumn("_row", F.monotonically_increasing_id())  # the same on every retry
             .join(F.broadcast(hot), F.col("email_id") == F.col("_hot"), "left")
             .withColumn("_key", _share("email_id", "pmod(_row, _shares)")).select(*columns, "_key"))
    df = attach(sends, stg_campaigns, [("campaign_id", "campaign_id")],
                [("segment_id", "segment_id"), ("send_timestamp", "send_timestamp")],
                by_source=bs)
    df = attach(df, _every_share(by_email, "email_id", hot), [("_key", "_key")],
                [(c, c) for c in ("opens", "unique_opens", "clicks", "unique_clicks",
                                  "was_opened", "was_clicked", "first_open_timestamp",
                                  "time_to_open_minutes", "time_to_open_hours",
                                  "time_to_open_days")],
                fill={"opens": 0, "unique_opens": 0, "clicks": 0, "unique_clicks": 0,
                      "was_opened": False, "was_clicked": False}, by_source=bs)
    if stg_unsubscribes is not None:
        # Per send key the distinct (member, campaign, list) that unsubscribed
        # (several only where keys collide); a NULL part never matches.
        parts = ("member_id", "campaign_id", "list_id")
        unsub = stg_unsubscribes.dropna(subset=list(parts)).select(
            SR, surrogate_key(SR, "campaign_id", "member_id").alias("_email_id"),
            F.struct(*parts).alias("_one"))
        unsub = _every_share(unsub, "_email_id", hot).groupBy(*scope.keys("_key")).agg(
            F.collect_set("_one").alias("_who"), *[F.any_value(c).alias(c) for c in scope.carry])
        df = attach(df, unsub, [("_key", "_key")], [("_who", "_who")], by_source=bs)
        df = df.withColumn("was_unsubscribed", F.coalesce(
            F.array_contains("_who", F.struct(*parts)), F.lit(False)))
    return df.select(*columns, *[c for c in df.columns if c not in {*columns, "_key", "_who"}])


def recipients_by(recipients: DataFrame, keys: list[str], unsubscribes: bool,
                  strategy: str = "two_phase", not_null: str | None = None,
                  scope: Scope = Scope()) -> DataFrame:
    """Campaign rollup of per-send rows by ``keys`` (rows with NULL
    ``not_null`` dropped first)."""
    if not_null:
        recipients = recipients.where(F.col(not_null).isNotNull())
    df = recipient_rollup(recipients, scope.keys(*keys), unsubscribes=unsubscribes,
                          strategy=strategy, carry=scope.carry)
    return df.select(SR, *keys, *metric_names(unsubscribes))


def by_list_from_members(by_member: DataFrame, unsubscribes: bool,
                         scope: Scope = Scope()) -> DataFrame:
    """Campaign rollup by list, from the one by member and list."""
    names = metric_names(unsubscribes)
    df = sum_members(by_member, scope.keys("list_id"), names, carry=scope.carry)
    return df.select(SR, "list_id", *names)


def campaigns(stg_campaigns: DataFrame, by_campaign: DataFrame, unsubscribes: bool,
              scope: Scope = Scope()) -> DataFrame:
    return attach_metrics(stg_campaigns, by_campaign, ["campaign_id"], metric_names(unsubscribes),
                          by_source=scope.by_source)
