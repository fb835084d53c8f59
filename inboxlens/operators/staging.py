"""Staging: conform each raw table, rename to analytics names, add keys.

Each function takes the unioned raw table (with ``source_relation``) and
returns the staged DataFrame.  The output column names and their order in
each projection below are fixed values: they must equal those of the
tables users already query.  Pure projections: no shuffle, and column
pruning reaches the Parquet scan when callers use fewer columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import surrogate_key
from ..functions.sql import alias, q
from ..options import Options
from ..sources.connections import conform

# Columns that the members output adds: no pass-through column may have their names.
MEMBER_METRICS = tuple(f"{side}_{m}" for side in ("campaign", "automation") for m in (
    "sends", "opens", "clicks", "unique_opens", "unique_clicks", "unsubscribes"))


def _columns(spec: list[str]) -> list[str]:
    """``spec`` entries are ``"col"`` or ``"raw as out"``; SQL select items."""
    cols = []
    for item in spec:
        raw, _, out = item.partition(" as ")
        cols.append(alias(q(raw), out or raw))
    return cols


def _project(df: DataFrame, spec: list[str]) -> DataFrame:
    return df.selectExpr(*_columns(spec))


def _with_time(df: DataFrame, column: str) -> DataFrame:
    """``column`` as a zone-free timestamp; text that is no time is NULL (see ``stg_rejects``)."""
    return df.withColumn(column, F.expr(f"try_cast({q(column)} AS TIMESTAMP_NTZ)"))


# Raw columns whose times are parsed, and the staged key of their rows.
PARSED_TIMES = (("campaign", "send_time", ("id",)),
                ("campaign_recipient_activity", "timestamp", ("action", "campaign_id", "member_id")))


def stg_rejects(raw: dict[str, DataFrame], options: Options = Options()) -> DataFrame:
    """The raw values that staging could not parse and left NULL: source_relation,
    source_table, column_name, row_key (the row's ids, joined by '-') and raw_value."""
    parts = []
    for table, column, ids in PARSED_TIMES:
        if table not in raw:
            continue
        df = conform(raw[table], table, options)
        key = ", ".join(f"coalesce(cast({q(c)} AS STRING), '')" for c in ids)
        parts.append(df.where(f"{q(column)} IS NOT NULL AND try_cast({q(column)} AS TIMESTAMP_NTZ) IS NULL").selectExpr(
            "source_relation", f"'{table}' AS source_table", f"'{column}' AS column_name",
            f"concat_ws('-', {key}) AS row_key", f"cast({q(column)} AS STRING) AS raw_value"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def stg_automations(raw: DataFrame, options: Options = Options()) -> DataFrame:
    df = conform(raw, "automation", options)
    return _project(df, [
        "source_relation", "id as automation_id", "list_id", "segment_id", "segment_text",
        "start_time as started_timestamp", "create_time as created_timestamp", "status",
        "title", "trigger_settings"])


def stg_automation_emails(raw: DataFrame, options: Options = Options()) -> DataFrame:
    df = conform(raw, "automation_email", options)
    return _project(df, [
        "source_relation", "id as automation_email_id", "automation_id",
        "create_time as created_timestamp", "start_time as started_timestamp",
        "send_time as send_timestamp", "from_name", "reply_to", "status", "subject_line",
        "title", "to_name", "archive_url", "authenticate", "auto_footer", "auto_tweet",
        "clicktale", "content_type", "delay_action", "delay_action_description",
        "delay_amount", "delay_direction", "delay_full_description", "delay_type",
        "drag_and_drop", "fb_comments", "folder_id", "google_analytics", "inline_css",
        "position", "template_id", "timewarp", "track_ecomm_360", "track_goals",
        "track_html_clicks", "track_opens", "track_text_clicks", "use_conversation"])


def stg_automation_recipients(raw: DataFrame, options: Options = Options()) -> DataFrame:
    df = _project(conform(raw, "automation_recipient", options),
                  ["source_relation", "member_id", "automation_email_id", "list_id"])
    return df.withColumn("automation_recipient_id",
                         surrogate_key("source_relation", "member_id", "automation_email_id"))


def stg_automation_activities(raw: DataFrame, options: Options = Options()) -> DataFrame:
    # The activity time is not cast here (it is in the campaign twin).
    df = _project(conform(raw, "automation_recipient_activity", options), [
        "source_relation", "action as action_type", "automation_email_id", "member_id",
        "list_id", "timestamp as activity_timestamp", "ip as ip_address", "url",
        "bounce_type"])
    return df.withColumn("activity_id", surrogate_key(
        "source_relation", "action_type", "automation_email_id", "member_id",
        "activity_timestamp"))


def stg_campaigns(raw: DataFrame, options: Options = Options()) -> DataFrame:
    df = _with_time(conform(raw, "campaign", options), "send_time")
    return _project(df, [
        "source_relation", "id as campaign_id", "segment_id", "create_time as create_timestamp",
        "send_time as send_timestamp", "list_id", "reply_to as reply_to_email",
        "type as campaign_type", "title", "archive_url", "authenticate", "auto_footer",
        "auto_tweet", "clicktale", "content_type", "drag_and_drop", "fb_comments",
        "folder_id", "from_name", "google_analytics", "inline_css", "long_archive_url",
        "status", "subject_line", "template_id", "test_size", "timewarp", "to_name",
        "track_ecomm_360", "track_goals", "track_html_clicks", "track_opens",
        "track_text_clicks", "use_conversation", "wait_time", "winner_criteria",
        "winning_campaign_id", "winning_combination_id"])


def stg_campaign_recipients(raw: DataFrame, options: Options = Options()) -> DataFrame:
    df = _project(conform(raw, "campaign_recipient", options),
                  ["source_relation", "campaign_id", "member_id", "combination_id", "list_id"])
    # list_id is not part of the send key: one campaign sent to one member on
    # two lists shares one email_id.
    return df.withColumn("email_id", surrogate_key("source_relation", "campaign_id", "member_id"))


def stg_campaign_activities(raw: DataFrame, options: Options = Options()) -> DataFrame:
    df = _with_time(conform(raw, "campaign_recipient_activity", options), "timestamp")
    df = _project(df, [
        "source_relation", "action as action_type", "campaign_id", "member_id", "list_id",
        "timestamp as activity_timestamp", "ip as ip_address", "url", "bounce_type",
        "combination_id"])
    # activity_id leaves out url: two clicks in the same second collide.
    return df.select(
        "*",
        surrogate_key("source_relation", "action_type", "campaign_id", "member_id",
                      "activity_timestamp").alias("activity_id"),
        surrogate_key("source_relation", "campaign_id", "member_id").alias("email_id"))


def stg_lists(raw: DataFrame, options: Options = Options()) -> DataFrame:
    return _project(conform(raw, "list", options), [
        "source_relation", "id as list_id", "date_created", "name", "list_rating",
        "beamer_address", "contact_address_1", "contact_address_2", "contact_city",
        "contact_company", "contact_country", "contact_state", "contact_zip",
        "default_from_email", "default_from_name", "default_language", "default_subject",
        "email_type_option", "notify_on_subscribe", "notify_on_unsubscribe",
        "permission_reminder", "subscribe_url_long", "subscribe_url_short",
        "use_archive_bar", "visibility"])


def stg_members(raw: DataFrame, options: Options = Options()) -> DataFrame:
    extra = [(p.name, p.datatype) for p in options.member_pass_through]
    df = conform(raw, "member", options, extra)
    cols = _columns([
        "source_relation", "id as member_id", "email_address", "email_client", "email_type",
        "status", "list_id", "timestamp_signup as signup_timestamp",
        "timestamp_opt as opt_in_timestamp", "last_changed as last_changed_timestamp",
        "country_code", "dstoff", "gmtoff", "ip_opt as opt_in_ip_address",
        "ip_signup as signup_ip_address", "language", "latitude", "longitude",
        "member_rating", "timezone", "unique_email_id", "vip"])
    # User-declared extra columns, evaluated on the conformed raw row.
    taken = {c.split(" AS ")[-1].strip("`").lower() for c in cols} | set(MEMBER_METRICS)
    for p in options.member_pass_through:
        out = (p.alias or p.name).lower()
        if out in taken:
            raise ValueError(f"pass-through column {p.alias or p.name!r} would duplicate a "
                             "column of the members output; give it another alias")
        taken.add(out)
    for p in options.member_pass_through:
        cols.append(alias(f"({p.transform_sql})" if p.transform_sql else q(p.name),
                          p.alias or p.name))
    return df.selectExpr(*cols)


def stg_segments(raw: DataFrame, options: Options = Options()) -> DataFrame:
    return _project(conform(raw, "segment", options), [
        "source_relation", "id as segment_id", "list_id", "member_count",
        "name as segment_name", "type as segment_type", "updated_at as updated_timestamp",
        "created_at as created_timestamp"])


def stg_segment_members(raw: DataFrame, options: Options = Options()) -> DataFrame:
    return _project(conform(raw, "segment_member", options),
                    ["source_relation", "segment_id", "member_id", "list_id"])


def stg_unsubscribes(raw: DataFrame, options: Options = Options()) -> DataFrame:
    df = _project(conform(raw, "unsubscribe", options), [
        "source_relation", "campaign_id", "member_id", "list_id",
        "reason as unsubscribe_reason", "timestamp as unsubscribe_timestamp"])
    return df.withColumn("unsubscribe_id", surrogate_key(
        "source_relation", "member_id", "list_id", "unsubscribe_timestamp"))


# raw table name -> (staged name, function)
STAGING = {
    "automation": ("stg_automations", stg_automations),
    "automation_email": ("stg_automation_emails", stg_automation_emails),
    "automation_recipient": ("stg_automation_recipients", stg_automation_recipients),
    "automation_recipient_activity": ("stg_automation_activities", stg_automation_activities),
    "campaign": ("stg_campaigns", stg_campaigns),
    "campaign_recipient": ("stg_campaign_recipients", stg_campaign_recipients),
    "campaign_recipient_activity": ("stg_campaign_activities", stg_campaign_activities),
    "list": ("stg_lists", stg_lists),
    "member": ("stg_members", stg_members),
    "segment": ("stg_segments", stg_segments),
    "segment_member": ("stg_segment_members", stg_segment_members),
    "unsubscribe": ("stg_unsubscribes", stg_unsubscribes),
}


def stage_all(raw: dict[str, DataFrame], options: Options = Options()) -> dict[str, DataFrame]:
    """Staged DataFrames keyed by staged name, for every raw table given."""
    staged = {name: fn(raw[t], options) for t, (name, fn) in STAGING.items() if t in raw}
    if any(t in raw for t, _, _ in PARSED_TIMES):
        staged["stg_rejects"] = stg_rejects(raw, options)
    return staged
