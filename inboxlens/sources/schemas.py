"""Declared column lists of the twelve raw source tables.

The staging layer reads whatever columns a source really has, keeps the
declared ones, fills absent declared columns with a typed NULL and drops
everything else.  Declared types only matter for the NULL fill; present
columns pass through with their own type.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Logical type names used in the declarations below.
_TYPES = {
    "string": T.StringType(),
    "int": T.LongType(),
    "float": T.DoubleType(),
    "boolean": T.BooleanType(),
    # Raw tables carry naive wall-clock times; keep them zone-free so results
    # never depend on the session time zone.
    "timestamp": T.TimestampNTZType(),
}

# Placeholders for the connector bookkeeping columns; their real names are
# configurable (``Options.synced_column`` / ``Options.deleted_column``).
SYNCED = "<synced>"
DELETED = "<deleted>"

# ---------------------------------------------------------------------------
# Declared columns and types per raw table (must match the
# upstream connector's table layout).  A few declared types are text in
# practice and are declared as string here: bounce_type, reason,
# contact_address_2, default_subject, segment_text, to_name,
# delay_direction, winner_criteria, winning_campaign_id,
# notify_on_subscribe, notify_on_unsubscribe.
# ---------------------------------------------------------------------------
DECLARED: dict[str, list[tuple[str, str]]] = {
    "automation": [
        (DELETED, "boolean"), (SYNCED, "timestamp"), ("create_time", "timestamp"),
        ("id", "string"), ("list_id", "string"), ("segment_id", "int"),
        ("segment_text", "string"), ("start_time", "timestamp"), ("status", "string"),
        ("title", "string"), ("trigger_settings", "string"),
    ],
    "automation_email": [
        (DELETED, "boolean"), (SYNCED, "timestamp"), ("archive_url", "string"),
        ("authenticate", "boolean"), ("auto_footer", "boolean"), ("auto_tweet", "boolean"),
        ("automation_id", "string"), ("clicktale", "int"), ("content_type", "string"),
        ("create_time", "timestamp"), ("delay_action", "string"),
        ("delay_action_description", "string"), ("delay_amount", "int"),
        ("delay_direction", "string"), ("delay_full_description", "string"),
        ("delay_type", "string"), ("drag_and_drop", "boolean"), ("fb_comments", "boolean"),
        ("folder_id", "int"), ("from_name", "string"), ("google_analytics", "string"),
        ("id", "string"), ("inline_css", "boolean"), ("position", "int"),
        ("reply_to", "string"), ("send_time", "timestamp"), ("start_time", "timestamp"),
        ("status", "string"), ("subject_line", "string"), ("template_id", "int"),
        ("timewarp", "int"), ("title", "string"), ("to_name", "string"),
        ("track_ecomm_360", "boolean"), ("track_goals", "boolean"),
        ("track_html_clicks", "boolean"), ("track_opens", "boolean"),
        ("track_text_clicks", "boolean"), ("use_conversation", "int"),
    ],
    "automation_recipient": [
        (SYNCED, "timestamp"), ("automation_email_id", "string"), ("list_id", "string"),
        ("member_id", "string"),
    ],
    "automation_recipient_activity": [
        (SYNCED, "timestamp"), ("action", "string"), ("automation_email_id", "string"),
        ("bounce_type", "string"), ("ip", "string"), ("list_id", "string"),
        ("member_id", "string"), ("timestamp", "timestamp"), ("url", "string"),
    ],
    "campaign": [
        (DELETED, "boolean"), (SYNCED, "timestamp"), ("archive_url", "string"),
        ("authenticate", "boolean"), ("auto_footer", "boolean"), ("auto_tweet", "boolean"),
        ("clicktale", "string"), ("content_type", "string"), ("create_time", "timestamp"),
        ("drag_and_drop", "boolean"), ("fb_comments", "boolean"), ("folder_id", "int"),
        ("from_name", "string"), ("google_analytics", "string"), ("id", "string"),
        ("inline_css", "boolean"), ("list_id", "string"), ("long_archive_url", "string"),
        ("reply_to", "string"), ("segment_id", "int"), ("segment_text", "string"),
        ("send_time", "timestamp"), ("status", "string"), ("subject_line", "string"),
        ("template_id", "int"), ("test_size", "int"), ("timewarp", "boolean"),
        ("title", "string"), ("to_name", "string"), ("track_ecomm_360", "boolean"),
        ("track_goals", "boolean"), ("track_html_clicks", "boolean"),
        ("track_opens", "boolean"), ("track_text_clicks", "boolean"), ("type", "string"),
        ("use_conversation", "boolean"), ("wait_time", "int"), ("winner_criteria", "string"),
        ("winning_campaign_id", "string"), ("winning_combination_id", "int"),
    ],
    "campaign_recipient": [
        (SYNCED, "timestamp"), ("campaign_id", "string"), ("combination_id", "int"),
        ("list_id", "string"), ("member_id", "string"),
    ],
    "campaign_recipient_activity": [
        (SYNCED, "timestamp"), ("action", "string"), ("bounce_type", "string"),
        ("campaign_id", "string"), ("combination_id", "int"), ("ip", "string"),
        ("list_id", "string"), ("member_id", "string"), ("timestamp", "timestamp"),
        ("url", "string"),
    ],
    "list": [
        (DELETED, "boolean"), (SYNCED, "timestamp"), ("beamer_address", "string"),
        ("contact_address_1", "string"), ("contact_address_2", "string"),
        ("contact_city", "string"), ("contact_company", "string"),
        ("contact_country", "string"), ("contact_state", "string"), ("contact_zip", "string"),
        ("date_created", "timestamp"), ("default_from_email", "string"),
        ("default_from_name", "string"), ("default_language", "string"),
        ("default_subject", "string"), ("email_type_option", "boolean"), ("id", "string"),
        ("list_rating", "float"), ("name", "string"), ("notify_on_subscribe", "string"),
        ("notify_on_unsubscribe", "string"), ("permission_reminder", "string"),
        ("subscribe_url_long", "string"), ("subscribe_url_short", "string"),
        ("use_archive_bar", "boolean"), ("visibility", "string"),
    ],
    "member": [
        (SYNCED, "timestamp"), ("country_code", "string"), ("dstoff", "float"),
        ("email_address", "string"), ("email_client", "string"), ("email_type", "string"),
        ("gmtoff", "float"), ("id", "string"), ("ip_opt", "string"), ("ip_signup", "string"),
        ("language", "string"), ("last_changed", "timestamp"), ("latitude", "float"),
        ("list_id", "string"), ("longitude", "float"), ("member_rating", "int"),
        ("status", "string"), ("timestamp_opt", "timestamp"), ("timestamp_signup", "timestamp"),
        ("timezone", "string"), ("unique_email_id", "string"), ("vip", "boolean"),
    ],
    "segment": [
        (DELETED, "boolean"), (SYNCED, "timestamp"), ("created_at", "timestamp"),
        ("id", "int"), ("list_id", "string"), ("member_count", "int"), ("name", "string"),
        ("type", "string"), ("updated_at", "timestamp"),
    ],
    "segment_member": [
        (DELETED, "boolean"), (SYNCED, "timestamp"), ("list_id", "string"),
        ("member_id", "string"), ("segment_id", "int"),
    ],
    "unsubscribe": [
        (SYNCED, "timestamp"), ("campaign_id", "string"), ("list_id", "string"),
        ("member_id", "string"), ("reason", "string"), ("timestamp", "timestamp"),
    ],
}

SOURCE_TABLES = tuple(DECLARED)

# Raw tables that only exist when the matching feature switch is on.
AUTOMATION_TABLES = ("automation", "automation_email", "automation_recipient",
                     "automation_recipient_activity")
SEGMENT_TABLES = ("segment", "segment_member")
UNSUBSCRIBE_TABLES = ("unsubscribe",)


def spark_type(name: str) -> T.DataType:
    """A declared type name, or any Spark DDL type (``bigint``, ``date``, ...)."""
    return _TYPES.get(name) or T.DataType.fromDDL(name)


def declared_type(table: str, column: str) -> T.DataType | None:
    """Declared type of a raw column (any case); None for undeclared ones."""
    return next((spark_type(t) for n, t in DECLARED.get(table, []) if n.lower() == column.lower()), None)


def declared_columns(table: str, synced_column: str, deleted_column: str,
                     extra: list[tuple[str, str]] | None = None) -> list[tuple[str, T.DataType]]:
    """Declared (column, Spark type) list of ``table`` with real bookkeeping names."""
    rename = {SYNCED: synced_column, DELETED: deleted_column}
    cols = [(rename.get(n, n), spark_type(t)) for n, t in DECLARED[table]]
    for name, type_name in extra or []:
        if name.lower() not in {c.lower() for c, _ in cols}:
            cols.append((name, spark_type(type_name)))
    return cols
