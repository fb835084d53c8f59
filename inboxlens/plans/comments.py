"""Comments on the tables and columns of a written build.

Keys, metrics, times and switches are described by rules over their names; what
a name does not tell is listed. A comment is metadata of the DataFrame's field,
so it needs no further statement, and it is in the schema of a catalog table, of
a view on it and of a table that ``read_build`` reads from a folder alike.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sql import q

TABLES = {
    "campaign_activities": "One row per open, click or bounce of a campaign, with the time since the campaign was sent",
    "campaign_recipients": "One row per campaign send, with its engagement and whether the member unsubscribed",
    "campaigns": "One row per campaign, with its sends and engagement",
    "automation_activities": "One row per open, click or bounce of an automation email, with its automation and segment",
    "automation_emails": "One row per automation email, with its sends and engagement",
    "automations": "One row per automation, with the sends and engagement of its emails",
    "members": "One row per member of a list, with the engagement of their campaign and automation sends",
    "lists": "One row per list, with its members and the engagement of its sends",
    "segments": "One row per segment of a list, with the engagement of its sends",
    "stg_rejects": "Raw values that staging could not parse as a time and left NULL",
}
# Entities whose ids, titles and the like are columns.
ENTITIES = {"campaign": "campaign", "automation": "automation", "automation_email": "automation email", "list": "list",
            "member": "member", "segment": "segment", "email": "send", "activity": "event", "unsubscribe": "unsubscribe",
            "automation_recipient": "automation send", "combination": "variant of a test campaign", "folder": "folder",
            "template": "template", "unique_email": "address across all lists", "winning_campaign": "winning test campaign",
            "winning_combination": "winning variant"}
# Keys that are made here, from the parts named.
MADE_KEYS = {
    ("activity_id", "campaign"): "Key of the event: account, action, campaign, member and time",
    ("activity_id", "automation"): "Key of the event: account, action, automation email, member and time",
    ("email_id", ""): "Key of the send: account, campaign and member",
    ("automation_recipient_id", ""): "Key of the send: account, member and automation email",
    ("unsubscribe_id", ""): "Key of the unsubscribe: account, member, list and time",
}
METRICS = {"sends": "Emails sent", "opens": "Opens", "clicks": "Clicks", "unique_opens": "Distinct members that opened",
           "unique_clicks": "Distinct members that clicked", "unsubscribes": "Members that unsubscribed"}
TRACKED = {"ecomm_360": "purchases", "goals": "goals", "html_clicks": "clicks in the HTML version",
           "text_clicks": "clicks in the text version", "opens": "opens"}
COLUMNS = {
    "source_relation": "Account that the row comes from", "action_type": "Kind of the event: open, click or bounce",
    "ip_address": "Address that the event came from", "url": "Link that was clicked", "bounce_type": "Hard or soft, for bounces",
    "was_opened": "Whether the send was opened", "was_clicked": "Whether a link of the send was clicked",
    "was_unsubscribed": "Whether the member unsubscribed from this campaign",
    "first_open_timestamp": "First open of the send (UTC)", "count_members": "Member rows of the list",
    "most_recent_signup_timestamp": "Latest signup to the list (UTC)", "member_count": "Members as the source counts them",
    "status": "State of the row in the source", "title": "Title", "name": "Name", "list_name": "Name of the segment's list",
    "segment_name": "Name of the segment", "segment_type": "How members come into the segment", "segment_text": "The segment's conditions in words",
    "trigger_settings": "What starts the automation (JSON)", "subject_line": "Subject line", "from_name": "Name of the sender",
    "to_name": "Name of the addressee", "reply_to": "Address for replies", "reply_to_email": "Address for replies",
    "archive_url": "Short link to the archived email", "long_archive_url": "Full link to the archived email",
    "campaign_type": "Kind of campaign", "content_type": "How the content was made", "email_address": "Email address",
    "email_client": "Mail program", "email_type": "HTML or text", "email_type_option": "Whether members choose HTML or text",
    "list_rating": "Rating of the list", "member_rating": "Rating of the member", "language": "Language", "timezone": "Time zone",
    "latitude": "Latitude", "longitude": "Longitude", "country_code": "Country", "gmtoff": "Hours from UTC",
    "dstoff": "Hours from UTC in summer time", "vip": "Whether the member is marked as important", "position": "Place of the email in its automation",
    "visibility": "Whether the list is public", "permission_reminder": "Why members get these emails", "beamer_address": "Address that mails to the list",
    "unsubscribe_reason": "Reason the member gave", "test_size": "Share of the list that gets test variants", "wait_time": "Wait before a winner is picked",
    "winner_criteria": "What decides the winner of a test", "source_table": "Raw table of the value", "column_name": "Raw column of the value",
    "row_key": "Ids of the row, joined by '-'", "raw_value": "The value as it came", "date_created": "Creation (UTC)",
}


def column_comment(table: str, column: str) -> str | None:
    """What a column of a written table holds; None for columns not of the model
    (such as members' pass-through columns)."""
    side = next((s for s in ("automation", "campaign") if s in table), "")
    made = MADE_KEYS.get((column, side)) or MADE_KEYS.get((column, ""))
    if made:
        return made
    if column in COLUMNS:
        return COLUMNS[column]
    if m := re.fullmatch(r"(?:(campaign|automation)_)?(\w+)", column):
        if m[2] in METRICS:
            return METRICS[m[2]] + (f", {m[1]}s only" if m[1] else "")
    if (m := re.fullmatch(r"(\w+)_id", column)) and m[1] in ENTITIES:
        return f"Id of the {ENTITIES[m[1]]}"
    if m := re.fullmatch(r"time_since_send_(minute|hour|day)s", column):
        return f"Whole {m[1]}s crossed from the campaign's send to the event"
    if m := re.fullmatch(r"time_to_open_(minute|hour|day)s", column):
        return f"Whole {m[1]}s crossed from the campaign's send to the first open"
    if m := re.fullmatch(r"track_(\w+)", column):
        return f"Whether {TRACKED.get(m[1], m[1])} are tracked"
    if m := re.fullmatch(r"(\w+)_timestamp", column):
        return f"Time of {m[1].replace('_', ' ')} (UTC)"
    if m := re.fullmatch(r"(contact|default|delay|subscribe_url)_(\w+)", column):
        return f"{m[1].replace('_', ' ').capitalize()}: {m[2].replace('_', ' ')}"
    if m := re.fullmatch(r"(opt_in|signup)_ip_address", column):
        return f"Address that the {m[1].replace('_', '-')} came from"
    if m := re.fullmatch(r"notify_on_(\w+)", column):
        return f"Address told of each {m[1]}"
    if column in SWITCHES:
        return f"Setting of the source: {column.replace('_', ' ')}"
    return None


SWITCHES = ("authenticate", "auto_footer", "auto_tweet", "clicktale", "drag_and_drop", "fb_comments", "google_analytics",
            "inline_css", "timewarp", "use_archive_bar", "use_conversation")


def table_comment(table: str) -> str | None:
    if table in TABLES:
        return TABLES[table]
    if table.startswith("stg_"):
        return f"Staged rows of the raw {table.removeprefix('stg_').replace('_', ' ')}: declared columns, renamed, with keys"
    return None


def commented(table: str, df: DataFrame) -> DataFrame:
    """``df`` with a comment in the metadata of each column that has one."""
    def column(field):
        comment = column_comment(table, field.name)
        if comment is None:
            return F.col(q(field.name))
        return F.col(q(field.name)).alias(field.name, metadata={**field.metadata, "comment": comment})

    return df.select(*map(column, df.schema.fields))
