"""DuckDB SQL computing the same tables as the Spark plans, for the
side-by-side correctness check.

Written as plain one-phase SQL (COUNT(DISTINCT ...) FILTER, chained LEFT JOINs, the
members-by-list count read from the members table) so that any rewrite in
the Spark plans shows up as a difference.  Only the declared column lists
and the description of the test accounts are shared with the library.
"""

from __future__ import annotations

from inboxlens.plans.build import OUTPUTS
from inboxlens.plans.registry import GAP_MODELS, GAPS, GARBLED, LATER_BUILD, ONE_EMPTY, OTHER, OTHER_TYPES
from inboxlens.sources.fixtures import Account
from inboxlens.sources.schemas import DECLARED, DELETED as DELETED_MARK, SYNCED as SYNCED_MARK

SYNCED = "_synced"
BOOKKEEPING = {SYNCED_MARK: SYNCED, DELETED_MARK: "_deleted"}
KEY_NULL = "_dbt_utils_surrogate_key_null_"

TYPES = {"string": "varchar", "int": "bigint", "float": "double", "boolean": "boolean",
         "timestamp": "timestamp"}

# Raw columns that come from driver columns (SQL over the view's rows); the
# others are filled by the rule below.
GIVEN = {
    "automation": {"id": "k::varchar", "list_id": "n_regionkey::varchar", "title": "n_name",
                   "segment_id": "case when k % 4 <> 0 then k::int end"},
    "automation_email": {"id": "k::varchar", "automation_id": "s_nationkey::varchar", "title": "s_name"},
    "automation_recipient": {"automation_email_id": "sk::varchar", "member_id": "member_id", "list_id": "list_id"},
    "automation_recipient_activity": {"action": "action", "automation_email_id": "sk::varchar", "member_id": "member_id",
                                      "list_id": "list_id", "timestamp": "ts"},
    "campaign": {"id": "k::varchar", "list_id": "n_regionkey::varchar", "title": "s_name",
                 "send_time": "case when k % 10 <> 4 then send_time end",
                 "segment_id": "case when n_nationkey % 4 <> 0 then n_nationkey end"},
    "campaign_recipient": {"campaign_id": "sk::varchar", "member_id": "member_id", "list_id": "list_id"},
    "campaign_recipient_activity": {"action": "action", "campaign_id": "sk::varchar", "member_id": "member_id",
                                    "list_id": "list_id", "timestamp": "ts"},
    "list": {"id": "k::varchar", "name": "r_name", "list_rating": "k::double"},
    "member": {"id": "member_id", "list_id": "list_id", "country_code": "n_name", "timestamp_signup": "first_order",
               "vip": "c_acctbal > 9000", "status": "status"},
    "segment": {"id": "n_nationkey", "list_id": "n_regionkey::varchar", "name": "n_name", "type": "'static'"},
    "segment_member": {"segment_id": "c_nationkey", "member_id": "member_id", "list_id": "list_id"},
    "unsubscribe": {"campaign_id": "sk::varchar", "member_id": "member_id", "list_id": "list_id", "timestamp": "ts"},
}


def _filled(column: str, position: int, kind: str, label: str) -> str:
    text = f"'{column}-' || k::varchar" + (f" || case when k % 3 = 0 then '{label}' else '' end" if label else "")
    return {"string": text, "int": f"(k % 1000 + {position * 1000})::int",
            "float": f"(k % 1000)::double + {position / 4}::double",
            "boolean": f"substr(md5('{column}' || k::varchar), 1, 1) < '8'",
            "bigint": f"k % 1000 + {position * 1000}",
            "date": f"(date '1990-01-01' + (k % 3650 + {position})::int)::date",
            "timestamp": f"timestamp '2024-01-20 00:00:00' + to_minutes(((k * 7 + {position}) % 20000)::bigint)"}[kind]


# Raw member columns behind the declared ones, held only where they are passed through.
UNDECLARED = (("merge_fname", "string"), ("points", "bigint"), ("born", "date"))


def fixture_views(p: str, account: Account, undeclared: tuple[tuple[str, str], ...] = ()) -> str:
    """The raw tables of an account as views named ``{p}fx_<table>``; ``undeclared``: further member columns."""
    total = "((select count(*) from supplier) + (select count(*) from nation))"
    rows = {
        "automation": "from {p}nation", "automation_email": "from {p}mailing where k % 2 = 1",
        "automation_recipient": "from {p}rec where sk % 2 = 1",
        "automation_recipient_activity": "from {p}ev where event_type in ('view', 'click', 'error') and sk % 2 = 1",
        "campaign": "from {p}mailing join nation on s_nationkey = n_nationkey left join {p}sent on sk = k where k % 2 = 0",
        "campaign_recipient": "from {p}rec where sk % 2 = 0",
        "campaign_recipient_activity": "from {p}ev where event_type in ('view', 'click', 'error') and sk % 2 = 0",
        "list": "from (select *, r_regionkey::bigint as k from region)", "member": "from {p}member",
        "segment": "from {p}nation", "segment_member": "from (select *, c_custkey as k from {p}home)",
        "unsubscribe": "from {p}ev where event_type = 'signup'",
    }
    views = [f"""{p}nation as (select *, n_nationkey::bigint as k from nation),
{p}home as (select c_custkey, c_custkey::varchar as member_id, n_regionkey::varchar as list_id, n_name, c_acctbal, c_nationkey, n_regionkey
            from customer join nation on c_nationkey = n_nationkey),
{p}first as (select o_custkey, min(o_orderdate) as first_order from orders group by o_custkey),
{p}member as (
  select *, c_custkey as k, case when c_custkey % 7 = 0 then 'unsubscribed' else 'subscribed' end as status
  from {p}home left join {p}first on o_custkey = c_custkey
  union all
  select * replace (((n_regionkey + 1) % 5)::varchar as list_id), c_custkey + 1000000007, 'subscribed'
  from {p}home left join {p}first on o_custkey = c_custkey where c_custkey % 10 = 0),
{p}ev as (select event_id % {total} + {account.shift} as sk, event_id as k, member_id, list_id, event_type,
                 ts + to_minutes({account.minutes}) as ts,
                 case event_type when 'view' then 'open' when 'error' then 'bounce' else event_type end as action
          from events join {p}home on user_id = c_custkey),
{p}sent as (select sk, min(ts) as send_time from {p}ev where event_type = 'purchase' group by sk),
{p}mailing as (
  select s_suppkey + {account.shift} as k, s_name, s_nationkey from supplier union all
  select (select count(*) from supplier) + n_nationkey + {account.shift}, 'Extra ' || n_name, n_nationkey from nation),
{p}rec as (select *, sk * 1000003 + member_id::bigint as k
           from (select distinct l_suppkey + {account.shift} as sk, member_id, list_id
                 from lineitem join orders on l_orderkey = o_orderkey join {p}home on o_custkey = c_custkey))"""]
    types = {(t, c): kind for t, c, kind in account.types}
    for table, source in rows.items():
        cols = []
        for position, (name, kind) in enumerate([*DECLARED[table], *(undeclared if table == "member" else ())]):
            name = BOOKKEEPING.get(name, name)
            if (table, name) in account.without:
                value = f"null::{TYPES[kind]}"
            else:
                value = GIVEN[table].get(name) or _filled(name, position, kind, account.label)
            if (table, name) in types:
                value = f"cast({value} as {types[table, name].replace('string', 'varchar')})"
            if (table, name) in account.garbled:
                value = f"case when k % 11 = 0 then 'no time ' || k::varchar else ({value})::varchar end"
            if (table, name) in account.blank:
                value = f"case when k % 5 <> 0 then {value} end"
            cols.append(f'{value} as "{name}"')
        limit = " limit 0" if table in account.empty else ""
        views.append(f"{p}fx_{table} as (select {', '.join(cols)} {source.format(p=p)}{limit})")
    return ",\n".join(views)


# The contract of the staged tables (output name and column order,
# key parts, casts) is stated once more here, apart from the library.
# Staged output: (output column, raw column) in output order.
STAGED = {
    "automation": ("stg_automations", "source_relation, id as automation_id, list_id, segment_id, segment_text, start_time as started_timestamp, create_time as created_timestamp, status, title, trigger_settings"),
    "automation_email": ("stg_automation_emails", "source_relation, id as automation_email_id, automation_id, create_time as created_timestamp, start_time as started_timestamp, send_time as send_timestamp, from_name, reply_to, status, subject_line, title, to_name, archive_url, authenticate, auto_footer, auto_tweet, clicktale, content_type, delay_action, delay_action_description, delay_amount, delay_direction, delay_full_description, delay_type, drag_and_drop, fb_comments, folder_id, google_analytics, inline_css, position, template_id, timewarp, track_ecomm_360, track_goals, track_html_clicks, track_opens, track_text_clicks, use_conversation"),
    "automation_recipient": ("stg_automation_recipients", "source_relation, member_id, automation_email_id, list_id"),
    "automation_recipient_activity": ("stg_automation_activities", "source_relation, action as action_type, automation_email_id, member_id, list_id, timestamp as activity_timestamp, ip as ip_address, url, bounce_type"),
    "campaign": ("stg_campaigns", "source_relation, id as campaign_id, segment_id, create_time as create_timestamp, send_time as send_timestamp, list_id, reply_to as reply_to_email, type as campaign_type, title, archive_url, authenticate, auto_footer, auto_tweet, clicktale, content_type, drag_and_drop, fb_comments, folder_id, from_name, google_analytics, inline_css, long_archive_url, status, subject_line, template_id, test_size, timewarp, to_name, track_ecomm_360, track_goals, track_html_clicks, track_opens, track_text_clicks, use_conversation, wait_time, winner_criteria, winning_campaign_id, winning_combination_id"),
    "campaign_recipient": ("stg_campaign_recipients", "source_relation, campaign_id, member_id, combination_id, list_id"),
    "campaign_recipient_activity": ("stg_campaign_activities", "source_relation, action as action_type, campaign_id, member_id, list_id, timestamp as activity_timestamp, ip as ip_address, url, bounce_type, combination_id"),
    "list": ("stg_lists", "source_relation, id as list_id, date_created, name, list_rating, beamer_address, contact_address_1, contact_address_2, contact_city, contact_company, contact_country, contact_state, contact_zip, default_from_email, default_from_name, default_language, default_subject, email_type_option, notify_on_subscribe, notify_on_unsubscribe, permission_reminder, subscribe_url_long, subscribe_url_short, use_archive_bar, visibility"),
    "member": ("stg_members", "source_relation, id as member_id, email_address, email_client, email_type, status, list_id, timestamp_signup as signup_timestamp, timestamp_opt as opt_in_timestamp, last_changed as last_changed_timestamp, country_code, dstoff, gmtoff, ip_opt as opt_in_ip_address, ip_signup as signup_ip_address, language, latitude, longitude, member_rating, timezone, unique_email_id, vip"),
    "segment": ("stg_segments", "source_relation, id as segment_id, list_id, member_count, name as segment_name, type as segment_type, updated_at as updated_timestamp, created_at as created_timestamp"),
    "segment_member": ("stg_segment_members", "source_relation, segment_id, member_id, list_id"),
    "unsubscribe": ("stg_unsubscribes", "source_relation, campaign_id, member_id, list_id, reason as unsubscribe_reason, timestamp as unsubscribe_timestamp"),
}

KEYS = {
    "automation_recipient": [("automation_recipient_id", ["source_relation", "member_id", "automation_email_id"])],
    "automation_recipient_activity": [("activity_id", ["source_relation", "action_type", "automation_email_id", "member_id", "activity_timestamp"])],
    "campaign_recipient": [("email_id", ["source_relation", "campaign_id", "member_id"])],
    "campaign_recipient_activity": [("activity_id", ["source_relation", "action_type", "campaign_id", "member_id", "activity_timestamp"]),
                                    ("email_id", ["source_relation", "campaign_id", "member_id"])],
    "unsubscribe": [("unsubscribe_id", ["source_relation", "member_id", "list_id", "unsubscribe_timestamp"])],
}

def _key(cols: list[str]) -> str:
    return "md5(" + " || '-' || ".join(
        f"coalesce(cast({c} as varchar), '{KEY_NULL}')" for c in cols) + ")"


def _raw_select(table: str, conn: str, p: str, casts: dict[tuple[str, str], str], passthrough: str = "") -> str:
    sel = [f"'{conn}' as source_relation"]
    for item in STAGED[table][1].split(", ")[1:]:
        raw, _, out = item.partition(" as ")
        expr = f'"{raw}"'
        if (table, raw) in casts:
            expr = f"try_cast({expr} as {casts[table, raw]})"
        sel.append(f"{expr} as {out or raw}")
    return f"select {', '.join(sel)}{passthrough if table == 'member' else ''} from {p}fx_{table}"


def staging_ctes(p: str, conns: list[tuple[str, Account]], passthrough: str = "",
                 absent: tuple[tuple[str, str], ...] = (),
                 casts: dict[tuple[str, str], str] | None = None) -> list[str]:
    """The accounts' raw tables, and the staged ones named ``{p}stg_*`` over them."""
    out = [fixture_views(f"{p}x{i}_", account, UNDECLARED if passthrough else ()) for i, (_, account) in enumerate(conns)]
    for table, (name, _) in STAGED.items():
        body = " union all ".join(_raw_select(table, c, f"{p}x{i}_", casts or {}, passthrough) for i, (c, _) in enumerate(conns)
                                  if (c, table) not in absent)
        keys = "".join(f", {_key(cols)} as {k}" for k, cols in KEYS.get(table, []))
        out.append(f"{p}{name} as (select *{keys} from ({body}))")
    return out


def _metrics(alias: str, prefix: str, unsub: bool) -> str:
    names = ["sends", "opens", "clicks", "unique_opens", "unique_clicks"] + (["unsubscribes"] if unsub else [])
    return ", ".join(f"coalesce({alias}.{n}, 0) as {prefix}{n}" for n in names)


def _on(a: str, b: str, *cols: str) -> str:
    return " and ".join(f"{a}.{c} = {b}.{c}" for c in ("source_relation",) + cols)


def model_ctes(p: str, auto: bool = True, unsub: bool = True, segs: bool = True) -> list[str]:
    u_count = ", count(distinct member_id) filter (where was_unsubscribed) as unsubscribes" if unsub else ""
    c = [
        f"""{p}campaign_activities as (
  select a.*, c.send_timestamp,
         datediff('minute', c.send_timestamp, a.activity_timestamp) as time_since_send_minutes,
         datediff('hour', c.send_timestamp, a.activity_timestamp) as time_since_send_hours,
         datediff('day', c.send_timestamp, a.activity_timestamp) as time_since_send_days
  from {p}stg_campaign_activities a left join {p}stg_campaigns c on {_on('a', 'c', 'campaign_id')})""",
        f"""{p}int_campaign_activities_by_email as (
  select *, ifnull(opens, 0) > 0 as was_opened, ifnull(clicks, 0) > 0 as was_clicked
  from (select source_relation, email_id,
               cast(sum(1) filter (where action_type = 'open') as bigint) as opens,
               cast(sum(1) filter (where action_type = 'click') as bigint) as clicks,
               count(distinct member_id) filter (where action_type = 'open') as unique_opens,
               count(distinct member_id) filter (where action_type = 'click') as unique_clicks,
               min(activity_timestamp) filter (where action_type = 'open') as first_open_timestamp,
               min(time_since_send_minutes) filter (where action_type = 'open') as time_to_open_minutes,
               min(time_since_send_hours) filter (where action_type = 'open') as time_to_open_hours,
               min(time_since_send_days) filter (where action_type = 'open') as time_to_open_days
        from {p}campaign_activities group by source_relation, email_id))""",
        f"""{p}campaign_recipients as (
  select r.*, c.segment_id, c.send_timestamp,
         coalesce(e.opens, 0) as opens, coalesce(e.unique_opens, 0) as unique_opens,
         coalesce(e.clicks, 0) as clicks, coalesce(e.unique_clicks, 0) as unique_clicks,
         coalesce(e.was_opened, false) as was_opened, coalesce(e.was_clicked, false) as was_clicked,
         e.first_open_timestamp, e.time_to_open_minutes, e.time_to_open_hours, e.time_to_open_days
         {", u.member_id is not null as was_unsubscribed" if unsub else ""}
  from {p}stg_campaign_recipients r
  left join {p}stg_campaigns c on {_on('r', 'c', 'campaign_id')}
  left join {p}int_campaign_activities_by_email e on {_on('r', 'e', 'email_id')}
  {f"left join (select distinct source_relation, member_id, list_id, campaign_id from {p}stg_unsubscribes) u on {_on('r', 'u', 'member_id', 'campaign_id', 'list_id')}" if unsub else ""})""",
    ]
    for by, keys, where in (("campaign", "campaign_id", ""), ("list", "list_id", ""),
                            ("member", "member_id, list_id", ""),
                            ("segment", "segment_id", "where segment_id is not null")):
        c.append(f"""{p}int_campaign_activities_by_{by} as (
  select source_relation, {keys}, count(*) as sends, cast(sum(opens) as bigint) as opens,
         cast(sum(clicks) as bigint) as clicks,
         count(distinct member_id) filter (where was_opened) as unique_opens,
         count(distinct member_id) filter (where was_clicked) as unique_clicks{u_count}
  from {p}campaign_recipients {where} group by source_relation, {keys})""")
    c.append(f"""{p}campaigns as (
  select c.*, {_metrics('b', '', unsub)}
  from {p}stg_campaigns c left join {p}int_campaign_activities_by_campaign b on {_on('c', 'b', 'campaign_id')})""")

    if auto:
        owner = (f"left join {p}stg_automation_emails e on x.{{k}} = e.automation_email_id and x.source_relation = e.source_relation "
                 f"left join {p}stg_automations au on e.automation_id = au.automation_id and e.source_relation = au.source_relation")
        c.append(f"""{p}automation_activities as (select x.*, au.automation_id, au.segment_id
  from {p}stg_automation_activities x {owner.format(k='automation_email_id')})""")
        c.append(f"""{p}int_automation_recipients as (select x.*, au.segment_id, au.automation_id
  from {p}stg_automation_recipients x {owner.format(k='automation_email_id')})""")
        if unsub:
            c.append(f"""{p}int_automation_unsubscribes as (select x.*, au.segment_id, au.automation_id
  from {p}stg_unsubscribes x {owner.format(k='campaign_id')})""")
        for by, key, ukey, dk, lifted in (
                ("automation", "automation_id", "automation_id", "member_id", False),
                ("email", "automation_email_id", "campaign_id", "member_id", False),
                ("list", "list_id", "list_id", "member_id", False),
                ("member", "member_id, list_id", "member_id, list_id", "member_id", True),
                ("segment", "segment_id", "segment_id", "segment_id", False)):
            where = "where segment_id is not null" if by == "segment" else ""
            keys = [k.strip() for k in key.split(",")]
            ukeys = [k.strip() for k in ukey.split(",")]
            sel_keys = ", ".join(("ev." if (lifted and k == "list_id") else "s.") + k for k in keys)
            join_ev = " and ".join(f"ev.{k} = s.{k}" for k in keys + ["source_relation"])
            join_u = " and ".join(f"un.{k} = s.{k}" for k in keys + ["source_relation"])
            usel = ", ".join(f"{a} as {b}" for a, b in zip(ukeys, keys))
            c.append(f"""{p}int_automation_activities_by_{by} as (
  select s.source_relation, {sel_keys}, ev.opens, ev.clicks, ev.unique_opens, ev.unique_clicks, s.sends
         {", un.unsubscribes" if unsub else ""}
  from (select source_relation, {key}, count(*) as sends from {p}int_automation_recipients {where} group by source_relation, {key}) s
  left join (select source_relation, {key},
                    cast(sum(1) filter (where action_type = 'open') as bigint) as opens,
                    cast(sum(1) filter (where action_type = 'click') as bigint) as clicks,
                    count(distinct {dk}) filter (where action_type = 'open') as unique_opens,
                    count(distinct {dk}) filter (where action_type = 'click') as unique_clicks
             from {p}automation_activities {where} group by source_relation, {key}) ev on {join_ev}
  {f"left join (select source_relation, {usel}, count(*) as unsubscribes from {p}int_automation_unsubscribes {where} group by source_relation, {', '.join(ukeys)}) un on {join_u}" if unsub else ""})""")
        c.append(f"""{p}automation_emails as (
  select e.*, au.list_id, au.segment_id, {_metrics('b', '', unsub)}
  from {p}stg_automation_emails e
  left join {p}stg_automations au on {_on('e', 'au', 'automation_id')}
  left join {p}int_automation_activities_by_email b on {_on('e', 'b', 'automation_email_id')})""")
        c.append(f"""{p}automations as (
  select au.*, {_metrics('b', '', unsub)}
  from {p}stg_automations au left join {p}int_automation_activities_by_automation b on {_on('au', 'b', 'automation_id')})""")

    a_m = f", {_metrics('a', 'automation_', unsub)}" if auto else ""
    a_j = lambda alias, keys: (f" left join {p}int_automation_activities_by_{alias} a on {_on('x', 'a', *keys)}" if auto else "")
    c.append(f"""{p}members as (
  select x.*, {_metrics('c', 'campaign_', unsub)}{a_m}
  from {p}stg_members x left join {p}int_campaign_activities_by_member c on {_on('x', 'c', 'member_id', 'list_id')}{a_j('member', ['member_id', 'list_id'])})""")
    c.append(f"""{p}int_members_by_list as (
  select source_relation, list_id, count(*) as count_members, max(signup_timestamp) as most_recent_signup_timestamp
  from {p}members group by source_relation, list_id)""")
    c.append(f"""{p}lists as (
  select x.*, coalesce(mb.count_members, 0) as count_members, mb.most_recent_signup_timestamp,
         {_metrics('c', 'campaign_', unsub)}{a_m}
  from {p}stg_lists x left join {p}int_members_by_list mb on {_on('x', 'mb', 'list_id')}
  left join {p}int_campaign_activities_by_list c on {_on('x', 'c', 'list_id')}{a_j('list', ['list_id'])})""")
    if segs:
        c.append(f"""{p}segments as (
  select x.*, l.name as list_name, {_metrics('c', 'campaign_', unsub)}{a_m}
  from {p}stg_segments x left join {p}int_campaign_activities_by_segment c on {_on('x', 'c', 'segment_id')}
  left join {p}stg_lists l on {_on('x', 'l', 'list_id')}{a_j('segment', ['segment_id'])})""")
    return c


def with_clause(ctes: list[str]) -> str:
    return "with " + ",\n".join(ctes) + "\n"


def chain(p: str = "", conns: list[tuple[str, Account]] | None = None, passthrough: str = "",
          absent: tuple[tuple[str, str], ...] = (), casts: dict[tuple[str, str], str] | None = None,
          **flags) -> list[str]:
    return staging_ctes(p, conns or [("conn_a", Account())], passthrough, absent, casts) + model_ctes(p, **flags)


# The declared tests.
NOT_NULL = [
    ("stg_automation_activities", "activity_id"), ("stg_automation_emails", "automation_email_id"),
    ("stg_automation_recipients", "automation_recipient_id"), ("stg_automations", "automation_id"),
    ("stg_campaign_recipients", "email_id"), ("stg_campaign_activities", "activity_id"),
    ("stg_campaigns", "campaign_id"), ("stg_lists", "list_id"), ("stg_members", "member_id"),
    ("stg_segments", "segment_id"), ("stg_unsubscribes", "unsubscribe_id"),
    ("lists", "list_id"), ("members", "member_id"), ("campaigns", "campaign_id"),
    ("campaign_recipients", "email_id"), ("campaign_activities", "activity_id"),
    ("automations", "automation_id"), ("automation_emails", "automation_email_id"),
    ("automation_activities", "activity_id"), ("segments", "segment_id"),
]
UNIQUE = [t for t in NOT_NULL[:11] if t[0] != "stg_members"]


def _select(ctes: list[str], name: str) -> str:
    return with_clause(ctes) + f"select * from {name}"


def oracle_queries(model_names: list[str]) -> dict[str, str]:
    base = chain()
    q = {name: _select(base, name) for name in model_names}
    pair = [("conn_a", Account()), ("conn_b", OTHER)]
    two = chain(conns=pair)
    for name in ("stg_campaign_recipients", "campaign_activities",
                 "int_campaign_activities_by_email", "campaign_recipients", "campaigns",
                 "automation_activities", "int_automation_activities_by_member",
                 "int_automation_activities_by_segment", "automation_emails", "automations",
                 "members", "int_members_by_list", "lists", "segments"):
        q[f"{name}_two_sources"] = _select(two, name)
    q["stg_members_source_casing"] = _select(chain(conns=[("Conn_A", Account())]), "stg_members")
    q["stg_lists_folded_casing"] = _select(chain(), "stg_lists")
    no_auto = chain(auto=False)
    q["lists_no_automations"] = _select(no_auto, "lists")
    q["members_no_automations"] = _select(no_auto, "members")
    no_unsub = chain(unsub=False)
    for name in ("campaign_recipients", "campaigns", "automation_emails", "segments"):
        q[f"{name}_no_unsubscribes"] = _select(no_unsub, name)
    off = chain(auto=False, unsub=False, segs=False)
    for name in ("members", "lists", "campaigns"):
        q[f"{name}_all_off"] = _select(off, name)
    # on the raw member rows, as staging does: a member without an id has them too
    q["members_passthrough"] = _select(chain(
        passthrough=", lower(country_code) as country_lower, merge_fname, points, born as birthday"), "members")
    for name in ("int_campaign_activities_by_email", "int_campaign_activities_by_list",
                 "int_campaign_activities_by_campaign", "int_automation_activities_by_list",
                 "int_automation_activities_by_automation"):
        q[f"{name}_native"] = q[name]
    q["dq_not_null"] = with_clause(base) + "\nunion all\n".join(
        f"select '{m}' as model, 'not_null' as test, '{c}' as column_name, count(*) as failures "
        f"from {m} where {c} is null" for m, c in NOT_NULL)
    gaps = chain(conns=[("conn_a", GAPS)])
    q["dq_not_null_gaps"] = q["dq_not_null"].replace(with_clause(base), with_clause(gaps))
    for name in GAP_MODELS:
        q[f"{name}_gaps"] = _select(gaps, name)
    times = {("campaign", "send_time"): "timestamp", ("campaign_recipient_activity", "timestamp"): "timestamp"}
    garbled = chain(conns=[("conn_a", GARBLED)], casts=times)
    for name in ("stg_campaigns", "campaign_activities"):
        q[f"{name}_garbled_times"] = _select(garbled, name)
    q["stg_rejects_garbled_times"] = with_clause([fixture_views("g_", GARBLED)]) + "\nunion all\n".join(
        f"select 'conn_a' as source_relation, '{t}' as source_table, '{c}' as column_name, {key} as row_key, {c} as raw_value "
        f"from g_fx_{t} where {c} is not null and try_cast({c} as timestamp) is null"
        for t, c, key in (("campaign", "send_time", "id"), ("campaign_recipient_activity", '"timestamp"', "action || '-' || campaign_id || '-' || member_id"))
    ).replace("""'"timestamp"'""", "'timestamp'")
    for name, plain in (("members_written_build", "members"), ("lists_view", "lists")):
        q[name] = q[plain]
    q["campaigns_renamed_tables"] = q["campaigns_all_off"]
    q["campaigns_two_stored_accounts"] = q["campaigns_two_sources"]
    for key, ctes in (("dq_unique", base), ("dq_unique_two_sources", two), ("dq_unique_gaps", gaps)):
        q[key] = with_clause(ctes) + "\nunion all\n".join(
            f"select '{m}' as model, 'unique' as test, '{c}' as column_name, count(*) as failures "
            f"from (select source_relation, {c} from {m} where {c} is not null "
            f"group by source_relation, {c} having count(*) > 1)" for m, c in UNIQUE)
    wide = {("campaign", "id"): "varchar", ("campaign", "segment_id"): "bigint",
            ("campaign", "wait_time"): "varchar", ("campaign", "test_size"): "double"}
    mixed = [("conn_a", Account()), ("conn_b", OTHER_TYPES)]
    for name, conns in (("campaigns_mixed_types_two_sources", mixed),
                        ("campaigns_mixed_types_two_sources_reversed", mixed[::-1])):
        q[name] = _select(chain(conns=conns, casts=wide), "campaigns")
    q["lists_one_account_without_unsubscribes"] = _select(
        chain(conns=pair, absent=(("conn_b", "unsubscribe"),)), "lists")
    for key, conns in (("dq_freshness", pair[:1]), ("dq_freshness_two_sources", pair),
                       ("dq_freshness_empty_table", [("conn_a", ONE_EMPTY)])):
        q[key] = _freshness(conns)
    for name in OUTPUTS:
        rec = chain("p_") + chain("d_", conns=[("conn_a", LATER_BUILD)])
        cols = "* exclude (trigger_settings)" if name == "automations" else "*"
        p_, d_ = f"select {cols} from p_{name}", f"select {cols} from d_{name}"
        q[f"dq_reconcile_{name}"] = with_clause(rec) + f"""
select *, 'from prod' as source from ({p_} except {d_})
union all
select *, 'from dev' as source from ({d_} except {p_})"""
    return q


def _freshness(conns: list[tuple[str, Account]]) -> str:
    """An aggregate without grouping has a row for an empty table too."""
    fresh = [f"select '{table}' as source_table, '{c}' as source_relation, max({SYNCED}) as max_loaded_at from f{i}_fx_{table}"
             for i, (c, _) in enumerate(conns) for table in DECLARED]
    return with_clause([fixture_views(f"f{i}_", account) for i, (_, account) in enumerate(conns)]
                       + ["fresh as (" + "\nunion all\n".join(fresh) + ")"]) + """
select *, case when max_loaded_at is null then 'error'
               when max_loaded_at >= timestamp '2024-02-03 00:00:00' - interval 72 hour then 'pass'
               when max_loaded_at >= timestamp '2024-02-03 00:00:00' - interval 168 hour then 'warn'
               else 'error' end as status
from fresh"""
