"""The whole model graph: raw tables in, every staged, intermediate and
output table out (lazy DataFrames).

Hub tables read by several rollups (per-send campaign metrics, automation
activities / sends / unsubscribes) pass through ``materialize``; the default
keeps them lazy, a sink writes them once and hands back the stored copy so
later outputs read it instead of recomputing its lineage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..operators.staging import stage_all
from ..options import Options
from ..sources.connections import enabled_tables
from . import audience, automation, campaign
from .scope import Scope

Materialize = Callable[[str, DataFrame], DataFrame]

OUTPUTS = ("campaign_activities", "campaign_recipients", "campaigns", "automation_activities",
           "automation_emails", "automations", "members", "lists", "segments")
# Read by several others; a sink stores them.
HUBS = ("campaign_activities", "automation_activities", "int_automation_recipients",
        "int_automation_unsubscribes", "campaign_recipients", "int_campaign_activities_by_member")


def _lazy(name: str, df: DataFrame) -> DataFrame:
    return df


def _in_turn(*parts: Callable) -> list:
    return [p() for p in parts]


def build(raw: dict[str, DataFrame], options: Options = Options(), materialize: Materialize = _lazy,
          ready: Callable[[str, DataFrame], None] | None = None,
          together: Callable[..., list] | None = None) -> dict[str, DataFrame]:
    """All models for the raw tables ``raw`` (as returned by ``read_sources``).

    Keys: ``stg_*`` staged tables, ``int_*`` intermediates and the nine
    outputs of ``OUTPUTS`` (those switched off are absent).

    ``ready`` is told of each model once all hubs it reads are materialized;
    ``together`` runs the campaign and the automation side, two functions, at a
    time and returns what they do."""
    o = options
    missing = [t for t in enabled_tables(o) if t not in raw]
    if missing:
        raise ValueError(f"raw tables missing: {', '.join(missing)}; switch those features off "
                         "in Options (and pass the same Options to read_sources and build)")
    unsub = o.using_unsubscribes
    # One connection: source_relation is constant, keys can leave it out.
    conns = getattr(raw, "connections", None)
    sc = Scope(by_source=not (conns is not None and len(conns) == 1))
    s = stage_all(raw, o)
    m: dict[str, DataFrame] = {}

    def hub(name: str, df: DataFrame) -> DataFrame:
        m[name] = materialize(name, df) if name in HUBS else df
        if ready:
            ready(name, m[name])
        return m[name]

    for name, df in s.items():
        hub(name, df)
    c_by, a_by = (together or _in_turn)(lambda: _campaign_side(s, hub, o, sc), lambda: _automation_side(s, hub, o, sc))

    # audience
    hub("members", audience.members(s["stg_members"], c_by["member"], a_by["member"], unsub,
                                    sc))
    by_list_members = hub("int_members_by_list", audience.members_by_list(s["stg_members"], sc))
    hub("lists", audience.lists(s["stg_lists"], by_list_members, c_by["list"], a_by["list"],
                                unsub, sc))
    if o.using_segments:
        hub("segments", audience.segments(s["stg_segments"], c_by["segment"], s["stg_lists"],
                                          a_by["segment"], unsub, sc))
    return m


def _campaign_side(s: dict[str, DataFrame], hub: Materialize, o: Options, sc: Scope) -> dict[str, DataFrame]:
    """The campaign models; returns the rollups by campaign, member, list and segment."""
    unsub = o.using_unsubscribes
    acts = hub("campaign_activities",
               campaign.campaign_activities(s["stg_campaign_activities"], s["stg_campaigns"], sc))
    by_email = campaign.activities_by_email(acts, o.distinct_strategy, sc)
    hub("int_campaign_activities_by_email", by_email)
    recips = hub("campaign_recipients", campaign.campaign_recipients(
        s["stg_campaign_recipients"], s["stg_campaigns"], by_email,
        s["stg_unsubscribes"] if unsub else None, sc))
    c_by = {}
    for by, keys in (("campaign", ["campaign_id"]), ("member", ["member_id", "list_id"]),
                     ("list", ["list_id"]), ("segment", ["segment_id"])):
        if by == "segment" and not o.using_segments:
            continue
        if by == "list" and o.distinct_strategy == "two_phase":
            # the first phase by (list, member) is the rollup by member
            rollup = campaign.by_list_from_members(c_by["member"], unsub, sc)
        else:
            rollup = campaign.recipients_by(
                recips, keys, unsub, o.distinct_strategy,
                not_null="segment_id" if by == "segment" else None, scope=sc)
        c_by[by] = hub(f"int_campaign_activities_by_{by}", rollup)
    hub("campaigns", campaign.campaigns(s["stg_campaigns"], c_by["campaign"], unsub, sc))

    return c_by


def _automation_side(s: dict[str, DataFrame], hub: Materialize, o: Options, sc: Scope) -> dict[str, DataFrame | None]:
    """The automation models; returns the five rollups (None if switched off)."""
    a_by: dict[str, DataFrame | None] = {k: None for k in automation.ROLLUPS}
    if not o.using_automations:
        return a_by
    unsub = o.using_unsubscribes
    owner = automation.email_owner(s["stg_automation_emails"], s["stg_automations"], sc)
    a_acts = hub("automation_activities",
                 automation.automation_activities(s["stg_automation_activities"], owner, sc))
    a_rec = hub("int_automation_recipients",
                automation.automation_recipients(s["stg_automation_recipients"], owner, sc))
    a_uns = hub("int_automation_unsubscribes",
                automation.automation_unsubscribes(s["stg_unsubscribes"], owner, sc)) \
        if unsub else None
    for by in automation.ROLLUPS:
        a_by[by] = hub(f"int_automation_activities_by_{by}", automation.automation_rollup(
            by, a_acts, a_rec, a_uns, o.distinct_strategy, o.fix_member_list_id, sc))
    hub("automation_emails", automation.automation_emails(
        s["stg_automation_emails"], s["stg_automations"], a_by["email"], unsub, sc))
    hub("automations", automation.automations(s["stg_automations"], a_by["automation"],
                                              unsub, sc))
    return a_by


def checkpointed(spark) -> Materialize:
    """A ``materialize`` for builds that are used in place rather than
    written: each hub is checkpointed (reliably, into the cluster's shared
    ``spark.checkpoint.dir``) when planned, so every rollup reads the saved
    copy and a lost executor never recomputes the upstream joins."""
    from ..session import checkpoint_dir

    checkpoint_dir(spark)  # fails early when the cluster names no folder

    def materialize(name: str, df: DataFrame) -> DataFrame:
        return df.checkpoint(eager=True)
    return materialize
