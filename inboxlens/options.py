"""Build options: feature switches and naming knobs."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class PassThrough:
    """An extra member column carried from the raw table to the outputs.

    ``name`` is the raw column, ``alias`` the output name (defaults to
    ``name``), ``transform_sql`` an optional Spark SQL expression computing
    the output value, ``datatype`` the type used when the raw column is absent
    (a declared type name or any Spark DDL type).
    """

    name: str
    alias: str | None = None
    transform_sql: str | None = None
    datatype: str = "string"


@dataclass(frozen=True)
class Options:
    using_automations: bool = True
    using_segments: bool = True
    using_unsubscribes: bool = True
    # Keep the case of connection names in ``source_relation``.
    source_casing: bool = False
    member_pass_through: tuple[PassThrough, ...] = field(default_factory=tuple)
    # Names of the connector bookkeeping columns in the raw tables.
    synced_column: str = "_synced"
    deleted_column: str = "_deleted"
    # Distinct-member rollups: "two_phase" (group by key+member, then key)
    # or "native" (COUNT(DISTINCT ...) planned by Spark with Expand).
    distinct_strategy: str = "two_phase"
    # Reproduce the by-member automation rollup literally: its list_id comes
    # from the activity side, so members with sends but no activity match
    # nothing downstream.  True takes list_id from the send side instead.
    fix_member_list_id: bool = False
