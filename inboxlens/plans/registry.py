"""Named queries over the driver's test tables: every model of the build,
build variants (two connections, switches, pass-through columns, distinct
strategy) and the data checks.  Each takes (spark, sf_dir) and returns a
lazy DataFrame over the whole tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from ..operators import quality
from ..options import Options, PassThrough
from ..session import shared_folder
from ..sources import ABSENT, Connection, read_sources
from ..sources.connections import enabled_tables
from ..sources.fixtures import Account, fixture_sources, load_driver_tables
from .build import OUTPUTS, build
from .publish import read_build
from .views import register_views
from .write import write_build

Query = Callable[[SparkSession, str], DataFrame]

WRITERS = 4  # raw tables written at a time
FRESHNESS_AS_OF = datetime(2024, 2, 3)
PASS_THROUGH = (PassThrough("country_code", alias="country_lower",
                            transform_sql="lower(country_code)"),
                PassThrough("merge_fname"), PassThrough("points", datatype="bigint"),
                PassThrough("born", alias="birthday", datatype="date"))


# The second account of the two-account builds: the same rows under other mailing
# ids (most of which the first account has too), later, and some columns short.
OTHER = Account(shift=4, minutes=1500, without=(
    ("campaign", "archive_url"), ("automation_email", "delay_amount"), ("list", "visibility"),
    ("member", "latitude"), ("segment", "updated_at"), ("unsubscribe", "reason"),
    ("campaign_recipient_activity", "combination_id")))
# One that stores some columns with other types, and one build later with changes.
OTHER_TYPES = Account(shift=4, minutes=1500, types=(
    ("campaign", "id", "bigint"), ("campaign", "segment_id", "bigint"),
    ("campaign", "wait_time", "string"), ("campaign", "test_size", "double")))
LATER_BUILD = Account(minutes=60, label="*", blank=(("segment", "updated_at"),))
# One with ids and times left out: NULL keys, keys that collide, and sends without a
# member; and one with times that are no times.
GAPS = Account(blank=tuple((t, "id") for t in ("automation", "automation_email", "campaign", "list", "member", "segment"))
               + tuple((t, c) for t in ("automation_recipient_activity", "campaign_recipient_activity", "unsubscribe")
                       for c in ("member_id", "timestamp"))
               + (("automation_recipient", "member_id"), ("campaign_recipient", "member_id")))
GARBLED = Account(garbled=(("campaign", "send_time"), ("campaign_recipient_activity", "timestamp")))
ONE_EMPTY = Account(empty=("segment_member",))

ONE = (("conn_a", Account()),)
TWO = (("conn_a", Account()), ("conn_b", OTHER))
MIXED = (("conn_a", Account()), ("conn_b", OTHER_TYPES))


def sources(spark: SparkSession, sf_dir: str, options: Options = Options(), conns: tuple = ONE,
            absent: tuple[tuple[str, str], ...] = ()) -> dict[str, DataFrame]:
    """``absent``: (connection, table) that the account does not sync."""
    d = load_driver_tables(spark, sf_dir)
    return read_sources(spark, [
        Connection(n, {**fixture_sources(d, options, account), **{t: ABSENT for c, t in absent if c == n}})
        for n, account in conns], options)


def models(spark: SparkSession, sf_dir: str, options: Options = Options(), conns: tuple = ONE,
           absent: tuple[tuple[str, str], ...] = ()) -> dict[str, DataFrame]:
    return build(sources(spark, sf_dir, options, conns, absent), options)


def _model(name: str, options: Options = Options(), conns: tuple = ONE,
           absent: tuple[tuple[str, str], ...] = ()) -> Query:
    return lambda spark, sf_dir: models(spark, sf_dir, options, conns, absent)[name]


MODEL_NAMES = (
    [f"stg_{n}" for n in ("automations", "automation_emails", "automation_recipients",
                          "automation_activities", "campaigns", "campaign_recipients",
                          "campaign_activities", "lists", "members", "segments",
                          "segment_members", "unsubscribes")]
    + ["campaign_activities", "int_campaign_activities_by_email", "campaign_recipients"]
    + [f"int_campaign_activities_by_{b}" for b in ("campaign", "list", "member", "segment")]
    + ["campaigns", "automation_activities", "int_automation_recipients",
       "int_automation_unsubscribes"]
    + [f"int_automation_activities_by_{b}" for b in ("automation", "email", "list", "member",
                                                     "segment")]
    + ["automation_emails", "automations", "members", "int_members_by_list", "lists",
       "segments"])

TWO_SOURCE_MODELS = (
    "stg_campaign_recipients", "campaign_activities", "int_campaign_activities_by_email",
    "campaign_recipients", "campaigns", "automation_activities",
    "int_automation_activities_by_member", "int_automation_activities_by_segment",
    "automation_emails", "automations", "members", "int_members_by_list", "lists", "segments")
ALL_OFF = Options(using_automations=False, using_segments=False, using_unsubscribes=False)
NATIVE = Options(distinct_strategy="native")


GAP_MODELS = ("stg_campaign_recipients", "int_campaign_activities_by_email", "campaign_recipients", "campaigns", "members", "lists",
              "automations")


def _written(name: str) -> Query:
    """A table of a build that was written, published and read again."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        target = f"{shared_folder(spark)}/build-{uuid4().hex}"
        write_build(spark, sources(spark, sf_dir), target)
        return read_build(spark, target)[name]
    return query


def _view(name: str) -> Query:
    """A model through its SQL view."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        register_views({name: models(spark, sf_dir)[name]}, prefix="by_view_")
        return spark.sql(f"SELECT * FROM by_view_{name}")
    return query


def _renamed(name: str, tables: tuple[str, ...]) -> Query:
    """A model over raw tables that are stored in folders of other names."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = f"{shared_folder(spark)}/raw-{uuid4().hex}"
        options = Options(using_automations=False, using_segments=False, using_unsubscribes=False)
        names = {t: f"{t}_v2" if t in tables else t for t in enabled_tables(options)}
        for table, df in sources(spark, sf_dir, options).items():
            df.drop("source_relation").write.parquet(f"{root}/{names[table]}")
        raw = read_sources(spark, [Connection.from_directory("conn_a", root, names)], options)
        return build(raw, options)[name]
    return query


def _one_scan(name: str) -> Query:
    """A model over the stored raw tables of several accounts, read by one scan a table."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = f"{shared_folder(spark)}/accounts-{uuid4().hex}"
        d = load_driver_tables(spark, sf_dir)
        with ThreadPoolExecutor(WRITERS) as pool:
            jobs = [pool.submit(df.write.parquet, f"{root}/{conn}/{table}") for conn, account in TWO
                    for table, df in fixture_sources(d, Options(), account).items()]
            for job in jobs:
                job.result()  # raises the first failure
        return build(read_sources(spark, [Connection.from_directory(c, f"{root}/{c}") for c, _ in TWO]))[name]
    return query


def _dq_tests(kind: str, conns: tuple = ONE) -> Query:
    return lambda spark, sf_dir: quality.run_tests(models(spark, sf_dir, conns=conns), kind)


def _dq_freshness(conns: tuple = ONE) -> Query:
    o = Options()
    return lambda spark, sf_dir: quality.freshness(sources(spark, sf_dir, o, conns), o.synced_column,
                                                   FRESHNESS_AS_OF)


def _dq_reconcile(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        later = models(spark, sf_dir, conns=(("conn_a", LATER_BUILD),))[name]
        return quality.reconcile(models(spark, sf_dir)[name], later,
                                 quality.RECONCILE_EXCLUDE.get(name, []))
    return query


def spark_queries() -> dict[str, Query]:
    q: dict[str, Query] = {name: _model(name) for name in MODEL_NAMES}
    for name in TWO_SOURCE_MODELS:
        q[f"{name}_two_sources"] = _model(name, conns=TWO)
    q["stg_members_source_casing"] = _model("stg_members", Options(source_casing=True),
                                            (("Conn_A", Account()),))
    q["stg_lists_folded_casing"] = _model("stg_lists", Options(), (("Conn_A", Account()),))
    q["lists_no_automations"] = _model("lists", Options(using_automations=False))
    q["members_no_automations"] = _model("members", Options(using_automations=False))
    q["campaign_recipients_no_unsubscribes"] = _model("campaign_recipients",
                                                      Options(using_unsubscribes=False))
    q["campaigns_no_unsubscribes"] = _model("campaigns", Options(using_unsubscribes=False))
    q["automation_emails_no_unsubscribes"] = _model("automation_emails",
                                                    Options(using_unsubscribes=False))
    q["segments_no_unsubscribes"] = _model("segments", Options(using_unsubscribes=False))
    for name in ("members", "lists", "campaigns"):
        q[f"{name}_all_off"] = _model(name, ALL_OFF)
    q["members_passthrough"] = _model("members", Options(member_pass_through=PASS_THROUGH))
    for name in ("int_campaign_activities_by_email", "int_campaign_activities_by_list",
                 "int_campaign_activities_by_campaign", "int_automation_activities_by_list",
                 "int_automation_activities_by_automation"):
        q[f"{name}_native"] = _model(name, NATIVE)
    q["dq_not_null"] = _dq_tests("not_null")
    q["dq_unique"] = _dq_tests("unique")
    q["dq_unique_two_sources"] = _dq_tests("unique", TWO)
    gaps = (("conn_a", GAPS),)
    q["dq_not_null_gaps"] = _dq_tests("not_null", gaps)
    q["dq_unique_gaps"] = _dq_tests("unique", gaps)
    for name in GAP_MODELS:
        q[f"{name}_gaps"] = _model(name, conns=gaps)
    for name in ("stg_rejects", "stg_campaigns", "campaign_activities"):
        q[f"{name}_garbled_times"] = _model(name, conns=(("conn_a", GARBLED),))
    q["members_written_build"] = _written("members")
    q["lists_view"] = _view("lists")
    q["campaigns_renamed_tables"] = _renamed("campaigns", ("campaign", "campaign_recipient"))
    q["campaigns_two_stored_accounts"] = _one_scan("campaigns")
    q["campaigns_mixed_types_two_sources"] = _model("campaigns", conns=MIXED)
    q["campaigns_mixed_types_two_sources_reversed"] = _model("campaigns", conns=MIXED[::-1])
    q["lists_one_account_without_unsubscribes"] = _model("lists", conns=TWO,
                                                         absent=(("conn_b", "unsubscribe"),))
    q["dq_freshness"] = _dq_freshness()
    q["dq_freshness_two_sources"] = _dq_freshness(TWO)
    q["dq_freshness_empty_table"] = _dq_freshness((("conn_a", ONE_EMPTY),))
    for name in OUTPUTS:
        q[f"dq_reconcile_{name}"] = _dq_reconcile(name)
    return q
