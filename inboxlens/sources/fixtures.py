"""The driver's TPC-H-like tables reshaped as the twelve raw source tables.

Customers are members (list = region; members with key % 10 = 0 are also on
a second list), nations are segments and automations, regions are lists.
Suppliers are mailings in one id space: even ones campaigns, odd ones
automation emails. Each nation adds one mailing behind the last supplier that
no order line refers to, so some mailings have events but no sends. Order lines
give sends, events give opens / clicks / bounces (view, click, error),
purchases give send times and signups give unsubscribes. Every other declared
column is filled by a rule from the row's key, so no column is all NULL.

Everything is a distributed DataFrame plan over the whole driver tables; the
only scalars brought to the plan are row counts, as scalar subqueries.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..options import Options
from . import schemas

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem", "events")


@dataclass(frozen=True)
class Account:
    """How a test account differs from the plain one; it keeps all rows.

    shift: added to mailing ids (even, so roles stay; ids of two accounts
    overlap); minutes: added to event times; label: appended to the filled
    texts of every third key; without: (table, column) that its raw tables
    lack; types: (table, column, SQL type) stored differently; empty: tables
    without rows; blank: (table, column) that is NULL in every fifth row;
    garbled: (table, text column) that holds no time in every eleventh row."""

    shift: int = 0
    minutes: int = 0
    label: str = ""
    without: tuple[tuple[str, str], ...] = ()
    types: tuple[tuple[str, str, str], ...] = ()
    empty: tuple[str, ...] = ()
    blank: tuple[tuple[str, str], ...] = ()
    garbled: tuple[tuple[str, str], ...] = ()


def load_driver_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet") for t in DRIVER_TABLES}


def filler(column: str, position: int, kind: str, label: str = "") -> str:
    """Spark SQL for the value of a declared column in the row with key ``k``."""
    text = f"concat('{column}-', cast(k as string))"
    if label:
        text = f"if(k % 3 = 0, concat({text}, '{label}'), {text})"
    return {
        "string": text,
        "int": f"cast(k % 1000 + {position * 1000} as int)",
        "float": f"cast(k % 1000 as double) + {position / 4}D",
        "bigint": f"k % 1000 + {position * 1000}",
        "date": f"date_add(date'1990-01-01', cast(k % 3650 as int) + {position})",
        "boolean": f"substring(md5(concat('{column}', cast(k as string))), 1, 1) < '8'",
        "timestamp": "timestamp_ntz'2024-01-20 00:00:00' + "
                     f"make_dt_interval(0, 0, cast((k * 7 + {position}) % 20000 as int), 0)",
    }[kind]


def _raw(df: DataFrame, table: str, options: Options, account: Account,
         **given: str) -> DataFrame:
    """``table`` with all declared columns: ``given`` ones by expression, the
    others filled."""
    names = {schemas.SYNCED: options.synced_column, schemas.DELETED: options.deleted_column}
    types = {(t, c): kind for t, c, kind in account.types}
    out = []
    declared = [*schemas.DECLARED[table]]
    if table == "member":  # and the extra columns that the options carry
        held = {name for name, _ in declared}
        declared += [(p.name, p.datatype) for p in options.member_pass_through if p.name not in held]
    for position, (name, kind) in enumerate(declared):
        name = names.get(name, name)
        if (table, name) in account.without:
            continue
        value = given.get(name) or filler(name, position, kind, account.label)
        if (table, name) in types:
            value = f"cast({value} as {types[table, name]})"
        if (table, name) in account.garbled:
            value = f"if(k % 11 = 0, concat('no time ', cast(k as string)), {value})"
        if (table, name) in account.blank:
            value = f"if(k % 5 = 0, null, {value})"
        out.append(f"{value} as `{name}`")
    df = df.selectExpr(*out)
    return df.where(F.lit(False)) if table in account.empty else df


def fixture_sources(d: dict[str, DataFrame], options: Options = Options(),
                    account: Account = Account()) -> dict[str, DataFrame]:
    """Raw source tables of one connection."""
    nation = d["nation"].select("n_nationkey", "n_name", "n_regionkey")
    home = d["customer"].select("c_custkey", "c_nationkey", "c_acctbal") \
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey")) \
        .selectExpr("c_custkey", "cast(c_custkey as string) as member_id",
                    "cast(n_regionkey as string) as list_id", "n_name", "c_acctbal", "c_nationkey",
                    "n_regionkey")
    first = d["orders"].groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"))
    joined = home.join(first, F.col("o_custkey") == F.col("c_custkey"), "left")
    member = joined.selectExpr(
        "*", "c_custkey as k",
        "if(c_custkey % 7 = 0, 'unsubscribed', 'subscribed') as status",
    ).unionByName(joined.where("c_custkey % 10 = 0").selectExpr(
        "* except (list_id)", "cast((n_regionkey + 1) % 5 as string) as list_id",
        "c_custkey + 1000000007 as k", "'subscribed' as status"))

    n_suppliers = d["supplier"].select(F.count(F.lit(1))).scalar()
    n_nations = d["nation"].select(F.count(F.lit(1))).scalar()
    ev = d["events"].select("event_id", "ts", "user_id", "event_type") \
        .join(home.select("c_custkey", "member_id", "list_id"), F.col("user_id") == F.col("c_custkey")) \
        .select((F.col("event_id") % (n_suppliers + n_nations) + account.shift).alias("sk"),
                F.col("event_id").alias("k"), "member_id", "list_id", "event_type",
                (F.col("ts") + F.make_dt_interval(mins=F.lit(account.minutes))).alias("ts"),
                F.expr("case event_type when 'view' then 'open' when 'error' then 'bounce' "
                       "else event_type end as action"))
    sent = ev.where("event_type = 'purchase'").groupBy("sk").agg(F.min("ts").alias("send_time"))

    mailing = d["supplier"].select((F.col("s_suppkey") + account.shift).alias("sk"), "s_name", "s_nationkey") \
        .unionByName(nation.select(
            (n_suppliers + F.col("n_nationkey") + account.shift).cast("bigint").alias("sk"),
            F.concat(F.lit("Extra "), "n_name").alias("s_name"),
            F.col("n_nationkey").alias("s_nationkey"))).withColumnRenamed("sk", "k")
    campaign = mailing.where("k % 2 = 0") \
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey")) \
        .join(sent, F.col("sk") == F.col("k"), "left")
    # One send per mailing and member: the pairs of keys are made distinct before they meet the
    # members, as two numbers; a customer that is stored twice gives its list once.
    rec = d["lineitem"].select("l_orderkey", "l_suppkey") \
        .join(d["orders"].select("o_orderkey", "o_custkey"),
              F.col("l_orderkey") == F.col("o_orderkey")) \
        .select((F.col("l_suppkey") + account.shift).alias("sk"), "o_custkey").distinct() \
        .join(home.select("c_custkey", "list_id").distinct(), F.col("o_custkey") == F.col("c_custkey")) \
        .selectExpr("sk", "cast(c_custkey as string) as member_id", "list_id", "sk * 1000003 + c_custkey as k")
    engaged = ev.where(F.col("event_type").isin("view", "click", "error"))
    even, odd = "sk % 2 = 0", "sk % 2 = 1"
    segment = "if(n_nationkey % 4 <> 0, n_nationkey, null)"

    def raw(df: DataFrame, table: str, **given: str) -> DataFrame:
        return _raw(df, table, options, account, **given)

    to_member = {"member_id": "member_id", "list_id": "list_id"}
    nation = nation.selectExpr("*", "cast(n_nationkey as bigint) as k")
    return {
        "automation": raw(nation, "automation", id="cast(k as string)", list_id="cast(n_regionkey as string)",
                          title="n_name", segment_id=segment),
        "automation_email": raw(mailing.where("k % 2 = 1"), "automation_email", id="cast(k as string)",
                                automation_id="cast(s_nationkey as string)", title="s_name"),
        "automation_recipient": raw(rec.where(odd), "automation_recipient",
                                    automation_email_id="cast(sk as string)", **to_member),
        "automation_recipient_activity": raw(
            engaged.where(odd), "automation_recipient_activity", action="action",
            automation_email_id="cast(sk as string)", timestamp="ts", **to_member),
        # These two hold their times as text, as some loading tools do.
        "campaign": raw(campaign, "campaign", id="cast(k as string)", list_id="cast(n_regionkey as string)",
                        title="s_name", send_time="if(k % 10 <> 4, cast(send_time as string), null)",
                        segment_id=segment),
        "campaign_recipient": raw(rec.where(even), "campaign_recipient", campaign_id="cast(sk as string)",
                                  **to_member),
        "campaign_recipient_activity": raw(
            engaged.where(even), "campaign_recipient_activity", action="action",
            campaign_id="cast(sk as string)", timestamp="cast(ts as string)", **to_member),
        "list": raw(d["region"].selectExpr("*", "cast(r_regionkey as bigint) as k"), "list",
                    id="cast(k as string)", name="r_name", list_rating="cast(k as double)"),
        "member": raw(member, "member", id="member_id", list_id="list_id", country_code="n_name",
                      timestamp_signup="first_order", vip="c_acctbal > 9000", status="status"),
        "segment": raw(nation, "segment", id="n_nationkey", list_id="cast(n_regionkey as string)",
                       name="n_name", type="'static'"),
        "segment_member": raw(home.selectExpr("*", "c_custkey as k"), "segment_member",
                              segment_id="c_nationkey", **to_member),
        "unsubscribe": raw(ev.where("event_type = 'signup'"), "unsubscribe", campaign_id="cast(sk as string)",
                           timestamp="ts", **to_member),
    }
