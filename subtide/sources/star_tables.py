"""The five tables derived from the star-schema test tables (rules: FIXTURES.md §2).

Customers are reduced with map-side partial aggregates, and a customer's first order
is found by an aggregate and a join on the unique order key, not by a window over all
the orders of one customer. The lookups of a line's order and of an order's customer
name join on keys that may be hot; adaptive execution splits those partitions.
Lookups are left joins to sides grouped by their key, so Catalyst drops a lookup
whose columns a query does not use.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subtide.domain import ACQUISITION_CHANNELS, CHURN_REASONS, COMPANY_SIZES, LOSS_REASONS, PLAN_PRICES
from subtide.operators.campaigns import segment_of_type

AS_OF = dt.date(2001, 8, 2)
CHURN_BEFORE = AS_OF - dt.timedelta(days=365)

# Upper bounds (exclusive, of the order key modulo 100) of each lead source.
_SOURCE_BOUNDS = {"referral": 12, "inbound": 30, "linkedin": 52, "cold_email": 82, "cold_call": 92, "paid_ad": 100}


# Any non-negative long has at most so many digits.
_KEY_DIGITS = 19

# The columns read here; given, so that no job opens a file to find them.
_STAR_SCHEMAS = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
}


def star_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_STAR_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _padded(number: Column, digits: int) -> Column:
    """At least so many digits; a longer number stays whole."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.lit(digits), F.length(text)), F.lit("0"))


def user_id_of(key: Column | str) -> Column:
    return F.concat(F.lit("usr_"), _padded(F.col(key) if isinstance(key, str) else key, 8))


def _pick(values: list[str], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (position + 1).cast("int"))


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = F.col("o_orderdate").cast("date")
    activity = (
        star_table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.min(ordered).alias("first_day"),
            F.max(ordered).alias("last_day"),
            F.count_if(F.col("o_orderstatus") == "P").alias("payment_failures"),
        )
    )
    nations = star_table(spark, sf_dir, "nation").groupBy("n_nationkey").agg(F.min("n_name").alias("country"))
    customers = (
        star_table(spark, sf_dir, "customer")
        .join(activity, "c_custkey")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    )

    last_digit = F.col("c_custkey") % 10
    plan = (
        F.when(last_digit <= 3, "starter").when(last_digit <= 6, "growth").when(last_digit <= 8, "pro")
        .otherwise("enterprise")
    )
    churned = (F.col("last_day") < F.lit(CHURN_BEFORE)) & (F.col("last_day") > F.col("first_day"))
    return (
        customers.withColumns({"user_id": user_id_of("c_custkey"), "plan": plan, "churned": churned})
        .select(
            "user_id",
            F.col("c_name").alias("company_name"),
            F.concat("user_id", F.lit("@example.com")).alias("email"),
            "plan",
            plan_price("plan").alias("mrr"),
            F.when(F.col("churned"), "churned").otherwise("active").alias("status"),
            F.col("first_day").alias("signup_date"),
            F.when(F.col("churned"), F.col("last_day")).alias("churn_date"),
            F.when(F.col("churned"), _pick(CHURN_REASONS, F.col("c_nationkey") % 8)).alias("churn_reason"),
            "payment_failures",
            "country",
            F.col("c_mktsegment").alias("industry"),
            F.col("first_day").alias("created_at"),
            F.datediff(F.lit(AS_OF), "first_day").cast("long").alias("account_age_days"),
            _pick(ACQUISITION_CHANNELS, F.col("c_nationkey") % 5).alias("acquisition_channel"),
        )
    )


def plan_price(plan: Column | str) -> Column:
    column = F.col(plan) if isinstance(plan, str) else plan
    price = F.lit(None).cast("long")
    for name, amount in PLAN_PRICES.items():
        price = F.when(column == name, F.lit(amount).cast("long")).otherwise(price)
    return price


def _events(source: DataFrame, key: str, user: str, kind: str, moment: str) -> DataFrame:
    return source.select(
        F.col(key).cast("string").alias("event_id"),
        user_id_of(user).alias("user_id"),
        F.col(kind).alias("event_name"),
        F.col(moment).cast("date").alias("event_date"),
        F.when(F.col(key) % 100 < 78, "web").otherwise("mobile").alias("platform"),
        F.concat(F.lit("ses_"), F.col(user), F.lit("_"), F.col(moment).cast("date")).alias("session_id"),
    )


def product_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five weeks of events."""
    return _events(star_table(spark, sf_dir, "events"), "event_id", "user_id", "event_type", "ts")


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as events: years long and within the customers' lifetimes."""
    return _events(star_table(spark, sf_dir, "orders"), "o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")


def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = star_table(spark, sf_dir, "orders").withColumn("ordered", F.col("o_orderdate").cast("date"))
    # Day above, order key below in one decimal that holds any of both: a minimum that hash
    # aggregation can keep, where a minimum over a struct would sort all orders.
    above = F.lit(str(10**_KEY_DIGITS)).cast("decimal(20,0)")
    day_and_key = F.unix_date("ordered").cast("decimal(10,0)") * above + F.col("o_orderkey").cast("decimal(19,0)")
    first_orders = (
        orders.groupBy("o_custkey")
        .agg(F.min(day_and_key).alias("first"))
        .select(F.pmod("first", above).cast("long").alias("first_key"))
    )
    customers = (
        star_table(spark, sf_dir, "customer")
        .groupBy("c_custkey")
        .agg(F.min("c_name").alias("company"), F.min("c_mktsegment").alias("industry"))
    )
    rows = (
        orders.join(first_orders, F.col("o_orderkey") == F.col("first_key"), "left")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
        .withColumn("won", F.col("first_key").isNotNull())
    )

    key = F.col("o_orderkey")
    source = F.lit(None).cast("string")
    for name, bound in reversed(_SOURCE_BOUNDS.items()):
        source = F.when(key % 100 < bound, name).otherwise(source)
    open_stage = (
        F.when(F.col("o_orderstatus") == "F", "new").when(F.col("o_orderstatus") == "O", "qualified")
        .otherwise("demo_booked")
    )
    priority = F.substring("o_orderpriority", 1, 1).cast("int") - 1
    reason = F.lit(None).cast("string")
    for stage, reasons in LOSS_REASONS.items():
        reason = F.when(F.col("stage") == stage, _pick(reasons, priority % len(reasons))).otherwise(reason)
    no_reason = F.col("won") | ((F.col("stage") == "new") & (F.col("o_orderpriority") == "5-LOW"))
    return (
        rows.withColumns(
            {
                "lead_id": key.cast("string"),
                "stage": F.when(F.col("won"), "converted").otherwise(open_stage),
            }
        )
        .select(
            "lead_id",
            F.when(F.col("won"), user_id_of("o_custkey")).alias("user_id"),
            F.lit("first").alias("first_name"),
            F.lit("last").alias("last_name"),
            "company",
            F.concat("lead_id", F.lit("@example.com")).alias("email"),
            "industry",
            _pick(COMPANY_SIZES, key % 5).alias("company_size"),
            source.alias("source"),
            "stage",
            F.when(F.col("won"), F.date_sub("ordered", (key % 58 + 3).cast("int")))
            .otherwise(F.col("ordered"))
            .alias("created_date"),
            F.when(F.col("won"), F.col("ordered")).alias("converted_date"),
            F.when(~no_reason, reason).alias("loss_reason"),
        )
    )


_CAMPAIGN_TYPES = ["newsletter", "promo", "upsell", "re_engagement", "winback"]


def _campaign_id(number: Column, digits: int) -> Column:
    return F.concat(F.lit("cmp_"), _padded(number, digits))


def _campaign_day(number: Column) -> Column:
    return F.date_add(F.lit(dt.date(1995, 6, 30)), (number * 90).cast("int"))


def _campaigns(source: DataFrame, key: str, digits: int, title: str, day: Column) -> DataFrame:
    kind = _pick(_CAMPAIGN_TYPES, F.col(key) % 5)
    return source.select(
        _campaign_id(F.col(key) + 1, digits).alias("campaign_id"),
        F.col(title).alias("campaign_name"),
        kind.alias("campaign_type"),
        segment_of_type(kind).alias("segment"),
        day.alias("send_date"),
        F.col(title).alias("subject_line"),
    )


def email_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A calendar of one campaign per nation, 90 days apart."""
    nations = star_table(spark, sf_dir, "nation")
    return _campaigns(nations, "n_nationkey", 3, "n_name", _campaign_day(F.col("n_nationkey")))


def order_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A calendar that grows with the data: one campaign per order, on its day."""
    orders = star_table(spark, sf_dir, "orders")
    return _campaigns(orders, "o_orderkey", 10, "o_orderpriority", F.col("o_orderdate").cast("date"))


def email_sends(spark: SparkSession, sf_dir: str) -> DataFrame:
    buyers = (
        star_table(spark, sf_dir, "orders").groupBy("o_orderkey").agg(F.min("o_custkey").alias("o_custkey"))
    )
    # Adaptive execution splits a hot key only in shuffles made for the join. The second key, which follows from
    # the first, keeps the join from taking over the shuffle of the aggregate.
    parity = (F.col("l_orderkey") % 2 == F.col("_parity")) & (F.col("l_orderkey") == F.col("o_orderkey"))
    lines = star_table(spark, sf_dir, "lineitem").join(buyers.withColumn("_parity", F.col("o_orderkey") % 2), parity, "left")
    number = F.col("l_orderkey") % 25
    opened = F.col("l_returnflag") != "N"
    return lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("send_id"),
        _campaign_id(number + 1, 3).alias("campaign_id"),
        user_id_of("o_custkey").alias("user_id"),
        _campaign_day(number).alias("send_date"),
        opened.alias("opened"),
        (opened & (F.col("l_linestatus") == "F")).alias("clicked"),
        (opened & (F.col("l_discount") >= 0.08)).alias("replied"),
        (F.col("l_tax") >= 0.08).alias("unsubscribed"),
    )
