"""The adapters' tables with planted violations for the quality checks (FIXTURES.md §4)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subtide.sources import star_tables
from subtide.sources.star_tables import AS_OF

UNKNOWN_USER = "usr_unknown"
UNKNOWN_CAMPAIGN = "cmp_999"
LONG_AFTER = dt.date(2100, 1, 1)
LONG_BEFORE = dt.date(1900, 1, 1)


def _doubled(rows: DataFrame, chosen: Column) -> DataFrame:
    """``rows`` with each chosen row twice."""
    copies = F.when(chosen, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.withColumn("_copy", F.explode(copies)).drop("_copy")


def _number(column: str) -> Column:
    return F.regexp_extract(column, "([0-9]+)", 1).cast("long")


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = _number("user_id")
    churned = F.col("status") == "churned"
    active = F.col("status") == "active"
    churn_date = (
        F.when(churned & (key % 41 == 1), F.col("signup_date"))
        .when(churned & (key % 43 == 2), F.lit(AS_OF + dt.timedelta(days=1)))
        .when(active & (key % 37 == 4), F.date_add("signup_date", 1))
        .otherwise(F.col("churn_date"))
    )
    churn_reason = (
        F.when(key % 13 == 3, F.lit(None).cast("string"))
        .when(active & (key % 31 == 5), "too_expensive")
        .otherwise(F.col("churn_reason"))
    )
    changed = star_tables.subscriptions(spark, sf_dir).withColumns(
        {
            "churn_date": churn_date,
            "churn_reason": churn_reason,
            "mrr": F.when(key % 29 == 6, F.col("mrr") + 1).otherwise(F.col("mrr")),
        }
    )
    return _doubled(changed, key % 50 == 0)


def product_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id").cast("long")
    changed = star_tables.product_events(spark, sf_dir).withColumns(
        {
            "user_id": F.when(key % 97 == 1, UNKNOWN_USER).otherwise(F.col("user_id")),
            "event_date": F.when(key % 89 == 2, F.lit(LONG_AFTER))
            .when(key % 83 == 3, F.lit(LONG_BEFORE))
            .otherwise(F.col("event_date")),
        }
    )
    return _doubled(changed, key % 100 == 0)


def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("lead_id").cast("long")
    won = F.col("stage") == "converted"
    kept = star_tables.leads(spark, sf_dir).where(~won | (_number("user_id") % 101 != 0))
    user_id = (
        F.when(won & (key % 19 == 1), F.lit(None).cast("string"))
        .when(won & (key % 89 == 2), UNKNOWN_USER)
        .when(~won & (key % 79 == 5), star_tables.user_id_of(F.lit(1)))
        .otherwise(F.col("user_id"))
    )
    changed = kept.withColumns(
        {
            "user_id": user_id,
            "created_date": F.when(won & (key % 17 == 4), F.col("converted_date")).otherwise(F.col("created_date")),
            "loss_reason": F.when(key % 73 != 6, F.col("loss_reason")),
        }
    )
    return _doubled(changed, key % 100 == 0)


def email_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubled(star_tables.email_campaigns(spark, sf_dir), F.col("campaign_id") == "cmp_007")


def email_sends(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = _number("send_id")
    unread_click = key % 83 == 3
    unread_reply = key % 79 == 4
    return star_tables.email_sends(spark, sf_dir).withColumns(
        {
            "campaign_id": F.when(key % 97 == 1, UNKNOWN_CAMPAIGN).otherwise(F.col("campaign_id")),
            "user_id": F.when(key % 89 == 2, UNKNOWN_USER).otherwise(F.col("user_id")),
            "opened": F.col("opened") & ~unread_click & ~unread_reply,
            "clicked": F.col("clicked") | unread_click,
            "replied": F.col("replied") | unread_reply,
            "send_date": F.when(key % 73 == 5, F.lit(AS_OF + dt.timedelta(days=1))).otherwise(F.col("send_date")),
        }
    )
