"""Summary aggregates and table profiles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtide.domain import DECLINE_PHASE_END, NORMAL_PHASE_END
from subtide.functions.dates import as_of_or_today, days_between, month_start
from subtide.functions.numbers import ratio, round_as_printed, round_half_even

# Parts into which the events of one user are dealt.
_SLICES = 32


def _churned() -> Column:
    return F.col("status") == "churned"


def frequency(df: DataFrame, column: str, count: str, top: int | None = None) -> DataFrame:
    """How often each value occurs, most frequent first, missing values left out;
    equal counts in the order of the values."""
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias(count))
        .orderBy(F.desc(count), column)
    )
    return counts if top is None else counts.limit(top)


# Subscriptions


def plan_summary(subs: DataFrame) -> DataFrame:
    return (
        subs.where(F.col("plan").isNotNull())
        .groupBy("plan")
        .agg(
            F.count("user_id").alias("users"),
            F.count_if(_churned()).alias("churned"),
            F.coalesce(F.sum("mrr"), F.lit(0)).alias("total_mrr"),
        )
        .select(
            "plan",
            "users",
            "churned",
            round_half_even(ratio(F.col("churned"), F.col("users")) * 100, 1).alias("churn_rate_pct"),
            "total_mrr",
        )
        .orderBy("plan")
    )


def subscription_overview(subs: DataFrame) -> DataFrame:
    active = F.col("status") == "active"
    return subs.agg(
        F.count("*").alias("total_users"),
        F.count_if(active).alias("active"),
        F.count_if(_churned()).alias("churned"),
        F.coalesce(F.sum(F.when(active, F.col("mrr"))), F.lit(0)).alias("active_mrr"),
    )


def top_churn_reasons(subs: DataFrame, top: int = 6) -> DataFrame:
    return frequency(subs, "churn_reason", "customers", top)


def signup_month_spread(subs: DataFrame) -> DataFrame:
    monthly = (
        subs.where(F.col("signup_date").isNotNull())
        .groupBy(month_start("signup_date").alias("month"))
        .agg(
            F.count("*").alias("signups"),
            F.min("signup_date").alias("oldest"),
            F.max("signup_date").alias("newest"),
        )
    )
    return monthly.agg(
        F.min("oldest").alias("oldest_signup"),
        F.max("newest").alias("newest_signup"),
        F.min("signups").alias("min_signups_per_month"),
        F.max("signups").alias("max_signups_per_month"),
    )


def churn_label_profile(subs: DataFrame) -> DataFrame:
    return subs.agg(
        F.count_if(F.col("status") == "active").alias("active"),
        F.count_if(_churned()).alias("churned"),
        round_as_printed(ratio(F.count_if(_churned()), F.count("*")) * 100, 1).alias("churn_rate_pct"),
    )


def plan_mix(subs: DataFrame) -> DataFrame:
    return frequency(subs, "plan", "customers")


def account_age_days(subs: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    age = days_between("signup_date", F.lit(as_of_or_today(as_of)))
    return subs.select("user_id", "signup_date", age.alias("account_age_days"))


# Events


def _events_per_user(events: DataFrame) -> DataFrame:
    """Event counts per user; a user with very many events is one row per task before
    the shuffle, and one row when it joins."""
    return (
        events.where(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.count("event_id").alias("events"), F.count("*").alias("n"))
    )


def _one_per_user(subs: DataFrame, column: str) -> DataFrame:
    """One value of each user: a subscription that is there twice does not count events twice."""
    return subs.where(F.col(column).isNotNull()).groupBy("user_id").agg(F.min(column).alias(column))


def events_by_plan(events: DataFrame, subs: DataFrame) -> DataFrame:
    return (
        _events_per_user(events)
        .join(_one_per_user(subs, "plan"), "user_id")
        .groupBy("plan")
        .agg(F.sum("events").alias("total_events"), F.count("*").alias("unique_users"))
        .withColumn(
            "events_per_user", round_half_even(ratio(F.col("total_events"), F.col("unique_users")), 1)
        )
        .orderBy("plan")
    )


def avg_events_per_user_by_status(events: DataFrame, subs: DataFrame) -> DataFrame:
    """Mean events of the users that have any, by subscription status."""
    return (
        _events_per_user(events)
        .join(_one_per_user(subs, "status"), "user_id")
        .groupBy("status")
        .agg(round_half_even(F.avg("n"), 1).alias("avg_events_per_user"))
        .orderBy("status")
    )


def top_events(events: DataFrame, top: int = 8) -> DataFrame:
    return frequency(events, "event_name", "events", top)


def event_total(events: DataFrame) -> DataFrame:
    return events.agg(F.count("*").alias("total_events"))


def decay_phases(events: DataFrame, subs: DataFrame) -> DataFrame:
    """Churned customers' events before 60 %, between 60 and 85 %, and after 85 % of
    their tenure, with each phase's share in whole percent."""
    tenure = F.datediff("churn_date", "signup_date")

    def phase_end(share: float):
        return F.date_add("signup_date", (tenure * F.lit(share)).cast("int"))

    lives = subs.where(_churned() & F.col("signup_date").isNotNull() & F.col("churn_date").isNotNull()).select(
        "user_id", phase_end(NORMAL_PHASE_END).alias("normal_end"), phase_end(DECLINE_PHASE_END).alias("decline_end")
    )
    # Only churned users' events are summed. The users meet them in slices, so a user with very many
    # events is split until the sums per day have made them few.
    dealt = events.where(F.col("event_date").isNotNull()).withColumn("_slice", F.pmod(F.xxhash64("event_id"), F.lit(_SLICES)))
    slices = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(_SLICES - 1).cast("long")))
    churned_users = lives.select("user_id", slices.alias("_slice"))
    of_churned = dealt.join(churned_users, ["user_id", "_slice"], "left_semi")
    per_day = of_churned.groupBy("user_id", "event_date").agg(F.count("*").alias("n"))
    n, day = F.col("n"), F.col("event_date")
    normal, silent = day <= F.col("normal_end"), day > F.col("decline_end")
    phases = per_day.join(lives, "user_id").agg(
        F.coalesce(F.sum(F.when(normal, n)), F.lit(0)).alias("phase1_normal"),
        F.coalesce(F.sum(F.when(~normal & ~silent, n)), F.lit(0)).alias("phase2_decline"),
        F.coalesce(F.sum(F.when(silent, n)), F.lit(0)).alias("phase3_silent"),
    )
    names = ["phase1_normal", "phase2_decline", "phase3_silent"]
    total = sum(F.col(name) for name in names)
    return phases.select(
        *names, *[round_as_printed(ratio(F.col(name), total) * 100, 0).alias(f"{name}_pct") for name in names]
    )


# Leads


def lead_overview(leads: DataFrame) -> DataFrame:
    won = F.count_if(F.col("stage") == "converted")
    return leads.agg(
        F.count("*").alias("total_leads"),
        won.alias("converted"),
        round_as_printed(ratio(won, F.count("*")) * 100, 1).alias("conversion_pct"),
        (F.count("*") - won).alias("not_converted"),
    )


def lead_stage_breakdown(leads: DataFrame) -> DataFrame:
    return frequency(leads, "stage", "leads")


def lead_conversion_by_source(leads: DataFrame) -> DataFrame:
    won = F.count_if(F.col("stage") == "converted")
    return (
        leads.where(F.col("source").isNotNull())
        .groupBy("source")
        .agg(
            F.count("*").alias("total"),
            won.alias("converted"),
            round_as_printed(ratio(won, F.count("*")) * 100, 1).alias("conv_rate_pct"),
        )
        .orderBy("source")
    )


def lead_loss_breakdown(leads: DataFrame) -> DataFrame:
    return frequency(leads, "loss_reason", "leads")


def company_size_mix(leads: DataFrame) -> DataFrame:
    return frequency(leads, "company_size", "leads")


# Any table


def table_profile(name: str, df: DataFrame, date_column: str | None = None) -> DataFrame:
    """Row count, column names and, for a dated table, its first and last date."""
    no_date = F.lit(None).cast("date")
    return df.agg(
        F.count("*").alias("row_count"),
        (F.min(date_column) if date_column else F.min(no_date)).alias("first_date"),
        (F.max(date_column) if date_column else F.max(no_date)).alias("last_date"),
    ).select(
        F.lit(name).alias("table_name"),
        "row_count",
        F.lit(", ".join(df.columns)).alias("column_names"),
        "first_date",
        "last_date",
    )
