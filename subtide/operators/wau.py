"""Weekly active users."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subtide.functions.numbers import percent, ratio


def weekly_active_users(events: DataFrame) -> DataFrame:
    """Distinct users and sessions per Monday-based week, the change to the previous
    reported week, and the mean over up to four reported weeks.

    Users and sessions are counted in two narrow passes that meet as one row per week.
    Distinct counts of both columns in one aggregate would expand every event to three
    rows before the first shuffle. Both passes shuffle on week and value, so a busy
    week or a very active user is never one task's work.
    """
    week = F.trunc("event_date", "week")
    users = (
        events.groupBy(week.alias("week_start"), "user_id")
        .agg(F.count("*").alias("n"))
        .groupBy("week_start")
        .agg(F.count("user_id").alias("wau"), F.sum("n").alias("events"))
    )
    sessions = (
        events.select(week.alias("_week"), "session_id")
        .distinct()
        .groupBy("_week")
        .agg(F.count("session_id").alias("total_sessions"))
    )
    weekly = users.join(sessions, F.col("week_start").eqNullSafe(F.col("_week")))
    by_week = Window.orderBy(F.asc_nulls_last("week_start"))
    change = F.col("wau") - F.col("previous")
    return (
        weekly.withColumn("previous", F.lag("wau").over(by_week))
        .withColumn("mean_of_4", F.avg("wau").over(by_week.rowsBetween(-3, Window.currentRow)))
        .select(
            "week_start",
            "wau",
            change.alias("wau_change"),
            percent(change, F.col("previous"), 1).alias("wau_growth_pct"),
            "total_sessions",
            F.round(ratio(F.col("events"), F.col("wau")), 1).alias("events_per_user"),
            F.round("mean_of_4", 1).alias("wau_4wk_avg"),
        )
        .orderBy(F.asc_nulls_last("week_start"))
    )
