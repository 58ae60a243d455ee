"""Monthly recurring revenue."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subtide.functions.dates import as_of_or_today, month_label, month_start
from subtide.functions.numbers import percent


def mrr_monthly(subs: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """New, churned, net and cumulative MRR of each complete month that saw a signup
    or a churn date, with month-over-month growth and revenue churn in percent.

    One scan: a subscription becomes its signup row and its churn row, and the
    months are summed map-side, so the shuffle carries only months. A churn date
    opens a month whatever the status, but only churned customers count as lost.
    """
    current_month = month_start(F.lit(as_of_or_today(as_of)))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    lost = F.col("status") == "churned"
    movements = subs.select(
        F.inline(
            F.array(
                F.struct(
                    month_start("signup_date").alias("month"),
                    F.lit(1).cast("long").alias("joined"),
                    F.col("mrr").alias("joined_mrr"),
                    zero.alias("left"),
                    none.alias("left_mrr"),
                ),
                F.struct(
                    month_start("churn_date").alias("month"),
                    zero.alias("joined"),
                    none.alias("joined_mrr"),
                    F.when(lost, 1).otherwise(0).cast("long").alias("left"),
                    F.when(lost, F.col("mrr")).alias("left_mrr"),
                ),
            )
        )
    )
    # A later month never reaches an earlier one through the windows below, so the
    # incomplete month can go before them.
    monthly = (
        movements.where(F.col("month") < current_month)
        .groupBy("month")
        .agg(
            F.sum("joined").alias("new_customers"),
            F.coalesce(F.sum("joined_mrr"), F.lit(0)).alias("new_mrr"),
            F.sum("left").alias("churned_customers"),
            F.coalesce(F.sum("left_mrr"), F.lit(0)).alias("churned_mrr"),
        )
        .withColumn("net_mrr", F.col("new_mrr") - F.col("churned_mrr"))
    )
    by_month = Window.orderBy("month")
    to_date = by_month.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.col("opening_mrr")
    return (
        monthly.withColumn("cumulative_mrr", F.sum("net_mrr").over(to_date))
        .withColumn("opening_mrr", F.lag("cumulative_mrr").over(by_month))
        .orderBy("month")
        .select(
            month_label("month").alias("month"),
            "new_customers",
            "new_mrr",
            "churned_customers",
            "churned_mrr",
            "net_mrr",
            "cumulative_mrr",
            percent(F.col("cumulative_mrr") - before, before, 1).alias("mrr_growth_pct"),
            percent(F.col("churned_mrr"), before, 1).alias("revenue_churn_pct"),
        )
    )
