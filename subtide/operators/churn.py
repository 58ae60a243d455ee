"""Churn by month, plan and reason, tenure, and the four stacked into one report.

All of them are sums over *cells*: a subscription is one cell in the profile
sections, and in the monthly section it is its signup month, +1 on the active count
from the month after signup, -1 from the first month start it no longer sees, and
its churn. Cells are summed map-side; no subscription is joined to the months it was
active in.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subtide.functions.cells import REPORT_COLUMNS, by_section, fan_out
from subtide.functions.dates import as_of_or_today, days_between, month_label, month_start, next_month
from subtide.functions.numbers import decimal_text, percent, ratio

MONTHLY, BY_PLAN, BY_REASON, TENURE = "1_monthly_churn", "2_by_plan", "3_by_reason", "4_tenure"
_PROFILE = "profile"


def _churned() -> Column:
    return F.col("status") == "churned"


def _reason_known() -> Column:
    return _churned() & F.col("churn_reason").isNotNull()


def _sums() -> list[Column]:
    return [
        F.sum("users").alias("users"),
        F.sum("churned").alias("churned"),
        F.sum("mrr").alias("mrr"),
        F.sum("days").alias("days"),
        F.sum("churned_days").alias("churned_days"),
        F.min("min_days").alias("min_days"),
        F.max("max_days").alias("max_days"),
        F.sum("change").alias("change"),
    ]


def _long(value: int | None) -> Column:
    return F.lit(value).cast("long")


def _with_tenure(subs: DataFrame, as_of: dt.date) -> DataFrame:
    return subs.where(F.col("signup_date").isNotNull()).withColumn(
        "tenure", days_between("signup_date", F.coalesce("churn_date", F.lit(as_of)))
    )


def _profile_measures() -> dict[str, Column]:
    return {
        "users": _long(1),
        "churned": F.when(_churned(), 1).otherwise(0).cast("long"),
        "mrr": F.col("mrr"),
        "days": F.col("tenure"),
        "churned_days": F.when(_churned(), F.col("tenure")),
        "min_days": F.col("tenure"),
        "max_days": F.col("tenure"),
        "change": _long(0),
    }


def _month_cell(month: Column, users: int = 0, churned: int = 0, mrr: Column | None = None, change: int = 0):
    return {
        "plan": F.lit(None).cast("string"),
        "status": F.lit(None).cast("string"),
        "churn_reason": F.lit(None).cast("string"),
        "month": month,
        "users": _long(users),
        "churned": _long(churned),
        "mrr": mrr if mrr is not None else _long(None),
        "days": _long(None),
        "churned_days": _long(None),
        "min_days": _long(None),
        "max_days": _long(None),
        "change": _long(change),
    }


def _month_sections() -> list[tuple[str, Column | None, dict[str, Column]]]:
    """A subscription counts as active at a month start strictly after its signup
    and strictly before its churn date."""
    known = F.col("user_id").isNotNull()
    entry = next_month(F.col("signup_date"))
    churn = F.col("churn_date")
    first_unseen = F.when(churn == month_start(churn), churn).otherwise(next_month(churn))
    left = _churned() & churn.isNotNull()
    return [
        (MONTHLY, None, _month_cell(month_start("signup_date"), users=1)),
        (MONTHLY, known, _month_cell(entry, change=1)),
        (MONTHLY, known & churn.isNotNull(), _month_cell(F.greatest(entry, first_unseen), change=-1)),
        (MONTHLY, left, _month_cell(month_start(churn), churned=1, mrr=F.col("mrr"))),
    ]


def _fill_months(cells: DataFrame, as_of: dt.date, *section_key: str) -> DataFrame:
    """Running active count per month, and a row for each month without a cell. Rows
    of other sections have no month and pass through. The windows see one row per
    month of the calendar."""
    current_month = month_start(F.lit(as_of))
    section = Window.partitionBy(*section_key)
    by_month = section.orderBy("month")
    to_date = by_month.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    no_month = F.col("month").isNull()
    gap = F.sequence("month", F.add_months("following", -1), F.expr("interval 1 month"))
    own = F.col("spine") == F.col("month")
    return (
        cells.where(no_month | (F.col("month") < current_month))
        .withColumns(
            {
                "active": F.sum("change").over(to_date),
                "first_month": F.min(F.when(F.col("users") > 0, F.col("month"))).over(section),
                "following": F.coalesce(F.lead("month").over(by_month), current_month),
            }
        )
        .where(no_month | (F.col("month") >= F.col("first_month")))
        .withColumn("spine", F.explode(F.when(no_month, F.array("month")).otherwise(gap)))
        .withColumns(
            {
                "churned": F.when(no_month | own, F.col("churned")).otherwise(0),
                "mrr": F.when(no_month | own, F.col("mrr")),
                "month": F.col("spine"),
            }
        )
    )


def _monthly_columns() -> list[Column]:
    return [
        F.col("active").alias("active_count"),
        F.col("churned"),
        F.coalesce("mrr", F.lit(0)).alias("lost_mrr"),
        percent(F.col("churned"), F.col("active"), 2).alias("churn_rate_pct"),
    ]


def _plan_columns() -> list[Column]:
    return [
        F.col("users").alias("total_users"),
        F.col("churned").alias("churned_users"),
        percent(F.col("churned"), F.col("users"), 1).alias("churn_rate_pct"),
        F.round(ratio(F.col("churned_days"), F.col("churned")), 0).alias("avg_days_to_churn"),
    ]


def _reason_columns() -> list[Column]:
    all_reasons = F.sum("users").over(Window.partitionBy("section"))
    return [
        F.col("users").alias("churned_users"),
        percent(F.col("users"), all_reasons, 1).alias("pct_of_churned"),
        F.col("mrr").alias("lost_mrr"),
        F.round(ratio(F.col("days"), F.col("users")), 0).alias("avg_tenure_days"),
    ]


def _tenure_columns() -> list[Column]:
    return [
        F.col("users"),
        F.round(ratio(F.col("days"), F.col("users")), 0).alias("avg_days"),
        F.col("min_days"),
        F.col("max_days"),
    ]


def _profile_cells(subs: DataFrame, as_of: dt.date) -> DataFrame:
    return _with_tenure(subs, as_of).select("plan", "status", "churn_reason", *_aliased(_profile_measures()))


def _aliased(columns: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def churn_monthly(subs: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Customers active at each month start, churned in the month and their MRR, from
    the first signup month to the last complete month."""
    day = as_of_or_today(as_of)
    rows = subs.where(F.col("signup_date").isNotNull())
    cells = fan_out(rows, _month_sections()).groupBy("month").agg(*_sums())
    return (
        _fill_months(cells, day).orderBy("month").select(month_label("month").alias("month"), *_monthly_columns())
    )


def churn_by_plan(subs: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    cells = _profile_cells(subs, as_of_or_today(as_of))
    return (
        cells.groupBy("plan").agg(*_sums()).select("plan", *_plan_columns())
        .orderBy(F.desc_nulls_last("churn_rate_pct"), F.asc_nulls_last("plan"))
    )


def churn_by_reason(subs: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    cells = _profile_cells(subs.where(_reason_known()), as_of_or_today(as_of))
    return (
        cells.groupBy("churn_reason").agg(*_sums())
        .withColumn("section", F.lit(BY_REASON))
        .select("churn_reason", *_reason_columns())
        .orderBy(F.desc("churned_users"), "churn_reason")
    )


def tenure_by_plan_status(subs: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    cells = _profile_cells(subs, as_of_or_today(as_of))
    return (
        cells.groupBy("plan", "status").agg(*_sums()).select("plan", "status", *_tenure_columns())
        .orderBy(F.asc_nulls_last("plan"), F.asc_nulls_last("status"))
    )


def churn_report(subs: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """The four sections stacked, every measure as text, from one scan of ``subs``."""
    day = as_of_or_today(as_of)
    rows = _with_tenure(subs, day)
    profile = {
        "plan": F.col("plan"),
        "status": F.col("status"),
        "churn_reason": F.col("churn_reason"),
        "month": F.lit(None).cast("date"),
        **_profile_measures(),
    }
    cells = (
        fan_out(rows, [(_PROFILE, None, profile), *_month_sections()])
        .groupBy("section", "plan", "status", "churn_reason", "month")
        .agg(*_sums())
    )

    none = F.lit(None).cast("string")
    measures = {name: F.col(name) for name in _profile_measures()}
    is_profile = F.col("section") == _PROFILE

    def section(label: str, condition: Column, first: Column, second: Column):
        return (label, condition, {"first": first, "second": second, "month": F.col("month"), **measures})

    stacked = (
        fan_out(
            cells,
            [
                section(MONTHLY, ~is_profile, none, none),
                section(BY_PLAN, is_profile, F.col("plan"), none),
                section(BY_REASON, is_profile & _reason_known(), F.col("churn_reason"), none),
                section(TENURE, is_profile, F.col("plan"), F.col("status")),
            ],
        )
        .groupBy("section", "first", "second", "month")
        .agg(*_sums())
    )
    texts = {
        MONTHLY: _texts(_monthly_columns(), {3: 2}),
        BY_PLAN: _texts(_plan_columns(), {2: 1, 3: 0}),
        BY_REASON: _texts(_reason_columns(), {1: 1, 3: 0}),
        TENURE: _texts(_tenure_columns(), {1: 0}),
    }
    dim = (
        F.when(F.col("section") == MONTHLY, month_label("month"))
        .when(F.col("section") == TENURE, F.concat_ws("", "first", F.lit(" / "), "second"))
        .otherwise(F.col("first"))
    )
    return (
        _fill_months(stacked, day, "section")
        .select("section", dim.alias("dim"), *[by_section(texts, i) for i in range(4)])
        .select(*REPORT_COLUMNS)
        .orderBy("section", F.asc_nulls_last("dim"))
    )


def _texts(columns: list[Column], decimals: dict[int, int]) -> list[Column]:
    """Columns as text; ``decimals`` gives the digits of those that are doubles."""
    return [
        decimal_text(column, decimals[i]) if i in decimals else column.cast("string")
        for i, column in enumerate(columns)
    ]
