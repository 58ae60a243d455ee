"""The lead funnel: volume per stage, conversion by source, loss reasons, time to convert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subtide.domain import FUNNEL_STAGES
from subtide.functions.cells import REPORT_COLUMNS, by_section, fan_out
from subtide.functions.dates import days_between
from subtide.functions.numbers import decimal_text, percent, ratio

OVERVIEW, BY_SOURCE, LOSSES, TIME = "1_funnel", "2_by_source", "3_loss_reasons", "4_time_to_convert"


def _won() -> Column:
    return F.col("stage") == "converted"


def _lost() -> Column:
    return (F.col("stage") != "converted") & F.col("loss_reason").isNotNull()


def _sums() -> list[Column]:
    return [
        F.sum("leads").alias("leads"),
        F.sum("won").alias("won"),
        F.sum("won_mrr").alias("won_mrr"),
        F.sum("won_dated").alias("won_dated"),
        F.sum("won_days").alias("won_days"),
        F.min("fastest").alias("fastest"),
        F.max("slowest").alias("slowest"),
        F.sum("dated_mrr").alias("dated_mrr"),
    ]


def _source_cells(leads: DataFrame, subs: DataFrame) -> DataFrame:
    """Lead measures by source and the plan of the customer a lead became.

    Leads are summed per user before the join: all leads without a user collapse to
    a few rows map-side, and a user with very many leads joins as a few rows too.
    """
    days = F.when(_won(), days_between("created_date", "converted_date"))
    per_user = (
        leads.groupBy("user_id", "source")
        .agg(
            F.count("*").alias("leads"),
            F.count_if(_won()).alias("won"),
            F.count(days).alias("won_dated"),
            F.sum(days).alias("won_days"),
            F.min(days).alias("fastest"),
            F.max(days).alias("slowest"),
        )
    )
    mrr = F.col("mrr")
    other = F.when(F.col("won") < F.col("leads"), 0)
    return (
        per_user.join(subs.select("user_id", "plan", "mrr"), "user_id", "left")
        .withColumns(
            {
                "won_mrr": F.coalesce(F.when(F.col("won") > 0, F.col("won") * mrr), other),
                "dated_mrr": F.when(F.col("won_dated") > 0, F.col("won_dated") * mrr),
            }
        )
        .groupBy("source", "plan")
        .agg(*_sums())
    )


def _source_columns() -> list[Column]:
    return [
        F.col("leads").alias("total_leads"),
        F.col("won").alias("converted"),
        percent(F.col("won"), F.col("leads"), 1).alias("conversion_rate_pct"),
        F.col("won_mrr").alias("mrr_generated"),
        F.round(ratio(F.col("won_days"), F.col("won_dated")), 0).alias("avg_days_to_convert"),
    ]


def _time_columns() -> list[Column]:
    return [
        F.col("won_dated").alias("customers"),
        F.round(ratio(F.col("won_days"), F.col("won_dated")), 0).alias("avg_days"),
        F.col("fastest").alias("fastest_days"),
        F.col("slowest").alias("slowest_days"),
        F.col("dated_mrr").alias("total_mrr"),
    ]


def _overview_columns() -> list[Column]:
    down = Window.partitionBy("section").orderBy("ord")
    return [
        F.col("leads").alias("total_leads"),
        (F.col("leads") - F.lead("leads").over(down)).alias("drop_off"),
        percent(F.col("leads"), F.first("leads").over(down), 1).alias("pct_of_top_of_funnel"),
    ]


def _loss_columns() -> list[Column]:
    stage_total = F.sum("leads").over(Window.partitionBy("section", "stage"))
    return [
        F.col("leads").alias("lost_leads"),
        percent(F.col("leads"), stage_total, 1).alias("pct_within_stage"),
    ]


def _stage_ordinal() -> Column:
    ordinal = F.lit(None).cast("int")
    for position, stage in enumerate(FUNNEL_STAGES, start=1):
        ordinal = F.when(F.col("stage") == stage, position).otherwise(ordinal)
    return ordinal


def _every_stage(leads: DataFrame) -> DataFrame:
    """One empty row per funnel stage, so that a stage without leads is reported."""
    names = F.array(*[F.lit(stage) for stage in FUNNEL_STAGES])
    return leads.sparkSession.range(0, len(FUNNEL_STAGES), 1, 1).select(
        F.lit(OVERVIEW).alias("section"),
        F.element_at(names, (F.col("id") + 1).cast("int")).alias("stage"),
        F.lit(0).cast("long").alias("leads"),
    )


def funnel_overview(leads: DataFrame) -> DataFrame:
    """Leads by their current stage, the drop to the next stage and the share of the top."""
    counts = leads.groupBy("stage").agg(F.count("*").alias("leads")).withColumn("section", F.lit(OVERVIEW))
    return (
        counts.unionByName(_every_stage(leads))
        .groupBy("section", "stage", _stage_ordinal().alias("ord"))
        .agg(F.sum("leads").alias("leads"))
        .where(F.col("ord").isNotNull())
        .select("ord", "stage", *_overview_columns())
        .orderBy("ord")
    )


def conversion_by_source(leads: DataFrame, subs: DataFrame) -> DataFrame:
    return (
        _source_cells(leads, subs).groupBy("source").agg(*_sums()).select("source", *_source_columns())
        .orderBy(F.desc_nulls_last("conversion_rate_pct"), F.asc_nulls_last("source"))
    )


def loss_reasons(leads: DataFrame) -> DataFrame:
    return (
        leads.where(_lost())
        .groupBy("stage", "loss_reason")
        .agg(F.count("*").alias("leads"))
        .withColumn("section", F.lit(LOSSES))
        .select("stage", "loss_reason", *_loss_columns())
        .orderBy("stage", F.desc("lost_leads"), "loss_reason")
    )


def time_to_convert(leads: DataFrame, subs: DataFrame) -> DataFrame:
    """Days from creation to conversion by source and plan, of leads with both dates."""
    return (
        _source_cells(leads.where(_won()), subs)
        .where(F.col("won_dated") > 0)
        .select("source", "plan", *_time_columns())
        .orderBy("avg_days", F.asc_nulls_last("source"), F.asc_nulls_last("plan"))
    )


def funnel_report(leads: DataFrame, subs: DataFrame) -> DataFrame:
    """The four sections stacked, every measure as text.

    Two scans of ``leads``: the stage sections read two columns and shuffle one row
    per stage and reason, the source sections share the one join to ``subs``.
    """
    stage_cells = leads.groupBy("stage", "loss_reason").agg(F.count("*").alias("leads"))
    no_reason = F.lit(None).cast("string")
    stages = (
        fan_out(
            stage_cells,
            [
                (OVERVIEW, None, {"stage": F.col("stage"), "loss_reason": no_reason, "leads": F.col("leads")}),
                (LOSSES, _lost(), {c: F.col(c) for c in ("stage", "loss_reason", "leads")}),
            ],
        )
        .unionByName(_every_stage(leads).withColumn("loss_reason", no_reason))
        .groupBy("section", "stage", "loss_reason", _stage_ordinal().alias("ord"))
        .agg(F.sum("leads").alias("leads"))
        .where((F.col("section") == LOSSES) | F.col("ord").isNotNull())
    )
    total, drop, share = _overview_columns()
    lost, within = _loss_columns()
    none = F.lit(None).cast("string")
    stage_texts = {
        OVERVIEW: [total.cast("string"), drop.cast("string"), decimal_text(share, 1), none],
        LOSSES: [lost.cast("string"), decimal_text(within, 1), none, none],
    }
    overview = F.col("section") == OVERVIEW
    ordinal = F.concat(F.lpad(F.col("ord").cast("string"), 2, "0"), F.lit("_"), "stage")
    lost_at = F.concat_ws("", "stage", F.lit(" → "), "loss_reason")
    stage_rows = stages.select(
        "section",
        F.when(overview, ordinal).otherwise(F.concat_ws("", "stage", "loss_reason")).alias("sort_key"),
        F.when(overview, F.col("stage")).otherwise(lost_at).alias("dim"),
        *[by_section(stage_texts, i) for i in range(4)],
    )

    source_cells = _source_cells(leads, subs)
    sums = {c: F.col(c) for c in source_cells.columns if c not in ("source", "plan")}
    sources = (
        fan_out(
            source_cells,
            [
                (BY_SOURCE, None, {"source": F.col("source"), "plan": none, **sums}),
                (TIME, F.col("won_dated") > 0, {"source": F.col("source"), "plan": F.col("plan"), **sums}),
            ],
        )
        .groupBy("section", "source", "plan")
        .agg(*_sums())
    )
    by_source, timing = _source_columns(), _time_columns()
    source_texts = {
        BY_SOURCE: [
            by_source[0].cast("string"),
            by_source[1].cast("string"),
            decimal_text(by_source[2], 1),
            by_source[3].cast("string"),
        ],
        TIME: [
            timing[0].cast("string"),
            decimal_text(timing[1], 0),
            timing[2].cast("string"),
            timing[3].cast("string"),
        ],
    }
    whole = F.col("section") == BY_SOURCE
    source_rows = sources.select(
        "section",
        F.when(whole, F.col("source")).otherwise(F.concat_ws("", "source", "plan")).alias("sort_key"),
        F.when(whole, F.col("source")).otherwise(F.concat_ws("", "source", F.lit(" / "), "plan")).alias("dim"),
        *[by_section(source_texts, i) for i in range(4)],
    )
    return (
        stage_rows.unionByName(source_rows)
        .orderBy("section", F.asc_nulls_last("sort_key"), F.asc_nulls_last("dim"))
        .select(*REPORT_COLUMNS)
    )
