"""Named results over your own five tables, as CSV or Parquet under one folder."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from subtide.functions.dates import as_of_or_today
from subtide.functions.numbers import money_text, percent_text
from subtide.operators import campaigns, churn, funnel, mrr, profile, quality, wau
from subtide.operators.quality import assert_quality, failed_checks, raise_failed
from subtide.sources.schemas import SCHEMAS
from subtide.sources.tables import drop_folder, load_tables, move_folder, read_rescued, write_table

SUBS, EVENTS, LEADS, CALENDAR, SENDS = "subscriptions", "product_events", "leads", "email_campaigns", "email_sends"


def _segment(name: str) -> Callable[..., DataFrame]:
    return partial(campaigns.resolve_segment, name)


def _table_profiles(*tables: DataFrame) -> DataFrame:
    dated = {SUBS: None, EVENTS: "event_date", LEADS: "created_date", CALENDAR: "send_date", SENDS: "send_date"}
    each = [profile.table_profile(name, df, date) for (name, date), df in zip(dated.items(), tables, strict=True)]
    return reduce(DataFrame.unionByName, each)


_AUDIENCE = [CALENDAR, SUBS, EVENTS]

# name -> (operator, its tables in order, whether it takes the as-of date)
REPORTS: dict[str, tuple[Callable[..., DataFrame], list[str], bool]] = {
    "wau": (wau.weekly_active_users, [EVENTS], False),
    "mrr": (mrr.mrr_monthly, [SUBS], True),
    "churn": (churn.churn_report, [SUBS], True),
    "churn_monthly": (churn.churn_monthly, [SUBS], True),
    "churn_by_plan": (churn.churn_by_plan, [SUBS], True),
    "churn_by_reason": (churn.churn_by_reason, [SUBS], True),
    "tenure_by_plan_status": (churn.tenure_by_plan_status, [SUBS], True),
    "funnel": (funnel.funnel_report, [LEADS, SUBS], False),
    "funnel_overview": (funnel.funnel_overview, [LEADS], False),
    "conversion_by_source": (funnel.conversion_by_source, [LEADS, SUBS], False),
    "loss_reasons": (funnel.loss_reasons, [LEADS], False),
    "time_to_convert": (funnel.time_to_convert, [LEADS, SUBS], False),
    "audience": (campaigns.campaign_audience, [CALENDAR, SUBS, EVENTS], False),
    "audience_capped": (campaigns.campaign_audience_capped, [CALENDAR, SUBS, EVENTS], False),
    **{f"segment_{name}": (_segment(name), _AUDIENCE, False) for name in ("all_active", "starter_growth", "low_activity", "churned")},
    "campaign_segments": (campaigns.campaign_segments, [CALENDAR], False),
    "campaign_labels": (campaigns.campaign_labels, [CALENDAR], False),
    "send_records": (campaigns.send_records, [CALENDAR, SUBS, EVENTS, SENDS], False),
    "campaign_performance": (campaigns.campaign_performance, [SENDS, CALENDAR], False),
    "campaign_type_mix": (partial(profile.frequency, column="campaign_type", count="campaigns"), [CALENDAR], False),
    "table_profile": (_table_profiles, [SUBS, EVENTS, LEADS, CALENDAR, SENDS], False),
    "campaign_calendar_overview": (campaigns.campaign_calendar_overview, [CALENDAR], False),
    "send_overview": (campaigns.send_overview, [SENDS], False),
    "plan_summary": (profile.plan_summary, [SUBS], False),
    "subscription_overview": (profile.subscription_overview, [SUBS], False),
    "top_churn_reasons": (profile.top_churn_reasons, [SUBS], False),
    "signup_month_spread": (profile.signup_month_spread, [SUBS], False),
    "churn_label_profile": (profile.churn_label_profile, [SUBS], False),
    "plan_mix": (profile.plan_mix, [SUBS], False),
    "account_age_days": (profile.account_age_days, [SUBS], True),
    "events_by_plan": (profile.events_by_plan, [EVENTS, SUBS], False),
    "avg_events_per_user_by_status": (profile.avg_events_per_user_by_status, [EVENTS, SUBS], False),
    "top_events": (profile.top_events, [EVENTS], False),
    "decay_phases": (profile.decay_phases, [EVENTS, SUBS], False),
    "event_total": (profile.event_total, [EVENTS], False),
    "lead_overview": (profile.lead_overview, [LEADS], False),
    "lead_stage_breakdown": (profile.lead_stage_breakdown, [LEADS], False),
    "lead_conversion_by_source": (profile.lead_conversion_by_source, [LEADS], False),
    "lead_loss_breakdown": (profile.lead_loss_breakdown, [LEADS], False),
    "company_size_mix": (profile.company_size_mix, [LEADS], False),
    "quality_subscriptions": (quality.quality_subscriptions, [SUBS], True),
    "quality_events": (quality.quality_events, [EVENTS, SUBS], False),
    "quality_leads": (quality.quality_leads, [LEADS, SUBS], False),
    "quality_campaigns": (quality.quality_campaigns, [CALENDAR, SENDS, SUBS], True),
}


def run_report(
    name: str,
    spark: SparkSession,
    base_path: str,
    fmt: str = "parquet",
    as_of: dt.date | None = None,
    multi_line: bool = False,
    bad_values: str = "fail",
) -> DataFrame:
    """The named result over the tables in ``base_path``; reads only the tables it needs."""
    if name not in REPORTS:
        raise KeyError(f"no report named {name!r}; known: {', '.join(sorted(REPORTS))}")
    operator, names, dated = REPORTS[name]
    tables = load_tables(spark, base_path, names, fmt, multi_line=multi_line, bad_values=bad_values)
    options = {"as_of": as_of_or_today(as_of)} if dated else {}
    return operator(*[tables[n] for n in names], **options)


def displayed(df: DataFrame) -> DataFrame:
    """Revenue in dollars and percentages with their sign, as text; other columns as they are."""

    def shown(name: str, kind: str) -> Column:
        if kind != "string" and (name == "mrr" or name.endswith("_mrr")):
            return money_text(F.col(name)).alias(name)
        if kind != "string" and name.endswith("_pct"):
            return percent_text(F.col(name), 2).alias(name)
        return F.col(name)

    return df.select(*[shown(name, kind) for name, kind in df.dtypes])


def write_checked(
    df: DataFrame, checks: DataFrame, base_path: str, name: str, fmt: str = "parquet", sort_by: list[str] | None = None, partition_by: str | None = None
) -> str:
    """Write a table only if all of its quality checks pass; raise ``ValueError`` otherwise."""
    assert_quality(checks)
    return write_table(df, base_path, name, fmt, sort_by=sort_by, partition_by=partition_by)


# Table -> the report that checks it.
CHECKS = {
    SUBS: "quality_subscriptions",
    EVENTS: "quality_events",
    LEADS: "quality_leads",
    CALENDAR: "quality_campaigns",
    SENDS: "quality_campaigns",
}

# Table -> the rules of its rows, counted while it is written.
_ROW_RULES = {SUBS: quality.subscription_rules, LEADS: quality.lead_rules, SENDS: quality.send_rules}


def write_checked_tables(
    spark: SparkSession,
    base_path: str,
    target: str,
    names: list[str] | None = None,
    sort_by: dict[str, list[str]] | None = None,
    as_of: dt.date | None = None,
    fmt: str = "parquet",
    target_fmt: str = "parquet",
    partition_by: dict[str, str] | None = None,
    bucket_by: dict[str, tuple[str, int]] | None = None,
    **reading: bool | str,
) -> list[str]:
    """Copy tables to ``target``, each sorted by its ``sort_by`` columns and in folders by its ``partition_by`` date or in the buckets
    of its ``bucket_by`` key, if the checks of all of them pass; else write none.

    Each table is read once, into a folder beside ``target``; the rules of its rows are counted on the way, and if they hold, keys and
    references are checked over what was written there. So a source that changes meanwhile cannot slip through unchecked, and only
    tables whose checks have passed are moved to their place.
    """
    names = names or list(CHECKS)
    sort_by, partition_by, bucket_by = sort_by or {}, partition_by or {}, bucket_by or {}
    staging = f"{target.rstrip('/')}.staging-{uuid.uuid4().hex[:12]}"
    sources = load_tables(spark, base_path, names, fmt, **reading)
    try:
        failed: list[tuple[str, str, int]] = []
        for name in names:
            rules = _ROW_RULES[name](as_of) if name in _ROW_RULES else {}
            counted = Observation(name)
            observed = (counted, [F.count_if(rule).alias(check) for check, rule in rules.items()]) if rules else None
            layout = {"sort_by": sort_by.get(name), "partition_by": partition_by.get(name), "bucket_by": bucket_by.get(name)}
            write_table(sources[name], staging, name, target_fmt, **layout, observed=observed)
            if rules:
                failed += [(name, check, n) for check, n in counted.get.items() if n]
        raise_failed(failed)
        for check in dict.fromkeys(CHECKS[name] for name in names):
            operator, needed, dated = REPORTS[check]
            tables = load_tables(spark, staging, [n for n in needed if n in names], target_fmt)
            tables |= load_tables(spark, base_path, [n for n in needed if n not in names], fmt, **reading)
            failed += failed_checks(operator(*[tables[n] for n in needed], **({"as_of": as_of_or_today(as_of)} if dated else {})))
        raise_failed(failed)
        paths = [f"{target.rstrip('/')}/{name}.{target_fmt}" for name in names]
        for name, path in zip(names, paths, strict=True):
            move_folder(spark, f"{staging}/{name}.{target_fmt}", path)
        return paths
    finally:
        drop_folder(spark, staging)


def malformed_values(spark: SparkSession, base_path: str, names: list[str] | None = None, multi_line: bool = False) -> DataFrame:
    """Per CSV table, how many values did not fit their column and how many lines had too few or too many values."""
    found = [
        quality.quality_malformed(name, read_rescued(spark, f"{base_path.rstrip('/')}/{name}.csv", SCHEMAS[name], multi_line))
        for name in names or list(CHECKS)
    ]
    return reduce(DataFrame.unionByName, found)
