"""Named queries: every operator over the star-schema tables, ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from subtide.operators import campaigns, churn, funnel, mrr, profile, quality, wau
from subtide.sources import dirty_tables, star_tables
from subtide.sources.star_tables import AS_OF

Query = Callable[[SparkSession, str], DataFrame]

# Table name in the queries below -> adapter.
TABLES: dict[str, Query] = {
    "subscriptions": star_tables.subscriptions,
    "product_events": star_tables.product_events,
    "order_events": star_tables.order_events,
    "leads": star_tables.leads,
    "email_campaigns": star_tables.email_campaigns,
    "order_campaigns": star_tables.order_campaigns,
    "email_sends": star_tables.email_sends,
    "subscriptions_dirty": dirty_tables.subscriptions,
    "product_events_dirty": dirty_tables.product_events,
    "leads_dirty": dirty_tables.leads,
    "email_campaigns_dirty": dirty_tables.email_campaigns,
    "email_sends_dirty": dirty_tables.email_sends,
}


def _on(operator: Callable[..., DataFrame], *tables: str, **options) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(*[TABLES[name](spark, sf_dir) for name in tables], **options)

    return query


def _segment(name: str) -> Query:
    def resolve(calendar: DataFrame, subs: DataFrame, events: DataFrame) -> DataFrame:
        return campaigns.resolve_segment(name, calendar, subs, events)

    return _on(resolve, "email_campaigns", "subscriptions", "order_events")


def _table_profiles(subs: DataFrame, events: DataFrame) -> DataFrame:
    return profile.table_profile("subscriptions", subs).unionByName(
        profile.table_profile("product_events", events, "event_date")
    )


_AUDIENCE = ("email_campaigns", "subscriptions", "order_events")

QUERIES: dict[str, Query] = {
    # Reports
    "wau": _on(wau.weekly_active_users, "product_events"),
    "wau_orders": _on(wau.weekly_active_users, "order_events"),
    "mrr_monthly": _on(mrr.mrr_monthly, "subscriptions", as_of=AS_OF),
    "churn_monthly": _on(churn.churn_monthly, "subscriptions", as_of=AS_OF),
    "churn_by_plan": _on(churn.churn_by_plan, "subscriptions", as_of=AS_OF),
    "churn_by_reason": _on(churn.churn_by_reason, "subscriptions", as_of=AS_OF),
    "tenure_by_plan_status": _on(churn.tenure_by_plan_status, "subscriptions", as_of=AS_OF),
    "churn_report": _on(churn.churn_report, "subscriptions", as_of=AS_OF),
    "funnel_overview": _on(funnel.funnel_overview, "leads"),
    "conversion_by_source": _on(funnel.conversion_by_source, "leads", "subscriptions"),
    "loss_reasons": _on(funnel.loss_reasons, "leads"),
    "time_to_convert": _on(funnel.time_to_convert, "leads", "subscriptions"),
    "funnel_report": _on(funnel.funnel_report, "leads", "subscriptions"),
    # Segments and campaigns
    "segment_all_active": _segment("all_active"),
    "segment_starter_growth": _segment("starter_growth"),
    "segment_low_activity": _segment("low_activity"),
    "segment_churned": _segment("churned"),
    "segment_default": _segment("no_such_segment"),
    "campaign_audience": _on(campaigns.campaign_audience, *_AUDIENCE),
    "campaign_audience_capped": _on(campaigns.campaign_audience_capped, *_AUDIENCE),
    "campaign_segments": _on(campaigns.campaign_segments, "order_campaigns"),
    "campaign_labels": _on(campaigns.campaign_labels, "order_campaigns"),
    "send_records": _on(campaigns.send_records, *_AUDIENCE, "email_sends"),
    # Data quality
    "quality_subscriptions": _on(quality.quality_subscriptions, "subscriptions", as_of=AS_OF),
    "quality_subscriptions_dirty": _on(quality.quality_subscriptions, "subscriptions_dirty", as_of=AS_OF),
    "quality_events": _on(quality.quality_events, "product_events", "subscriptions"),
    "quality_events_dirty": _on(quality.quality_events, "product_events_dirty", "subscriptions"),
    "quality_leads": _on(quality.quality_leads, "leads", "subscriptions"),
    "quality_leads_dirty": _on(quality.quality_leads, "leads_dirty", "subscriptions"),
    "quality_campaigns": _on(
        quality.quality_campaigns, "email_campaigns", "email_sends", "subscriptions", as_of=AS_OF
    ),
    "quality_campaigns_dirty": _on(
        quality.quality_campaigns, "email_campaigns_dirty", "email_sends_dirty", "subscriptions", as_of=AS_OF
    ),
    # Summaries and profiles
    "plan_summary": _on(profile.plan_summary, "subscriptions"),
    "subscription_overview": _on(profile.subscription_overview, "subscriptions"),
    "top_churn_reasons": _on(profile.top_churn_reasons, "subscriptions"),
    "signup_month_spread": _on(profile.signup_month_spread, "subscriptions"),
    "events_by_plan": _on(profile.events_by_plan, "order_events", "subscriptions"),
    "avg_events_per_user_by_status": _on(profile.avg_events_per_user_by_status, "order_events", "subscriptions"),
    "top_events": _on(profile.top_events, "product_events"),
    "decay_phases": _on(profile.decay_phases, "order_events", "subscriptions"),
    "event_total": _on(profile.event_total, "product_events"),
    "lead_overview": _on(profile.lead_overview, "leads"),
    "lead_stage_breakdown": _on(profile.lead_stage_breakdown, "leads"),
    "lead_conversion_by_source": _on(profile.lead_conversion_by_source, "leads"),
    "lead_loss_breakdown": _on(profile.lead_loss_breakdown, "leads"),
    "company_size_mix": _on(profile.company_size_mix, "leads"),
    "campaign_calendar_overview": _on(campaigns.campaign_calendar_overview, "order_campaigns"),
    "campaign_type_mix": _on(profile.frequency, "order_campaigns", column="campaign_type", count="campaigns"),
    "campaign_performance": _on(campaigns.campaign_performance, "email_sends", "email_campaigns"),
    "send_overview": _on(campaigns.send_overview, "email_sends"),
    "table_profile": _on(_table_profiles, "subscriptions", "product_events"),
    "churn_label_profile": _on(profile.churn_label_profile, "subscriptions"),
    "plan_mix": _on(profile.plan_mix, "subscriptions"),
    "account_age_days": _on(profile.account_age_days, "subscriptions", as_of=AS_OF),
}


def run_query(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The named query's lazy result; the caller shows, writes or collects it."""
    if name not in QUERIES:
        raise KeyError(f"no query named {name!r}; known: {', '.join(sorted(QUERIES))}")
    return QUERIES[name](spark, sf_dir)
