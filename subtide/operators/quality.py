"""Data-quality checks: one row (table_name, check_name, violations, passed) per check."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtide.domain import PLAN_PRICES
from subtide.functions.dates import as_of_or_today
from subtide.sources.tables import LINE, RESCUED


def _rows(counts: DataFrame, table: str, checks: list[str]) -> DataFrame:
    """One row of counts, a column per check, as one row per check."""
    entries = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(check).alias("check_name"),
            F.coalesce(F.col(check), F.lit(0)).cast("long").alias("violations"),
        )
        for check in checks
    ]
    return counts.select(F.inline(F.array(*entries))).withColumn("passed", F.col("violations") == 0)


def _key_and_row_checks(df: DataFrame, table: str, key: str, repeated: str, row_checks: dict[str, Column]) -> DataFrame:
    """Rows beyond the first of each key (a missing key is a key), and rows that break
    a same-row rule, in one scan and one shuffle on the key."""
    per_key = df.groupBy(key).agg(
        (F.count("*") - 1).alias(repeated), *[F.count_if(rule).alias(name) for name, rule in row_checks.items()]
    )
    checks = [repeated, *row_checks]
    return _rows(per_key.agg(*[F.sum(name).alias(name) for name in checks]), table, checks)


def _presence(
    child: DataFrame, parents: dict[str, tuple[str, DataFrame]], rules: dict[str, Column] | None = None
) -> DataFrame:
    """Per foreign key value: rows in ``child`` and rows in the parent table, and the child rows that break
    each of the ``rules``, counted with the first reference alone.

    ``parents`` maps a label to (child column, parent table with that column). Values are counted
    map-side on both sides and meet in one shuffle, so a value that most rows share
    is one row per task.
    """
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")

    def entry(label: str, column: str) -> list[Column]:
        return [F.lit(label).alias("reference"), F.col(column).cast("string").alias("value")]

    rules = rules or {}
    broken = {name: F.coalesce(rule.cast("long"), none) for name, rule in rules.items()}
    references = []
    for k, (label, (column, _)) in enumerate(parents.items()):
        counted = [(value if k == 0 else none).alias(name) for name, value in broken.items()]
        references.append(F.struct(*entry(label, column), one.alias("in_child"), none.alias("in_parent"), *counted))
    sides = [child.select(F.inline(F.array(*references)))]
    for label, (column, parent) in parents.items():
        known = parent.where(F.col(column).isNotNull()).select(*entry(label, column))
        sides.append(known.select("*", none.alias("in_child"), one.alias("in_parent"), *[none.alias(n) for n in rules]))
    counts = ["in_child", "in_parent", *rules]
    return (
        reduce(DataFrame.unionByName, sides)
        .groupBy("reference", "value")
        .agg(*[F.sum(name).alias(name) for name in counts])
    )


def _wrong_price() -> Column:
    wrong = F.lit(False)
    for plan, price in PLAN_PRICES.items():
        wrong = wrong | ((F.col("plan") == plan) & (F.col("mrr").isNull() | (F.col("mrr") != price)))
    return wrong


def subscription_rules(as_of: dt.date | None = None) -> dict[str, Column]:
    """What a subscription breaks by itself."""
    churned, active = F.col("status") == "churned", F.col("status") == "active"
    return {
        "churn_not_after_signup": churned & (F.col("churn_date") <= F.col("signup_date")),
        "future_churn_dates": F.col("churn_date") > F.lit(as_of_or_today(as_of)),
        "churned_without_reason": churned & F.col("churn_reason").isNull(),
        "active_with_churn_date": active & F.col("churn_date").isNotNull(),
        "active_with_churn_reason": active & F.col("churn_reason").isNotNull(),
        "mrr_not_plan_price": _wrong_price(),
    }


def lead_rules(as_of: dt.date | None = None) -> dict[str, Column]:
    """What a lead breaks by itself."""
    won = F.col("stage") == "converted"
    open_lead = ~F.coalesce(won, F.lit(False))
    return {
        "converted_without_user": won & F.col("user_id").isNull(),
        "created_not_before_converted": won & (F.col("created_date") >= F.col("converted_date")),
        "open_lead_with_user": open_lead & F.col("user_id").isNotNull(),
        "open_lead_without_reason": open_lead & F.col("loss_reason").isNull(),
    }


def send_rules(as_of: dt.date | None = None) -> dict[str, Column]:
    """What a send breaks by itself."""
    opened = F.coalesce("opened", F.lit(False))
    return {
        "clicked_without_open": F.col("clicked") & ~opened,
        "replied_without_open": F.col("replied") & ~opened,
        "future_send_dates": F.col("send_date") > F.lit(as_of_or_today(as_of)),
    }


def quality_subscriptions(subs: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    return _key_and_row_checks(subs, "subscriptions", "user_id", "duplicate_user_ids", subscription_rules(as_of))


def quality_events(events: DataFrame, subs: DataFrame) -> DataFrame:
    """Events are counted per user and day before they meet the subscriptions."""
    keys = _key_and_row_checks(events, "product_events", "event_id", "duplicate_event_ids", {})
    per_day = events.groupBy("user_id", "event_date").agg(F.count("*").alias("n"))
    lives = subs.where(F.col("user_id").isNotNull()).select(
        "user_id", "signup_date", "churn_date", F.lit(True).alias("known")
    )
    n, day = F.col("n"), F.col("event_date")
    against_lives = per_day.join(lives, "user_id", "left").agg(
        F.sum(F.when(F.col("known").isNull(), n)).alias("unknown_users"),
        F.sum(F.when(day > F.col("churn_date"), n)).alias("events_after_churn"),
        F.sum(F.when(day < F.col("signup_date"), n)).alias("events_before_signup"),
    )
    checks = ["unknown_users", "events_after_churn", "events_before_signup"]
    return keys.unionByName(_rows(against_lives, "product_events", checks))


def quality_leads(leads: DataFrame, subs: DataFrame) -> DataFrame:
    own = _key_and_row_checks(leads, "leads", "lead_id", "duplicate_lead_ids", lead_rules())
    users = _presence(leads.where(F.col("user_id").isNotNull()), {"user": ("user_id", subs)}).agg(
        F.count_if((F.col("in_child") > 0) & (F.col("in_parent") == 0)).alias("unknown_users"),
        F.count_if((F.col("in_child") == 0) & (F.col("in_parent") > 0)).alias("subscribers_without_lead"),
    )
    return own.unionByName(_rows(users, "leads", ["unknown_users", "subscribers_without_lead"]))


def quality_campaigns(
    campaigns: DataFrame, sends: DataFrame, subs: DataFrame, as_of: dt.date | None = None
) -> DataFrame:
    calendar = _key_and_row_checks(campaigns, "email_campaigns", "campaign_id", "duplicate_campaign_ids", {})
    keys = _key_and_row_checks(sends, "email_sends", "send_id", "duplicate_send_ids", {})
    rules = send_rules(as_of)
    references = _presence(sends, {"campaign": ("campaign_id", campaigns), "user": ("user_id", subs)}, rules)
    orphans = F.when(F.col("in_parent") == 0, F.col("in_child"))
    unknown = references.agg(
        F.sum(F.when(F.col("reference") == "campaign", orphans)).alias("unknown_campaigns"),
        F.sum(F.when(F.col("reference") == "user", orphans)).alias("unknown_users"),
        *[F.sum(name).alias(name) for name in rules],
    )
    own = _rows(unknown, "email_sends", [*rules, "unknown_campaigns", "unknown_users"])
    return calendar.unionByName(keys).unionByName(own)


def quality_malformed(table: str, rescued: DataFrame) -> DataFrame:
    """How many values of a table read by ``read_rescued`` did not fit their column, and how many lines had too few or too many."""
    values = F.coalesce(F.size(F.map_filter(RESCUED, lambda name, _: name != LINE)), F.lit(0))
    lines = F.map_contains_key(RESCUED, F.lit(LINE))
    counts = rescued.agg(F.sum(values).alias("malformed_values"), F.count_if(lines).alias("malformed_lines"))
    return _rows(counts, table, ["malformed_values", "malformed_lines"])


def failed_checks(checks: DataFrame) -> list[tuple[str, str, int]]:
    """Table, check and violations of every failed check of a quality DataFrame."""
    failed = checks.where(~F.col("passed")).orderBy("table_name", "check_name").collect()
    return [(r["table_name"], r["check_name"], r["violations"]) for r in failed]


def raise_failed(failed: list[tuple[str, str, int]]) -> None:
    """Raise ``ValueError`` naming the failed checks, if there are any."""
    if failed:
        raise ValueError("; ".join(f"{table}.{check}: {n} violations" for table, check, n in sorted(failed)))


def assert_quality(checks: DataFrame) -> None:
    """Raise ``ValueError`` naming every failed check of a quality DataFrame."""
    raise_failed(failed_checks(checks))
