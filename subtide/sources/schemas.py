"""The five tables' schemas. Declared, never inferred: no extra pass over the data,
and an all-empty date column stays a date."""

from __future__ import annotations

from pyspark.sql.types import BooleanType, DataType, DateType, LongType, StringType, StructType

_TYPES: dict[str, DataType] = {
    "string": StringType(),
    "bigint": LongType(),
    "date": DateType(),
    "boolean": BooleanType(),
}


def _schema(columns: str) -> StructType:
    schema = StructType()
    for column in columns.split(", "):
        name, kind = column.split(" ")
        schema.add(name, _TYPES[kind])
    return schema


SCHEMAS: dict[str, StructType] = {
    "subscriptions": _schema(
        "user_id string, company_name string, email string, plan string, mrr bigint, status string, "
        "signup_date date, churn_date date, churn_reason string, payment_failures bigint, country string, "
        "industry string, created_at date, account_age_days bigint, acquisition_channel string"
    ),
    "product_events": _schema(
        "event_id string, user_id string, event_name string, event_date date, platform string, session_id string"
    ),
    "leads": _schema(
        "lead_id string, user_id string, first_name string, last_name string, company string, email string, "
        "industry string, company_size string, source string, stage string, created_date date, "
        "converted_date date, loss_reason string"
    ),
    "email_campaigns": _schema(
        "campaign_id string, campaign_name string, campaign_type string, segment string, send_date date, "
        "subject_line string"
    ),
    "email_sends": _schema(
        "send_id string, campaign_id string, user_id string, send_date date, opened boolean, clicked boolean, "
        "replied boolean, unsubscribed boolean"
    ),
}
