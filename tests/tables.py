"""Small hand-made tables: a row names the columns it cares about, the rest are plain."""

from __future__ import annotations

import datetime as dt

from subtide.sources.schemas import SCHEMAS

D = dt.date.fromisoformat

_DEFAULTS = {
    "subscriptions": {"plan": "starter", "mrr": 49, "status": "active"},
    "product_events": {"event_name": "login", "platform": "web"},
    "leads": {"source": "inbound", "stage": "new"},
    "email_campaigns": {"campaign_type": "newsletter", "segment": "all_active"},
    "email_sends": {"opened": False, "clicked": False, "replied": False, "unsubscribed": False},
}


def table(spark, name: str, rows: list[dict]):
    schema = SCHEMAS[name]
    values = []
    for row in rows:
        unknown = set(row) - set(schema.names)
        assert not unknown, unknown
        full = _DEFAULTS[name] | row
        values.append(
            tuple(
                D(full[f.name]) if f.dataType.typeName() == "date" and isinstance(full.get(f.name), str) else full.get(f.name)
                for f in schema
            )
        )
    return spark.createDataFrame(values, schema)


def rows(df) -> list[tuple]:
    return [tuple(row) for row in df.collect()]
