"""One key with a third of the rows, many missing keys: results stay whole and exact."""

import random
from collections import Counter, defaultdict

import pytest
from tables import D, rows, table

from subtide.operators.funnel import conversion_by_source
from subtide.operators.profile import avg_events_per_user_by_status, events_by_plan
from subtide.operators.quality import quality_events, quality_leads
from subtide.operators.wau import weekly_active_users


@pytest.fixture(scope="module")
def data():
    rng = random.Random(11)
    subs = [
        {
            "user_id": f"u{i}",
            "plan": rng.choice(["starter", "pro"]),
            "mrr": rng.choice([49, 399]),
            "status": rng.choice(["active", "churned"]),
            "signup_date": "2024-01-01",
            "churn_date": "2024-02-15",
        }
        for i in range(40)
    ]

    def user():
        return rng.choice(["u0", None, f"u{rng.randrange(45)}"])

    events = [
        {
            "event_id": str(i if i % 50 else 0),
            "user_id": user(),
            "event_date": f"2024-0{rng.randrange(1, 4)}-{rng.randrange(1, 29):02d}",
            "session_id": f"s{rng.randrange(200)}",
        }
        for i in range(3000)
    ]
    leads = [
        {
            "lead_id": str(i if i % 50 else 0),
            "user_id": user(),
            "source": "inbound" if i % 3 else rng.choice(["referral", "cold_call", None]),
            "stage": rng.choice(["converted", "new"]),
            "created_date": "2024-01-01",
            "converted_date": f"2024-01-{rng.randrange(1, 29):02d}",
        }
        for i in range(3000)
    ]
    return {"subscriptions": subs, "product_events": events, "leads": leads}


@pytest.fixture(params=[1, 6])
def t(spark, data, request):
    return {name: table(spark, name, values).repartition(request.param) for name, values in data.items()}


def test_conversion_by_source(t, data):
    subs = {s["user_id"]: s for s in data["subscriptions"]}
    total, won, mrr, days = Counter(), Counter(), Counter(), defaultdict(list)
    for lead in data["leads"]:
        source = lead["source"]
        total[source] += 1
        if lead["stage"] == "converted":
            won[source] += 1
            mrr[source] += subs[lead["user_id"]]["mrr"] if lead["user_id"] in subs else 0
            days[source].append((D(lead["converted_date"]) - D("2024-01-01")).days)
    found = {r[0]: (r[1], r[2], r[4], r[5]) for r in rows(conversion_by_source(t["leads"], t["subscriptions"]))}
    assert found == {s: (total[s], won[s], mrr[s], float(int(sum(days[s]) / len(days[s]) + 0.5))) for s in total}


def test_events_by_plan_and_status(t, data):
    subs = {s["user_id"]: s for s in data["subscriptions"]}
    per_user = Counter(e["user_id"] for e in data["product_events"] if e["user_id"] in subs)
    totals, users = Counter(), Counter()
    for user, n in per_user.items():
        totals[subs[user]["plan"]] += n
        users[subs[user]["plan"]] += 1
    found = rows(events_by_plan(t["product_events"], t["subscriptions"]))
    assert {r[0]: (r[1], r[2]) for r in found} == {p: (totals[p], users[p]) for p in totals}
    by_status = defaultdict(list)
    for user, n in per_user.items():
        by_status[subs[user]["status"]].append(n)
    means = dict(rows(avg_events_per_user_by_status(t["product_events"], t["subscriptions"])))
    assert means == {s: pytest.approx(sum(v) / len(v), abs=0.051) for s, v in by_status.items()}


def test_weekly_distinct_counts(t, data):
    users, sessions, n = defaultdict(set), defaultdict(set), Counter()
    for e in data["product_events"]:
        week = D(e["event_date"]).isocalendar()[:2]
        n[week] += 1
        sessions[week].add(e["session_id"])
        if e["user_id"]:
            users[week].add(e["user_id"])
    found = rows(weekly_active_users(t["product_events"]))
    assert [(r[1], r[4]) for r in found] == [(len(users[w]), len(sessions[w])) for w in sorted(n)]


def test_quality_counts(t, data):
    known = {s["user_id"] for s in data["subscriptions"]}
    events, leads = data["product_events"], data["leads"]
    found = {r[1]: r[2] for r in rows(quality_events(t["product_events"], t["subscriptions"]))}
    assert found == {
        "duplicate_event_ids": len(events) - len({e["event_id"] for e in events}),
        "unknown_users": sum(e["user_id"] not in known for e in events),
        "events_after_churn": sum(e["user_id"] in known and e["event_date"] > "2024-02-15" for e in events),
        "events_before_signup": 0,
    }
    found = {r[1]: r[2] for r in rows(quality_leads(t["leads"], t["subscriptions"]))}
    users = {lead["user_id"] for lead in leads} - {None}
    assert found["unknown_users"] == len(users - known)
    assert found["subscribers_without_lead"] == len(known - users)
    assert found["duplicate_lead_ids"] == len(leads) - len({lead["lead_id"] for lead in leads})


def test_lines_of_a_hot_order_are_split(spark, tmp_path, request):
    """Adaptive execution splits the order that has a third of all lines, given partitions small enough to show it here."""
    import duckdb

    from subtide.sources.star_tables import email_sends

    con = duckdb.connect()
    source = "/root/testdata/sf0.01"
    con.execute(f"COPY (FROM '{source}/orders.parquet') TO '{tmp_path}/orders.parquet' (FORMAT parquet)")
    # Several files, so that a partition has blocks of several tasks to be split by.
    (tmp_path / "lineitem.parquet").mkdir()
    hot = "* REPLACE (CASE WHEN l_partkey % 3 = 0 THEN 5 ELSE l_orderkey END AS l_orderkey)"
    for k in range(8):
        lines = f"SELECT {hot} FROM '{source}/lineitem.parquet' WHERE l_suppkey % 8 = {k}"
        con.execute(f"COPY ({lines}) TO '{tmp_path}/lineitem.parquet/part-{k}.parquet' (FORMAT parquet)")
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.files.openCostInBytes": "128m",
    }
    for key, value in small.items():
        before = spark.conf.get(key, None)
        request.addfinalizer(lambda key=key, before=before: spark.conf.unset(key) if before is None else spark.conf.set(key, before))
        spark.conf.set(key, value)
    sends = email_sends(spark, str(tmp_path))
    sends.collect()
    assert "skew=true" in sends._jdf.queryExecution().executedPlan().toString()
