import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F
from tables import D, rows, table

from subtide.operators import campaigns
from subtide.operators.campaigns import (
    campaign_audience,
    campaign_audience_capped,
    campaign_labels,
    campaign_performance,
    campaign_segments,
    cap_audience,
    resolve_segment,
    send_overview,
    send_records,
)

SEND = "2024-06-30"
SUBS = [
    {"user_id": "on_the_day", "signup_date": SEND},
    {"user_id": "too_late", "signup_date": "2024-07-01"},
    {"user_id": "gone_on_day", "signup_date": "2024-01-01", "churn_date": SEND, "status": "churned"},
    {"user_id": "gone_next_day", "signup_date": "2024-01-01", "churn_date": "2024-07-01", "status": "churned"},
    {"user_id": "pro", "signup_date": "2023-01-01", "plan": "pro"},
    {"user_id": "growth", "signup_date": "2023-01-01", "plan": "growth"},
    {"user_id": "no_plan", "signup_date": "2023-01-01", "plan": None},
    {"user_id": "no_signup", "signup_date": None},
    {"user_id": "backwards", "signup_date": "2024-05-01", "churn_date": "2024-04-01", "status": "churned"},
    {"user_id": "dated_not_churned", "signup_date": "2023-01-01", "churn_date": "2024-02-01"},
]
EVENTS = [
    {"event_id": "1", "user_id": "pro", "event_date": "2024-05-31"},  # 30 days before: outside
    {"event_id": "2", "user_id": "growth", "event_date": "2024-06-01"},  # 29 days before: inside
    {"event_id": "3", "user_id": "on_the_day", "event_date": SEND},
    {"event_id": "4", "user_id": "no_plan", "event_date": "2024-07-01"},
    {"event_id": "5", "user_id": None, "event_date": SEND},
]


def calendar(spark, *campaigns):
    return table(
        spark,
        "email_campaigns",
        [{"campaign_id": i, "segment": s, "send_date": d, **more} for i, s, d, more in [(*c, {})[:4] for c in campaigns]],
    )


def joined_by(spark, broadcast, request):
    """Let Spark broadcast small sides, or not, until the test ends."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, before if broadcast else "-1")
    request.addfinalizer(lambda: spark.conf.set(key, before))


def members(df):
    return sorted(r["user_id"] for r in df.collect())


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize(
    "segment, expected",
    [
        ("all_active", ["gone_next_day", "growth", "no_plan", "on_the_day", "pro"]),
        ("no_such_segment", ["gone_next_day", "growth", "no_plan", "on_the_day", "pro"]),
        ("starter_growth", ["gone_next_day", "growth", "on_the_day"]),
        ("low_activity", ["gone_next_day", "no_plan", "pro"]),
        ("churned", ["backwards", "gone_on_day"]),
    ],
)
def test_segment_members(spark, segment, expected, broadcast, request):
    joined_by(spark, broadcast, request)
    campaigns = calendar(spark, ("c1", "ignored", SEND))
    result = resolve_segment(
        segment, campaigns, table(spark, "subscriptions", SUBS), table(spark, "product_events", EVENTS)
    )
    assert members(result) == expected


def test_audience_follows_each_campaigns_segment_and_drops_empty_ones(spark):
    campaigns = calendar(
        spark,
        ("c1", "churned", SEND),
        ("c2", None, SEND),
        ("c3", "churned", "2020-01-01"),
        ("c4", "all_active", "2020-01-01"),
        ("c5", "all_active", None),
        ("c6", "low_activity", SEND),
    )
    result = campaign_audience(campaigns, table(spark, "subscriptions", SUBS), table(spark, "product_events", EVENTS))
    sizes = {}
    for row in result.collect():
        sizes[row["campaign_id"]] = sizes.get(row["campaign_id"], 0) + 1
    assert sizes == {"c1": 2, "c2": 5, "c6": 3}


def test_audience_of_an_empty_calendar(spark):
    result = campaign_audience(
        calendar(spark), table(spark, "subscriptions", SUBS), table(spark, "product_events", EVENTS)
    )
    assert result.columns == ["campaign_id", "send_date", "user_id"] and rows(result) == []


def reference_segment(segment, day, subs, events):
    """One campaign at a time, straight from the definition."""
    active = [
        s for s in subs
        if D(s["signup_date"]) <= day and (s["churn_date"] is None or D(s["churn_date"]) > day)
    ]
    if segment == "starter_growth":
        active = [s for s in active if s["plan"] in ("starter", "growth")]
    elif segment == "low_activity":
        recent = {e["user_id"] for e in events if day - dt.timedelta(days=30) < D(e["event_date"]) <= day}
        active = [s for s in active if s["user_id"] not in recent]
    elif segment == "churned":
        active = [s for s in subs if s["status"] == "churned" and D(s["churn_date"]) <= day]
    return {s["user_id"] for s in active}


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("seed", [1, 2])
def test_random_audiences(spark, seed, broadcast, request):
    joined_by(spark, broadcast, request)
    rng = random.Random(seed)
    start = dt.date(2023, 1, 1)

    def day(low, high):
        return (start + dt.timedelta(days=rng.randrange(low, high))).isoformat()

    subs, events, campaigns = [], [], []
    for i in range(60):
        signup, gone = rng.randrange(500), rng.random() < 0.4
        churn = (start + dt.timedelta(days=signup + rng.randrange(300))).isoformat() if gone else None
        subs.append(
            {
                "user_id": f"u{i}",
                "plan": rng.choice(["starter", "growth", "pro"]),
                "signup_date": (start + dt.timedelta(days=signup)).isoformat(),
                "churn_date": churn,
                "status": "churned" if gone else "active",
            }
        )
    # One user has a third of all events.
    for i in range(300):
        user = "u0" if i % 3 == 0 else f"u{rng.randrange(60)}"
        events.append({"event_id": str(i), "user_id": user, "event_date": day(0, 700)})
    for i in range(25):
        segment = rng.choice(["all_active", "starter_growth", "low_activity", "churned", "other"])
        campaigns.append((f"c{i:02d}", segment, day(-50, 800)))
    result = campaign_audience(
        calendar(spark, *campaigns),
        table(spark, "subscriptions", subs),
        table(spark, "product_events", events),
    )
    expected = sorted(
        (cid, D(sent), user) for cid, segment, sent in campaigns for user in reference_segment(segment, D(sent), subs, events)
    )
    assert sorted(rows(result)) == expected


def test_segments_nest(spark):
    campaigns, subs = calendar(spark, ("c1", "x", SEND)), table(spark, "subscriptions", SUBS)
    events = table(spark, "product_events", EVENTS)
    found = {
        s: set(members(resolve_segment(s, campaigns, subs, events)))
        for s in ("all_active", "starter_growth", "low_activity", "churned")
    }
    assert found["starter_growth"] <= found["all_active"] and found["low_activity"] <= found["all_active"]
    assert not found["churned"] & found["all_active"]


def audience(spark, sizes):
    pairs = [(c, D(SEND), f"usr_{i:04d}") for c, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(pairs, "campaign_id string, send_date date, user_id string")


def test_cap_keeps_the_smallest_digests_of_every_campaign(spark):
    everyone = audience(spark, {"big": 500, "fits": 20, "one": 1})
    kept = {}
    for row in cap_audience(everyone, 20).collect():
        kept.setdefault(row["campaign_id"], set()).add(row["user_id"])
    assert {c: len(users) for c, users in kept.items()} == {"big": 20, "fits": 20, "one": 1}
    by_digest = sorted((hashlib.md5(f"big:usr_{i:04d}".encode()).hexdigest(), f"usr_{i:04d}") for i in range(500))
    assert kept["big"] == {user for _, user in by_digest[:20]}


def test_cap_does_not_depend_on_the_partitioning(spark):
    everyone = audience(spark, {"big": 400, "small": 30})
    assert sorted(rows(cap_audience(everyone.repartition(7), 25))) == sorted(rows(cap_audience(everyone.coalesce(1), 25)))


@pytest.mark.parametrize("broadcast", [True, False])
def test_send_records(spark, broadcast, request):
    joined_by(spark, broadcast, request)
    campaigns = calendar(
        spark, ("cmp_1", "all_active", "2024-07-05"), ("cmp_2", "churned", SEND), ("cmp_3", "churned", "2020-01-01")
    )
    sends = table(
        spark,
        "email_sends",
        [
            {"send_id": "1", "campaign_id": "cmp_2", "user_id": "backwards", "opened": True},
            {"send_id": "2", "campaign_id": "cmp_2", "user_id": "backwards", "clicked": True},
            {"send_id": "3", "campaign_id": "cmp_1", "user_id": "stranger", "opened": True},
        ],
    )
    result = send_records(
        campaigns,
        table(spark, "subscriptions", SUBS),
        table(spark, "product_events", EVENTS),
        sends,
    )
    found = sorted(rows(result))
    assert found[:2] == [
        ("snd_000001", "cmp_2", "backwards", D(SEND), True, True, False, False),
        ("snd_000002", "cmp_2", "gone_on_day", D(SEND), False, False, False, False),
    ]
    users = ["growth", "no_plan", "on_the_day", "pro", "too_late"]
    assert [r[:3] for r in found[2:]] == [(f"snd_{n:06d}", "cmp_1", u) for n, u in enumerate(users, start=3)]


def test_capped_audience_is_a_subset(spark):
    campaigns, subs = calendar(spark, ("c1", "all_active", SEND)), table(spark, "subscriptions", SUBS)
    events = table(spark, "product_events", EVENTS)
    capped = rows(campaign_audience_capped(campaigns, subs, events, cap=2))
    assert len(capped) == 2 and set(capped) < set(rows(campaign_audience(campaigns, subs, events)))


def test_labels_number_campaigns_within_their_type(spark):
    campaigns = table(
        spark,
        "email_campaigns",
        [
            {"campaign_id": "5", "campaign_type": "upsell", "send_date": "2024-03-09"},
            {"campaign_id": "4", "campaign_type": "upsell", "send_date": "2024-03-01"},
            {"campaign_id": "3", "campaign_type": "upsell", "send_date": "2024-03-09"},
            {"campaign_id": "2", "campaign_type": "upsell", "send_date": "2025-01-01"},
            {"campaign_id": "1", "campaign_type": "promo", "send_date": "2024-12-31"},
            {"campaign_id": "6", "campaign_type": "newsletter", "send_date": "2024-02-29"},
            {"campaign_id": "7", "campaign_type": "trial_end", "send_date": "2024-02-29"},
        ],
    )
    labels = {r["campaign_id"]: r["campaign_name"] for r in campaign_labels(campaigns).collect()}
    assert labels == {
        "4": "Upgrade Offer #1 — Mar 2024",
        "3": "Upgrade Offer #2 — Mar 2024",
        "5": "Upgrade Offer #3 — Mar 2024",
        "2": "Upgrade Offer #4 — Jan 2025",
        "1": "Q4 Promotion — 2024",
        "6": "Monthly Newsletter — Feb 2024",
        "7": "Trial_End #1 — Feb 2024",
    }
    segments = {r["campaign_type"]: r["segment"] for r in campaign_segments(campaigns).collect()}
    assert segments == {
        "upsell": "starter_growth",
        "promo": "all_active",
        "newsletter": "all_active",
        "trial_end": "all_active",
    }


def test_performance_rounds_half_to_even(spark):
    campaigns = table(spark, "email_campaigns", [{"campaign_id": "c", "campaign_type": "promo", "send_date": SEND}])
    # 201 of 400 opened is exactly halfway between 0.502 and 0.503.
    sends = [
        {"send_id": str(i), "campaign_id": "c", "opened": i < 201, "replied": i < 1} for i in range(400)
    ] + [{"send_id": "x", "campaign_id": "unknown"}]
    sends = table(spark, "email_sends", sends)
    assert rows(campaign_performance(sends, campaigns)) == [("promo", 400, 0.502, 0.0, 0.002, 0.0)]
    assert rows(send_overview(sends)) == [(401, 50.1, 0.2)]


def test_unknown_types_are_titled_like_words(spark):
    campaigns = calendar(spark, *[(f"c{k}", "all_active", SEND) for k in range(4)])
    kinds = ["flash-sale", "q4promo", "BLACK_friday", "été!now"]
    rows_ = [(r["campaign_id"], kinds[k], r["send_date"]) for k, r in enumerate(sorted(campaigns.collect()))]
    labels = campaign_labels(spark.createDataFrame(rows_, "campaign_id string, campaign_type string, send_date date"))
    titles = {r["campaign_type"]: r["campaign_name"].split(" #")[0] for r in labels.collect()}
    assert titles == {kind: kind.title() for kind in kinds}


def test_daily_sends_do_not_multiply_activity(spark):
    """A year of daily low_activity sends: what meets the memberships is at most two rows per user and day."""
    from subtide.operators.campaigns import _reach, _recent_days

    days = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(366)]
    campaigns = calendar(spark, *[(f"c{k:03d}", "low_activity", d.isoformat()) for k, d in enumerate(days)])
    events = [{"event_id": str(k), "user_id": f"u{k % 5}", "event_date": days[(k * 7) % 366].isoformat()} for k in range(4000)]
    table_ = table(spark, "product_events", events)
    user_days = len({(e["user_id"], e["event_date"]) for e in events})
    found = _recent_days(table_, _reach(campaigns)).collect()
    assert sum((r["early"] | r["late"]).bit_count() for r in found) <= 2 * user_days
    quarters = {(r["user_id"], r["quarter"]) for r in found}
    assert len(quarters) == len(found) <= user_days


def test_recent_days_of_every_distance(spark):
    start = dt.date(2023, 12, 1)
    days = [start + dt.timedelta(days=k) for k in range(0, 500)]
    subs = [{"user_id": f"u{k:03d}", "signup_date": "2020-01-01", "status": "active", "plan": "pro"} for k in range(0, 500, 7)]
    events = [{"event_id": s["user_id"], "user_id": s["user_id"], "event_date": days[int(s["user_id"][1:])].isoformat()} for s in subs]
    sends = days[::3]
    campaigns = calendar(spark, *[(f"c{k:03d}", "low_activity", d.isoformat()) for k, d in enumerate(sends)])
    result = campaign_audience(campaigns, table(spark, "subscriptions", subs), table(spark, "product_events", events))
    expected = sorted(
        (f"c{k:03d}", sent, e["user_id"]) for k, sent in enumerate(sends) for e in events if not 0 <= (sent - D(e["event_date"])).days < 30
    )
    assert sorted(rows(result)) == expected


@pytest.mark.parametrize("users", [1, 2, 7])
def test_slices_of_any_size_give_the_same_audience(spark, monkeypatch, users):
    people = [{"user_id": f"u{k}", "signup_date": f"2023-{1 + k % 12:02d}-05", **({"status": "churned", "churn_date": "2024-02-10"} if k % 4 == 0 else {})} for k in range(40)]
    calendar = [{"campaign_id": f"c{k}", "send_date": f"2024-{1 + k % 6:02d}-01", "segment": s} for k, s in enumerate(["all_active", "churned", "low_activity", "starter_growth", "other"] * 2)]
    log = [{"event_id": str(k), "user_id": f"u{k % 40}", "event_date": f"2024-{1 + k % 5:02d}-20"} for k in range(0, 120, 7)]
    tables = [table(spark, n, c) for n, c in (("email_campaigns", calendar), ("subscriptions", people), ("product_events", log))]
    plain = sorted(rows(campaigns.campaign_audience(*tables)))
    monkeypatch.setattr(campaigns, "_SLICE_USERS", users)
    assert sorted(rows(campaigns.campaign_audience(*tables))) == plain and len(plain) > 100


def test_campaigns_are_copied_as_their_quarter_asks(spark, monkeypatch):
    """A quarter with many users has many slices, others one, whatever the number of shuffle partitions."""
    members = spark.range(1_000).selectExpr("concat('u', id) AS user_id", "'active' AS kind", "CASE WHEN id < 900 THEN date'2024-01-01' ELSE date'2024-07-01' END AS quarter")
    monkeypatch.setattr(campaigns, "_SLICE_USERS", 100)
    quarters = spark.createDataFrame([(D(q), k) for q in ("2023-10-01", "2024-01-01", "2024-04-01", "2024-07-01", "2025-01-01") for k in ("active", "churned")], "quarter date, kind string")
    found = {(str(r["quarter"]), r["kind"]): r["n"] for r in quarters.withColumn("n", campaigns._slices_of_quarters(members)).collect()}
    assert found[("2024-01-01", "active")] == 9
    assert all(n == 1 for key, n in found.items() if key != ("2024-01-01", "active"))
    assert [r["n"] for r in quarters.withColumn("n", campaigns._slices_of_quarters(members.limit(0))).collect()] == [1] * 10


def test_an_audience_grows_in_many_tasks(spark):
    """Users that come in one partition are dealt out before each becomes a row per campaign."""
    people = table(spark, "subscriptions", [{"user_id": f"u{k:03d}", "signup_date": "2023-01-05", "status": "active"} for k in range(400)]).coalesce(1)
    sent = spark.range(12).selectExpr("concat('c', id) AS campaign_id", "'all_active' AS segment", "add_months(date'2024-01-01', cast(id AS int)) AS send_date")
    tasks = [r["n"] for r in campaign_audience(sent, people, table(spark, "product_events", EVENTS)).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(tasks) == 4_800 and max(tasks) < 2_400


def test_users_have_rows_for_quarters_with_campaigns_only(spark):
    sent = calendar(spark, ("c1", "all_active", "2010-02-01"), ("c2", "all_active", "2024-11-30"), ("c3", "all_active", "2024-10-01"))
    people = table(spark, "subscriptions", [{"user_id": "always", "signup_date": "2001-01-01", "status": "active"}, {"user_id": "late", "signup_date": "2020-01-01", "status": "active"}])
    users = campaigns._users_in_reach(people, campaigns._reach(sent), active=True, churned=False)
    found = campaigns._memberships(users, campaigns._quarters(sent)).select("user_id", "quarter")
    assert sorted(rows(found)) == [("always", D("2010-01-01")), ("always", D("2024-10-01")), ("late", D("2024-10-01"))]
