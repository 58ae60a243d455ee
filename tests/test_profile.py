from tables import D, rows, table

from subtide.operators import profile

SUBS = [
    {"user_id": "a", "signup_date": "2024-01-01", "plan": "starter"},
    {"user_id": "b", "signup_date": "2024-01-31", "plan": "starter", "status": "churned", "churn_date": "2024-02-20", "churn_reason": "x"},
    {"user_id": "c", "signup_date": "2024-03-01", "plan": "pro", "mrr": 399},
    {"user_id": "d", "signup_date": None, "plan": None},
]


def events(spark, counts):
    return table(
        spark,
        "product_events",
        [
            {"event_id": f"{u}{d}{i}", "user_id": u, "event_date": d}
            for (u, d), n in counts.items()
            for i in range(n)
        ],
    )


def test_plan_summary_and_overview(spark):
    subs = table(spark, "subscriptions", SUBS)
    assert rows(profile.plan_summary(subs)) == [("pro", 1, 0, 0.0, 399), ("starter", 2, 1, 50.0, 98)]
    assert rows(profile.subscription_overview(subs)) == [(4, 3, 1, 497)]
    assert rows(profile.churn_label_profile(subs)) == [(3, 1, 25.0)]
    assert rows(profile.plan_mix(subs)) == [("starter", 2), ("pro", 1)]


def test_plan_summary_rounds_half_to_even(spark):
    # 1 of 16 is 6.25 %: half to even gives 6.2.
    people = [{"user_id": str(i), "status": "churned" if i == 0 else "active"} for i in range(16)]
    subs = table(spark, "subscriptions", people)
    assert rows(profile.plan_summary(subs))[0][3] == 6.2
    assert rows(profile.churn_label_profile(subs))[0][2] == 6.2


def test_signup_month_spread(spark):
    subs = table(spark, "subscriptions", SUBS)
    assert rows(profile.signup_month_spread(subs)) == [(D("2024-01-01"), D("2024-03-01"), 1, 2)]


def test_frequency_orders_ties_by_value_and_skips_missing(spark):
    reasons = ["b", "a", None, "c", "c", None, None]
    subs = table(spark, "subscriptions", [{"user_id": str(i), "churn_reason": r} for i, r in enumerate(reasons)])
    assert rows(profile.top_churn_reasons(subs, 2)) == [("c", 2), ("a", 1)]
    assert rows(profile.top_churn_reasons(subs)) == [("c", 2), ("a", 1), ("b", 1)]


def test_events_by_plan_and_status(spark):
    subs = table(spark, "subscriptions", SUBS)
    counts = {("a", "2024-01-02"): 5, ("b", "2024-02-01"): 2, ("c", "2024-03-02"): 1, ("stranger", "2024-03-02"): 9, ("d", "2024-01-02"): 1, (None, "2024-01-02"): 2}
    log = events(spark, counts)
    assert rows(profile.events_by_plan(log, subs)) == [("pro", 1, 1, 1.0), ("starter", 7, 2, 3.5)]
    assert rows(profile.avg_events_per_user_by_status(log, subs)) == [("active", 2.3), ("churned", 2.0)]
    assert rows(profile.event_total(log)) == [(20,)]
    assert rows(profile.top_events(log)) == [("login", 20)]


def test_decay_phases_split_at_60_and_85_percent(spark):
    # b: 20 days of tenure from 31 January; phases end on 12 and 17 February.
    counts = {("b", "2024-01-31"): 1, ("b", "2024-02-12"): 2, ("b", "2024-02-13"): 3, ("b", "2024-02-17"): 4, ("b", "2024-02-18"): 5, ("a", "2024-02-18"): 9}
    result = rows(profile.decay_phases(events(spark, counts), table(spark, "subscriptions", SUBS)))
    assert result == [(3, 7, 5, 20.0, 47.0, 33.0)]


def test_decay_phases_without_churned_events(spark):
    result = rows(profile.decay_phases(events(spark, {("a", "2024-02-18"): 1}), table(spark, "subscriptions", SUBS)))
    assert result == [(0, 0, 0, None, None, None)]


def test_lead_summaries(spark):
    leads = [{"lead_id": str(i), "source": s, "stage": g, "loss_reason": r, "company_size": c} for i, (s, g, r, c) in enumerate(
        [("inbound", "converted", None, "1-10"), ("inbound", "new", "x", "1-10"), ("referral", "new", "x", "500+")]
    )]
    leads = table(spark, "leads", leads)
    assert rows(profile.lead_overview(leads)) == [(3, 1, 33.3, 2)]
    assert rows(profile.lead_stage_breakdown(leads)) == [("new", 2), ("converted", 1)]
    assert rows(profile.lead_conversion_by_source(leads)) == [("inbound", 2, 1, 50.0), ("referral", 1, 0, 0.0)]
    assert rows(profile.lead_loss_breakdown(leads)) == [("x", 2)]
    assert rows(profile.company_size_mix(leads)) == [("1-10", 2), ("500+", 1)]


def test_lead_overview_of_no_leads(spark):
    assert rows(profile.lead_overview(table(spark, "leads", []))) == [(0, 0, None, 0)]


def test_table_profile_and_account_age(spark):
    log = events(spark, {("a", "2024-01-02"): 1, ("a", "2024-03-04"): 1})
    assert rows(profile.table_profile("log", log, "event_date")) == [
        ("log", 2, "event_id, user_id, event_name, event_date, platform, session_id", D("2024-01-02"), D("2024-03-04"))
    ]
    subs = table(spark, "subscriptions", SUBS)
    assert rows(profile.table_profile("subs", subs.select("user_id"))) == [("subs", 4, "user_id", None, None)]
    ages = rows(profile.account_age_days(subs, D("2024-03-02")))
    assert [r[2] for r in ages] == [61, 31, 1, None]


def test_a_doubled_subscription_counts_events_once(spark):
    from subtide.operators.profile import avg_events_per_user_by_status, events_by_plan

    subs = table(spark, "subscriptions", [{"user_id": "u1", "plan": "pro", "status": "active"}] * 2)
    events = table(spark, "product_events", [{"event_id": str(k), "user_id": "u1"} for k in range(2)])
    assert rows(events_by_plan(events, subs)) == [("pro", 2, 1, 2.0)]
    assert rows(avg_events_per_user_by_status(events, subs)) == [("active", 2.0)]
