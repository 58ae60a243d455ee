import pytest
from tables import rows, table

from subtide.operators.funnel import (
    conversion_by_source,
    funnel_overview,
    funnel_report,
    loss_reasons,
    time_to_convert,
)

LEADS = [
    {"lead_id": "1", "source": "inbound", "stage": "converted", "user_id": "a", "created_date": "2024-01-01", "converted_date": "2024-01-11"},
    {"lead_id": "2", "source": "inbound", "stage": "converted", "user_id": "b", "created_date": "2024-01-01", "converted_date": "2024-01-14"},
    {"lead_id": "3", "source": "inbound", "stage": "converted", "user_id": "unknown", "created_date": "2024-01-01", "converted_date": "2024-01-03"},
    {"lead_id": "4", "source": "inbound", "stage": "new", "loss_reason": "duplicate"},
    {"lead_id": "5", "source": "referral", "stage": "converted", "user_id": "nofee", "created_date": "2024-01-01", "converted_date": None},
    {"lead_id": "6", "source": "cold_call", "stage": "lost", "loss_reason": "no_show"},
    {"lead_id": "7", "source": "cold_call", "stage": "qualified", "loss_reason": None},
    {"lead_id": "8", "source": "cold_call", "stage": "qualified", "loss_reason": "wrong_icp"},
    {"lead_id": "9", "source": None, "stage": None, "loss_reason": "wrong_icp"},
    {"lead_id": "10", "source": "cold_call", "stage": "qualified", "user_id": "a", "loss_reason": "wrong_icp"},
]
SUBS = [
    {"user_id": "a", "plan": "pro", "mrr": 399},
    {"user_id": "b", "plan": "pro", "mrr": 399},
    {"user_id": "nofee", "plan": "growth", "mrr": None},
    {"user_id": None, "plan": "starter", "mrr": 49},
]


@pytest.fixture
def leads(spark):
    return table(spark, "leads", LEADS)


@pytest.fixture
def subs(spark):
    return table(spark, "subscriptions", SUBS)


def test_overview_reports_every_stage_by_current_stage(leads):
    assert rows(funnel_overview(leads)) == [
        (1, "new", 1, -2, 100.0),
        (2, "qualified", 3, 3, 300.0),
        (3, "demo_booked", 0, -4, 0.0),
        (4, "converted", 4, None, 400.0),
    ]


def test_overview_without_top_of_funnel(spark):
    result = rows(funnel_overview(table(spark, "leads", [{"lead_id": "1", "stage": "converted"}])))
    assert [r[2:] for r in result] == [(0, 0, None), (0, 0, None), (0, -1, None), (1, None, None)]


def test_conversion_by_source(leads, subs):
    assert rows(conversion_by_source(leads, subs)) == [
        ("referral", 1, 1, 100.0, None, None),
        ("inbound", 4, 3, 75.0, 798, 8.0),
        ("cold_call", 4, 0, 0.0, 0, None),
        (None, 1, 0, 0.0, 0, None),
    ]


def test_unmatched_and_missing_users_have_no_plan(leads, subs):
    assert rows(time_to_convert(leads, subs)) == [
        ("inbound", None, 1, 2.0, 2, 2, None),
        ("inbound", "pro", 2, 12.0, 10, 13, 798),
    ]


def test_repeated_subscriptions_repeat_their_leads(spark, leads):
    twice = table(spark, "subscriptions", SUBS + [{"user_id": "a", "plan": "pro", "mrr": 1}])
    by_source = {r[0]: r[1:] for r in rows(conversion_by_source(leads, twice))}
    assert by_source["inbound"] == (5, 4, 80.0, 799, 9.0)


def test_loss_reasons_share_within_stage(leads):
    assert rows(loss_reasons(leads)) == [
        ("lost", "no_show", 1, 100.0),
        ("new", "duplicate", 1, 100.0),
        ("qualified", "wrong_icp", 2, 100.0),
    ]


def text(value):
    return None if value is None else str(value)


def test_report_stacks_the_four_sections(leads, subs):
    expected = [("1_funnel", r[1], text(r[2]), text(r[3]), text(r[4]), None) for r in rows(funnel_overview(leads))]
    by_source = sorted(rows(conversion_by_source(leads, subs)), key=lambda r: (r[0] is None, r[0]))
    expected += [("2_by_source", *map(text, r[:5])) for r in by_source]
    losses = sorted(rows(loss_reasons(leads)))
    expected += [("3_loss_reasons", f"{r[0]} → {r[1]}", text(r[2]), text(r[3]), None, None) for r in losses]
    timing = [(f"{r[0]} / {r[1] or ''}", *map(text, r[2:6])) for r in rows(time_to_convert(leads, subs))]
    expected += [("4_time_to_convert", *r) for r in sorted(timing)]
    assert rows(funnel_report(leads, subs)) == expected
