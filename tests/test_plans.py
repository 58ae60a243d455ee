"""What the physical plans must and must not contain, over plain Parquet tables."""

import contextlib
import io
import re

import pytest
from tables import D, table

from subtide.operators.campaigns import campaign_audience, campaign_audience_capped, resolve_segment
from subtide.operators.churn import churn_by_plan, churn_monthly, churn_report
from subtide.operators.funnel import conversion_by_source, funnel_report, time_to_convert
from subtide.operators.mrr import mrr_monthly
from subtide.operators.profile import decay_phases, events_by_plan
from subtide.operators.quality import quality_campaigns, quality_leads, quality_subscriptions
from subtide.operators.wau import weekly_active_users
from subtide.plans.registry import QUERIES
from subtide.sources.schemas import SCHEMAS
from subtide.sources.tables import load_tables, write_table

AS_OF = D("2024-07-15")


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.fixture(scope="module")
def t(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("plain"))
    first = {
        "email_campaigns": [
            {"campaign_id": "c1", "segment": "low_activity", "send_date": "2024-03-01"},
            {"campaign_id": "c2", "segment": "churned", "send_date": "2024-06-01"},
        ]
    }
    for name in SCHEMAS:
        write_table(table(spark, name, first.get(name, [])), base, name)
    return load_tables(spark, base)


def test_days_that_no_campaign_reaches_are_not_opened(spark, t, tmp_path):
    """The calendar's dates, found as the query runs, choose the folders of a table partitioned by day."""
    people = table(spark, "subscriptions", [{"user_id": f"u{k}", "signup_date": "2023-01-01"} for k in range(4)])
    log = [("u0", "2024-02-20"), ("u1", "2024-01-15"), ("u2", "2023-05-05"), ("u3", "2024-03-02")]
    events = table(spark, "product_events", [{"event_id": u, "user_id": u, "event_date": d} for u, d in log])
    write_table(events, str(tmp_path), "product_events", partition_by="event_date")
    # Folders outside the 30 days before 1 March hold what no reader can open.
    for day in ("2023-05-05", "2024-01-15", "2024-03-02"):
        for part in (tmp_path / "product_events.parquet" / f"event_date={day}").glob("part-*"):
            part.write_bytes(b"no parquet")
    by_day = load_tables(spark, str(tmp_path), ["product_events"])["product_events"]
    found = resolve_segment("low_activity", t["email_campaigns"].where("campaign_id = 'c1'"), people, by_day)
    assert sorted(r["user_id"] for r in found.collect()) == ["u1", "u2", "u3"]
    assert re.search(r"PartitionFilters: \[isnotnull\(event_date#\d+\), \(event_date#\d+ >= date_sub\(Subquery", plan(found))
    with pytest.raises(Exception, match="(?i)parquet"):
        by_day.where("event_date = '2024-01-15'").collect()


def scans(text: str, column: str) -> list[str]:
    """Column lists of the file scans that read ``column``."""
    return [m for m in re.findall(r"FileScan parquet \[([^\]]*)\]", text) if re.search(rf"\b{column}#", m)]


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_python_and_no_nested_loops(spark, name):
    text = plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
    for node in ("Python", "Pandas", "Arrow", "NestedLoop", "Cartesian"):
        assert node not in text, node


def test_revenue_and_churn_scan_once(t):
    for df in (
        mrr_monthly(t["subscriptions"], AS_OF),
        churn_monthly(t["subscriptions"], AS_OF),
        churn_by_plan(t["subscriptions"], AS_OF),
        churn_report(t["subscriptions"], AS_OF),
        quality_subscriptions(t["subscriptions"], AS_OF),
    ):
        text = plan(df)
        assert text.count("FileScan") == 1 and "Join" not in text
    assert "PushedFilters: [IsNotNull(signup_date)]" in plan(churn_report(t["subscriptions"], AS_OF))


def test_reports_read_only_their_columns(t):
    [columns] = scans(plan(mrr_monthly(t["subscriptions"], AS_OF)), "signup_date")
    assert re.findall(r"(\w+)#", columns) == ["mrr", "status", "signup_date", "churn_date"]
    found = scans(plan(weekly_active_users(t["product_events"])), "event_date")
    assert sorted(re.findall(r"(\w+)#", c) for c in found) == [["event_date", "session_id"], ["user_id", "event_date"]]


def test_funnel_aggregates_before_the_join(t):
    text = plan(funnel_report(t["leads"], t["subscriptions"]))
    assert len(scans(text, "stage")) == 2 and len(scans(text, "plan")) == 1
    assert text.count("Join") == 1
    below = text[text.index("Join") :]
    assert "HashAggregate(keys=[user_id" in below
    assert "HashAggregate(keys=[user_id" in plan(conversion_by_source(t["leads"], t["subscriptions"]))
    assert "EqualTo(stage,converted)" in plan(time_to_convert(t["leads"], t["subscriptions"]))


def test_events_are_counted_per_user_before_the_join(t):
    text = plan(events_by_plan(t["product_events"], t["subscriptions"]))
    below = text[text.index("Join") :]
    assert "HashAggregate(keys=[user_id" in below and "partial_count" in below


def test_distinct_counts_expand_no_rows(t):
    text = plan(weekly_active_users(t["product_events"]))
    assert "Expand" not in text and text.count("FileScan") == 2


def test_audience_pushes_the_calendars_dates_into_the_scans(t):
    text = plan(campaign_audience(t["email_campaigns"], t["subscriptions"], t["product_events"]))
    [events] = [m for m in re.findall(r"FileScan parquet .*", text) if "event_date" in m]
    assert re.search(r"event_date#\d+ >= date_sub\(Subquery", events)
    people = [m for m in re.findall(r"FileScan parquet .*", text) if "signup_date" in m]
    assert people and all("ubquery" in m for m in people)
    # Users' quarters, not audience rows, meet the recent activity.
    assert re.search(r"Join \[user_id#\d+, quarter#\d+\], \[user_id#\d+, quarter#\d+\], LeftOuter", text) and "LeftAnti" not in text


@pytest.mark.parametrize("campaigns", [25, 25_000])
def test_audience_plans_alike_for_any_calendar(spark, t, campaigns, request):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    request.addfinalizer(lambda: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    calendar = spark.range(campaigns).selectExpr(
        "concat('c', id) AS campaign_id", "element_at(array('churned', 'low_activity', 'x'), cast(id % 3 + 1 AS int)) AS segment", "date_add(date'2024-01-01', cast(id % 300 AS int)) AS send_date"
    )
    text = plan(campaign_audience(calendar, t["subscriptions"], t["product_events"]))
    assert len(re.findall(r"SortMergeJoin \[kind#\d+, quarter#\d+, _slice", text)) == 2
    assert "NestedLoop" not in text and "BroadcastHashJoin" not in text


@pytest.mark.parametrize("name", list(QUERIES))
def test_building_a_query_runs_no_job(spark, name):
    context = spark.sparkContext
    context.setJobGroup(f"build-{name}", name)
    QUERIES[name](spark, "/root/testdata/sf0.001")
    assert list(context.statusTracker().getJobIdsForGroup(f"build-{name}")) == []
    context.setLocalProperty("spark.jobGroup.id", None)


def test_cap_limits_each_task_before_its_shuffle(t):
    text = plan(campaign_audience_capped(t["email_campaigns"], t["subscriptions"], t["product_events"]))
    assert len(re.findall(r"WindowGroupLimit.*Partial", text)) == 2
    assert re.search(r"hashpartitioning\(campaign_id#\d+, _slice", text)


def test_send_records_make_their_audience_once(spark):
    """The totals and the records read one capped audience, which is shuffled once as the query runs."""
    records = QUERIES["send_records"](spark, "/root/testdata/sf0.001")
    records.collect()
    [final, _] = re.split(r"(?m)^\+- == Initial Plan", plan(records))
    assert len(re.findall(r"Exchange hashpartitioning\(campaign_id#\d+, _slice", final)) == 1


def test_foreign_keys_need_no_join(t):
    leads = plan(quality_leads(t["leads"], t["subscriptions"]))
    sends = plan(quality_campaigns(t["email_campaigns"], t["email_sends"], t["subscriptions"], AS_OF))
    assert "Join" not in leads + sends
    assert len(scans(leads, "lead_id")) == 1 and len(scans(sends, "send_id")) == 1


def test_sends_are_scanned_twice_for_their_checks(t):
    text = plan(quality_campaigns(t["email_campaigns"], t["email_sends"], t["subscriptions"], AS_OF))
    assert len([m for m in re.findall(r"FileScan parquet \[([^\]]*)\]", text) if "send_id#" in m or "opened#" in m]) == 2


def test_only_churned_users_events_are_shuffled_for_the_phases(t):
    text = plan(decay_phases(t["product_events"], t["subscriptions"]))
    exchange = text.index("hashpartitioning(user_id")
    assert "LeftSemi" in text[exchange:]
    assert text.index("partial_count", exchange) > exchange
