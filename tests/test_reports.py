import csv

import pytest
from tables import D, rows, table

from subtide.__main__ import main
from subtide.operators.quality import quality_subscriptions
from subtide.plans.reports import REPORTS, run_report, write_checked, write_checked_tables
from subtide.sources import star_tables
from subtide.sources.tables import read_table, write_table

STAR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """The five tables of the smallest test data, written as CSV and as Parquet."""
    base = tmp_path_factory.mktemp("tables")
    tables = {
        "subscriptions": star_tables.subscriptions,
        "product_events": star_tables.order_events,
        "leads": star_tables.leads,
        "email_campaigns": star_tables.email_campaigns,
        "email_sends": star_tables.email_sends,
    }
    for name, make in tables.items():
        for fmt in ("csv", "parquet"):
            write_table(make(spark, STAR), str(base / fmt), name, fmt)
    return base


@pytest.mark.parametrize("name", list(REPORTS))
def test_csv_and_parquet_give_the_same_report(spark, folders, name):
    results = [
        sorted(map(repr, rows(run_report(name, spark, str(folders / fmt), fmt, star_tables.AS_OF))))
        for fmt in ("csv", "parquet")
    ]
    assert results[0] == results[1] and results[0]


def test_unknown_report(spark):
    with pytest.raises(KeyError, match="no report named"):
        run_report("no_such_report", spark, "/nowhere")


def test_command_line(spark, folders, tmp_path, capfd):
    main(["churn_by_plan", str(folders / "csv"), "--format", "csv", "--as-of", "2001-08-02"])
    shown = capfd.readouterr().out
    assert "CHURN_BY_PLAN" in shown and "enterprise" in shown
    main(["plan_mix", str(folders / "parquet"), "--output", str(tmp_path / "out")])
    lines = [line for part in (tmp_path / "out").glob("*.csv") for line in csv.reader(part.open())]
    assert ["plan", "customers"] in lines and len(lines) == 5


def test_command_line_shows_signs(spark, folders, capfd):
    main(["mrr", str(folders / "parquet"), "--as-of", "2001-08-02", "--pretty"])
    shown = capfd.readouterr().out
    assert "$" in shown and "%" in shown


def test_command_line_shows_every_row(spark, tmp_path, capfd):
    many = [{"user_id": f"u{k:04d}", "signup_date": "2024-01-01"} for k in range(1500)]
    write_table(table(spark, "subscriptions", many), str(tmp_path), "subscriptions")
    main(["account_age_days", str(tmp_path), "--as-of", "2024-07-01"])
    assert capfd.readouterr().out.count("u0") + 500 >= 1500
    main(["account_age_days", str(tmp_path), "--as-of", "2024-07-01", "--rows", "10"])
    assert "only showing top 10 rows" in capfd.readouterr().out


def test_command_line_writes_checked_tables(spark, tmp_path, capfd):
    people = [{"user_id": f"u{9 - k}", "signup_date": "2024-01-01"} for k in range(9)]
    write_table(table(spark, "subscriptions", people), str(tmp_path / "in"), "subscriptions", "csv")
    arguments = ["write_checked", str(tmp_path / "in"), "--format", "csv", "--output", str(tmp_path / "out"), "--as-of", "2024-07-01", "--tables", "subscriptions"]
    main([*arguments, "--sort-by", "subscriptions=user_id"])
    assert [r["user_id"] for r in read_table(spark, str(tmp_path / "out"), "subscriptions").collect()] == [f"u{k}" for k in range(1, 10)]
    write_table(table(spark, "subscriptions", people + people[:1]), str(tmp_path / "in"), "subscriptions", "csv")
    with pytest.raises(ValueError, match="duplicate_user_ids: 1"):
        main([*arguments[:5], str(tmp_path / "other"), *arguments[6:]])
    assert not (tmp_path / "other").exists()


def test_lenient_and_multi_line_csv_reach_the_reports(spark, tmp_path):
    header = "campaign_id,campaign_name,campaign_type,segment,send_date,subject_line"
    (tmp_path / "email_campaigns.csv").write_text(f'{header}\nc1,"two\nlines",promo,x,2024-01-01,l\nc2,n,promo,x,not a date,l\n', encoding="utf-8")
    found = run_report("campaign_calendar_overview", spark, str(tmp_path), "csv", multi_line=True, bad_values="null")
    assert rows(found) == [(2, D("2024-01-01"), D("2024-01-01"))]
    with pytest.raises(Exception, match="(?i)malformed|not a date"):
        run_report("campaign_calendar_overview", spark, str(tmp_path), "csv", multi_line=True).collect()


def test_write_checked_blocks_bad_tables(spark, tmp_path):
    good = table(spark, "subscriptions", [{"user_id": "a", "signup_date": "2024-01-01"}])
    bad = good.unionByName(good)
    with pytest.raises(ValueError, match="duplicate_user_ids: 1"):
        write_checked(bad, quality_subscriptions(bad, D("2024-07-01")), str(tmp_path), "subscriptions")
    assert not list(tmp_path.iterdir())
    write_checked(good, quality_subscriptions(good, D("2024-07-01")), str(tmp_path), "subscriptions")
    assert read_table(spark, str(tmp_path), "subscriptions").count() == 1


def test_command_line_counts_malformed_values(spark, tmp_path, capfd):
    header = "campaign_id,campaign_name,campaign_type,segment,send_date,subject_line"
    (tmp_path / "email_campaigns.csv").write_text(f"{header}\nc1,n,promo,x,2024-01-01,l\nc2,n,promo,x,not a date,l\n", encoding="utf-8")
    main(["malformed_values", str(tmp_path), "--tables", "email_campaigns"])
    shown = [[v.strip() for v in line.split("|")[1:-1]] for line in capfd.readouterr().out.splitlines() if "malformed_" in line and "|" in line]
    assert ["email_campaigns", "malformed_values", "1", "false"] in shown and ["email_campaigns", "malformed_lines", "0", "true"] in shown


def test_checked_tables_are_read_once_and_moved_whole(spark, tmp_path):
    people = [{"user_id": f"u{k}", "signup_date": f"2024-01-{1 + k % 9:02d}"} for k in range(30)]
    leads = [{"lead_id": f"l{k}", "user_id": f"u{k}", "stage": "converted", "created_date": "2023-12-01", "converted_date": "2024-01-01"} for k in range(30)]
    for name, content in (("subscriptions", people), ("leads", leads)):
        write_table(table(spark, name, content), str(tmp_path / "in"), name)
    named = {"partition_by": {"subscriptions": "signup_date"}, "sort_by": {"leads": ["lead_id"]}}
    for _ in range(2):  # a second time over what is there
        paths = write_checked_tables(spark, str(tmp_path / "in"), str(tmp_path / "out"), ["subscriptions", "leads"], as_of=D("2024-07-01"), **named)
    assert paths == [str(tmp_path / "out" / f"{n}.parquet") for n in ("subscriptions", "leads")]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["in", "out"]
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["leads.parquet", "subscriptions.parquet"]
    assert read_table(spark, str(tmp_path / "out"), "subscriptions").where("signup_date = '2024-01-03'").count() == 4
    assert (tmp_path / "out" / "subscriptions.parquet" / "signup_date=2024-01-03").is_dir()


@pytest.mark.parametrize(
    ("name", "extra", "message"),
    [
        ("subscriptions", {"user_id": "u1", "signup_date": "2024-01-01"}, "duplicate_user_ids: 1"),
        ("subscriptions", {"user_id": "x", "signup_date": "2024-01-01", "mrr": 50}, "mrr_not_plan_price: 1"),
        ("leads", {"lead_id": "x", "stage": "converted", "created_date": "2024-01-01", "converted_date": "2024-02-01"}, "converted_without_user: 1"),
        ("leads", {"lead_id": "x", "user_id": "stranger", "stage": "converted", "created_date": "2024-01-01", "converted_date": "2024-02-01"}, "unknown_users: 1"),
    ],
)
def test_a_failed_check_leaves_nothing_behind(spark, tmp_path, name, extra, message):
    content = {
        "subscriptions": [{"user_id": f"u{k}", "signup_date": "2024-01-01"} for k in range(5)],
        "leads": [{"lead_id": f"l{k}", "user_id": f"u{k}", "stage": "converted", "created_date": "2023-12-01", "converted_date": "2024-01-01"} for k in range(5)],
    }
    for table_name, entries in content.items():
        write_table(table(spark, table_name, entries), str(tmp_path / "out"), table_name)
    content[name].append(extra)
    for table_name, entries in content.items():
        write_table(table(spark, table_name, entries), str(tmp_path / "in"), table_name)
    before = sorted(p.name for p in (tmp_path / "out").glob("*/part-*"))
    with pytest.raises(ValueError, match=message):
        write_checked_tables(spark, str(tmp_path / "in"), str(tmp_path / "out"), ["subscriptions", "leads"], as_of=D("2024-07-01"), sort_by={"leads": ["lead_id"]})
    assert sorted(p.name for p in (tmp_path / "out").glob("*/part-*")) == before
    assert sorted(p.name for p in tmp_path.iterdir()) == ["in", "out"]
