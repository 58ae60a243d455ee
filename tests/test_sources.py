import csv

import pytest
from tables import D, rows, table

from subtide.operators.mrr import mrr_monthly
from subtide.plans.reports import malformed_values
from subtide.sources.schemas import SCHEMAS
from subtide.sources.tables import LINE, RESCUED, load_tables, read_csv, read_rescued, read_table, write_table

CAMPAIGNS = [
    {"campaign_id": "cmp_001", "campaign_name": "News — May", "send_date": "2024-05-01", "subject_line": "features, tips & more"},
    {"campaign_id": "cmp_002", "campaign_name": 'The "big" one', "send_date": None, "subject_line": None},
]


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_round_trip(spark, tmp_path, fmt):
    campaigns = table(spark, "email_campaigns", CAMPAIGNS)
    write_table(campaigns, str(tmp_path), "email_campaigns", fmt)
    again = read_table(spark, str(tmp_path), "email_campaigns", fmt)
    assert again.schema == SCHEMAS["email_campaigns"]
    assert sorted(rows(again)) == sorted(rows(campaigns))


def test_csv_file_with_quotes_dashes_and_empty_dates(spark, tmp_path):
    with open(tmp_path / "subscriptions.csv", "w", newline="", encoding="utf-8") as f:
        out = csv.DictWriter(f, SCHEMAS["subscriptions"].names)
        out.writeheader()
        out.writerow({"user_id": "usr_0001", "company_name": "Acme, Inc — West", "mrr": 49, "status": "active", "signup_date": "2024-05-01"})
        out.writerow({"user_id": "usr_0002", "company_name": 'The ""Co', "mrr": 149, "status": "churned", "signup_date": "2024-05-02", "churn_date": "2024-06-30"})
    subs = load_tables(spark, str(tmp_path), ["subscriptions"], "csv", views=True)["subscriptions"]
    found = sorted(rows(subs.select("user_id", "company_name", "mrr", "signup_date", "churn_date")))
    assert found == [
        ("usr_0001", "Acme, Inc — West", 49, D("2024-05-01"), None),
        ("usr_0002", 'The ""Co', 149, D("2024-05-02"), D("2024-06-30")),
    ]
    assert [r[0] for r in rows(mrr_monthly(subs, D("2024-08-01")))] == ["2024-05", "2024-06"]
    assert rows(spark.sql("SELECT count(*) FROM subscriptions")) == [(2,)]


def test_csv_value_that_does_not_fit_is_an_error(spark, tmp_path):
    header = ",".join(SCHEMAS["email_campaigns"].names)
    (tmp_path / "email_campaigns.csv").write_text(f"{header}\nc,n,t,s,not a date,l\n", encoding="utf-8")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_table(spark, str(tmp_path), "email_campaigns", "csv").collect()


def test_csv_columns_go_by_their_names(spark, tmp_path):
    names = SCHEMAS["email_campaigns"].names
    header = ",".join([names[1], "further", names[0], *names[2:]])
    path = tmp_path / "email_campaigns.csv"
    path.write_text(f"{header}\nname,9,id,t,s,2024-01-01,l\n", encoding="utf-8")
    [row] = read_table(spark, str(tmp_path), "email_campaigns", "csv").collect()
    assert row["campaign_id"] == "id" and row["campaign_name"] == "name" and len(row) == len(names)
    path.write_text("campaign_id\nid\n", encoding="utf-8")
    with pytest.raises(ValueError, match="no column campaign_name"):
        read_table(spark, str(tmp_path), "email_campaigns", "csv")


def test_unknown_format(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown format"):
        read_table(spark, str(tmp_path), "leads", "xml")
    with pytest.raises(ValueError, match="unknown format"):
        write_table(table(spark, "leads", []), str(tmp_path), "leads", "xml")


def test_csv_value_that_does_not_fit_can_be_missing(spark, tmp_path):
    path = tmp_path / "email_campaigns.csv"
    path.write_text(f"{','.join(SCHEMAS['email_campaigns'].names)}\nc,n,t,s,not a date,l\n", encoding="utf-8")
    campaigns = read_csv(spark, str(path), SCHEMAS["email_campaigns"], bad_values="null")
    assert rows(campaigns) == [("c", "n", "t", "s", None, "l")]


def test_csv_line_break_inside_quotes(spark, tmp_path):
    path = tmp_path / "email_campaigns.csv"
    path.write_text(f"{','.join(SCHEMAS['email_campaigns'].names)}\nc,\"two\nlines\",t,s,2024-01-01,l\n", encoding="utf-8")
    campaigns = read_csv(spark, str(path), SCHEMAS["email_campaigns"], multi_line=True)
    assert [r["campaign_name"] for r in campaigns.collect()] == ["two\nlines"]


def test_sorted_table(spark, tmp_path):
    log = [{"event_id": str(i), "user_id": f"u{i * 7 % 10}", "event_date": f"2024-01-{i + 1:02d}"} for i in range(20)]
    events = table(spark, "product_events", log).repartition(4)
    path = write_table(events, str(tmp_path), "product_events", "csv", sort_by=["user_id", "event_date"])
    parts = sorted(p for p in (tmp_path / "product_events.csv").glob("part-*"))
    found = [(line["user_id"], line["event_date"]) for part in parts for line in csv.DictReader(part.open())]
    assert path.endswith("product_events.csv") and found == sorted(found) and len(found) == 20


def _days(spark, n=40):
    log = [{"event_id": str(i), "user_id": f"u{i % 3}", "event_date": f"2024-{1 + i % 4:02d}-{1 + i % 5:02d}" if i % 9 else None} for i in range(n)]
    return table(spark, "product_events", log).repartition(3)


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_a_folder_per_day_reads_as_the_same_table(spark, tmp_path, fmt):
    events = _days(spark)
    write_table(events, str(tmp_path), "product_events", fmt, partition_by="event_date", sort_by=["user_id"])
    again = read_table(spark, str(tmp_path), "product_events", fmt)
    assert again.schema == SCHEMAS["product_events"]
    assert sorted(map(repr, rows(again))) == sorted(map(repr, rows(events)))
    folders = {p.name for p in (tmp_path / f"product_events.{fmt}").iterdir() if p.is_dir()}
    assert "event_date=2024-01-01" in folders and "event_date=__HIVE_DEFAULT_PARTITION__" in folders


def test_days_can_be_replaced_alone(spark, tmp_path):
    write_table(_days(spark), str(tmp_path), "product_events", partition_by="event_date")
    late = table(spark, "product_events", [{"event_id": "late", "event_date": "2024-01-01"}])
    write_table(late, str(tmp_path), "product_events", mode="overwrite_days", partition_by="event_date")
    found = read_table(spark, str(tmp_path), "product_events")
    assert [r["event_id"] for r in found.where("event_date = '2024-01-01'").collect()] == ["late"]
    assert found.where("event_date <> '2024-01-01' OR event_date IS NULL").count() == _days(spark).where("event_date <> '2024-01-01' OR event_date IS NULL").count()
    with pytest.raises(ValueError, match="needs partition_by"):
        write_table(late, str(tmp_path), "product_events", mode="overwrite_days")
    with pytest.raises(ValueError, match="no date column"):
        write_table(late, str(tmp_path), "product_events", partition_by="user_id")


def test_a_hot_value_is_sorted_into_many_files(spark, tmp_path, request):
    # Few rows would be merged into one file.
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    request.addfinalizer(lambda: spark.conf.set(merging, "true"))
    spark.conf.set(merging, "false")
    events = spark.range(20_000).selectExpr(
        "cast(id AS string) AS event_id", "CASE WHEN id % 3 < 2 THEN 'hot' ELSE concat('u', id) END AS user_id", "'e' AS event_name",
        "date_add(date'2024-01-01', cast(id % 7 AS int)) AS event_date", "'web' AS platform", "'s' AS session_id",
    )
    write_table(events, str(tmp_path), "product_events", sort_by=["user_id"])
    files = spark.read.parquet(str(tmp_path / "product_events.parquet")).selectExpr("user_id", "_metadata.file_name AS file")
    hot = {r["file"]: r["count"] for r in files.where("user_id = 'hot'").groupBy("file").count().collect()}
    assert len(hot) >= 3 and max(hot.values()) < 10_000
    ranges = files.groupBy("file").agg({"user_id": "min"}).collect()
    ends = {r["file"]: r["max(user_id)"] for r in files.groupBy("file").agg({"user_id": "max"}).collect()}
    ordered = sorted(ranges, key=lambda r: r["file"])
    assert all(ends[a["file"]] <= b["min(user_id)"] for a, b in zip(ordered, ordered[1:], strict=False))


DAMAGED = """user_id,company_name,email,plan,mrr,status,signup_date,churn_date,churn_reason,payment_failures,country,industry,created_at,account_age_days,acquisition_channel,further
u1,c,e,starter,49,active,2024-01-01,,,0,us,x,2024-01-01,3,web,-
u2,c,e,starter,forty,active,2024-01-01,,,0,us,x,2024-01-01,3,web,-
u3,c,e,starter,49,active,2024-13-01,31.12.2024,,0,us,x,2024-01-01,3,web,-
u4,c,e,starter,49,active
u5,c,e,starter,49,active,2024-01-01,,,0,us,x,2024-01-01,3,web,-,more,and more
u6,"c, d",e,starter,49,active,2024-01-01,,,99999999999999999999,us,x,2024-01-01,3,web,-
"""


def test_damaged_values_are_kept_and_counted(spark, tmp_path):
    path = tmp_path / "subscriptions.csv"
    path.write_text(DAMAGED, encoding="utf-8")
    found = {r["user_id"]: r for r in read_rescued(spark, str(path), SCHEMAS["subscriptions"]).collect()}
    assert found["u1"][RESCUED] is None and found["u1"]["mrr"] == 49
    assert found["u2"][RESCUED] == {"mrr": "forty"} and found["u2"]["mrr"] is None
    assert found["u3"][RESCUED] == {"signup_date": "2024-13-01", "churn_date": "31.12.2024"}
    assert set(found["u4"][RESCUED]) == {LINE} and found["u4"][RESCUED][LINE].startswith("u4,")
    assert set(found["u5"][RESCUED]) == {LINE}
    assert found["u6"][RESCUED] == {"payment_failures": "9" * 20} and found["u6"]["company_name"] == "c, d"
    counts = {r["check_name"]: (r["violations"], r["passed"]) for r in malformed_values(spark, str(tmp_path), ["subscriptions"]).collect()}
    assert counts == {"malformed_values": (4, False), "malformed_lines": (2, False)}


def test_whole_tables_lose_nothing(spark, tmp_path):
    write_table(table(spark, "email_campaigns", CAMPAIGNS), str(tmp_path), "email_campaigns", "csv")
    path = str(tmp_path / "email_campaigns.csv")
    rescued = read_rescued(spark, path, SCHEMAS["email_campaigns"])
    assert sorted(rows(rescued.drop(RESCUED))) == sorted(rows(read_csv(spark, path, SCHEMAS["email_campaigns"])))
    assert [r["violations"] for r in malformed_values(spark, str(tmp_path), ["email_campaigns"]).collect()] == [0, 0]
    with pytest.raises(ValueError, match="no column send_id"):
        read_rescued(spark, path, SCHEMAS["email_sends"])
