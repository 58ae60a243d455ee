from tables import D, rows, table

from subtide.operators.wau import weekly_active_users


def events(spark, triples):
    return table(
        spark,
        "product_events",
        [
            {"event_id": str(i), "user_id": u, "event_date": d, "session_id": s}
            for i, (u, d, s) in enumerate(triples)
        ],
    )


def test_weeks_start_on_monday_and_gaps_stay_gaps(spark):
    result = rows(
        weekly_active_users(
            events(
                spark,
                [
                    ("a", "2024-01-07", "s1"),  # a Sunday
                    ("a", "2024-01-08", "s2"),  # the Monday after
                    ("a", "2024-01-08", "s2"),
                    ("b", "2024-01-14", "s3"),
                    (None, "2024-01-14", "s4"),
                    ("a", "2024-01-30", "s5"),  # two weeks without events before
                ],
            )
        )
    )
    assert result == [
        (D("2024-01-01"), 1, None, None, 1, 1.0, 1.0),
        (D("2024-01-08"), 2, 1, 100.0, 3, 2.0, 1.5),
        (D("2024-01-29"), 1, -1, -50.0, 1, 1.0, 1.3),
    ]


def test_rolling_mean_covers_four_reported_weeks(spark):
    days = ["2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22", "2024-01-29"]
    triples = [(f"u{n}", day, f"s{n}{day}") for k, day in enumerate(days, start=1) for n in range(k)]
    result = rows(weekly_active_users(events(spark, triples)))
    assert [r[1] for r in result] == [1, 2, 3, 4, 5]
    assert [r[6] for r in result] == [1.0, 1.5, 2.0, 2.5, 3.5]


def test_week_of_unknown_users_only(spark):
    assert rows(weekly_active_users(events(spark, [(None, "2024-01-01", "s")]))) == [
        (D("2024-01-01"), 0, None, None, 1, None, 0.0)
    ]
