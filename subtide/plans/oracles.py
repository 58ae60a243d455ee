"""The registered queries in plain SQL (DuckDB dialect) over the star-schema tables.

Written from the specification, in the form a reader would check it, not the form the
Spark operators use: joins where those use deltas, one query per section where those
share a scan.
"""

from __future__ import annotations

from subtide.domain import (
    ACQUISITION_CHANNELS,
    AUDIENCE_CAP,
    CAMPAIGN_SEGMENTS,
    CHURN_REASONS,
    COMPANY_SIZES,
    FUNNEL_STAGES,
    LOSS_REASONS,
    PLAN_PRICES,
)

AS_OF = "DATE '2001-08-02'"
THIS_MONTH = "DATE '2001-08-01'"


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _case(subject: str, mapping: dict[str, object], otherwise: str) -> str:
    arms = " ".join(
        f"WHEN '{key}' THEN " + (f"'{value}'" if isinstance(value, str) else str(value))
        for key, value in mapping.items()
    )
    return f"CASE {subject} {arms} ELSE {otherwise} END"


def _pct(part: str, whole: str, places: int) -> str:
    # Adding 0 turns a negative zero into 0.
    return f"ROUND(({part}) * 100.0 / NULLIF({whole}, 0), {places}) + 0.0"


def _printed(value: str, places: int) -> str:
    return f"CAST(printf('%.{places}f', CAST({value} AS DOUBLE)) AS DOUBLE)"


def _padded(number: str, digits: int) -> str:
    text = f"CAST({number} AS VARCHAR)"
    return f"lpad({text}, CAST(greatest({digits}, length({text})) AS INTEGER), '0')"


# --- the five tables -------------------------------------------------------------

_LIVES = """
  SELECT o_custkey, MIN(CAST(o_orderdate AS DATE)) AS first_day, MAX(CAST(o_orderdate AS DATE)) AS last_day,
         COUNT(*) FILTER (o_orderstatus = 'P') AS payment_failures
  FROM orders GROUP BY o_custkey
"""

_PLAN = (
    "CASE WHEN c_custkey % 10 < 4 THEN 'starter' WHEN c_custkey % 10 < 7 THEN 'growth' "
    "WHEN c_custkey % 10 < 9 THEN 'pro' ELSE 'enterprise' END"
)

_SUBSCRIPTIONS = f"""
  SELECT user_id, company_name, user_id || '@example.com' AS email, plan,
         CAST({_case("plan", PLAN_PRICES, "NULL")} AS BIGINT) AS mrr,
         CASE WHEN gone THEN 'churned' ELSE 'active' END AS status,
         first_day AS signup_date,
         CASE WHEN gone THEN last_day END AS churn_date,
         CASE WHEN gone THEN {_list(CHURN_REASONS)}[c_nationkey % 8 + 1] END AS churn_reason,
         payment_failures, country, industry, first_day AS created_at,
         datediff('day', first_day, {AS_OF}) AS account_age_days,
         {_list(ACQUISITION_CHANNELS)}[c_nationkey % 5 + 1] AS acquisition_channel
  FROM (
    SELECT 'usr_' || {_padded("c_custkey", 8)} AS user_id, c_name AS company_name, {_PLAN} AS plan,
           first_day, last_day, last_day < DATE '2000-08-02' AND last_day > first_day AS gone,
           c_nationkey, payment_failures, n_name AS country, c_mktsegment AS industry
    FROM customer JOIN ({_LIVES}) lives ON c_custkey = o_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
  )
"""


def _events(table: str, key: str, user: str, kind: str, moment: str) -> str:
    return f"""
  SELECT CAST({key} AS VARCHAR) AS event_id, 'usr_' || {_padded(user, 8)} AS user_id,
         {kind} AS event_name, CAST({moment} AS DATE) AS event_date,
         CASE WHEN {key} % 100 < 78 THEN 'web' ELSE 'mobile' END AS platform,
         'ses_' || {user} || '_' || CAST({moment} AS DATE) AS session_id
  FROM {table}
"""


_PRODUCT_EVENTS = _events("events", "event_id", "user_id", "event_type", "ts")
_ORDER_EVENTS = _events("orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")

_LOSS = " ".join(
    f"WHEN '{stage}' THEN {_list(reasons)}[(CAST(o_orderpriority[1] AS INTEGER) - 1) % {len(reasons)} + 1]"
    for stage, reasons in LOSS_REASONS.items()
)

_LEADS = f"""
  SELECT lead_id, CASE WHEN rn = 1 THEN 'usr_' || {_padded("o_custkey", 8)} END AS user_id,
         'first' AS first_name, 'last' AS last_name, c_name AS company, lead_id || '@example.com' AS email,
         c_mktsegment AS industry, {_list(COMPANY_SIZES)}[o_orderkey % 5 + 1] AS company_size,
         CASE WHEN b < 12 THEN 'referral' WHEN b < 30 THEN 'inbound' WHEN b < 52 THEN 'linkedin'
              WHEN b < 82 THEN 'cold_email' WHEN b < 92 THEN 'cold_call' ELSE 'paid_ad' END AS source,
         stage,
         CASE WHEN rn = 1 THEN CAST(day - CAST(3 + o_orderkey % 58 AS INTEGER) AS DATE) ELSE day END AS created_date,
         CASE WHEN rn = 1 THEN day END AS converted_date,
         CASE WHEN rn = 1 OR (stage = 'new' AND o_orderpriority = '5-LOW') THEN NULL
              ELSE CASE stage {_LOSS} END END AS loss_reason
  FROM (
    SELECT *, CASE WHEN rn = 1 THEN 'converted' WHEN o_orderstatus = 'F' THEN 'new'
                   WHEN o_orderstatus = 'O' THEN 'qualified' ELSE 'demo_booked' END AS stage
    FROM (
      SELECT *, CAST(o_orderdate AS DATE) AS day, CAST(o_orderkey AS VARCHAR) AS lead_id, o_orderkey % 100 AS b,
             row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
      FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    )
  )
"""


def _campaigns(table: str, key: str, digits: int, title: str, day: str) -> str:
    return f"""
  SELECT campaign_id, campaign_name, campaign_type,
         {_case("campaign_type", CAMPAIGN_SEGMENTS, "'all_active'")} AS segment, send_date, subject_line
  FROM (
    SELECT 'cmp_' || {_padded(f"{key} + 1", digits)} AS campaign_id, {title} AS campaign_name,
           ['newsletter', 'promo', 'upsell', 're_engagement', 'winback'][{key} % 5 + 1] AS campaign_type,
           CAST({day} AS DATE) AS send_date, {title} AS subject_line
    FROM {table}
  )
"""


_EMAIL_CAMPAIGNS = _campaigns("nation", "n_nationkey", 3, "n_name", "DATE '1995-06-30' + 90 * n_nationkey")
_ORDER_CAMPAIGNS = _campaigns("orders", "o_orderkey", 10, "o_orderpriority", "o_orderdate")

_EMAIL_SENDS = f"""
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS send_id,
         'cmp_' || {_padded("l_orderkey % 25 + 1", 3)} AS campaign_id,
         'usr_' || {_padded("o_custkey", 8)} AS user_id,
         CAST(DATE '1995-06-30' + CAST(90 * (l_orderkey % 25) AS INTEGER) AS DATE) AS send_date,
         l_returnflag <> 'N' AS opened,
         l_returnflag <> 'N' AND l_linestatus = 'F' AS clicked,
         l_returnflag <> 'N' AND l_discount >= 0.08 AS replied,
         l_tax >= 0.08 AS unsubscribed
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
"""


def _twice(rows: str, chosen: str) -> str:
    return f"WITH r AS ({rows}) SELECT * FROM r UNION ALL SELECT * FROM r WHERE {chosen}"


_SUBSCRIPTIONS_DIRTY = _twice(
    f"""
  SELECT * REPLACE (
    CASE WHEN status = 'churned' AND k % 41 = 1 THEN signup_date
         WHEN status = 'churned' AND k % 43 = 2 THEN DATE '2001-08-03'
         WHEN status = 'active' AND k % 37 = 4 THEN CAST(signup_date + 1 AS DATE)
         ELSE churn_date END AS churn_date,
    CASE WHEN k % 13 = 3 THEN NULL
         WHEN status = 'active' AND k % 31 = 5 THEN 'too_expensive' ELSE churn_reason END AS churn_reason,
    CASE WHEN k % 29 = 6 THEN mrr + 1 ELSE mrr END AS mrr)
  FROM (SELECT *, CAST(user_id[5:] AS BIGINT) AS k FROM ({_SUBSCRIPTIONS}))
""",
    "k % 50 = 0",
)

_PRODUCT_EVENTS_DIRTY = _twice(
    f"""
  SELECT * REPLACE (
    CASE WHEN k % 97 = 1 THEN 'usr_unknown' ELSE user_id END AS user_id,
    CASE WHEN k % 89 = 2 THEN DATE '2100-01-01' WHEN k % 83 = 3 THEN DATE '1900-01-01' ELSE event_date END
      AS event_date)
  FROM (SELECT *, CAST(event_id AS BIGINT) AS k FROM ({_PRODUCT_EVENTS}))
""",
    "k % 100 = 0",
)

_LEADS_DIRTY = _twice(
    f"""
  SELECT * REPLACE (
    CASE WHEN won AND k % 19 = 1 THEN NULL WHEN won AND k % 89 = 2 THEN 'usr_unknown'
         WHEN NOT won AND k % 79 = 5 THEN 'usr_00000001' ELSE user_id END AS user_id,
    CASE WHEN won AND k % 17 = 4 THEN converted_date ELSE created_date END AS created_date,
    CASE WHEN k % 73 = 6 THEN NULL ELSE loss_reason END AS loss_reason)
  FROM (SELECT *, CAST(lead_id AS BIGINT) AS k, stage = 'converted' AS won FROM ({_LEADS}))
  WHERE NOT won OR CAST(user_id[5:] AS BIGINT) % 101 <> 0
""",
    "k % 100 = 0",
)

_EMAIL_CAMPAIGNS_DIRTY = _twice(_EMAIL_CAMPAIGNS, "campaign_id = 'cmp_007'")

_EMAIL_SENDS_DIRTY = f"""
  SELECT * REPLACE (
    CASE WHEN k % 97 = 1 THEN 'cmp_999' ELSE campaign_id END AS campaign_id,
    CASE WHEN k % 89 = 2 THEN 'usr_unknown' ELSE user_id END AS user_id,
    opened AND k % 83 <> 3 AND k % 79 <> 4 AS opened,
    clicked OR k % 83 = 3 AS clicked,
    replied OR k % 79 = 4 AS replied,
    CASE WHEN k % 73 = 5 THEN DATE '2001-08-03' ELSE send_date END AS send_date)
  FROM (SELECT *, CAST(split_part(send_id, '-', 1) AS BIGINT) AS k FROM ({_EMAIL_SENDS}))
"""

_TABLES = {
    "subscriptions": _SUBSCRIPTIONS,
    "product_events": _PRODUCT_EVENTS,
    "order_events": _ORDER_EVENTS,
    "leads": _LEADS,
    "email_campaigns": _EMAIL_CAMPAIGNS,
    "order_campaigns": _ORDER_CAMPAIGNS,
    "email_sends": _EMAIL_SENDS,
    "subscriptions_dirty": _SUBSCRIPTIONS_DIRTY,
    "product_events_dirty": _PRODUCT_EVENTS_DIRTY,
    "leads_dirty": _LEADS_DIRTY,
    "email_campaigns_dirty": _EMAIL_CAMPAIGNS_DIRTY,
    "email_sends_dirty": _EMAIL_SENDS_DIRTY,
}


def _over(tables: str, select: str, **ctes: str) -> str:
    """``select`` with the named adapter tables (optionally ``adapter AS name``) and
    further common table expressions in front."""
    parts = []
    for entry in tables.split(", "):
        adapter, _, name = entry.partition(" AS ")
        parts.append(f"{name or adapter} AS MATERIALIZED ({_TABLES[adapter]})")
    parts += [f"{name} AS ({body})" for name, body in ctes.items()]
    return "WITH " + ",\n".join(parts) + "\n" + select


# --- reports ---------------------------------------------------------------------


def _wau(table: str) -> str:
    return _over(
        table,
        f"""
SELECT week_start, wau, wau - before AS wau_change, {_pct("wau - before", "before", 1)} AS wau_growth_pct,
       total_sessions, ROUND(n * 1.0 / NULLIF(wau, 0), 1) AS events_per_user,
       ROUND(AVG(wau) OVER (ORDER BY week_start ROWS 3 PRECEDING), 1) AS wau_4wk_avg
FROM (SELECT *, lag(wau) OVER (ORDER BY week_start) AS before FROM weeks)
""",
        weeks=f"""
SELECT CAST(date_trunc('week', event_date) AS DATE) AS week_start, COUNT(*) AS n,
       COUNT(DISTINCT user_id) AS wau, COUNT(DISTINCT session_id) AS total_sessions
FROM {table} GROUP BY ALL
""",
    )


_MRR = _over(
    "subscriptions",
    f"""
SELECT strftime(month, '%Y-%m') AS month, new_customers, new_mrr, churned_customers, churned_mrr, net_mrr,
       cumulative_mrr, {_pct("cumulative_mrr - before", "before", 1)} AS mrr_growth_pct,
       {_pct("churned_mrr", "before", 1)} AS revenue_churn_pct
FROM (SELECT *, lag(cumulative_mrr) OVER (ORDER BY month) AS before FROM running)
WHERE month < {THIS_MONTH}
""",
    joined="""
SELECT date_trunc('month', signup_date) AS month, COUNT(*) AS customers, SUM(mrr) AS revenue
FROM subscriptions WHERE signup_date IS NOT NULL GROUP BY ALL
""",
    lost="""
SELECT date_trunc('month', churn_date) AS month, COUNT(*) AS customers, SUM(mrr) AS revenue
FROM subscriptions WHERE status = 'churned' AND churn_date IS NOT NULL GROUP BY ALL
""",
    calendar="""
SELECT date_trunc('month', signup_date) AS month FROM subscriptions
UNION SELECT date_trunc('month', churn_date) FROM subscriptions WHERE churn_date IS NOT NULL
""",
    running="""
SELECT month, CAST(COALESCE(j.customers, 0) AS BIGINT) AS new_customers,
       CAST(COALESCE(j.revenue, 0) AS BIGINT) AS new_mrr,
       CAST(COALESCE(l.customers, 0) AS BIGINT) AS churned_customers,
       CAST(COALESCE(l.revenue, 0) AS BIGINT) AS churned_mrr,
       new_mrr - churned_mrr AS net_mrr,
       CAST(SUM(COALESCE(j.revenue, 0) - COALESCE(l.revenue, 0)) OVER (ORDER BY month ROWS UNBOUNDED PRECEDING)
            AS BIGINT) AS cumulative_mrr
FROM calendar LEFT JOIN joined j USING (month) LEFT JOIN lost l USING (month)
""",
)

_CHURN_CTES = {
    "lives": f"""
SELECT *, datediff('day', signup_date, COALESCE(churn_date, {AS_OF})) AS tenure
FROM subscriptions WHERE signup_date IS NOT NULL
""",
    "spine": f"""
SELECT unnest(generate_series(date_trunc('month', (SELECT MIN(signup_date) FROM lives)),
                              CAST({THIS_MONTH} AS TIMESTAMP) - INTERVAL 1 MONTH, INTERVAL 1 MONTH)) AS month
""",
    "seen": """
SELECT month, COUNT(user_id) AS active_count FROM spine
LEFT JOIN lives ON signup_date < month AND (churn_date IS NULL OR churn_date > month) GROUP BY month
""",
    "lost": """
SELECT date_trunc('month', churn_date) AS month, COUNT(*) AS churned, CAST(SUM(mrr) AS BIGINT) AS lost_mrr
FROM lives WHERE status = 'churned' AND churn_date IS NOT NULL GROUP BY ALL
""",
    "by_month": f"""
SELECT strftime(month, '%Y-%m') AS month, active_count, COALESCE(churned, 0) AS churned,
       COALESCE(lost_mrr, 0) AS lost_mrr, {_pct("COALESCE(churned, 0)", "active_count", 2)} AS churn_rate_pct
FROM seen LEFT JOIN lost USING (month)
""",
    "by_plan": f"""
SELECT plan, COUNT(*) AS total_users, COUNT(*) FILTER (status = 'churned') AS churned_users,
       {_pct("COUNT(*) FILTER (status = 'churned')", "COUNT(*)", 1)} AS churn_rate_pct,
       ROUND(AVG(tenure) FILTER (status = 'churned'), 0) AS avg_days_to_churn
FROM lives GROUP BY plan
""",
    "by_reason": f"""
SELECT churn_reason, n AS churned_users, {_pct("n", "SUM(n) OVER ()", 1)} AS pct_of_churned, lost_mrr, avg_tenure_days
FROM (
  SELECT churn_reason, COUNT(*) AS n, CAST(SUM(mrr) AS BIGINT) AS lost_mrr, ROUND(AVG(tenure), 0) AS avg_tenure_days
  FROM lives WHERE status = 'churned' AND churn_reason IS NOT NULL GROUP BY churn_reason
)
""",
    "by_tenure": """
SELECT plan, status, COUNT(*) AS users, ROUND(AVG(tenure), 0) AS avg_days,
       MIN(tenure) AS min_days, MAX(tenure) AS max_days
FROM lives GROUP BY plan, status
""",
}


def _churn(select: str) -> str:
    return _over("subscriptions", select, **_CHURN_CTES)


def _section(label: str, dim: str, columns: list[str], source: str) -> str:
    texts = [f"CAST({c} AS VARCHAR) AS col{i}" for i, c in enumerate(columns, start=1)]
    return f"SELECT '{label}' AS section, {dim} AS dim, {', '.join(texts)} FROM {source}"


_CHURN_REPORT = _churn(
    " UNION ALL ".join(
        [
            _section("1_monthly_churn", "month", ["active_count", "churned", "lost_mrr", "churn_rate_pct"], "by_month"),
            _section(
                "2_by_plan", "plan", ["total_users", "churned_users", "churn_rate_pct", "avg_days_to_churn"], "by_plan"
            ),
            _section(
                "3_by_reason",
                "churn_reason",
                ["churned_users", "pct_of_churned", "lost_mrr", "avg_tenure_days"],
                "by_reason",
            ),
            _section("4_tenure", "concat(plan, ' / ', status)", ["users", "avg_days", "min_days", "max_days"], "by_tenure"),
        ]
    )
)

_FUNNEL_CTES = {
    "enriched": """
SELECT l.*, s.plan, s.mrr, stage = 'converted' AS won, datediff('day', created_date, converted_date) AS days
FROM leads l LEFT JOIN subscriptions s ON l.user_id = s.user_id
""",
    "overview": f"""
SELECT ord, stage, n AS total_leads, n - lead(n) OVER (ORDER BY ord) AS drop_off,
       {_pct("n", "first_value(n) OVER (ORDER BY ord)", 1)} AS pct_of_top_of_funnel
FROM (
  SELECT ord, s.stage, COUNT(lead_id) AS n
  FROM (SELECT unnest({_list(FUNNEL_STAGES)}) AS stage, unnest(range(1, 5)) AS ord) s
  LEFT JOIN leads l ON l.stage = s.stage GROUP BY ALL
)
""",
    "by_source": f"""
SELECT source, COUNT(*) AS total_leads, COUNT(*) FILTER (won) AS converted,
       {_pct("COUNT(*) FILTER (won)", "COUNT(*)", 1)} AS conversion_rate_pct,
       CAST(SUM(CASE WHEN won THEN mrr ELSE 0 END) AS BIGINT) AS mrr_generated,
       ROUND(AVG(days) FILTER (won), 0) AS avg_days_to_convert
FROM enriched GROUP BY source
""",
    "losses": f"""
SELECT stage, loss_reason, n AS lost_leads, {_pct("n", "SUM(n) OVER (PARTITION BY stage)", 1)} AS pct_within_stage
FROM (
  SELECT stage, loss_reason, COUNT(*) AS n FROM leads
  WHERE stage <> 'converted' AND loss_reason IS NOT NULL GROUP BY ALL
)
""",
    "timing": """
SELECT source, plan, COUNT(*) AS customers, ROUND(AVG(days), 0) AS avg_days, MIN(days) AS fastest_days,
       MAX(days) AS slowest_days, CAST(SUM(mrr) AS BIGINT) AS total_mrr
FROM enriched WHERE won AND days IS NOT NULL GROUP BY ALL
""",
}


def _funnel(select: str) -> str:
    return _over("subscriptions, leads", select, **_FUNNEL_CTES)


_FUNNEL_REPORT = _funnel(
    " UNION ALL ".join(
        [
            _section("1_funnel", "stage", ["total_leads", "drop_off", "pct_of_top_of_funnel", "NULL"], "overview"),
            _section(
                "2_by_source", "source", ["total_leads", "converted", "conversion_rate_pct", "mrr_generated"], "by_source"
            ),
            _section(
                "3_loss_reasons",
                "concat(stage, ' → ', loss_reason)",
                ["lost_leads", "pct_within_stage", "NULL", "NULL"],
                "losses",
            ),
            _section(
                "4_time_to_convert",
                "concat(source, ' / ', plan)",
                ["customers", "avg_days", "fastest_days", "slowest_days"],
                "timing",
            ),
        ]
    )
)

# --- segments and campaigns --------------------------------------------------------

_ACTIVE = "signup_date <= send_date AND (churn_date IS NULL OR churn_date > send_date)"
_SEGMENT_RULES = {
    "all_active": _ACTIVE,
    "starter_growth": f"{_ACTIVE} AND plan IN ('starter', 'growth')",
    "low_activity": f"""{_ACTIVE} AND NOT EXISTS (
    SELECT 1 FROM order_events e
    WHERE e.user_id = s.user_id AND e.event_date > c.send_date - 30 AND e.event_date <= c.send_date)""",
    "churned": "status = 'churned' AND churn_date <= send_date",
}
_AUDIENCE_TABLES = "email_campaigns, subscriptions, order_events"


def _segment_select(rule: str, only: str = "TRUE") -> str:
    return (
        "SELECT campaign_id, send_date, s.user_id FROM email_campaigns c "
        f"JOIN subscriptions s ON {only} WHERE {_SEGMENT_RULES[rule]}"
    )


def _segment(rule: str) -> str:
    return _over(_AUDIENCE_TABLES, _segment_select(rule))


_AUDIENCE = " UNION ALL ".join(_segment_select(rule, f"c.segment = '{rule}'") for rule in _SEGMENT_RULES)
_CAPPED = f"""
SELECT campaign_id, send_date, user_id FROM ({_AUDIENCE})
QUALIFY row_number() OVER (PARTITION BY campaign_id ORDER BY md5(campaign_id || ':' || user_id), user_id)
        <= {AUDIENCE_CAP}
"""

_LABELS = _over(
    "order_campaigns",
    """
SELECT campaign_id, campaign_type, send_date, ordinal,
       CASE campaign_type
         WHEN 'newsletter' THEN 'Monthly Newsletter — ' || month
         WHEN 'promo' THEN 'Q' || quarter(send_date) || ' Promotion — ' || year(send_date)
         WHEN 'upsell' THEN 'Upgrade Offer #' || ordinal || ' — ' || month
         WHEN 're_engagement' THEN 'Re-engagement #' || ordinal || ' — ' || month
         ELSE 'Winback Campaign #' || ordinal || ' — ' || month END AS campaign_name
FROM (
  SELECT *, strftime(send_date, '%b %Y') AS month,
         row_number() OVER (PARTITION BY campaign_type ORDER BY send_date, campaign_id) AS ordinal
  FROM order_campaigns
)
""",
)

_SEND_RECORDS = _over(
    _AUDIENCE_TABLES + ", email_sends",
    """
SELECT 'snd_' || lpad(CAST(number AS VARCHAR), CAST(greatest(6, length(CAST(number AS VARCHAR))) AS INTEGER), '0') AS send_id,
       r.campaign_id, r.user_id, send_date, COALESCE(opened, FALSE) AS opened, COALESCE(clicked, FALSE) AS clicked,
       COALESCE(replied, FALSE) AS replied, COALESCE(unsubscribed, FALSE) AS unsubscribed
FROM (SELECT *, row_number() OVER (ORDER BY send_date, campaign_id, user_id) AS number FROM capped) r
LEFT JOIN seen ON r.campaign_id = seen.campaign_id AND r.user_id = seen.user_id
""",
    capped=_CAPPED,
    seen="""
SELECT campaign_id, user_id, bool_or(opened) AS opened, bool_or(clicked) AS clicked, bool_or(replied) AS replied,
       bool_or(unsubscribed) AS unsubscribed
FROM email_sends GROUP BY campaign_id, user_id
""",
)


def _rate(flag: str) -> str:
    return f"round_even(AVG(CAST({flag} AS INTEGER)) * 1000, 0) / 1000"


_PERFORMANCE = _over(
    "email_campaigns, email_sends",
    f"""
SELECT campaign_type, COUNT(send_id) AS sends, {_rate("opened")} AS open_rate, {_rate("clicked")} AS click_rate,
       {_rate("replied")} AS reply_rate, {_rate("unsubscribed")} AS unsub_rate
FROM email_sends s JOIN email_campaigns c ON s.campaign_id = c.campaign_id GROUP BY campaign_type
""",
)

# --- data quality ------------------------------------------------------------------


def _checks(checks: list[tuple[str, str, str]]) -> str:
    counts = " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{check}' AS check_name, CAST(({count}) AS BIGINT) AS violations"
        for table, check, count in checks
    )
    return f"SELECT *, violations = 0 AS passed FROM ({counts})"


def _rows(table: str, condition: str) -> str:
    return f"SELECT COUNT(*) FROM {table} WHERE {condition}"


def _repeats(table: str, key: str) -> str:
    return f"SELECT COALESCE(SUM(n - 1), 0) FROM (SELECT COUNT(*) AS n FROM {table} GROUP BY {key})"


_PRICE = " OR ".join(f"(plan = '{plan}' AND mrr IS DISTINCT FROM {price})" for plan, price in PLAN_PRICES.items())


def _quality_subscriptions(subs: str) -> str:
    rules = {
        "churn_not_after_signup": "status = 'churned' AND churn_date <= signup_date",
        "future_churn_dates": f"churn_date > {AS_OF}",
        "churned_without_reason": "status = 'churned' AND churn_reason IS NULL",
        "active_with_churn_date": "status = 'active' AND churn_date IS NOT NULL",
        "active_with_churn_reason": "status = 'active' AND churn_reason IS NOT NULL",
        "mrr_not_plan_price": _PRICE,
    }
    checks = [("duplicate_user_ids", _repeats("t", "user_id"))]
    checks += [(name, _rows("t", rule)) for name, rule in rules.items()]
    return _over(f"{subs} AS t", _checks([("subscriptions", *check) for check in checks]))


def _quality_events(events: str) -> str:
    joined = "t JOIN subscriptions s ON t.user_id = s.user_id"
    checks = [
        ("duplicate_event_ids", _repeats("t", "event_id")),
        ("unknown_users", _rows("t", "NOT EXISTS (SELECT 1 FROM subscriptions s WHERE s.user_id = t.user_id)")),
        ("events_after_churn", _rows(joined, "event_date > churn_date")),
        ("events_before_signup", _rows(joined, "event_date < signup_date")),
    ]
    return _over(f"subscriptions, {events} AS t", _checks([("product_events", *check) for check in checks]))


def _quality_leads(leads: str) -> str:
    known = "SELECT user_id FROM {} WHERE user_id IS NOT NULL"
    checks = [
        ("duplicate_lead_ids", _repeats("t", "lead_id")),
        ("converted_without_user", _rows("t", "stage = 'converted' AND user_id IS NULL")),
        ("created_not_before_converted", _rows("t", "stage = 'converted' AND created_date >= converted_date")),
        ("open_lead_with_user", _rows("t", "stage IS DISTINCT FROM 'converted' AND user_id IS NOT NULL")),
        ("open_lead_without_reason", _rows("t", "stage IS DISTINCT FROM 'converted' AND loss_reason IS NULL")),
        (
            "unknown_users",
            f"SELECT COUNT(*) FROM ({known.format('t')} EXCEPT {known.format('subscriptions')})",
        ),
        (
            "subscribers_without_lead",
            f"SELECT COUNT(*) FROM ({known.format('subscriptions')} EXCEPT {known.format('t')})",
        ),
    ]
    return _over(f"subscriptions, {leads} AS t", _checks([("leads", *check) for check in checks]))


def _quality_campaigns(campaigns: str, sends: str) -> str:
    checks = [
        ("email_campaigns", "duplicate_campaign_ids", _repeats("c", "campaign_id")),
        ("email_sends", "duplicate_send_ids", _repeats("t", "send_id")),
        ("email_sends", "clicked_without_open", _rows("t", "clicked AND NOT opened")),
        ("email_sends", "replied_without_open", _rows("t", "replied AND NOT opened")),
        ("email_sends", "future_send_dates", _rows("t", f"send_date > {AS_OF}")),
        (
            "email_sends",
            "unknown_campaigns",
            _rows("t", "NOT EXISTS (SELECT 1 FROM c WHERE c.campaign_id = t.campaign_id)"),
        ),
        (
            "email_sends",
            "unknown_users",
            _rows("t", "NOT EXISTS (SELECT 1 FROM subscriptions s WHERE s.user_id = t.user_id)"),
        ),
    ]
    return _over(f"subscriptions, {campaigns} AS c, {sends} AS t", _checks(checks))


# --- summaries and profiles --------------------------------------------------------


def _frequency(table: str, column: str, count: str, top: int | None = None) -> str:
    limit = f" ORDER BY {count} DESC, {column} LIMIT {top}" if top else ""
    return _over(
        table, f"SELECT {column}, COUNT(*) AS {count} FROM {table} WHERE {column} IS NOT NULL GROUP BY {column}{limit}"
    )


_CHURNED = "COUNT(*) FILTER (status = 'churned')"
_WON = "COUNT(*) FILTER (stage = 'converted')"


def _share(part: str, whole: str) -> str:
    """Percent as the summaries compute it: divide first, then scale."""
    return f"({part}) / CAST(NULLIF({whole}, 0) AS DOUBLE) * 100"


def _columns(*names: str) -> str:
    return "'" + ", ".join(names) + "'"


_SUMMARIES = {
    "plan_summary": _over(
        "subscriptions",
        f"""
SELECT plan, COUNT(user_id) AS users, {_CHURNED} AS churned,
       round_even({_share(_CHURNED, "COUNT(user_id)")} * 10, 0) / 10 AS churn_rate_pct,
       CAST(SUM(mrr) AS BIGINT) AS total_mrr
FROM subscriptions GROUP BY plan
""",
    ),
    "subscription_overview": _over(
        "subscriptions",
        f"""
SELECT COUNT(*) AS total_users, COUNT(*) FILTER (status = 'active') AS active, {_CHURNED} AS churned,
       CAST(COALESCE(SUM(mrr) FILTER (status = 'active'), 0) AS BIGINT) AS active_mrr
FROM subscriptions
""",
    ),
    "top_churn_reasons": _frequency("subscriptions", "churn_reason", "customers", 6),
    "signup_month_spread": _over(
        "subscriptions",
        """
SELECT (SELECT MIN(signup_date) FROM subscriptions) AS oldest_signup,
       (SELECT MAX(signup_date) FROM subscriptions) AS newest_signup,
       MIN(n) AS min_signups_per_month, MAX(n) AS max_signups_per_month
FROM (SELECT COUNT(*) AS n FROM subscriptions GROUP BY date_trunc('month', signup_date))
""",
    ),
    "events_by_plan": _over(
        "order_events, subscriptions",
        """
SELECT plan, COUNT(event_id) AS total_events, COUNT(DISTINCT e.user_id) AS unique_users,
       round_even(COUNT(event_id) / CAST(COUNT(DISTINCT e.user_id) AS DOUBLE) * 10, 0) / 10 AS events_per_user
FROM order_events e JOIN subscriptions s ON e.user_id = s.user_id GROUP BY plan
""",
    ),
    "avg_events_per_user_by_status": _over(
        "order_events, subscriptions",
        """
SELECT status, round_even(AVG(n) * 10, 0) / 10 AS avg_events_per_user
FROM (
  SELECT status, e.user_id, COUNT(*) AS n
  FROM order_events e JOIN subscriptions s ON e.user_id = s.user_id GROUP BY ALL
) GROUP BY status
""",
    ),
    "top_events": _frequency("product_events", "event_name", "events", 8),
    "decay_phases": _over(
        "order_events, subscriptions",
        f"""
SELECT CAST(p1 AS BIGINT) AS phase1_normal, CAST(p2 AS BIGINT) AS phase2_decline, CAST(p3 AS BIGINT) AS phase3_silent,
       {_printed(_share("p1", "p1 + p2 + p3"), 0)} AS phase1_normal_pct,
       {_printed(_share("p2", "p1 + p2 + p3"), 0)} AS phase2_decline_pct,
       {_printed(_share("p3", "p1 + p2 + p3"), 0)} AS phase3_silent_pct
FROM (
  SELECT COUNT(*) FILTER (event_date <= end1) AS p1,
         COUNT(*) FILTER (event_date > end1 AND event_date <= end2) AS p2,
         COUNT(*) FILTER (event_date > end2) AS p3
  FROM order_events e JOIN (
    SELECT user_id, signup_date + CAST(trunc(tenure * CAST(0.60 AS DOUBLE)) AS INTEGER) AS end1,
           signup_date + CAST(trunc(tenure * CAST(0.85 AS DOUBLE)) AS INTEGER) AS end2
    FROM (SELECT *, datediff('day', signup_date, churn_date) AS tenure FROM subscriptions WHERE status = 'churned')
  ) s ON e.user_id = s.user_id
)
""",
    ),
    "event_total": _over("product_events", "SELECT COUNT(*) AS total_events FROM product_events"),
    "lead_overview": _over(
        "leads",
        f"""
SELECT COUNT(*) AS total_leads, {_WON} AS converted, {_printed(_share(_WON, "COUNT(*)"), 1)} AS conversion_pct,
       COUNT(*) - {_WON} AS not_converted
FROM leads
""",
    ),
    "lead_stage_breakdown": _frequency("leads", "stage", "leads"),
    "lead_conversion_by_source": _over(
        "leads",
        f"""
SELECT source, COUNT(*) AS total, {_WON} AS converted, {_printed(_share(_WON, "COUNT(*)"), 1)} AS conv_rate_pct
FROM leads GROUP BY source
""",
    ),
    "lead_loss_breakdown": _frequency("leads", "loss_reason", "leads"),
    "company_size_mix": _frequency("leads", "company_size", "leads"),
    "campaign_calendar_overview": _over(
        "order_campaigns",
        """
SELECT COUNT(*) AS campaigns, MIN(send_date) AS first_send, MAX(send_date) AS last_send FROM order_campaigns
""",
    ),
    "campaign_type_mix": _frequency("order_campaigns", "campaign_type", "campaigns"),
    "send_overview": _over(
        "email_sends",
        f"""
SELECT COUNT(*) AS total_sends,
       {_printed(_share("COUNT(*) FILTER (opened)", "COUNT(opened)"), 1)} AS open_rate_pct,
       {_printed(_share("COUNT(*) FILTER (replied)", "COUNT(replied)"), 1)} AS reply_rate_pct
FROM email_sends
""",
    ),
    "table_profile": _over(
        "subscriptions, product_events",
        f"""
SELECT 'subscriptions' AS table_name, COUNT(*) AS row_count,
       {_columns("user_id", "company_name", "email", "plan", "mrr", "status", "signup_date", "churn_date",
                 "churn_reason", "payment_failures", "country", "industry", "created_at", "account_age_days",
                 "acquisition_channel")} AS column_names,
       CAST(NULL AS DATE) AS first_date, CAST(NULL AS DATE) AS last_date
FROM subscriptions
UNION ALL
SELECT 'product_events', COUNT(*),
       {_columns("event_id", "user_id", "event_name", "event_date", "platform", "session_id")},
       MIN(event_date), MAX(event_date)
FROM product_events
""",
    ),
    "churn_label_profile": _over(
        "subscriptions",
        f"""
SELECT COUNT(*) FILTER (status = 'active') AS active, {_CHURNED} AS churned,
       {_printed(_share(_CHURNED, "COUNT(*)"), 1)} AS churn_rate_pct
FROM subscriptions
""",
    ),
    "plan_mix": _frequency("subscriptions", "plan", "customers"),
    "account_age_days": _over("subscriptions", "SELECT user_id, signup_date, account_age_days FROM subscriptions"),
}

ORACLES: dict[str, str] = {
    "wau": _wau("product_events"),
    "wau_orders": _wau("order_events"),
    "mrr_monthly": _MRR,
    "churn_monthly": _churn("SELECT * FROM by_month"),
    "churn_by_plan": _churn("SELECT * FROM by_plan"),
    "churn_by_reason": _churn("SELECT * FROM by_reason"),
    "tenure_by_plan_status": _churn("SELECT * FROM by_tenure"),
    "churn_report": _CHURN_REPORT,
    "funnel_overview": _funnel("SELECT CAST(ord AS INTEGER) AS ord, * EXCLUDE (ord) FROM overview"),
    "conversion_by_source": _funnel("SELECT * FROM by_source"),
    "loss_reasons": _funnel("SELECT * FROM losses"),
    "time_to_convert": _funnel("SELECT * FROM timing"),
    "funnel_report": _FUNNEL_REPORT,
    **{f"segment_{rule}": _segment(rule) for rule in _SEGMENT_RULES},
    "segment_default": _segment("all_active"),
    "campaign_audience": _over(_AUDIENCE_TABLES, _AUDIENCE),
    "campaign_audience_capped": _over(_AUDIENCE_TABLES, _CAPPED),
    "campaign_segments": _over("order_campaigns", "SELECT campaign_id, campaign_type, segment FROM order_campaigns"),
    "campaign_labels": _LABELS,
    "send_records": _SEND_RECORDS,
    "campaign_performance": _PERFORMANCE,
    "quality_subscriptions": _quality_subscriptions("subscriptions"),
    "quality_subscriptions_dirty": _quality_subscriptions("subscriptions_dirty"),
    "quality_events": _quality_events("product_events"),
    "quality_events_dirty": _quality_events("product_events_dirty"),
    "quality_leads": _quality_leads("leads"),
    "quality_leads_dirty": _quality_leads("leads_dirty"),
    "quality_campaigns": _quality_campaigns("email_campaigns", "email_sends"),
    "quality_campaigns_dirty": _quality_campaigns("email_campaigns_dirty", "email_sends_dirty"),
    **_SUMMARIES,
}
