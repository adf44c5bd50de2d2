"""DuckDB building blocks: each named block is plain SQL over the given tables or other blocks."""

from __future__ import annotations

import re

H = (30, 60, 90)

BLOCKS: dict[str, str] = {}

BLOCKS["raw_customer_info"] = """
SELECT CAST(o_custkey AS VARCHAR) AS unique_customer_identifier,
       strftime(m, '%Y-%m-%d') AS datevalue, '0' || prio AS contract_status,
       dd AS contract_dd_cancels, dd60 AS dd_cancel_60_day,
       CASE WHEN c_acctbal >= 0 THEN floor(c_acctbal / 10.0) - 300.0 END AS ooc_days,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'FTTP' WHEN 'BUILDING' THEN 'FTTC'
            WHEN 'FURNITURE' THEN 'MPF' WHEN 'MACHINERY' THEN 'WLR' ELSE 'Unknown' END AS technology,
       CAST(floor(hi / 5000.0) AS INTEGER) AS speed, lo * CAST(0.00017321 AS DOUBLE) AS line_speed,
       r_name AS sales_channel, n_name AS crm_package_name,
       CAST(date_diff('day', min(f) OVER (PARTITION BY o_custkey), m) AS INTEGER) AS tenure_days
FROM (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS m,
             min(o_orderpriority) AS prio,
             CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS INTEGER) AS dd,
             CAST(count(*) FILTER (WHERE o_orderstatus = 'P') AS INTEGER) AS dd60,
             max(o_totalprice) AS hi, min(o_totalprice) AS lo, CAST(min(o_orderdate) AS DATE) AS f
      FROM orders GROUP BY 1, 2)
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey"""

BLOCKS["raw_usage"] = """
SELECT CAST(o_custkey AS VARCHAR) AS unique_customer_identifier,
       strftime(d, '%Y-%m-%d') AS calendar_date,
       CASE WHEN q % 47 = 0 THEN 'n/a' ELSE CAST(q * 10 AS VARCHAR) || '.5' END AS usage_download_mbs,
       CAST(x AS VARCHAR) AS usage_upload_mbs
FROM (SELECT o_custkey, CAST(l_shipdate AS DATE) AS d, sum(CAST(l_quantity AS BIGINT)) AS q,
             sum(CAST(floor(l_extendedprice) AS BIGINT)) AS x
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""

BLOCKS["raw_calls"] = """
SELECT CAST(o_custkey AS VARCHAR) AS unique_customer_identifier,
       strftime(o_orderdate, '%Y-%m-%d') AS event_date,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Loyalty' WHEN '2-HIGH' THEN 'Complaints'
            WHEN '3-MEDIUM' THEN 'Tech' WHEN '5-LOW' THEN 'Other' END AS call_type,
       CAST(floor(o_totalprice / 100) AS INTEGER) AS talk_time_seconds,
       CAST(o_orderkey % 600 AS INTEGER) AS hold_time_seconds
FROM orders"""

BLOCKS["raw_cease"] = """
SELECT CAST(o_custkey AS VARCHAR) AS unique_customer_identifier,
       strftime(o_orderdate, '%Y-%m-%d') AS cease_placed_date,
       strftime(done, '%Y-%m-%d') AS cease_completed_date,
       o_orderpriority AS reason_description_insight
FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS done FROM lineitem
                       WHERE l_linestatus = 'F' GROUP BY 1) ON o_orderkey = l_orderkey
WHERE o_orderstatus = 'F'"""

BLOCKS["cease_days"] = """
SELECT CAST(o_custkey AS VARCHAR) AS unique_customer_identifier,
       CAST(o_orderdate AS DATE) AS cease_placed_date
FROM orders WHERE o_orderstatus = 'F'"""

BLOCKS["customer_info"] = """
SELECT unique_customer_identifier, CAST(datevalue AS DATE) AS datevalue, contract_status,
       contract_dd_cancels, dd_cancel_60_day, coalesce(ooc_days, -9999.0) AS ooc_days,
       technology, speed, line_speed, sales_channel, crm_package_name, tenure_days,
       TRY_CAST(substr(contract_status, 1, 2) AS INTEGER) AS contract_status_ord,
       CASE WHEN speed > 0 THEN round((speed - line_speed) / speed * 100, 2) ELSE 0.0 END
         AS speed_gap_pct,
       CASE WHEN tenure_days < 90 THEN '0-90d' WHEN tenure_days < 365 THEN '90d-1y'
            WHEN tenure_days < 730 THEN '1y-2y' WHEN tenure_days < 1095 THEN '2y-3y'
            ELSE '3y+' END AS tenure_bucket
FROM raw_customer_info"""

BLOCKS["usage_daily"] = """
SELECT *, usage_download_mbs + usage_upload_mbs AS usage_total_mbs,
       CAST(date_trunc('month', calendar_date) AS DATE) AS month_key
FROM (SELECT unique_customer_identifier, CAST(calendar_date AS DATE) AS calendar_date,
             TRY_CAST(usage_download_mbs AS DOUBLE) AS usage_download_mbs,
             TRY_CAST(usage_upload_mbs AS DOUBLE) AS usage_upload_mbs FROM raw_usage)"""

BLOCKS["calls"] = """
SELECT unique_customer_identifier, CAST(event_date AS DATE) AS event_date,
       coalesce(call_type, 'Unknown') AS call_type, talk_time_seconds, hold_time_seconds,
       CASE WHEN call_type = 'Loyalty' THEN 1 ELSE 0 END AS is_loyalty_call,
       CASE WHEN call_type = 'Complaints' THEN 1 ELSE 0 END AS is_complaint_call,
       CASE WHEN call_type = 'Tech' THEN 1 ELSE 0 END AS is_tech_call
FROM raw_calls"""

BLOCKS["cease"] = """
SELECT unique_customer_identifier, CAST(cease_placed_date AS DATE) AS cease_placed_date,
       CAST(cease_completed_date AS DATE) AS cease_completed_date, reason_description_insight,
       CASE WHEN cease_completed_date IS NOT NULL THEN 1 ELSE 0 END AS is_completed,
       CAST(date_trunc('month', CAST(cease_placed_date AS DATE)) AS DATE) AS cease_month
FROM raw_cease"""

BLOCKS["spine"] = """
SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS unique_customer_identifier,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS observation_date FROM orders"""

BLOCKS["horizon_labels"] = "SELECT s.unique_customer_identifier, s.observation_date, " + ", ".join(
    f"max(CASE WHEN c.cease_placed_date < s.observation_date + {h} THEN 1 ELSE 0 END)"
    f" AS churned_in_{h}d" for h in H) + """
FROM spine s LEFT JOIN cease_days c ON s.unique_customer_identifier = c.unique_customer_identifier
     AND c.cease_placed_date >= s.observation_date AND c.cease_placed_date < s.observation_date + 90
GROUP BY 1, 2"""

BLOCKS["call_features"] = """
SELECT s.unique_customer_identifier, s.observation_date,
       CAST(count(*) FILTER (WHERE c.event_date >= s.observation_date - 30) AS BIGINT) AS calls_30d,
       CAST(count(*) FILTER (WHERE c.event_date >= s.observation_date - 90) AS BIGINT) AS calls_90d,
       count(c.event_date) AS calls_180d,
       CAST(coalesce(sum(is_loyalty_call) FILTER (WHERE c.event_date >= s.observation_date - 90), 0)
            AS BIGINT) AS loyalty_calls_90d,
       CAST(coalesce(sum(is_complaint_call) FILTER (WHERE c.event_date >= s.observation_date - 90), 0)
            AS BIGINT) AS complaint_calls_90d,
       CAST(coalesce(sum(is_tech_call) FILTER (WHERE c.event_date >= s.observation_date - 90), 0)
            AS BIGINT) AS tech_calls_90d,
       avg(talk_time_seconds) AS avg_talk_time, avg(hold_time_seconds) AS avg_hold_time,
       max(hold_time_seconds) AS max_hold_time,
       CAST(date_diff('day', max(c.event_date), s.observation_date) AS INTEGER) AS days_since_last_call
FROM spine s LEFT JOIN calls c ON s.unique_customer_identifier = c.unique_customer_identifier
     AND c.event_date < s.observation_date AND c.event_date >= s.observation_date - 180
GROUP BY 1, 2"""

BLOCKS["cease_history"] = """
SELECT s.unique_customer_identifier, s.observation_date,
       count(c.cease_placed_date) AS prior_cease_count,
       CAST(date_diff('day', max(c.cease_placed_date), s.observation_date) AS INTEGER)
         AS days_since_last_cease
FROM spine s LEFT JOIN cease_days c ON s.unique_customer_identifier = c.unique_customer_identifier
     AND c.cease_placed_date < s.observation_date
GROUP BY 1, 2"""

BLOCKS["usage_monthly"] = """
SELECT unique_customer_identifier, month_key,
       sum(usage_download_mbs) AS monthly_download_mb, sum(usage_upload_mbs) AS monthly_upload_mb,
       sum(usage_total_mbs) AS monthly_total_mb, avg(usage_download_mbs) AS avg_daily_download_mb,
       avg(usage_upload_mbs) AS avg_daily_upload_mb, avg(usage_total_mbs) AS avg_daily_total_mb,
       stddev_samp(usage_total_mbs) AS std_daily_total_mb, count(*) AS active_days_in_month,
       max(usage_total_mbs) AS peak_daily_total_mb, min(usage_total_mbs) AS min_daily_total_mb
FROM usage_daily GROUP BY 1, 2"""

BLOCKS["usage_trends"] = """
SELECT *, CASE WHEN prev_month_total > 0
               THEN (monthly_total_mb - prev_month_total) / prev_month_total END AS usage_mom_change,
       CASE WHEN prev_3mo_avg_total > 0
            THEN (monthly_total_mb - prev_3mo_avg_total) / prev_3mo_avg_total END AS usage_vs_3mo_avg
FROM (SELECT *, lag(monthly_total_mb) OVER w AS prev_month_total,
             avg(monthly_total_mb) OVER (PARTITION BY unique_customer_identifier ORDER BY month_key
                                         ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS prev_3mo_avg_total
      FROM usage_monthly
      WINDOW w AS (PARTITION BY unique_customer_identifier ORDER BY month_key))"""

BLOCKS["features"] = """
SELECT i.unique_customer_identifier, i.datevalue AS observation_date, contract_status_ord,
       contract_dd_cancels, dd_cancel_60_day, ooc_days, technology, speed, line_speed,
       speed_gap_pct, sales_channel, crm_package_name, tenure_days, tenure_bucket,
       calls_30d, calls_90d, calls_180d, loyalty_calls_90d, complaint_calls_90d, tech_calls_90d,
       avg_talk_time, avg_hold_time, max_hold_time, days_since_last_call,
       prior_cease_count, days_since_last_cease,
       monthly_download_mb, monthly_upload_mb, monthly_total_mb, avg_daily_download_mb,
       std_daily_total_mb, active_days_in_month, peak_daily_total_mb, usage_mom_change,
       usage_vs_3mo_avg
FROM customer_info i
LEFT JOIN call_features f ON i.unique_customer_identifier = f.unique_customer_identifier
      AND i.datevalue = f.observation_date
LEFT JOIN cease_history h ON i.unique_customer_identifier = h.unique_customer_identifier
      AND i.datevalue = h.observation_date
LEFT JOIN usage_trends u ON i.unique_customer_identifier = u.unique_customer_identifier
      AND i.datevalue = u.month_key"""


def _probability(b, ws) -> str:
    z = " + ".join([f"CAST({b} AS DOUBLE)"] + [f"coalesce({f}, 0) * CAST({w} AS DOUBLE)"
                                               for f, w in ws.items()])
    return f"round(1.0 / (1.0 + exp(-({z}))), 6)"


def _scored(shift: float = 0.0) -> str:
    from tidemark.plans.scoring import SCORECARD
    parts = [f"{_probability(b + shift, ws)} AS churn_prob_{h}d" for h, (b, ws) in SCORECARD.items()]
    return ("""
SELECT i.unique_customer_identifier, i.datevalue AS observation_date, technology, sales_channel,
       contract_status_ord, speed_gap_pct, tenure_days, calls_90d, complaint_calls_90d,
       prior_cease_count, """ + ", ".join(parts) + """
FROM customer_info i
JOIN call_features f ON i.unique_customer_identifier = f.unique_customer_identifier
     AND i.datevalue = f.observation_date
JOIN cease_history h ON i.unique_customer_identifier = h.unique_customer_identifier
     AND i.datevalue = h.observation_date""")


BLOCKS["scored"] = _scored()
ALARMING = 1.5          # added to every intercept, a run that sets off alerts
BLOCKS["alarming"] = _scored(ALARMING)

TIER = """CASE WHEN churn_prob_30d > 0.5 THEN 'RED' WHEN churn_prob_60d > 0.5 THEN 'AMBER'
     WHEN churn_prob_90d > 0.5 THEN 'YELLOW' ELSE 'GREEN' END"""

BLOCKS["alarming_tiered"] = f"SELECT *, observation_date AS score_date, {TIER} AS risk_tier FROM alarming"
BLOCKS["tiered"] = f"SELECT *, observation_date AS score_date, {TIER} AS risk_tier FROM scored"

_EDGES = ", ".join(
    f"list_sort(list_distinct(quantile_cont(churn_prob_{h}d, "
    f"[0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]))) AS e{h}" for h in H)
BLOCKS["decile_edges"] = f"SELECT {_EDGES} FROM tiered"

BLOCKS["scores"] = ("SELECT unique_customer_identifier, observation_date, score_date, risk_tier, "
                    "churn_prob_30d, churn_prob_60d, churn_prob_90d, " + ", ".join(
                        f"CASE WHEN len(e{h}) > 1 THEN CAST(greatest(1, len(list_filter(e{h}, "
                        f"lambda x: x < churn_prob_{h}d))) AS INTEGER) END AS risk_decile_{h}d" for h in H)
                    + " FROM tiered, decile_edges")

BLOCKS["judged"] = """
SELECT s.*, l.churned_in_30d, l.churned_in_60d, l.churned_in_90d
FROM tiered s JOIN horizon_labels l ON s.unique_customer_identifier = l.unique_customer_identifier
     AND s.observation_date = l.observation_date"""

BLOCKS["long_judged"] = " UNION ALL ".join(
    f"SELECT {h} AS horizon, observation_date, churn_prob_{h}d AS score, churned_in_{h}d AS y FROM judged"
    for h in H)

BLOCKS["hist"] = """
SELECT horizon, score, CAST(sum(y) AS BIGINT) AS pos, CAST(sum(1 - y) AS BIGINT) AS neg
FROM long_judged GROUP BY 1, 2"""

BLOCKS["curve"] = """
SELECT *, CAST(sum(pos) OVER (PARTITION BY horizon ORDER BY score DESC) AS DOUBLE) AS tp,
       CAST(sum(neg) OVER (PARTITION BY horizon ORDER BY score DESC) AS DOUBLE) AS fp,
       CAST(sum(pos) OVER (PARTITION BY horizon) AS DOUBLE) AS p,
       CAST(sum(neg) OVER (PARTITION BY horizon) AS DOUBLE) AS n
FROM hist"""

BLOCKS["request_log"] = """
SELECT event_id, ts, CASE WHEN k % 2 = 0 THEN '/predict' ELSE '/predict/batch' END AS endpoint,
       CASE WHEN event_type = 'error' AND k < 30 THEN 'error' ELSE 'success' END AS status,
       value / 50 AS latency_seconds, event_type AS tier
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events)"""

# every window of five minutes, stepping by one, that holds a request
BLOCKS["windowed_log"] = """
SELECT l.*, date_trunc('minute', ts) - s * INTERVAL 1 MINUTE AS window_start,
       date_trunc('minute', ts) - s * INTERVAL 1 MINUTE + INTERVAL 5 MINUTE AS window_end
FROM request_log l, (SELECT unnest([0, 1, 2, 3, 4]) AS s)"""


def with_blocks(body: str) -> str:
    """``body`` behind a WITH clause of all blocks it needs, directly or not."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in BLOCKS:
            if name not in needed and re.search(rf"(?<![\w.]){name}(?![\w(])", text):
                visit(BLOCKS[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    joined = ",\n".join(f"{n} AS ({BLOCKS[n].strip()})" for n in needed)
    rest = body.strip()
    if rest.startswith("WITH "):
        return f"WITH {joined},\n{rest.removeprefix('WITH ')}"
    return f"WITH {joined}\n{rest}"
