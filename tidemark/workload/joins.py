"""Point-in-time joins, assembly, semi and anti joins, windows, sorts and sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.contract import ENTITY, HORIZONS, OBSERVED, TREND_FEATURES, USAGE_FEATURES
from tidemark.functions import risk as R
from tidemark.operators import actions, assemble, rollup, setops, temporal
from tidemark.operators.evaluation import linear_attribution, rank_shift, top_features
from tidemark.plans.features import feature_table, training_set
from tidemark.plans.scoring import SCORECARD
from tidemark.sources import given
from tidemark.sources.tables import materialise
from tidemark.workload import inputs
from tidemark.workload.registry import query, rounded

ID = "unique_customer_identifier"
_WIDE = ("line_speed", "avg_talk_time", "avg_hold_time", "monthly_download_mb",
         "monthly_upload_mb", "monthly_total_mb", "avg_daily_download_mb", "std_daily_total_mb",
         "peak_daily_total_mb")
_FINE = ("usage_mom_change", "usage_vs_3mo_avg")
_REPLACED = ", ".join([f"round({c}, 3) AS {c}" for c in _WIDE]
                      + [f"round({c}, 6) AS {c}" for c in _FINE])


def _plain(df):
    return rounded(rounded(df, 3, *_WIDE), 6, *_FINE)


@query("jon_horizon_labels", "SELECT * FROM horizon_labels")
def _(spark, d):
    return temporal.horizon_labels(inputs.spine(spark, d), given.cease_days(spark, d))


@query("jon_lookback_counts", """
SELECT * REPLACE (round(avg_talk_time, 4) AS avg_talk_time, round(avg_hold_time, 4) AS avg_hold_time)
FROM call_features""")
def _(spark, d):
    out = temporal.lookback_features(inputs.spine(spark, d), inputs.calls(spark, d))
    return rounded(out, 4, "avg_talk_time", "avg_hold_time")


@query("jon_event_lookback", """
SELECT s.e AS unique_customer_identifier, s.day AS observation_date,
  count(*) FILTER (WHERE c.day >= s.day - 3) AS calls_3d,
  count(*) FILTER (WHERE c.day >= s.day - 7) AS calls_7d, count(c.day) AS calls_14d,
  count(*) FILTER (WHERE c.day >= s.day - 7 AND event_type = 'purchase') AS purchase_calls_7d
FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS e, CAST(ts AS DATE) AS day FROM events) s
LEFT JOIN (SELECT CAST(user_id AS VARCHAR) AS e, CAST(ts AS DATE) AS day, event_type FROM events) c
  ON s.e = c.e AND c.day < s.day AND c.day >= s.day - 14
GROUP BY 1, 2""")
def _(spark, d):
    events = given.table(spark, d, "events").select(
        F.col("user_id").cast("string").alias(ENTITY), F.col("ts").cast("date").alias("event_date"),
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("is_purchase_call"),
        F.col("value").alias("talk_time_seconds"),
        F.get_json_object("props", "$.k").cast("int").alias("hold_time_seconds"))
    spine = temporal.observation_spine(events, "event_date")
    return temporal.lookback_features(
        spine, events, windows=(3, 7, 14), type_window=7, flags=("is_purchase_call",)).select(
        ENTITY, OBSERVED, "calls_3d", "calls_7d", "calls_14d", "purchase_calls_7d")


@query("jon_prior_history", "SELECT * FROM cease_history")
def _(spark, d):
    return temporal.prior_history(inputs.spine(spark, d), given.cease_days(spark, d))


@query("jon_asof_last_event", f"""
SELECT s.{ID}, s.observation_date, max(c.event_date) AS last_event_date
FROM spine s LEFT JOIN calls c ON s.{ID} = c.{ID} AND c.event_date < s.observation_date
     AND c.event_date >= s.observation_date - 180
GROUP BY 1, 2""")
def _(spark, d):
    recent = temporal.lookback_features(inputs.spine(spark, d), inputs.calls(spark, d))
    return recent.select(ENTITY, OBSERVED,
                         F.date_sub(OBSERVED, F.col("days_since_last_call")).alias("last_event_date"))


@query("jon_snapshot_month", f"""
SELECT s.{ID}, s.observation_date, u.monthly_download_mb, u.monthly_upload_mb, u.monthly_total_mb,
       round(u.avg_daily_download_mb, 4) AS avg_daily_download_mb,
       round(u.std_daily_total_mb, 3) AS std_daily_total_mb, u.active_days_in_month,
       u.peak_daily_total_mb
FROM spine s LEFT JOIN usage_monthly u ON s.{ID} = u.{ID} AND s.observation_date = u.month_key""")
def _(spark, d):
    out = rollup.join_month(inputs.spine(spark, d), inputs.usage_monthly(spark, d), USAGE_FEATURES)
    return rounded(rounded(out, 4, "avg_daily_download_mb"), 3, "std_daily_total_mb")


@query("jon_snapshot_closed_month", f"""
SELECT s.{ID}, s.observation_date, u.monthly_total_mb, u.active_days_in_month
FROM spine s LEFT JOIN usage_monthly u ON s.{ID} = u.{ID}
     AND CAST(s.observation_date - INTERVAL 1 MONTH AS DATE) = u.month_key""")
def _(spark, d):
    return rollup.join_month(inputs.spine(spark, d), inputs.usage_monthly(spark, d),
                             ["monthly_total_mb", "active_days_in_month"], month_offset=-1)


@query("jon_assemble_features", f"SELECT * REPLACE ({_REPLACED}) FROM features")
def _(spark, d):
    return _plain(feature_table(
        inputs.customer_info(spark, d), inputs.calls(spark, d), given.cease_days(spark, d),
        inputs.usage_monthly(spark, d), unique=True))


@query("jon_wide_chain", f"""
SELECT s.*, f.calls_180d, h.prior_cease_count, l.churned_in_30d
FROM spine s LEFT JOIN call_features f USING ({ID}, observation_date)
LEFT JOIN cease_history h USING ({ID}, observation_date)
LEFT JOIN horizon_labels l USING ({ID}, observation_date)""")
def _(spark, d):
    spine, ceases = inputs.spine(spark, d), given.cease_days(spark, d)
    parts = [temporal.lookback_features(spine, inputs.calls(spark, d))
             .select(ENTITY, OBSERVED, "calls_180d"),
             temporal.prior_history(spine, ceases).select(ENTITY, OBSERVED, "prior_cease_count"),
             temporal.horizon_labels(spine, ceases).select(ENTITY, OBSERVED, "churned_in_30d")]
    return assemble.join_parts(spine, parts)


_SPLIT = (f"CASE WHEN observation_date < DATE '{given.TRAIN_END}' THEN 'train' "
          f"WHEN observation_date < DATE '{given.VALIDATION_END}' THEN 'validation' ELSE 'test' END")


@query("jon_training_set", f"""
SELECT f.* REPLACE ({_REPLACED}), churned_in_30d, churned_in_60d, churned_in_90d,
       {_SPLIT.replace('observation_date', 'f.observation_date')} AS split
FROM features f JOIN horizon_labels l ON f.{ID} = l.{ID} AND f.observation_date = l.observation_date""")
def _(spark, d):
    return _plain(training_set(
        inputs.customer_info(spark, d), inputs.calls(spark, d), given.cease_days(spark, d),
        inputs.usage_monthly(spark, d), given.TRAIN_END, given.VALIDATION_END, unique=True))


@query("jon_features_labels", f"""
SELECT h.*, churned_in_30d, churned_in_60d, churned_in_90d,
       {_SPLIT.replace('observation_date', 'h.observation_date')} AS split
FROM cease_history h JOIN horizon_labels l ON h.{ID} = l.{ID} AND h.observation_date = l.observation_date""")
def _(spark, d):
    spine, ceases = inputs.spine(spark, d), given.cease_days(spark, d)
    return assemble.join_labels(temporal.prior_history(spine, ceases),
                                temporal.horizon_labels(spine, ceases),
                                train_end=given.TRAIN_END, validation_end=given.VALIDATION_END)


@query("jon_pred_vs_actual", f"""
SELECT {ID}, score_date, churn_prob_30d, churn_prob_90d, churned_in_30d, churned_in_90d FROM judged""")
def _(spark, d):
    scores = inputs.scored(spark, d).select(
        ENTITY, F.col(OBSERVED).alias("score_date"), "churn_prob_30d", "churn_prob_90d")
    return temporal.horizon_labels(scores, given.cease_days(spark, d), (30, 90),
                                   observed="score_date")


_FANOUT = " JOIN ".join(
    f"""(SELECT s.observation_date AS snapshot_month, count(*) AS total_{h}d,
     count(c.cease_placed_date) AS churned_{h}d,
     round(count(c.cease_placed_date) / count(*) * 100, 2) AS churn_rate_{h}d
     FROM spine s LEFT JOIN cease_days c ON s.{ID} = c.{ID}
     AND c.cease_placed_date >= s.observation_date AND c.cease_placed_date < s.observation_date + {h}
     GROUP BY 1) t{h}""" + ("" if h == 30 else " USING (snapshot_month)") for h in HORIZONS)


@query("jon_snapshot_rate_fanout", f"SELECT * FROM {_FANOUT}")
def _(spark, d):
    return temporal.snapshot_rates(inputs.spine(spark, d), given.cease_days(spark, d))


@query("jon_semi_sample", f"""
SELECT {ID}, event_date, call_type FROM raw_calls WHERE {ID} IN (SELECT {ID} FROM cease_days)""")
def _(spark, d):
    return assemble.restrict_to(given.raw_calls(spark, d), given.cease_days(spark, d)).select(
        ENTITY, "event_date", "call_type")


@query("jon_never_churned", f"""
SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS {ID} FROM customer
WHERE CAST(c_custkey AS VARCHAR) NOT IN (SELECT {ID} FROM cease_days)""")
def _(spark, d):
    everyone = given.table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias(ENTITY))
    return assemble.never_in(everyone, given.cease_days(spark, d))


@query("jon_tier_domain", """
SELECT t AS risk_tier, count(risk_tier) AS count
FROM (SELECT unnest(['RED', 'AMBER', 'YELLOW', 'GREEN']) AS t)
LEFT JOIN (SELECT risk_tier FROM tiered WHERE churn_prob_30d > 0.9) ON t = risk_tier GROUP BY 1""")
def _(spark, d):
    high = (inputs.scored(spark, d).where(F.col("churn_prob_30d") > 0.9)
            .groupBy(R.risk_tier().alias("risk_tier")).agg(F.count("*").alias("count")))
    return assemble.complete_domain(high, "risk_tier", ("RED", "AMBER", "YELLOW", "GREEN"), ["count"])


@query("win_usage_trends", f"""
SELECT {ID}, month_key, monthly_total_mb, prev_month_total,
       round(prev_3mo_avg_total, 3) AS prev_3mo_avg_total,
       round(usage_mom_change, 6) AS usage_mom_change, round(usage_vs_3mo_avg, 6) AS usage_vs_3mo_avg
FROM usage_trends""")
def _(spark, d):
    out = rollup.usage_trends(inputs.usage_monthly(spark, d)).select(
        ENTITY, "month_key", "monthly_total_mb", "prev_month_total", "prev_3mo_avg_total",
        *TREND_FEATURES)
    return rounded(rounded(out, 3, "prev_3mo_avg_total"), 6, *TREND_FEATURES)


@query("win_calendar_trends", f"""
SELECT a.{ID}, a.month_key, p.monthly_total_mb AS prev_month_total,
  round((SELECT avg(q.monthly_total_mb) FROM usage_monthly q WHERE q.{ID} = a.{ID}
   AND q.month_key < a.month_key AND q.month_key >= a.month_key - INTERVAL 3 MONTH), 3)
   AS prev_3mo_avg_total
FROM usage_monthly a LEFT JOIN usage_monthly p ON p.{ID} = a.{ID}
  AND p.month_key = a.month_key - INTERVAL 1 MONTH""")
def _(spark, d):
    out = rollup.usage_trends(inputs.usage_monthly(spark, d), calendar=True).select(
        ENTITY, "month_key", "prev_month_total", "prev_3mo_avg_total")
    return rounded(out, 3, "prev_3mo_avg_total")


@query("win_quantile_bin", f"""
SELECT {ID}, score_date, risk_tier, risk_decile_30d, risk_decile_60d, risk_decile_90d FROM scores""")
def _(spark, d):
    return inputs.scores(spark, d).select(
        ENTITY, "score_date", "risk_tier", *[f"risk_decile_{h}d" for h in HORIZONS])


_IMPORTANCE = " UNION ALL ".join(
    f"SELECT {h} AS horizon, '{f}' AS feature, round(avg(abs(x - m)) * {abs(w)}, 8) AS importance FROM "
    f"(SELECT CAST({f} AS DOUBLE) AS x, avg({f}) OVER () AS m FROM scored)"
    for h, (_, ws) in SCORECARD.items() for f, w in ws.items())


def _importance(spark, d):
    weights = {h: ws for h, (_, ws) in SCORECARD.items()}
    return rounded(linear_attribution(materialise(inputs.scored(spark, d)), weights), 8, "importance")


@query("ml_linear_attribution", f"SELECT horizon, feature, round(importance, 6) AS importance FROM ({_IMPORTANCE})")
def _(spark, d):
    return rounded(_importance(spark, d), 6, "importance")


@query("win_rank_shift", f"""
WITH imp AS ({_IMPORTANCE}), r AS (
  SELECT horizon, feature, CAST(floor(rank() OVER (PARTITION BY horizon ORDER BY importance DESC)
    + (count(*) OVER (PARTITION BY horizon, importance) - 1) / 2.0) AS INTEGER) AS rk FROM imp)
SELECT feature, max(rk) FILTER (WHERE horizon = 30) AS rank_30d,
       max(rk) FILTER (WHERE horizon = 60) AS rank_60d, max(rk) FILTER (WHERE horizon = 90) AS rank_90d,
       max(rk) FILTER (WHERE horizon = 30) - max(rk) FILTER (WHERE horizon = 90) AS rank_shift_30_to_90
FROM r GROUP BY 1""")
def _(spark, d):
    return rank_shift(_importance(spark, d))


@query("srt_top_features", f"""
SELECT feature, round(avg(importance), 6) AS overall_avg FROM ({_IMPORTANCE}) GROUP BY 1
ORDER BY 2 DESC, 1 LIMIT 15""")
def _(spark, d):
    return rounded(top_features(_importance(spark, d)), 6, "overall_avg")


@query("win_dedup", """
SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM (
  SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS o_orderdate, o_orderkey, o_totalprice,
    row_number() OVER (PARTITION BY o_custkey, strftime(o_orderdate, '%Y-%m')
                       ORDER BY o_totalprice, o_orderkey) AS r FROM orders) WHERE r = 1""")
def _(spark, d):
    orders = given.table(spark, d, "orders").select(
        "o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("o_orderdate"), "o_orderkey",
        "o_totalprice")
    return assemble.keep_first(orders, ["o_custkey", "o_orderdate"], ["o_totalprice", "o_orderkey"])


@query("srt_topk", f"""
SELECT {ID}, risk_tier, round(churn_prob_30d, 3) AS prob_30d, round(churn_prob_60d, 3) AS prob_60d,
       round(churn_prob_90d, 3) AS prob_90d
FROM tiered WHERE observation_date = (SELECT max(observation_date) FROM tiered)
ORDER BY churn_prob_30d DESC, {ID} LIMIT 20""")
def _(spark, d):
    newest = assemble.latest(inputs.scored(spark, d)).withColumn("risk_tier", R.risk_tier())
    return actions.top_risks(newest)


@query("srt_action_list", f"""
SELECT {ID}, observation_date, risk_tier, churn_prob_60d FROM tiered WHERE risk_tier = 'AMBER'""")
def _(spark, d):
    tiered = inputs.scored(spark, d).withColumn("risk_tier", R.risk_tier())
    return actions.action_list(tiered, "AMBER").select(ENTITY, OBSERVED, "risk_tier", "churn_prob_60d")


@query("srt_action_ranks", f"""
SELECT {ID}, observation_date, risk_tier, own AS own_probability,
       rank() OVER (PARTITION BY risk_tier ORDER BY own DESC) AS priority
FROM (SELECT *, CASE risk_tier WHEN 'RED' THEN churn_prob_30d WHEN 'AMBER' THEN churn_prob_60d
        ELSE churn_prob_90d END AS own FROM tiered WHERE risk_tier <> 'GREEN')""")
def _(spark, d):
    tiered = inputs.scored(spark, d).withColumn("risk_tier", R.risk_tier())
    return actions.action_ranks(tiered).select(
        ENTITY, OBSERVED, "risk_tier", "own_probability", "priority")


@query("set_spine", "SELECT * FROM spine")
def _(spark, d):
    return inputs.spine(spark, d)


@query("set_overlap", """
SELECT (SELECT count(*) FROM customer) AS n_customers,
  (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_orderstatus = 'F') AS n_ceases,
  (SELECT count(DISTINCT user_id) FROM events) AS n_calls,
  (SELECT count(*) FROM (SELECT c_custkey FROM customer INTERSECT
     SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT user_id FROM events))
     AS n_in_all,
  (SELECT count(*) FROM (SELECT c_custkey FROM customer EXCEPT
     SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT user_id FROM events))
     AS n_customers_only""")
def _(spark, d):
    return setops.overlap_report(_three_sets(spark, d))


def _three_sets(spark, d):
    return {"customers": given.table(spark, d, "customer").select(
                F.col("c_custkey").cast("string").alias(ENTITY)),
            "ceases": given.cease_days(spark, d),
            "calls": given.table(spark, d, "events").select(
                F.col("user_id").cast("string").alias(ENTITY))}


@query("set_intersect", f"""
SELECT CAST(c_custkey AS VARCHAR) AS {ID} FROM customer INTERSECT
SELECT {ID} FROM cease_days INTERSECT SELECT CAST(user_id AS VARCHAR) FROM events""")
def _(spark, d):
    return setops.in_all(list(_three_sets(spark, d).values()))


@query("set_subtract", f"""
SELECT CAST(c_custkey AS VARCHAR) AS {ID} FROM customer EXCEPT
SELECT {ID} FROM cease_days EXCEPT SELECT CAST(user_id AS VARCHAR) FROM events""")
def _(spark, d):
    return setops.only_in_first(list(_three_sets(spark, d).values()))


@query("set_union_horizons", f"""
SELECT {ID}, observation_date, '30-day' AS horizon, churn_prob_30d AS probability FROM scored UNION ALL
SELECT {ID}, observation_date, '60-day', churn_prob_60d FROM scored UNION ALL
SELECT {ID}, observation_date, '90-day', churn_prob_90d FROM scored""")
def _(spark, d):
    return actions.long_probabilities(inputs.scored(spark, d), [ENTITY, OBSERVED])
