"""Aggregations and exploratory reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.contract import HORIZONS, OBSERVED
from tidemark.functions import columns as C
from tidemark.functions import risk as R
from tidemark.operators import actions, evaluation, monitor, profile, quantiles, temporal
from tidemark.plans.cleaning import clean_calls
from tidemark.sources import given
from tidemark.sources.tables import materialise
from tidemark.workload import inputs
from tidemark.workload.registry import query, rounded

ID = "unique_customer_identifier"
_RATES = ", ".join(f"round(avg(churned_in_{h}d), 6) AS churn_rate_{h}d" for h in HORIZONS)
_RATE_NAMES = [f"churn_rate_{h}d" for h in HORIZONS]


def _labels(spark, d):
    return temporal.horizon_labels(inputs.spine(spark, d), given.cease_days(spark, d))


@query("agg_label_rates_by_month", f"""
SELECT observation_date, count(*) AS rows, {_RATES} FROM horizon_labels GROUP BY 1""")
def _(spark, d):
    return rounded(temporal.label_rates(_labels(spark, d), [OBSERVED]), 6, *_RATE_NAMES)


@query("agg_global_rates", f"SELECT count(*) AS rows, {_RATES} FROM horizon_labels")
def _(spark, d):
    return rounded(temporal.label_rates(_labels(spark, d)), 6, *_RATE_NAMES)


@query("agg_split_rates", f"""
SELECT CASE WHEN observation_date < DATE '{given.TRAIN_END}' THEN 'train'
            WHEN observation_date < DATE '{given.VALIDATION_END}' THEN 'validation' ELSE 'test' END
       AS split, count(*) AS rows, {_RATES} FROM horizon_labels GROUP BY 1""")
def _(spark, d):
    split = C.split_label(OBSERVED, given.TRAIN_END, given.VALIDATION_END)
    return rounded(temporal.label_rates(_labels(spark, d).withColumn("split", split), ["split"]),
                   6, *_RATE_NAMES)


@query("agg_monthly_rollup", """
SELECT * REPLACE (round(avg_daily_download_mb, 4) AS avg_daily_download_mb,
  round(avg_daily_upload_mb, 4) AS avg_daily_upload_mb,
  round(avg_daily_total_mb, 4) AS avg_daily_total_mb,
  round(std_daily_total_mb, 3) AS std_daily_total_mb) FROM usage_monthly""")
def _(spark, d):
    return rounded(rounded(inputs.usage_monthly(spark, d), 4, "avg_daily_download_mb",
                           "avg_daily_upload_mb", "avg_daily_total_mb"), 3, "std_daily_total_mb")


@query("agg_distinct_by_group", f"""
SELECT technology, count(DISTINCT {ID}) AS unique_customers, count(*) AS total_rows
FROM raw_customer_info GROUP BY 1""")
def _(spark, d):
    return profile.distinct_by(given.raw_customer_info(spark, d), "technology")


@query("agg_frequency", """
SELECT contract_status, count(*) AS count FROM raw_customer_info GROUP BY 1""")
def _(spark, d):
    return profile.frequency(given.raw_customer_info(spark, d), "contract_status")


@query("agg_reason_frequency", """
SELECT reason_description_insight, count(*) AS count FROM raw_cease GROUP BY 1""")
def _(spark, d):
    return profile.frequency(given.raw_cease(spark, d), "reason_description_insight")


@query("agg_completion_frequency", """
SELECT CASE WHEN is_completed = 1 THEN 'Completed' ELSE 'Pending/Retracted' END AS completion,
       count(*) AS count FROM cease GROUP BY 1""")
def _(spark, d):
    return (inputs.cease(spark, d)
            .groupBy(C.completion_text("cease_completed_date").alias("completion"))
            .agg(F.count("*").alias("count")))


@query("agg_group_means", """
SELECT call_type, count(*) AS call_count, round(avg(talk_time_seconds), 4) AS avg_talk_time,
       round(avg(hold_time_seconds), 4) AS avg_hold_time FROM raw_calls GROUP BY 1""")
def _(spark, d):
    out = profile.group_means(given.raw_calls(spark, d), "call_type",
                              {"avg_talk_time": "talk_time_seconds",
                               "avg_hold_time": "hold_time_seconds"}, "call_count")
    return rounded(out, 4, "avg_talk_time", "avg_hold_time")


@query("agg_gap_by_technology", """
SELECT technology, round(avg(speed_gap_pct), 6) AS avg_gap, count(*) AS rows FROM customer_info GROUP BY 1""")
def _(spark, d):
    return rounded(profile.group_means(inputs.customer_info(spark, d), "technology",
                                       {"avg_gap": "speed_gap_pct"}, "rows"), 6, "avg_gap")


@query("agg_rates_by_snapshot", """
SELECT datevalue, count(*) AS rows, round(avg(contract_dd_cancels), 6) AS dd_cancel_rate,
       round(avg(dd_cancel_60_day), 6) AS dd_cancel_60d_rate FROM raw_customer_info GROUP BY 1""")
def _(spark, d):
    out = profile.group_means(given.raw_customer_info(spark, d), "datevalue",
                              {"dd_cancel_rate": "contract_dd_cancels",
                               "dd_cancel_60d_rate": "dd_cancel_60_day"}, "rows")
    return rounded(out, 6, "dd_cancel_rate", "dd_cancel_60d_rate")


@query("agg_usage_by_month", """
SELECT month_key AS month, round(avg(usage_download_mbs), 4) AS avg_daily_download_mb,
       count(*) AS records FROM usage_daily GROUP BY 1""")
def _(spark, d):
    out = profile.group_means(
        inputs.usage_daily(spark, d).withColumnRenamed("month_key", "month"), "month",
        {"avg_daily_download_mb": "usage_download_mbs"}, "records")
    return rounded(out, 4, "avg_daily_download_mb")


@query("agg_monthly_volume", """
SELECT cease_month, count(*) AS cease_count FROM cease GROUP BY 1""")
def _(spark, d):
    return profile.monthly_volume(given.raw_cease(spark, d), "cease_placed_date", "cease_month",
                                  "cease_count")


@query("agg_count_of_counts", f"""
SELECT cease_count, count(*) AS customers FROM (SELECT count(*) AS cease_count FROM cease_days
  GROUP BY {ID} HAVING count(*) > 1) GROUP BY 1""")
def _(spark, d):
    return profile.count_of_counts(given.cease_days(spark, d), more_than=1)


_NULL_COLUMNS = (ID, "datevalue", "contract_status", "contract_dd_cancels", "dd_cancel_60_day",
                 "ooc_days", "technology", "speed", "line_speed", "sales_channel",
                 "crm_package_name", "tenure_days")


@query("agg_null_report", " UNION ALL ".join(
    f"SELECT 'customer_info' AS dataset, '{c}' AS \"column\", "
    f"count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
    f"round(count(*) FILTER (WHERE {c} IS NULL) / count(*) * 100, 2) AS null_pct FROM raw_customer_info"
    for c in _NULL_COLUMNS))
def _(spark, d):
    return profile.null_report(given.raw_customer_info(spark, d), "customer_info")


@query("agg_summary", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean,
    round(stddev_samp({c}), 3) AS stddev, min({c}) AS min, round(quantile_cont({c}, 0.25), 4) AS p25,
    round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.75), 4) AS p75,
    max({c}) AS max FROM usage_daily""" for c in ("usage_download_mbs", "usage_upload_mbs")))
def _(spark, d):
    columns = ["usage_download_mbs", "usage_upload_mbs"]
    out = profile.summary(materialise(inputs.usage_daily(spark, d).select(*columns)), columns)
    return rounded(rounded(out, 4, "mean", "p25", "p50", "p75"), 3, "stddev")


@query("agg_histogram", """
SELECT CAST(least(floor((least(greatest(talk_time_seconds, 0), 5000) - 0) / 62.5), 79) AS INTEGER) AS bin,
       count(*) AS count,
       CAST(least(floor(least(greatest(talk_time_seconds, 0), 5000) / 62.5), 79) AS INTEGER) * CAST(62.5 AS DOUBLE)
         AS bin_low FROM raw_calls GROUP BY 1, 3""")
def _(spark, d):
    return quantiles.histogram(given.raw_calls(spark, d), "talk_time_seconds", 0, 5000, 80)


@query("agg_score_histogram", """
SELECT horizon, CAST(least(floor(p / CAST(0.02 AS DOUBLE)), 49) AS INTEGER) AS bin, count(*) AS count
FROM (SELECT '30-day' AS horizon, churn_prob_30d AS p FROM scored UNION ALL
      SELECT '60-day', churn_prob_60d FROM scored UNION ALL SELECT '90-day', churn_prob_90d FROM scored)
GROUP BY 1, 2""")
def _(spark, d):
    long = actions.long_probabilities(inputs.scored(spark, d))
    return quantiles.histogram(long, "probability", 0, 1, 50, by=["horizon"]).drop("bin_low")


def _tiered(spark, d):
    return (inputs.scored(spark, d).withColumn("risk_tier", R.risk_tier())
            .withColumn("score_date", F.col(OBSERVED)))


@query("agg_tier_distribution", """
SELECT t AS risk_tier, count(risk_tier) AS count,
       round(count(risk_tier) * 100.0::DOUBLE / (SELECT count(*) FROM tiered), 4) AS pct
FROM (SELECT unnest(['RED', 'AMBER', 'YELLOW', 'GREEN']) AS t) LEFT JOIN tiered ON t = risk_tier
GROUP BY 1""")
def _(spark, d):
    return actions.tier_distribution(_tiered(spark, d))


@query("agg_class_weight", " UNION ALL ".join(
    f"SELECT {h} AS horizon, CAST(sum(churned_in_{h}d) AS BIGINT) AS positives, "
    f"CAST(sum(1 - churned_in_{h}d) AS BIGINT) AS negatives, "
    f"round(sum(1 - churned_in_{h}d) / greatest(sum(churned_in_{h}d), 1), 6) AS pos_weight "
    f"FROM horizon_labels" for h in HORIZONS))
def _(spark, d):
    return rounded(evaluation.class_weights(_labels(spark, d)), 6, "pos_weight")


@query("agg_tier_heatmap", f"""
SELECT risk_tier, {', '.join(f'round(avg(churn_prob_{h}d), 10) AS avg_{h}d' for h in HORIZONS)}
FROM tiered GROUP BY 1""")
def _(spark, d):
    return rounded(actions.tier_heatmap(_tiered(spark, d)), 10, *[f"avg_{h}d" for h in HORIZONS])


@query("agg_score_trend", """
SELECT score_date, horizon, round(avg(p), 10) AS mean_probability,
       round(stddev_samp(p), 8) AS std_probability, round(median(p), 8) AS median_probability
FROM (SELECT score_date, 30 AS horizon, churn_prob_30d AS p FROM tiered UNION ALL
      SELECT score_date, 60, churn_prob_60d FROM tiered UNION ALL
      SELECT score_date, 90, churn_prob_90d FROM tiered) GROUP BY 1, 2""")
def _(spark, d):
    return rounded(rounded(actions.score_trend(_tiered(spark, d)), 10, "mean_probability"), 8,
                   "std_probability", "median_probability")


_LONG_SCORES = " UNION ALL ".join(
    f"SELECT {h} AS horizon, risk_decile_{h}d AS decile, churn_prob_{h}d AS p FROM scores"
    for h in HORIZONS)


@query("agg_decile_means", f"""
SELECT horizon, decile, round(avg(p), 10) AS avg_probability, count(*) AS count
FROM ({_LONG_SCORES}) GROUP BY 1, 2""")
def _(spark, d):
    return rounded(actions.decile_means(inputs.scores(spark, d)), 10, "avg_probability")


@query("ml_prediction_summary", f"""
SELECT horizon, round(avg(p), 10) AS mean_probability,
       round(avg(p) FILTER (WHERE decile = top), 10) AS top_decile_mean
FROM (SELECT *, max(decile) OVER (PARTITION BY horizon) AS top FROM ({_LONG_SCORES})) GROUP BY 1""")
def _(spark, d):
    return rounded(actions.prediction_summary(inputs.scores(spark, d)), 10,
                   "mean_probability", "top_decile_mean")


@query("agg_action_summary", """
SELECT risk_tier, count(*) AS customers, round(avg(CASE risk_tier WHEN 'RED' THEN churn_prob_30d
       WHEN 'AMBER' THEN churn_prob_60d ELSE churn_prob_90d END), 10) AS avg_own_probability
FROM tiered WHERE risk_tier <> 'GREEN' GROUP BY 1""")
def _(spark, d):
    return rounded(actions.action_summary(_tiered(spark, d)), 10, "avg_own_probability")


_SLICE_STATS = """count(v) AS count, round(avg(CASE WHEN v IS NULL THEN 1.0::DOUBLE ELSE 0 END), 6) AS null_rate,
 round(avg(v), 4) AS mean, round(stddev_samp(v), 3) AS std, min(v) AS min,
 quantile_disc(v, 0.25) AS p25, quantile_disc(v, 0.5) AS median, quantile_disc(v, 0.75) AS p75,
 max(v) AS max"""
_PROFILED = ("ooc_days", "speed", "tenure_days", "contract_dd_cancels")
_SLICED = " UNION ALL ".join(
    f"""SELECT date_trunc('month', datevalue)::DATE AS month, {k} AS slice_key, {v} AS slice_value,
    '{f}' AS feature, {_SLICE_STATS}
    FROM (SELECT *, CAST(nullif({f}, -9999) AS DOUBLE) AS v FROM customer_info) GROUP BY 1, 2, 3"""
    for f in _PROFILED for k, v in (("'all'", "'all'"), ("'technology'", "technology"),
                                    ("'sales_channel'", "sales_channel")))


@query("agg_sliced_profile", _SLICED)
def _(spark, d):
    info = inputs.customer_info(spark, d).withColumn("ooc_days", F.nullif("ooc_days", F.lit(-9999.0)))
    out = monitor.feature_profile(info, _PROFILED, date="datevalue")
    return rounded(rounded(rounded(out, 4, "mean"), 6, "null_rate"), 3, "std")


@query("agg_clean_calls_by_flag", """
SELECT is_loyalty_call, is_complaint_call, is_tech_call, count(*) AS count FROM calls GROUP BY 1, 2, 3""")
def _(spark, d):
    return (clean_calls(given.raw_calls(spark, d))
            .groupBy("is_loyalty_call", "is_complaint_call", "is_tech_call")
            .agg(F.count("*").alias("count")))
