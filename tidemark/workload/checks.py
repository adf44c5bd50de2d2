"""Data quality, table reports, model evaluation, monitoring and the request log."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import contract
from tidemark.contract import ENTITY, HORIZONS, OBSERVED
from tidemark.functions import risk as R
from tidemark.functions.columns import split_label
from tidemark.operators import evaluation, monitor, quality, requests, temporal
from tidemark.plans import training
from tidemark.sources import given
from tidemark.sources.tables import materialise
from tidemark.workload import inputs
from tidemark.workload.ctes import ALARMING
from tidemark.workload.registry import query, rounded, stamped

ID = "unique_customer_identifier"


def _lines(table, block, checks):
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c.name}' AS rule, count(*) AS total_rows, "
        f"count(*) FILTER (WHERE {c.bad}) AS violations, CASE WHEN count(*) FILTER (WHERE {c.bad}) = 0 "
        f"THEN 'PASS' ELSE '{c.verdict.upper()}' END AS status FROM {block}" for c in checks)


@query("dq_report", " UNION ALL ".join([
    _lines("customer_info", "customer_info", quality.SNAPSHOT_CHECKS),
    _lines("usage_daily", "usage_daily", quality.USAGE_CHECKS),
    _lines("calls", "calls", quality.CALL_CHECKS),
    _lines("cease", "cease", quality.CEASE_CHECKS)]))
def _(spark, d):
    return (quality.report(inputs.customer_info(spark, d), quality.SNAPSHOT_CHECKS, "customer_info")
            .unionByName(quality.report(inputs.usage_daily(spark, d), quality.USAGE_CHECKS, "usage_daily"))
            .unionByName(quality.report(inputs.calls(spark, d), quality.CALL_CHECKS, "calls"))
            .unionByName(quality.report(inputs.cease(spark, d), quality.CEASE_CHECKS, "cease")))


@query("dq_expectations", " UNION ALL ".join(
    f"SELECT 'customer_info' AS table_name, '{r.name}' AS rule, count(*) AS total_rows, "
    f"count(*) FILTER (WHERE NOT coalesce({r.condition}, false)) AS violations, CASE WHEN "
    f"count(*) FILTER (WHERE NOT coalesce({r.condition}, false)) = 0 THEN 'PASS' "
    f"ELSE '{r.severity.upper()}' END AS status FROM customer_info" for r in quality.SNAPSHOT_RULES))
def _(spark, d):
    return quality.violations(inputs.customer_info(spark, d), quality.SNAPSHOT_RULES, "customer_info")


@query("dq_drop", f"SELECT {ID}, datevalue, speed FROM customer_info WHERE speed > 0")
def _(spark, d):
    return quality.enforce(inputs.customer_info(spark, d), quality.SNAPSHOT_RULES).select(
        ENTITY, "datevalue", "speed")


@query("dq_quarantine", f"""
SELECT {ID}, datevalue, 'valid_speed' AS broken FROM customer_info WHERE NOT coalesce(speed > 0, false)""")
def _(spark, d):
    return quality.quarantine(inputs.customer_info(spark, d), quality.SNAPSHOT_RULES).select(
        ENTITY, "datevalue", F.array_join("broken_rules", ",").alias("broken"))


@query("dq_fail_gate", f"SELECT {ID}, calendar_date FROM usage_daily")
def _(spark, d):
    return quality.enforce(inputs.usage_daily(spark, d), quality.USAGE_RULES).select(
        ENTITY, "calendar_date")


_RECORD = f"""
SELECT {ID} AS customer_id, datevalue, CAST(speed * 150 AS DOUBLE) AS speed, speed_gap_pct,
       CAST(tenure_days AS DOUBLE) AS tenure_days, CAST(contract_status_ord AS DOUBLE) AS contract_status_ord,
       CASE WHEN technology = 'WLR' THEN '5G' ELSE technology END AS technology, tenure_bucket
FROM customer_info"""


def _records(spark, d):
    technology = F.col("technology")
    return inputs.customer_info(spark, d).select(
        F.col(ENTITY).alias("customer_id"), "datevalue",
        (F.col("speed") * 150).cast("double").alias("speed"), "speed_gap_pct",
        F.col("tenure_days").cast("double").alias("tenure_days"),
        F.col("contract_status_ord").cast("double").alias("contract_status_ord"),
        F.when(technology == "WLR", "5G").otherwise(technology).alias("technology"),
        "tenure_bucket")


@query("dq_validate_records", f"""
SELECT customer_id, datevalue, array_to_string(list_filter([
    CASE WHEN contract_status_ord < 0 OR contract_status_ord > 6 THEN 'contract_status_ord' END,
    CASE WHEN speed < 0 OR speed > 10000 THEN 'speed' END,
    CASE WHEN speed_gap_pct < -100 OR speed_gap_pct > 100 THEN 'speed_gap_pct' END,
    CASE WHEN tenure_days < 0 OR tenure_days > 36500 THEN 'tenure_days' END,
    CASE WHEN technology NOT IN ('FTTP', 'FTTC', 'MPF', 'WLR', 'Unknown') THEN 'technology' END],
    lambda x: x IS NOT NULL), ',') AS problems
FROM ({_RECORD}) WHERE (speed < 0 OR speed > 10000 OR speed_gap_pct < -100 OR speed_gap_pct > 100
  OR tenure_days < 0 OR tenure_days > 36500 OR technology = '5G')""")
def _(spark, d):
    return quality.rejected_records(_records(spark, d)).select(
        "customer_id", "datevalue", F.array_join("problems", ",").alias("problems"))


@query("dq_pk", """
SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, count(*) AS rows FROM orders
GROUP BY 1, 2 HAVING count(*) > 1""")
def _(spark, d):
    orders = given.table(spark, d, "orders").select(
        "o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    return quality.key_violations(orders, ["o_custkey", "day"])


@query("dq_leakage", f"""
SELECT count(*) FILTER (WHERE last_day >= observation_date) AS leaking, count(last_day) AS checked
FROM (SELECT s.{ID}, s.observation_date, max(c.event_date) AS last_day FROM spine s
      LEFT JOIN calls c ON s.{ID} = c.{ID} AND c.event_date < s.observation_date
           AND c.event_date >= s.observation_date - 180 GROUP BY 1, 2)""")
def _(spark, d):
    recent = temporal.lookback_features(inputs.spine(spark, d), inputs.calls(spark, d)).select(
        OBSERVED, F.date_sub(OBSERVED, F.col("days_since_last_call")).alias("last_day"))
    return recent.agg(F.count_if(F.col("last_day") >= F.col(OBSERVED)).alias("leaking"),
                      F.count("last_day").alias("checked"))


@query("dq_failed_casts", """
SELECT 'usage_download_mbs' AS "column", count(*) FILTER (WHERE usage_download_mbs IS NOT NULL
  AND TRY_CAST(usage_download_mbs AS DOUBLE) IS NULL) AS failed FROM raw_usage UNION ALL
SELECT 'usage_upload_mbs', count(*) FILTER (WHERE usage_upload_mbs IS NOT NULL
  AND TRY_CAST(usage_upload_mbs AS DOUBLE) IS NULL) FROM raw_usage""")
def _(spark, d):
    return quality.failed_casts(given.raw_usage(spark, d), ["usage_download_mbs", "usage_upload_mbs"])


@query("tbl_reconcile", """
SELECT 'orders' AS table_name, (SELECT count(*) FROM orders) AS row_count,
       CAST(15000 AS BIGINT) AS expected,
       CASE WHEN (SELECT count(*) FROM orders) = 15000 THEN 'PASS' ELSE 'WARN' END AS status UNION ALL
SELECT 'events', (SELECT count(*) FROM events), 9999,
       CASE WHEN (SELECT count(*) FROM events) = 9999 THEN 'PASS' ELSE 'WARN' END""")
def _(spark, d):
    return quality.reconcile({n: given.table(spark, d, n) for n in ("orders", "events")},
                             {"orders": 15000, "events": 9999})


@query("tbl_shapes", """
SELECT 'customer_info' AS table_name, count(*) AS rows, 12 AS columns FROM raw_customer_info UNION ALL
SELECT 'usage', count(*), 4 FROM raw_usage UNION ALL SELECT 'calls', count(*), 5 FROM raw_calls
UNION ALL SELECT 'cease', count(*), 4 FROM raw_cease""")
def _(spark, d):
    return quality.shapes({"customer_info": given.raw_customer_info(spark, d),
                           "usage": given.raw_usage(spark, d), "calls": given.raw_calls(spark, d),
                           "cease": given.raw_cease(spark, d)})


# --- model evaluation -------------------------------------------------------

def _hist(spark, d):
    return evaluation.score_histogram(inputs.judged(spark, d))


_METRICS = ("auc_roc", "auc_pr", "actual_churn_rate")


def _plain(metrics):
    return rounded(rounded(metrics, 6, *_METRICS), 10, "predicted_churn_rate")


_METRIC_SQL = """
SELECT horizon, round(sum(neg * (tp - pos / 2.0::DOUBLE)) / (max(p) * max(n)), 6) AS auc_roc,
       round(sum(pos * tp / (tp + fp)) / max(p), 6) AS auc_pr,
       CAST(max(p) + max(n) AS BIGINT) AS n_customers, CAST(max(p) AS BIGINT) AS actual_churn_count,
       round(max(p) / (max(p) + max(n)), 6) AS actual_churn_rate,
       round(sum(score * (pos + neg)) / (max(p) + max(n)), 10) AS predicted_churn_rate
FROM curve GROUP BY 1"""


@query("ml_ranking_metrics", _METRIC_SQL)
def _(spark, d):
    return _plain(evaluation.ranking_metrics(_hist(spark, d)))


# the oracle's scores have six decimals, so both ways must agree
@query("ml_ranking_metrics_unrounded", _METRIC_SQL)
def _(spark, d):
    hist = evaluation.score_histogram(inputs.judged(spark, d), digits=None)
    return _plain(evaluation.ranking_metrics(hist, cells=1024))


@query("ml_auc_pairs", """
SELECT a.horizon, round(sum(a.pos * b.neg * CASE WHEN a.score > b.score THEN 1.0::DOUBLE
   WHEN a.score = b.score THEN 0.5::DOUBLE ELSE 0 END)
   / (sum(a.pos * b.neg)), 6) AS auc_roc
FROM (SELECT horizon, round(score, 2) AS score, sum(pos) AS pos FROM hist GROUP BY 1, 2) a
JOIN (SELECT horizon, round(score, 2) AS score, sum(neg) AS neg FROM hist GROUP BY 1, 2) b
  ON a.horizon = b.horizon GROUP BY 1""")
def _(spark, d):
    coarse = evaluation.score_histogram(inputs.judged(spark, d), digits=2)
    return rounded(evaluation.ranking_metrics(coarse), 6, "auc_roc").select("horizon", "auc_roc")


@query("ml_roc_points", """
SELECT horizon, score AS threshold, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr FROM curve""")
def _(spark, d):
    return rounded(evaluation.roc_points(_hist(spark, d)), 6, "fpr", "tpr")


@query("ml_pr_points", """
SELECT horizon, score AS threshold, round(tp / (tp + fp), 6) AS "precision", round(tp / p, 6) AS recall
FROM curve""")
def _(spark, d):
    return rounded(evaluation.pr_points(_hist(spark, d)), 6, "precision", "recall")


@query("ml_precision_at_recall", """
SELECT horizon, round(max(tp / (tp + fp)), 6) AS precision_at_recall FROM curve
WHERE tp / p >= 0.7::DOUBLE GROUP BY 1""")
def _(spark, d):
    return rounded(evaluation.precision_at_recall(_hist(spark, d)), 6, "precision_at_recall")


_GRID = "[0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]"


@query("ml_calibration", f"""
SELECT horizon, CAST(len(list_filter(e[2:10], lambda x: x < score)) + 1 AS INTEGER) AS bin, count(*) AS count,
       round(avg(score), 10) AS mean_predicted, round(avg(y), 6) AS fraction_positive
FROM long_judged JOIN (SELECT horizon, quantile_cont(score, {_GRID}) AS e FROM long_judged GROUP BY 1)
     USING (horizon) GROUP BY 1, 2""")
def _(spark, d):
    return rounded(rounded(evaluation.calibration_curve(_hist(spark, d)), 10, "mean_predicted"),
                   6, "fraction_positive")


@query("ml_lift", f"""
SELECT horizon, decile, count, round(rate, 6) AS churn_rate, round(rate / base, 6) AS lift,
       decile = max(decile) OVER (PARTITION BY horizon) AS is_top
FROM (SELECT horizon, CAST(greatest(1, len(list_filter(e, lambda x: x < score))) AS INTEGER) AS decile,
             count(*) AS count, avg(y) AS rate, any_value(base) AS base
      FROM long_judged JOIN (SELECT horizon, avg(y) AS base,
           list_sort(list_distinct(quantile_cont(score, {_GRID}))) AS e FROM long_judged GROUP BY 1)
           USING (horizon) GROUP BY 1, 2)""")
def _(spark, d):
    return rounded(evaluation.lift_table(_hist(spark, d)), 6, "churn_rate", "lift")


@query("ml_confusion", " UNION ALL ".join(
    f"SELECT {h} AS horizon, churned_in_{h}d AS actual, CASE WHEN churn_prob_{h}d > 0.5 THEN 1 ELSE 0 END "
    f"AS predicted, count(*) AS count FROM judged GROUP BY 2, 3" for h in HORIZONS))
def _(spark, d):
    return evaluation.confusion(inputs.judged(spark, d))


def _versions(spark, d):
    """A version log from the data: quality per horizon on the train and validation stretches."""
    judged = materialise(inputs.judged(spark, d))
    early = judged.where(F.col(OBSERVED) < F.lit(given.TRAIN_END).cast("date"))
    late = judged.where((F.col(OBSERVED) >= F.lit(given.TRAIN_END).cast("date")) & (F.col("contract_status_ord") > 1))

    def metrics(df):
        return rounded(evaluation.ranking_metrics(evaluation.score_histogram(df)), 6, "auc_pr").select(
            "horizon", F.col("auc_pr").alias("test_auc_pr"))

    log = metrics(early).where(F.col("horizon") > 30).withColumns(
        {"version": F.lit(1), "alias": F.lit("Champion")})
    return metrics(late), log


_LONG_WITH_ORD = " UNION ALL ".join(
    f"SELECT {h} AS horizon, observation_date, contract_status_ord, churn_prob_{h}d AS score, "
    f"churned_in_{h}d AS y FROM judged" for h in HORIZONS)


def _stretch(condition):
    return f"""(SELECT horizon, round(sum(pos * tp / (tp + fp)) / max(p), 6) AS test_auc_pr FROM (
  SELECT *, CAST(sum(pos) OVER w AS DOUBLE) AS tp, CAST(sum(neg) OVER w AS DOUBLE) AS fp,
         CAST(sum(pos) OVER (PARTITION BY horizon) AS DOUBLE) AS p
  FROM (SELECT horizon, score, sum(y) AS pos, sum(1 - y) AS neg
        FROM (SELECT l.* FROM ({_LONG_WITH_ORD}) l WHERE {condition}) GROUP BY 1, 2)
  WINDOW w AS (PARTITION BY horizon ORDER BY score DESC)) GROUP BY 1)"""


_EARLY = _stretch(f"observation_date < DATE '{given.TRAIN_END}'")
_LATE = _stretch(f"observation_date >= DATE '{given.TRAIN_END}' AND contract_status_ord > 1")


@query("ml_gate", f"""
SELECT horizon, test_auc_pr, champion_auc_pr, promoted,
       CASE WHEN promoted THEN 'Champion' ELSE 'Challenger' END AS alias, NOT promoted AS requires_review,
       CASE WHEN champion_auc_pr IS NULL THEN 'First model'
            WHEN test_auc_pr < 0.2 THEN printf('Below minimum threshold (%.4f < 0.2)', test_auc_pr)
            WHEN test_auc_pr < champion_auc_pr
              THEN printf('Regression detected (%+.2f%%)', (test_auc_pr - champion_auc_pr) / champion_auc_pr * 100)
            ELSE printf('Performance improvement: %+.2f%%', (test_auc_pr - champion_auc_pr) / champion_auc_pr * 100)
       END AS reason
FROM (SELECT n.horizon, n.test_auc_pr, o.test_auc_pr AS champion_auc_pr,
        o.test_auc_pr IS NULL OR (n.test_auc_pr >= 0.2 AND n.test_auc_pr >= o.test_auc_pr) AS promoted
      FROM {_LATE} n LEFT JOIN (SELECT * FROM {_EARLY} WHERE horizon > 30) o ON n.horizon = o.horizon)""")
def _(spark, d):
    challengers, log = _versions(spark, d)
    return evaluation.promotion(challengers, log)


@query("mon_quality_drop", f"""
SELECT n.horizon, n.test_auc_pr AS auc_pr, o.test_auc_pr AS champion_auc_pr,
       round(1 - n.test_auc_pr / o.test_auc_pr, 6) AS relative_drop,
       1 - n.test_auc_pr / o.test_auc_pr > 0.1 AS retrain
FROM {_LATE} n JOIN (SELECT * FROM {_EARLY} WHERE horizon > 30) o ON n.horizon = o.horizon""")
def _(spark, d):
    challengers, log = _versions(spark, d)
    return rounded(monitor.quality_drop(challengers.withColumnRenamed("test_auc_pr", "auc_pr"), log),
                   6, "relative_drop")


_SPLIT = (f"CASE WHEN observation_date < DATE '{given.TRAIN_END}' THEN 'train' "
          f"WHEN observation_date < DATE '{given.VALIDATION_END}' THEN 'validation' ELSE 'test' END")


@query("ml_horizon_comparison", f"""
SELECT horizon, {', '.join(f"max({m}) FILTER (WHERE split = '{s}') AS {s}_{m}" for s in ('validation', 'test') for m in ('auc_roc', 'auc_pr'))}
FROM (SELECT split, horizon, round(sum(neg * (tp - pos / 2.0::DOUBLE)) / (max(p) * max(n)), 6) AS auc_roc,
             round(sum(pos * tp / (tp + fp)) / max(p), 6) AS auc_pr
  FROM (SELECT *, CAST(sum(pos) OVER w AS DOUBLE) AS tp, CAST(sum(neg) OVER w AS DOUBLE) AS fp,
         CAST(sum(pos) OVER (PARTITION BY split, horizon) AS DOUBLE) AS p,
         CAST(sum(neg) OVER (PARTITION BY split, horizon) AS DOUBLE) AS n
        FROM (SELECT {_SPLIT} AS split, horizon, score, sum(y) AS pos, sum(1 - y) AS neg
              FROM long_judged GROUP BY 1, 2, 3)
        WINDOW w AS (PARTITION BY split, horizon ORDER BY score DESC)) GROUP BY 1, 2) GROUP BY 1""")
def _(spark, d):
    judged = inputs.judged(spark, d).withColumn(
        "split", split_label(OBSERVED, given.TRAIN_END, given.VALIDATION_END))
    out = rounded(training.evaluate(judged), 6, "auc_roc", "auc_pr")
    return evaluation.compare_horizons(out)


_RETRO = """
SELECT observation_date AS score_date, horizon,
       round(sum(neg * (tp - pos / 2.0::DOUBLE)) / nullif(max(p) * max(n), 0), 6) AS auc_roc,
       round(sum(pos * tp / (tp + fp)) / nullif(max(p), 0), 6) AS auc_pr,
       CAST(max(p) + max(n) AS BIGINT) AS n_customers, CAST(max(p) AS BIGINT) AS actual_churn_count,
       round(max(p) / (max(p) + max(n)), 6) AS actual_churn_rate,
       round(sum(score * (pos + neg)) / (max(p) + max(n)), 10) AS predicted_churn_rate
FROM (SELECT *, CAST(sum(pos) OVER w AS DOUBLE) AS tp, CAST(sum(neg) OVER w AS DOUBLE) AS fp,
       CAST(sum(pos) OVER (PARTITION BY observation_date, horizon) AS DOUBLE) AS p,
       CAST(sum(neg) OVER (PARTITION BY observation_date, horizon) AS DOUBLE) AS n
      FROM (SELECT observation_date, horizon, score, sum(y) AS pos, sum(1 - y) AS neg
            FROM long_judged GROUP BY 1, 2, 3)
      WINDOW w AS (PARTITION BY observation_date, horizon ORDER BY score DESC))
GROUP BY 1, 2"""


def _retro(spark, d):
    scored = inputs.scored(spark, d).withColumn("score_date", F.col(OBSERVED))
    return _plain(monitor.retrospective(scored, given.cease_days(spark, d)))


@query("ml_retrospective", _RETRO)
def _(spark, d):
    return _retro(spark, d)


@query("snk_metric_log", f"""
UNPIVOT (SELECT score_date, horizon, auc_roc, auc_pr, CAST(n_customers AS DOUBLE) AS n_customers,
         CAST(actual_churn_count AS DOUBLE) AS actual_churn_count, actual_churn_rate, predicted_churn_rate
         FROM ({_RETRO})) ON auc_roc, auc_pr, n_customers, actual_churn_count, actual_churn_rate,
  predicted_churn_rate INTO NAME metric_name VALUE metric_value""")
def _(spark, d):
    return monitor.metric_log(_retro(spark, d))


# --- monitoring -------------------------------------------------------------

_CUT = given.TRAIN_END
_PSI_FEATURES = ("tenure_days", "speed", "calls_90d", "prior_cease_count")


def _psi_sql(feature):
    edges = ", ".join(f"{i / 10}" for i in range(1, 10))
    return f"""SELECT '{feature}' AS feature, sum((p - q) * ln(p / q)) AS psi FROM (
  SELECT greatest(count(*) FILTER (WHERE base) / any_value(nb), 0.0001::DOUBLE) AS q,
         greatest(count(*) FILTER (WHERE NOT base) / any_value(nc), 0.0001::DOUBLE) AS p
  FROM (SELECT v, base, count(*) FILTER (WHERE base) OVER () AS nb, count(*) FILTER (WHERE NOT base) OVER () AS nc,
               len(list_filter(list_distinct(e), lambda x: x < v)) AS bin
        FROM (SELECT CAST({feature} AS DOUBLE) AS v, observation_date < DATE '{_CUT}' AS base FROM psi_rows),
             (SELECT quantile_cont(CAST({feature} AS DOUBLE), [{edges}]) AS e FROM psi_rows
              WHERE observation_date < DATE '{_CUT}')) GROUP BY bin)"""


@query("mon_psi", f"""
WITH psi_rows AS (SELECT i.datevalue AS observation_date, tenure_days, speed, calls_90d, prior_cease_count
  FROM customer_info i JOIN call_features f ON i.{ID} = f.{ID} AND i.datevalue = f.observation_date
  JOIN cease_history h ON i.{ID} = h.{ID} AND i.datevalue = h.observation_date)
SELECT feature, round(psi, 6) AS psi, psi > 0.2 AS drifted FROM (
  {' UNION ALL '.join(_psi_sql(f) for f in _PSI_FEATURES)})""")
def _(spark, d):
    from tidemark.operators.temporal import call_view, cease_view, point_in_time
    rows = materialise(point_in_time(
        inputs.customer_info(spark, d).select(ENTITY, F.col("datevalue").alias(OBSERVED),
                                              "tenure_days", "speed"),
        call_view(inputs.calls(spark, d)), cease_view(given.cease_days(spark, d), labels=False))
        .select(OBSERVED, *_PSI_FEATURES))
    cut = F.lit(_CUT).cast("date")
    return rounded(monitor.population_stability(rows.where(F.col(OBSERVED) < cut),
                                                rows.where(F.col(OBSERVED) >= cut),
                                                _PSI_FEATURES), 6, "psi")


# in millionths: whole numbers have exact sums, so both engines divide the same two numbers
@query("mon_profile_scores", " UNION ALL ".join(
    f"""SELECT date_trunc('month', score_date)::DATE AS month, {k} AS slice_key, {v} AS slice_value,
    'churn_prob_{h}d' AS feature, count(p) AS count, 0.0::DOUBLE AS null_rate, round(avg(p), 4) AS mean,
    round(stddev_samp(p), 3) AS std, min(p) AS min, quantile_disc(p, 0.25) AS p25,
    quantile_disc(p, 0.5) AS median, quantile_disc(p, 0.75) AS p75, max(p) AS max
    FROM (SELECT *, round(churn_prob_{h}d * 1000000) AS p FROM tiered) GROUP BY 1, 2, 3"""
    for h in HORIZONS for k, v in (("'all'", "'all'"), ("'risk_tier'", "risk_tier"))))
def _(spark, d):
    names = [f"churn_prob_{h}d" for h in HORIZONS]
    tiered = _runs(spark, d).withColumns({n: F.round(F.col(n) * 1000000) for n in names})
    out = monitor.feature_profile(tiered, names, slices=("risk_tier",), date="score_date")
    return rounded(rounded(out, 4, "mean"), 3, "std")


_NULLABLE = ("avg_talk_time", "max_hold_time", "days_since_last_call", "days_since_last_cease")


@query("mon_null_shift", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(b, 6) AS baseline_rate, round(n, 6) AS current_rate,
    n - b > 0.05 AS alert FROM (SELECT
      count(*) FILTER (WHERE {c} IS NULL AND observation_date < DATE '1996-01-01')
        / count(*) FILTER (WHERE observation_date < DATE '1996-01-01') AS b,
      count(*) FILTER (WHERE {c} IS NULL AND observation_date >= DATE '1996-01-01')
        / count(*) FILTER (WHERE observation_date >= DATE '1996-01-01') AS n
      FROM call_features JOIN cease_history USING ({ID}, observation_date))""" for c in _NULLABLE))
def _(spark, d):
    from tidemark.operators.temporal import call_view, cease_view, point_in_time
    rows = materialise(
        point_in_time(inputs.spine(spark, d), call_view(inputs.calls(spark, d)),
                      cease_view(given.cease_days(spark, d), labels=False))
        .select(OBSERVED, *_NULLABLE))
    cut = F.lit("1996-01-01").cast("date")
    return rounded(monitor.null_rate_alerts(rows.where(F.col(OBSERVED) < cut),
                                            rows.where(F.col(OBSERVED) >= cut), _NULLABLE),
                   6, "baseline_rate", "current_rate")


def _moments(where, block):
    return ("SELECT count(*) AS n, count(*) FILTER (WHERE risk_tier = 'RED') / count(*) AS red, "
            "count(*) FILTER (WHERE risk_tier = 'GREEN') / count(*) AS green, " + ", ".join(
                f"avg(churn_prob_{h}d) AS m{h}, stddev_samp(churn_prob_{h}d) AS s{h}" for h in HORIZONS)
            + f" FROM {block} WHERE {where}")


_NOW = f"score_date >= DATE '{given.VALIDATION_END}'"
_THEN = "score_date < DATE '1996-01-01'"
_ALERTS = f"""
WITH m AS ({_moments(_NOW, "alarming_tiered")}), b AS ({_moments(_THEN, "tiered")})
SELECT code, CAST(horizon AS INTEGER) AS horizon, round(value, 6) AS value, message FROM (
{' UNION ALL '.join(f'''
  SELECT 'mean_too_high' AS code, {h} AS horizon, m{h} AS value, m{h} > 0.5 AS fires,
         printf('{h}d mean prediction (%.3f) is unusually high', m{h}) AS message FROM m UNION ALL
  SELECT 'collapsed_variance', {h}, s{h}, s{h} < 0.05,
         printf('{h}d prediction deviation (%.4f) is very low', s{h}) FROM m UNION ALL
  SELECT 'mean_shift', {h}, m.m{h} / b.m{h} - 1, abs(m.m{h} / b.m{h} - 1) > 0.2,
         printf('{h}d mean prediction moved by %+.1f%%', (m.m{h} / b.m{h} - 1) * 100) FROM m, b''' for h in HORIZONS)}
  UNION ALL SELECT 'red_concentration', NULL, red, red > 0.3,
         printf('%.1f%% of customers in RED tier', red * 100) FROM m
  UNION ALL SELECT 'green_concentration', NULL, green, green > 0.95,
         printf('%.1f%% of customers in GREEN tier', green * 100) FROM m) WHERE fires"""


def _runs(spark, d, shift=0.0):
    return inputs.scored(spark, d, shift).withColumns(
        {"risk_tier": R.risk_tier(), "score_date": F.col(OBSERVED)})


def _alerts(spark, d):
    then = _runs(spark, d).where(F.col("score_date") < F.lit("1996-01-01").cast("date"))
    means = then.agg(F.array(*[F.struct(F.lit(h).alias("horizon"),
                                        F.avg(f"churn_prob_{h}d").alias("mean_probability"))
                               for h in HORIZONS]).alias("_m")).select(F.inline("_m"))
    now = _runs(spark, d, ALARMING).where(
        F.col("score_date") >= F.lit(given.VALIDATION_END).cast("date"))
    return rounded(monitor.score_alerts(now, means), 6, "value")


@query("mon_alerts", _ALERTS)
def _(spark, d):
    return _alerts(spark, d)


@query("mon_retrain_flag", f"""
WITH m AS ({_moments(_NOW, "alarming_tiered")}), b AS ({_moments(_THEN, "tiered")}),
f AS (SELECT unnest([{', '.join([f'm.m{h} > 0.5, m.s{h} < 0.05, abs(m.m{h} / b.m{h} - 1) > 0.2' for h in HORIZONS] + ['m.red > 0.3', 'm.green > 0.95'])}]) AS x FROM m, b)
SELECT count(*) FILTER (WHERE x) > 0 AS retrain_needed, count(*) FILTER (WHERE x) AS alerts FROM f""")
def _(spark, d):
    return monitor.retrain_flag(_alerts(spark, d))


# --- request log ------------------------------------------------------------

_WIN = ("strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, "
        "strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end")


@query("obs_rate", f"""
SELECT {_WIN}, endpoint, count(*) AS requests, round(count(*) / 300, 6) AS per_second
FROM windowed_log GROUP BY ALL""")
def _(spark, d):
    return rounded(stamped(requests.request_rate(given.request_log(spark, d)), "window_start",
                           "window_end"), 6, "per_second")


_RATIO = """SELECT window_start, window_end, count(*) AS requests,
  count(*) FILTER (WHERE status = 'error') AS errors,
  count(*) FILTER (WHERE status = 'error') / count(*) AS error_ratio,
  count(*) FILTER (WHERE status = 'error') / count(*) > 0.05 AS alert FROM windowed_log GROUP BY 1, 2"""


@query("obs_error_ratio", f"""
SELECT {_WIN}, requests, errors, round(error_ratio, 6) AS error_ratio, alert FROM ({_RATIO})""")
def _(spark, d):
    return rounded(stamped(requests.error_ratio(given.request_log(spark, d)), "window_start",
                           "window_end"), 6, "error_ratio")


def _bucket_quantile(q):
    edges = contract.LATENCY_BUCKETS
    cases = []
    for i, e in enumerate(edges):
        low, before = (edges[i - 1], f"b{i - 1}") if i else (0.0, "0")
        cases.append(f"WHEN b{i} >= {q} * n THEN {low}::DOUBLE + ({e}::DOUBLE - {low}::DOUBLE) * "
                     f"({q} * n - {before}) / nullif(b{i} - {before}, 0)")
    return f"CASE {' '.join(cases)} ELSE {edges[-1]}::DOUBLE END"


@query("obs_latency_quantiles", f"""
SELECT {_WIN}, n AS requests, round(p50, 6) AS p50, round(p95, 6) AS p95, round(p99, 6) AS p99,
       p99 > 2 AS alert
FROM (SELECT *, {_bucket_quantile('0.5::DOUBLE')} AS p50, {_bucket_quantile('0.95::DOUBLE')} AS p95,
             {_bucket_quantile('0.99::DOUBLE')} AS p99
      FROM (SELECT window_start, window_end, count(latency_seconds) AS n,
              {', '.join(f'count(*) FILTER (WHERE latency_seconds <= {e}::DOUBLE) AS b{i}' for i, e in enumerate(contract.LATENCY_BUCKETS))}
            FROM windowed_log GROUP BY 1, 2))""")
def _(spark, d):
    return rounded(stamped(requests.latency_quantiles(given.request_log(spark, d)), "window_start",
                           "window_end"), 6, "p50", "p95", "p99")


@query("obs_latency_at_rank", """
SELECT strftime(time_bucket(INTERVAL 5 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS requests,
       quantile_disc(latency_seconds, 0.5) AS p50, quantile_disc(latency_seconds, 0.95) AS p95,
       quantile_disc(latency_seconds, 0.99) AS p99 FROM request_log GROUP BY 1""")
def _(spark, d):
    return stamped(requests.latency_at_rank(given.request_log(spark, d)), "window_start")


@query("obs_counts_1h", """
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, tier, count(*) AS count
FROM request_log GROUP BY 1, 2""")
def _(spark, d):
    return stamped(requests.counts_per(given.request_log(spark, d), "tier"), "window_start")


@query("obs_silence", """
SELECT endpoint, strftime(ts, '%Y-%m-%d %H:%M:%S') AS silent_from,
       strftime(n, '%Y-%m-%d %H:%M:%S') AS silent_until, round(epoch_us(n - ts) / 1e6::DOUBLE, 6) AS seconds
FROM (SELECT endpoint, ts, lead(ts) OVER (PARTITION BY endpoint ORDER BY ts) AS n FROM request_log)
WHERE n - ts > INTERVAL 30 MINUTE""")
def _(spark, d):
    return rounded(stamped(requests.silences(given.request_log(spark, d), by=["endpoint"]),
                           "silent_from", "silent_until"), 6, "seconds")


@query("obs_increase", f"""
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(w + INTERVAL 15 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end, tier, count(*) AS increase
FROM (SELECT tier, date_trunc('minute', ts) - s * INTERVAL 1 MINUTE AS w
      FROM request_log, (SELECT unnest(range(15)) AS s)) GROUP BY w, tier HAVING count(*) > 3""")
def _(spark, d):
    return stamped(requests.bursts(given.request_log(spark, d), ["tier"]), "window_start", "window_end")


@query("obs_sustained", f"""
SELECT strftime(min(window_end), '%Y-%m-%d %H:%M:%S') AS held_from,
       strftime(max(window_end), '%Y-%m-%d %H:%M:%S') AS held_until, count(*) AS samples
FROM (SELECT window_end, window_end - row_number() OVER (ORDER BY window_end) * INTERVAL 1 MINUTE AS run
      FROM ({_RATIO}) WHERE alert) GROUP BY run HAVING count(*) > 5""")
def _(spark, d):
    states = requests.error_ratio(given.request_log(spark, d))
    return stamped(requests.sustained(states, "alert"), "held_from", "held_until")
