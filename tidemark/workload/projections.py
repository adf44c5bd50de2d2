"""Projections, scalar expressions and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.contract import ENTITY, HORIZONS, OBSERVED, probability_name
from tidemark.functions import columns as C
from tidemark.functions import risk as R
from tidemark.operators import actions, assemble
from tidemark.plans.scoring import responses
from tidemark.sources import given
from tidemark.workload import inputs
from tidemark.workload.ctes import TIER
from tidemark.workload.registry import query, rounded

ID = "unique_customer_identifier"


@query("prj_try_cast", f"""
SELECT {ID}, CAST(calendar_date AS DATE) AS calendar_date,
       TRY_CAST(usage_download_mbs AS DOUBLE) AS usage_download_mbs,
       TRY_CAST(usage_upload_mbs AS DOUBLE) AS usage_upload_mbs FROM raw_usage""")
def _(spark, d):
    return given.raw_usage(spark, d).select(
        ENTITY, C.to_date("calendar_date").alias("calendar_date"),
        C.to_double("usage_download_mbs").alias("usage_download_mbs"),
        C.to_double("usage_upload_mbs").alias("usage_upload_mbs"))


@query("prj_sentinel", f"""
SELECT {ID}, datevalue, coalesce(ooc_days, -9999.0) AS ooc_days FROM raw_customer_info""")
def _(spark, d):
    return given.raw_customer_info(spark, d).select(
        ENTITY, "datevalue", C.or_sentinel("ooc_days").alias("ooc_days"))


@query("prj_prefix_ordinal", f"""
SELECT {ID}, contract_status, TRY_CAST(substr(contract_status, 1, 2) AS INTEGER)
       AS contract_status_ord FROM raw_customer_info""")
def _(spark, d):
    return given.raw_customer_info(spark, d).select(
        ENTITY, "contract_status", C.prefix_ordinal("contract_status").alias("contract_status_ord"))


@query("prj_pct_gap", f"""
SELECT {ID}, datevalue, speed, CASE WHEN speed > 0
       THEN round((speed - line_speed) / speed * 100, 2) ELSE 0.0 END AS speed_gap_pct
FROM raw_customer_info""")
def _(spark, d):
    return given.raw_customer_info(spark, d).select(
        ENTITY, "datevalue", "speed", C.pct_gap("speed", "line_speed").alias("speed_gap_pct"))


@query("prj_tenure_bucket", f"""
SELECT {ID}, datevalue, tenure_days, CASE WHEN tenure_days < 90 THEN '0-90d'
       WHEN tenure_days < 365 THEN '90d-1y' WHEN tenure_days < 730 THEN '1y-2y'
       WHEN tenure_days < 1095 THEN '2y-3y' ELSE '3y+' END AS tenure_bucket
FROM raw_customer_info""")
def _(spark, d):
    return given.raw_customer_info(spark, d).select(
        ENTITY, "datevalue", "tenure_days", C.tenure_bucket("tenure_days").alias("tenure_bucket"))


@query("prj_usage_total_month", f"""
SELECT {ID}, calendar_date, usage_total_mbs, month_key FROM usage_daily""")
def _(spark, d):
    return inputs.usage_daily(spark, d).select(
        ENTITY, "calendar_date", "usage_total_mbs", "month_key")


@query("prj_impute_flags", f"""
SELECT {ID}, event_date, call_type, is_loyalty_call, is_complaint_call, is_tech_call
FROM calls""")
def _(spark, d):
    return inputs.calls(spark, d).select(
        ENTITY, "event_date", "call_type", "is_loyalty_call", "is_complaint_call", "is_tech_call")


@query("prj_completed_flag", f"""
SELECT {ID}, cease_placed_date, is_completed, cease_month,
       CASE WHEN cease_completed_date IS NOT NULL THEN 'Completed' ELSE 'Pending/Retracted' END
       AS completion FROM cease""")
def _(spark, d):
    return inputs.cease(spark, d).select(
        ENTITY, "cease_placed_date", "is_completed", "cease_month",
        C.completion_text("cease_completed_date").alias("completion"))


@query("prj_clean_customer_info", "SELECT * REPLACE (round(line_speed, 4) AS line_speed) FROM customer_info")
def _(spark, d):
    return rounded(inputs.customer_info(spark, d), 4, "line_speed")


@query("prj_temporal_split", f"""
SELECT {ID}, observation_date, CASE WHEN observation_date < DATE '{given.TRAIN_END}' THEN 'train'
       WHEN observation_date < DATE '{given.VALIDATION_END}' THEN 'validation' ELSE 'test' END
       AS split FROM spine""")
def _(spark, d):
    return inputs.spine(spark, d).withColumn(
        "split", C.split_label(OBSERVED, given.TRAIN_END, given.VALIDATION_END))


@query("prj_quantile_split", f"""
SELECT {ID}, observation_date, CASE WHEN day >= c2 THEN 'test' WHEN day >= c1 THEN 'validation'
       ELSE 'train' END AS split
FROM (SELECT *, date_diff('day', DATE '1970-01-01', observation_date) AS day FROM spine),
     (SELECT quantile_cont(CAST(date_diff('day', DATE '1970-01-01', observation_date) AS DOUBLE), 0.7) AS c1,
             quantile_cont(CAST(date_diff('day', DATE '1970-01-01', observation_date) AS DOUBLE), 0.85) AS c2
      FROM spine)""")
def _(spark, d):
    return assemble.quantile_split(inputs.spine(spark, d))


@query("prj_scorecard", f"""
SELECT {ID}, observation_date, churn_prob_30d, churn_prob_60d, churn_prob_90d FROM scored""")
def _(spark, d):
    return inputs.scored(spark, d).select(ENTITY, OBSERVED, *[probability_name(h) for h in HORIZONS])


@query("prj_risk_tier", f"SELECT {ID}, observation_date, {TIER} AS risk_tier FROM scored")
def _(spark, d):
    return inputs.scored(spark, d).select(ENTITY, OBSERVED, R.risk_tier().alias("risk_tier"))


@query("prj_tier_actions", f"""
SELECT {ID}, observation_date, risk_tier,
  CASE risk_tier WHEN 'RED' THEN 'Emergency outbound call — best-offer retention deal'
    WHEN 'AMBER' THEN 'Targeted digital campaign — proactive contract renewal'
    WHEN 'YELLOW' THEN 'Customer success check-in — experience improvement'
    ELSE 'No action — continue monitoring' END AS recommended_action,
  CASE risk_tier WHEN 'RED' THEN 'Call center (Loyalty)' WHEN 'AMBER' THEN 'CRM / Marketing'
    WHEN 'YELLOW' THEN 'Customer Success' ELSE 'Automated' END AS action_owner,
  CASE risk_tier WHEN 'RED' THEN 'Within 24 hours' WHEN 'AMBER' THEN 'Within 7 days'
    WHEN 'YELLOW' THEN 'Within 30 days' ELSE 'N/A' END AS action_sla
FROM tiered""")
def _(spark, d):
    tiers = inputs.scored(spark, d).select(ENTITY, OBSERVED, R.risk_tier().alias("risk_tier"))
    return actions.with_actions(tiers)


@query("prj_abs_decile", f"""
SELECT {ID}, observation_date,
  CAST(least(floor(churn_prob_30d * 10) + 1, 10) AS INTEGER) AS decile_30d,
  CAST(least(floor(churn_prob_90d * 10) + 1, 10) AS INTEGER) AS decile_90d FROM scored""")
def _(spark, d):
    return inputs.scored(spark, d).select(
        ENTITY, OBSERVED, R.absolute_decile("churn_prob_30d").alias("decile_30d"),
        R.absolute_decile("churn_prob_90d").alias("decile_90d"))


@query("prj_prob_bands", f"""
SELECT {ID}, observation_date, CASE WHEN churn_prob_60d < 0.3 THEN '0-30'
  WHEN churn_prob_60d < 0.5 THEN '30-50' WHEN churn_prob_60d < 0.7 THEN '50-70' ELSE '70-100' END
  AS band FROM scored""")
def _(spark, d):
    return inputs.scored(spark, d).select(
        ENTITY, OBSERVED, R.probability_band("churn_prob_60d").alias("band"))


@query("prj_fill_policy", f"""
SELECT {ID}, observation_date, coalesce(avg_talk_time, 0) AS avg_talk_time,
  coalesce(max_hold_time, 0) AS max_hold_time,
  coalesce(days_since_last_call, 9999) AS days_since_last_call,
  coalesce(days_since_last_cease, 9999) AS days_since_last_cease
FROM call_features JOIN cease_history USING ({ID}, observation_date)""")
def _(spark, d):
    from tidemark.operators.temporal import call_view, cease_view, point_in_time
    wide = point_in_time(inputs.spine(spark, d), call_view(inputs.calls(spark, d)),
                         cease_view(given.cease_days(spark, d), labels=False))
    return assemble.fill_missing(wide.select(
        ENTITY, OBSERVED, "avg_talk_time", "max_hold_time", "days_since_last_call",
        "days_since_last_cease"))


_PARTIAL = f"""
SELECT {ID} AS customer_id, CASE WHEN contract_dd_cancels = 0 THEN NULL ELSE CAST(speed AS DOUBLE) END AS speed,
       CASE WHEN dd_cancel_60_day = 0 THEN NULL ELSE technology END AS technology,
       CAST(tenure_days AS DOUBLE) AS tenure_days FROM raw_customer_info"""


def _partial_records(spark, d):
    return given.raw_customer_info(spark, d).select(
        F.col(ENTITY).alias("customer_id"),
        F.when(F.col("contract_dd_cancels") != 0, F.col("speed").cast("double")).alias("speed"),
        F.when(F.col("dd_cancel_60_day") != 0, F.col("technology")).alias("technology"),
        F.col("tenure_days").cast("double").alias("tenure_days"))


@query("prj_defaults", f"""
SELECT customer_id, coalesce(speed, 0.0) AS speed, coalesce(technology, 'Unknown') AS technology,
       coalesce(tenure_days, 0.0) AS tenure_days, CAST(-9999.0 AS DOUBLE) AS ooc_days,
       CAST(0.0 AS DOUBLE) AS calls_30d, 'Unknown' AS sales_channel, '0-90d' AS tenure_bucket
FROM ({_PARTIAL})""")
def _(spark, d):
    return assemble.with_defaults(_partial_records(spark, d)).select(
        "customer_id", "speed", "technology", "tenure_days", "ooc_days", "calls_30d",
        "sales_channel", "tenure_bucket")


@query("prj_partial_features", f"""
SELECT {ID}, datevalue, CASE WHEN speed > 0 THEN round((speed - line_speed) / speed * 100, 2)
       ELSE 0.0 END AS speed_gap_pct, CASE WHEN tenure_days < 90 THEN '0-90d'
       WHEN tenure_days < 365 THEN '90d-1y' WHEN tenure_days < 730 THEN '1y-2y'
       WHEN tenure_days < 1095 THEN '2y-3y' ELSE '3y+' END AS tenure_bucket,
       round(t * CAST(0.85 AS DOUBLE), 4) AS monthly_download_mb,
       round(t * CAST(0.15 AS DOUBLE), 4) AS monthly_upload_mb,
       round(t * CAST(0.85 AS DOUBLE) / 30, 4) AS avg_daily_download_mb,
       CAST(30 AS DOUBLE) AS active_days_in_month
FROM (SELECT *, CAST(speed * 700 AS DOUBLE) AS t FROM raw_customer_info)""")
def _(spark, d):
    typed_in = given.raw_customer_info(spark, d).withColumn(
        "monthly_total_mb", (F.col("speed") * 700).cast("double"))
    out = assemble.partial_features(typed_in).select(
        ENTITY, "datevalue", "speed_gap_pct", "tenure_bucket", "monthly_download_mb",
        "monthly_upload_mb", "avg_daily_download_mb", "active_days_in_month")
    return rounded(out, 4, "monthly_download_mb", "monthly_upload_mb", "avg_daily_download_mb")


@query("prj_score_response", f"""
SELECT {ID}, risk_tier, action_sla, CAST(h AS INTEGER) AS horizon_days, p AS churn_probability,
       CAST(least(floor(p * 10) + 1, 10) AS INTEGER) AS risk_decile
FROM (SELECT {ID}, risk_tier, CASE risk_tier WHEN 'RED' THEN 'Within 24 hours'
        WHEN 'AMBER' THEN 'Within 7 days' WHEN 'YELLOW' THEN 'Within 30 days' ELSE 'N/A' END AS action_sla,
        unnest([30, 60, 90]) AS h, unnest([churn_prob_30d, churn_prob_60d, churn_prob_90d]) AS p
      FROM tiered WHERE observation_date = (SELECT max(observation_date) FROM tiered))""")
def _(spark, d):
    newest = assemble.latest(inputs.scored(spark, d))
    return responses(newest, stamp=False).select(
        ENTITY, "risk_tier", "action_sla", F.inline("predictions"))


@query("flt_nulls", f"""
SELECT {ID}, event_date FROM raw_calls WHERE call_type IS NULL""")
def _(spark, d):
    return given.raw_calls(spark, d).where(F.col("call_type").isNull()).select(ENTITY, "event_date")


@query("flt_latest_snapshot", f"""
SELECT {ID}, datevalue, technology, tenure_days FROM customer_info
WHERE datevalue = (SELECT max(datevalue) FROM customer_info)""")
def _(spark, d):
    return assemble.latest(inputs.customer_info(spark, d), "datevalue").select(
        ENTITY, "datevalue", "technology", "tenure_days")


@query("flt_drilldown", f"""
SELECT {ID}, observation_date, risk_tier, churn_prob_30d FROM tiered
WHERE risk_tier IN ('RED', 'AMBER') AND churn_prob_30d >= 0.3""")
def _(spark, d):
    tiered = inputs.scored(spark, d).withColumn("risk_tier", R.risk_tier())
    return actions.drilldown(tiered).select(ENTITY, OBSERVED, "risk_tier", "churn_prob_30d")


@query("flt_sql_predicate", f"SELECT {ID}, cease_placed_date FROM cease WHERE is_completed = 1")
def _(spark, d):
    return inputs.cease(spark, d).where("is_completed = 1").select(ENTITY, "cease_placed_date")


@query("flt_repeat_entities", f"""
SELECT {ID}, count(*) AS cease_count FROM cease_days GROUP BY 1 HAVING count(*) > 1""")
def _(spark, d):
    from tidemark.operators.profile import repeat_entities
    return repeat_entities(given.cease_days(spark, d))


_PLACE = "CAST('0x' || substr(md5({}), 1, 13) AS BIGINT)"


@query("flt_hash_sample", f"""
SELECT {ID}, calendar_date, usage_upload_mbs FROM raw_usage
WHERE {_PLACE.format(ID)} < {int(0.01 * (1 << 52))}""")
def _(spark, d):
    return assemble.hash_sample(given.raw_usage(spark, d), ENTITY, 0.01).select(
        ENTITY, "calendar_date", "usage_upload_mbs")


@query("flt_bernoulli_sample", """
SELECT count(*) AS rows, TRUE AS share_fits, CAST(0 AS BIGINT) AS foreign_rows FROM raw_usage""")
def _(spark, d):
    """A random draw has no rows to compare: its share lies within six deviations, and all come from the source."""
    usage = given.raw_usage(spark, d)
    keys = [ENTITY, "calendar_date"]
    sample = assemble.bernoulli_sample(usage, 0.1)
    drawn, foreign = sample.agg(F.count("*")).scalar(), sample.join(usage, keys, "left_anti").agg(F.count("*")).scalar()
    n = F.count("*")
    return usage.agg(n.alias("rows"), (F.abs(drawn - n * 0.1) <= 6 * F.sqrt(n * 0.09)).alias("share_fits"),
                     foreign.alias("foreign_rows"))


@query("flt_stratified_sample", f"""
SELECT {ID}, stratum FROM (
  SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY {_PLACE.format(ID)}, {ID}) AS r
  FROM (SELECT DISTINCT {ID}, CASE WHEN {ID} IN (SELECT {ID} FROM cease_days) THEN 'positive'
               ELSE 'other' END AS stratum
        FROM (SELECT CAST(c_custkey AS VARCHAR) AS {ID} FROM customer))),
  (SELECT least(150, (SELECT count(DISTINCT {ID}) FROM cease_days)) AS np)
WHERE r <= CASE stratum WHEN 'positive' THEN np ELSE 500 - np END""")
def _(spark, d):
    everyone = given.table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias(ENTITY))
    return assemble.stratified_entities(everyone, given.cease_days(spark, d), n=500)
