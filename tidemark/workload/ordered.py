"""Ranks, deciles and medians of scores with all their digits, most of them close to zero."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.contract import ENTITY, HORIZONS, decile_name, probability_name
from tidemark.functions.risk import risk_tier
from tidemark.operators import actions
from tidemark.operators.quantiles import quantile_bin
from tidemark.sources import given
from tidemark.workload.registry import query, rounded

# products of exact quotients, which every engine rounds alike; powers crowd near zero as scores of rare events do
_BASE = "(o_orderkey * 7919 + o_custkey * 104729 + CAST(floor(o_totalprice) AS BIGINT) * 31) % 1000003"
_SCORES = f"""
fine AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS {ENTITY}, CAST(date_trunc('month', o_orderdate) AS DATE) AS score_date,
         u * u * u * u AS churn_prob_30d, u * u * u AS churn_prob_60d, u * u AS churn_prob_90d
  FROM (SELECT *, CAST({_BASE} AS DOUBLE) / 1000003 AS u FROM orders)),
fine_tiered AS (
  SELECT *, CASE WHEN churn_prob_30d > 0.5 THEN 'RED' WHEN churn_prob_60d > 0.5 THEN 'AMBER'
                 WHEN churn_prob_90d > 0.5 THEN 'YELLOW' ELSE 'GREEN' END AS risk_tier FROM fine),
fine_long AS (
""" + " UNION ALL ".join(f"SELECT score_date, {h} AS horizon, {probability_name(h)} AS p FROM fine" for h in HORIZONS) + ")"


def _fine(spark, d):
    u = F.col("u")
    orders = given.table(spark, d, "orders").withColumn("u", F.expr(_BASE).cast("double") / 1000003)
    return orders.select(F.col("o_orderkey").cast("string").alias(ENTITY), F.trunc("o_orderdate", "month").alias("score_date"),
                         (u * u * u * u).alias("churn_prob_30d"), (u * u * u).alias("churn_prob_60d"),
                         (u * u).alias("churn_prob_90d"))


@query("win_quantile_bin_unrounded", f"""
WITH {_SCORES},
ranked AS (SELECT horizon, p, row_number() OVER (PARTITION BY horizon ORDER BY p) - 1 AS i,
                  count(*) OVER (PARTITION BY horizon) AS n FROM fine_long),
places AS (SELECT DISTINCT horizon, (n - 1) * (CAST(k AS DOUBLE) / 10) AS place FROM ranked, range(11) AS t(k)),
edges AS (
  SELECT DISTINCT g.horizon, CASE WHEN floor(place) = ceil(place) OR lo.p = hi.p THEN lo.p
           ELSE (ceil(place) - place) * lo.p + (place - floor(place)) * hi.p END AS edge
  FROM places g JOIN ranked lo ON lo.horizon = g.horizon AND lo.i = floor(place)
  JOIN ranked hi ON hi.horizon = g.horizon AND hi.i = ceil(place))
SELECT {ENTITY}, """ + ", ".join(
    f"CAST(greatest((SELECT count(*) FROM edges e WHERE e.horizon = {h} AND e.edge < f.{probability_name(h)}), 1) AS INTEGER) "
    f"AS {decile_name(h)}" for h in HORIZONS) + " FROM fine f")
def _(spark, d):
    binned = quantile_bin(_fine(spark, d), {probability_name(h): decile_name(h) for h in HORIZONS})
    return binned.select(ENTITY, *[decile_name(h) for h in HORIZONS])


@query("srt_action_ranks_unrounded", f"""
WITH {_SCORES}
SELECT {ENTITY}, risk_tier, own AS own_probability, rank() OVER (PARTITION BY risk_tier ORDER BY own DESC) AS priority
FROM (SELECT *, CASE risk_tier WHEN 'RED' THEN churn_prob_30d WHEN 'AMBER' THEN churn_prob_60d
        ELSE churn_prob_90d END AS own FROM fine_tiered WHERE risk_tier <> 'GREEN')""")
def _(spark, d):
    tiered = _fine(spark, d).withColumn("risk_tier", risk_tier())
    return actions.action_ranks(tiered).select(ENTITY, "risk_tier", "own_probability", "priority")


@query("agg_score_trend_unrounded", f"""
WITH {_SCORES}
SELECT score_date, horizon, round(avg(p), 12) AS mean_probability, round(stddev_samp(p), 12) AS std_probability,
       median(p) AS median_probability
FROM fine_long GROUP BY 1, 2""")
def _(spark, d):
    return rounded(actions.score_trend(_fine(spark, d)), 12, "mean_probability", "std_probability")
