"""Queries over what is kept between runs: drift counts, the ledger of closed windows, expectations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.contract import HORIZONS, OBSERVED, probability_name
from tidemark.operators import drift, monitor, quality
from tidemark.operators.quality import DROP, WARN, Rule
from tidemark.session import fresh_folder
from tidemark.sources import given
from tidemark.sources.readers import stream_raw
from tidemark.sources.tables import materialise
from tidemark.streaming import ingest
from tidemark.functions.risk import risk_tier
from tidemark.workload import inputs
from tidemark.workload.checks import _RETRO, _plain
from tidemark.workload.registry import query, rounded

_CUT = given.TRAIN_END
_NAMES = [probability_name(h) for h in HORIZONS]
_EDGES = " UNION ALL ".join(
    f"SELECT '{n}' AS feature, list_distinct(quantile_cont({n}, [{', '.join(str(i / 10) for i in range(1, 10))}])) AS e "
    f"FROM tiered WHERE observation_date < DATE '{_CUT}'" for n in _NAMES)
_LONG = " UNION ALL ".join(
    f"SELECT CAST(date_trunc('month', observation_date) AS DATE) AS month, {k} AS slice_key, {v} AS slice_value, "
    f"'{n}' AS feature, {n} AS v FROM tiered" for n in _NAMES for k, v in (("'all'", "'all'"), ("'risk_tier'", "risk_tier")))


@query("mon_score_drift", f"""
WITH edges AS ({_EDGES}), lines AS ({_LONG}),
cells AS (
  SELECT month, slice_key, slice_value, l.feature, len(list_filter(e, lambda x: x < v)) AS bin, count(*) AS n,
         month < DATE '{_CUT}' AS base
  FROM lines l JOIN edges USING (feature) WHERE v IS NOT NULL GROUP BY ALL),
earlier AS (SELECT slice_key, slice_value, feature, bin, sum(n) AS n FROM cells WHERE base GROUP BY ALL),
groups AS (SELECT DISTINCT month, slice_key, slice_value, feature FROM cells WHERE NOT base),
sides AS (
  SELECT g.*, b.bin,
         coalesce((SELECT sum(n) FROM cells c WHERE c.month = g.month AND c.slice_key = g.slice_key
                   AND c.slice_value = g.slice_value AND c.feature = g.feature AND c.bin = b.bin), 0) AS p,
         coalesce((SELECT sum(n) FROM earlier t WHERE t.slice_key = g.slice_key
                   AND t.slice_value = g.slice_value AND t.feature = g.feature AND t.bin = b.bin), 0) AS q
  FROM groups g, range(10) AS b(bin)),
shares AS (
  SELECT *, greatest(CAST(p AS DOUBLE) / sum(p) OVER w, 0.0001::DOUBLE) AS ps,
         greatest(CAST(q AS DOUBLE) / nullif(sum(q) OVER w, 0), 0.0001::DOUBLE) AS qs, sum(q) OVER w AS known
  FROM sides WINDOW w AS (PARTITION BY month, slice_key, slice_value, feature))
SELECT month, slice_key, slice_value, feature,
       CASE WHEN max(known) > 0 THEN round(sum((ps - qs) * ln(ps / qs)), 6) END AS psi,
       coalesce(CASE WHEN max(known) > 0 THEN sum((ps - qs) * ln(ps / qs)) > 0.2 END, FALSE) AS drifted
FROM shares GROUP BY ALL""")
def _(spark, d):
    """Counts of the baseline and of two halves of what followed are kept apart and laid together."""
    tiered = materialise(inputs.scored(spark, d).withColumn("risk_tier", risk_tier()).select(OBSERVED, "risk_tier", *_NAMES))
    day = F.lit(_CUT).cast("date")
    before, after = tiered.where(F.col(OBSERVED) < day), tiered.where(F.col(OBSERVED) >= day)
    edges = materialise(drift.baseline_edges(before, _NAMES), "edges")
    halves = [after.where(F.dayofyear(OBSERVED) % 2 == i) for i in (0, 1)]
    stored = [materialise(drift.drift_cube(part, _NAMES, edges, ["risk_tier"]), "cube") for part in (before, *halves)]
    cube = drift.merged_cube(stored[0].unionByName(stored[1]).unionByName(stored[2]))
    return rounded(drift.cube_stability(cube, F.col("month") < day), 6, "psi")


@query("ml_ledger", f"""
SELECT * FROM ({_RETRO}) WHERE score_date + CAST(horizon AS INTEGER) <= (SELECT max(cease_placed_date) FROM cease_days)""")
def _(spark, d):
    """The windows closed by a day a year before the newest event, then those closed by that event."""
    scored = materialise(inputs.scored(spark, d).withColumn("score_date", F.col(OBSERVED)), "history")
    ceases = given.cease_days(spark, d)
    newest = ceases.agg(F.max(F.col("cease_placed_date").cast("date"))).scalar()
    first = materialise(monitor.retrospective(scored, ceases, as_of=F.date_sub(newest, 365)), "ledger")
    second = monitor.newly_measured(monitor.retrospective(scored, ceases, as_of=newest), first)
    return _plain(first.unionByName(second))


_ORDER_RULES = (Rule("small_order", "o_totalprice < 150000", WARN), Rule("closed_order", "o_orderstatus <> 'O'", DROP),
                Rule("known_customer", "o_custkey IS NOT NULL", DROP))


@query("dq_recorded", """
WITH counted AS (SELECT count(*) AS rows, count(*) FILTER (NOT coalesce(o_totalprice < 150000, FALSE)) AS small,
                        count(*) FILTER (NOT coalesce(o_orderstatus <> 'O', FALSE)) AS closed,
                        count(*) FILTER (o_custkey IS NULL) AS known FROM orders)
SELECT 'small_order' AS rule, 'warn' AS severity, rows, small AS violations FROM counted UNION ALL
SELECT 'closed_order', 'drop', rows, closed FROM counted UNION ALL
SELECT 'known_customer', 'drop', rows, known FROM counted""")
def _(spark, d):
    """What rules have found in a stream of three batches, from the rows kept for each batch."""
    folder = fresh_folder(spark, "expectations")
    orders = given.table(spark, d, "orders")
    for part in range(3):
        orders.where(F.col("o_orderkey") % 3 == part).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = stream_raw(spark, f"{folder}/in", "parquet", orders.schema, max_files=1)
    ingest.run(ingest.land_checked(stream, lambda batch: batch, _ORDER_RULES, "orders", f"{folder}/out",
                                   f"{folder}/log", f"{folder}/checkpoint"))
    log = spark.read.parquet(f"{folder}/log")
    return log.groupBy("rule", "severity").agg(F.sum("rows").alias("rows"), F.sum("violations").alias("violations"))
