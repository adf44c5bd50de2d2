"""What each feature adds to the margin of boosted trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.contract import ENTITY, HORIZONS, MODEL_FEATURES, OBSERVED, label_name
from tidemark.plans import training, trees
from tidemark.plans.features import training_set
from tidemark.plans.trees import Node, Trees
from tidemark.session import fresh_folder
from tidemark.sources import given
from tidemark.workload import inputs
from tidemark.workload.registry import query, rounded

# --- fixed values: two trees over orders, the second one with a weight of a tenth ---
_ORDER_TREES = Trees(("price", "priority", "month"), (0, 5), (
    Node(0.1, 0, 100000.0, (), 1, 4), Node(-0.2, 1, 0.0, (1, 2), 2, 3), Node(0.3), Node(-0.5), Node(0.7),
    Node(0.005, 2, 6.0, (), 6, 7), Node(-0.1), Node(0.08, 0, 200000.0, (), 8, 9), Node(0.04), Node(0.16)), 2)


def _order_values():
    return F.array(F.col("o_totalprice").cast("double"), F.substring("o_orderpriority", 1, 1).cast("double"),
                   F.month("o_orderdate").cast("double"))


@query("ml_tree_contributions", """
WITH o AS (SELECT o_orderkey, o_totalprice AS price, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority,
                  month(o_orderdate) AS month FROM orders),
c AS (SELECT o_orderkey,
        CASE WHEN price <= 100000 THEN -0.3 ELSE 0.6 END
          + CASE WHEN month <= 6 THEN 0 WHEN price <= 200000 THEN -0.04 ELSE 0.08 END AS by_price,
        CASE WHEN price <= 100000 THEN CASE WHEN priority IN (1, 2) THEN 0.5 ELSE -0.3 END ELSE 0 END AS by_priority,
        CASE WHEN month <= 6 THEN -0.105 ELSE 0.075 END AS by_month,
        CASE WHEN price <= 100000 THEN CASE WHEN priority IN (1, 2) THEN 0.3 ELSE -0.5 END ELSE 0.7 END
          + CASE WHEN month <= 6 THEN -0.1 WHEN price <= 200000 THEN 0.04 ELSE 0.16 END AS margin FROM o)
SELECT o_orderkey, round(CAST(0.105 AS DOUBLE), 6) AS base, round(CAST(margin AS DOUBLE), 6) AS margin,
       round(CAST(by_price AS DOUBLE), 6) AS by_price, round(CAST(by_priority AS DOUBLE), 6) AS by_priority,
       round(CAST(by_month AS DOUBLE), 6) AS by_month FROM c""")
def _(spark, d):
    told = given.table(spark, d, "orders").select("o_orderkey", trees.explained(_order_values(), _ORDER_TREES).alias("told"))
    by = [(F.col("told.contributions")[i] + 0.0).alias(f"by_{f}") for i, f in enumerate(_ORDER_TREES.features)]
    return rounded(told.select("o_orderkey", "told.base", "told.margin", *by), 6,
                   "base", "margin", "by_price", "by_priority", "by_month")


@query("ml_mean_contributions")
def _(spark, d):
    """Mean contribution of every feature of each horizon's model over all rows, after ten rounds."""
    folder = fresh_folder(spark, "training-set")
    wanted = [ENTITY, OBSERVED, *MODEL_FEATURES, *[label_name(h) for h in HORIZONS], "split"]
    training_set(inputs.customer_info(spark, d), inputs.calls(spark, d),
                 given.cease_days(spark, d), inputs.usage_monthly(spark, d), given.TRAIN_END,
                 given.VALIDATION_END, unique=True).select(*wanted).write.parquet(folder)
    table = spark.read.parquet(folder)
    models = training.fit_horizons(table, rounds=10, validate=False)
    return trees.mean_contributions(trees.contributions(table, models))


@query("ml_round_quality", """
WITH o AS (SELECT o_totalprice AS price, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority,
                  month(o_orderdate) AS month, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y FROM orders),
t AS (SELECT y, CASE WHEN price <= 100000 THEN CASE WHEN priority IN (1, 2) THEN 0.3 ELSE -0.5 END ELSE 0.7 END AS first,
             CASE WHEN month <= 6 THEN -0.1 WHEN price <= 200000 THEN 0.04 ELSE 0.16 END AS second FROM o),
m AS (SELECT 1 AS rounds, first AS score, y FROM t UNION ALL SELECT 2, first + second, y FROM t),
h AS (SELECT rounds, score, sum(y) AS pos, count(*) AS n FROM m GROUP BY ALL),
r AS (SELECT rounds, pos, sum(pos) OVER w AS tp, sum(n) OVER w AS above, sum(pos) OVER (PARTITION BY rounds) AS total
      FROM h WINDOW w AS (PARTITION BY rounds ORDER BY score DESC))
SELECT rounds, 30 AS horizon, round(sum(pos * tp / above) / max(total), 6) AS auc_pr FROM r GROUP BY rounds""")
def _(spark, d):
    """Average precision of finished orders after each of the two trees."""
    done = F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)
    quality = trees.round_quality(given.table(spark, d, "orders"), _order_values(), done, _ORDER_TREES, 30)
    return rounded(quality, 6, "auc_pr")
