"""Cleaned and scored inputs shared by the queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.contract import ENTITY, OBSERVED
from tidemark.operators.rollup import monthly_rollup
from tidemark.operators.temporal import (call_view, cease_view, observation_spine, point_in_time)
from tidemark.plans.cleaning import clean_calls, clean_cease, clean_customer_info, clean_usage
from tidemark.plans.scoring import SCORECARD, score_table, scorecard_probabilities
from tidemark.sources import given
from tidemark.sources.tables import materialise


def customer_info(spark, d) -> DataFrame:
    return clean_customer_info(given.raw_customer_info(spark, d))


def usage_daily(spark, d) -> DataFrame:
    return clean_usage(given.raw_usage(spark, d))


def usage_monthly(spark, d) -> DataFrame:
    """Most months of a customer hold few days, so months too are made in tasks of bounded numbers
    of lines; a join by customer and month takes over these tasks."""
    return monthly_rollup(given.spread(usage_daily(spark, d), given.usage_tasks(spark, d), ENTITY, "month_key"))


def calls(spark, d) -> DataFrame:
    return clean_calls(given.raw_calls(spark, d))


def cease(spark, d) -> DataFrame:
    return clean_cease(given.raw_cease(spark, d))


def spine(spark, d) -> DataFrame:
    """The snapshot keys, without the attributes that need other tables."""
    orders = given.table(spark, d, "orders")
    return observation_spine(orders.select(F.col("o_custkey").cast("string").alias(ENTITY),
                                           F.trunc("o_orderdate", "month").alias("datevalue")))


def _scoring_features(spark, d, labels: bool) -> DataFrame:
    snapshot = customer_info(spark, d).select(
        ENTITY, F.col("datevalue").alias(OBSERVED), "technology", "sales_channel",
        "contract_status_ord", "speed_gap_pct", "tenure_days")
    return point_in_time(snapshot, call_view(calls(spark, d)),
                         cease_view(given.cease_days(spark, d), labels=labels))


def scored(spark, d, shift: float = 0.0) -> DataFrame:
    """Scorecard probabilities for every observation; ``shift`` moves all intercepts."""
    card = {h: (intercept + shift, weights) for h, (intercept, weights) in SCORECARD.items()}
    return scorecard_probabilities(_scoring_features(spark, d, labels=False), card)


def judged(spark, d) -> DataFrame:
    """Probabilities beside what happened."""
    return scorecard_probabilities(_scoring_features(spark, d, labels=True))


def scores(spark, d) -> DataFrame:
    return score_table(materialise(scored(spark, d), "scored"))
