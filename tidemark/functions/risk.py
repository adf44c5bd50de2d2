"""Column expressions for probabilities, tiers and deciles."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import contract
from tidemark.functions.columns import _col


def risk_tier(p30: Column | str = "churn_prob_30d", p60: Column | str = "churn_prob_60d",
              p90: Column | str = "churn_prob_90d",
              thresholds: contract.TierThresholds = contract.TierThresholds()) -> Column:
    """The most urgent tier whose horizon is strictly above its threshold."""
    return (F.when(_col(p30) > thresholds.red, "RED")
            .when(_col(p60) > thresholds.amber, "AMBER")
            .when(_col(p90) > thresholds.yellow, "YELLOW")
            .otherwise("GREEN"))


def absolute_decile(p: Column | str) -> Column:
    """Tenth of the unit interval that holds the probability, 1 to 10."""
    return F.least(F.floor(_col(p) * 10) + 1, F.lit(10)).cast("int")


def probability_band(p: Column | str) -> Column:
    """Null stays null."""
    value = _col(p)
    return (F.when(value < 0.3, "0-30").when(value < 0.5, "30-50")
            .when(value < 0.7, "50-70").when(value.isNotNull(), "70-100"))


def bin_of(value: Column | str, edges: Column | str, n: int) -> Column:
    """Quantile bin from at most ``n + 1`` ordered distinct edges, 1 = lowest.

    Bins are right-closed and the smallest value belongs to bin 1. Null if the
    edges leave no interval.
    """
    v, e = _col(value), _col(edges)
    below = reduce(lambda a, b: a + b,
                   [F.when(F.try_element_at(e, F.lit(i)) < v, 1).otherwise(0)
                    for i in range(1, n + 2)])
    return F.when(v.isNotNull() & (F.size(e) > 1), F.greatest(below, F.lit(1)))


def linear_score(weights: Mapping[str, float], intercept: float) -> Column:
    terms = [F.col(name) * F.lit(float(w)) for name, w in weights.items()]
    return reduce(lambda a, b: a + b, terms, F.lit(float(intercept)))


def logistic(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def horizon_text(name: Column | str, prefix: str = "churn_prob_") -> Column:
    """ "churn_prob_30d" -> "30-day"."""
    return F.regexp_replace(F.regexp_replace(_col(name), f"^{prefix}", ""), "d$", "-day")


