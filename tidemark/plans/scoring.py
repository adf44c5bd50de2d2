"""From features to scores: scorecard or fitted models, deciles, tiers, response records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contract import (ENTITY, HORIZONS, OBSERVED, TierThresholds, decile_name,
                               probability_name)
from tidemark.functions.risk import absolute_decile, linear_score, logistic, risk_tier
from tidemark.operators.actions import with_actions
from tidemark.operators.assemble import fill_missing
from tidemark.operators.quantiles import quantile_bin

# A fixed closed-form scorer, so that everything after it can be checked exactly.
SCORECARD: dict[int, tuple[float, dict[str, float]]] = {
    30: (-2.3, {"contract_status_ord": 0.35, "speed_gap_pct": -0.012, "calls_90d": 0.3,
                "complaint_calls_90d": 0.8, "prior_cease_count": -0.12, "tenure_days": 0.0002}),
    60: (-1.2, {"contract_status_ord": 0.25, "speed_gap_pct": -0.010, "calls_90d": 0.2,
                "complaint_calls_90d": 0.6, "prior_cease_count": -0.05, "tenure_days": 0.0001}),
    90: (-0.5, {"contract_status_ord": 0.15, "speed_gap_pct": -0.008, "calls_90d": 0.1,
                "complaint_calls_90d": 0.4, "prior_cease_count": 0.05, "tenure_days": -0.0001}),
}


def scorecard_probabilities(features: DataFrame,
                            card: Mapping[int, tuple[float, Mapping[str, float]]] = SCORECARD,
                            digits: int | None = 6) -> DataFrame:
    """One probability per horizon from a logistic scorecard; missing features are filled first."""
    def probability(intercept: float, weights: Mapping[str, float]) -> Column:
        p = logistic(linear_score(weights, intercept))
        return p if digits is None else F.round(p, digits)

    used = sorted({f for _, weights in card.values() for f in weights})
    return fill_missing(features, used).withColumns(
        {probability_name(h): probability(*line) for h, line in card.items()})


def score_table(scored: DataFrame, thresholds: TierThresholds = TierThresholds(),
                bins: int = 10) -> DataFrame:
    """The published score table: probabilities, quantile deciles and tier per entity and date."""
    probabilities = [probability_name(h) for h in HORIZONS]
    deciles = [decile_name(h) for h in HORIZONS]
    base = scored.select(ENTITY, OBSERVED, F.col(OBSERVED).alias("score_date"),
                         risk_tier(thresholds=thresholds).alias("risk_tier"), *probabilities)
    return quantile_bin(base, dict(zip(probabilities, deciles)), bins)


def responses(scored: DataFrame, thresholds: TierThresholds = TierThresholds(),
              stamp: bool = True) -> DataFrame:
    """One record per entity: predictions as an array, tier, action, owner, deadline.

    Deciles here are tenths of the unit interval, so a record depends on no other.
    """
    predictions = F.array(*[
        F.struct(F.lit(h).alias("horizon_days"),
                 F.round(probability_name(h), 6).alias("churn_probability"),
                 absolute_decile(probability_name(h)).alias("risk_decile")) for h in HORIZONS])
    tiered = scored.select(ENTITY, predictions.alias("predictions"),
                           risk_tier(thresholds=thresholds).alias("risk_tier"))
    out = with_actions(tiered)
    if stamp:
        out = out.withColumns({"scored_at": F.current_timestamp(), "request_id": F.expr("uuid()")})
    return out
