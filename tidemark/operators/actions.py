"""Scores in use: tier distribution, action lists, ranked priorities, score reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import contract
from tidemark.contract import ENTITY, HORIZONS, decile_name, probability_name
from tidemark.functions.risk import horizon_text
from tidemark.operators.assemble import complete_domain
from tidemark.operators.running import interpolated, running_sums


def tier_actions(spark) -> DataFrame:
    """The four tiers with action, owner and deadline."""
    return spark.createDataFrame(
        [(tier, *contract.TIER_ACTIONS[tier]) for tier in contract.TIER_ORDER],
        "risk_tier string, recommended_action string, action_owner string, action_sla string")


def with_actions(scores: DataFrame) -> DataFrame:
    """Scores with their tier's action; the four-row side is broadcast."""
    return scores.join(F.broadcast(tier_actions(scores.sparkSession)), "risk_tier", "left")


def tier_distribution(scores: DataFrame) -> DataFrame:
    """Count and share per tier, tiers without rows included. The window sees four rows."""
    counts = complete_domain(scores.groupBy("risk_tier").agg(F.count("*").alias("count")),
                             "risk_tier", contract.TIER_ORDER, ["count"])
    total = F.sum("count").over(Window.partitionBy(F.lit(0)))
    return counts.withColumn("pct", F.round(F.try_divide(F.col("count") * 100.0, total), 4))


def action_list(scores: DataFrame, tier: str) -> DataFrame:
    """The customers of a tier, most likely first by the tier's own horizon."""
    own = probability_name(contract.TIER_HORIZON[tier])
    return scores.where(F.col("risk_tier") == tier).orderBy(F.desc(own), ENTITY)


def action_ranks(scores: DataFrame, digits: int | None = None) -> DataFrame:
    """All action lists with ``priority``: 1 + customers of the tier with a higher probability.

    Ranks come from counts per (tier, probability), summed up over ranges of probabilities, so no
    task sorts a whole tier. Equal probabilities share a rank; ``digits`` cuts them to so many decimals.
    """
    own = F.coalesce(*[F.when(F.col("risk_tier") == t, F.col(probability_name(h)))
                       for t, h in contract.TIER_HORIZON.items()])
    listed = (scores.where(F.col("risk_tier").isin(*contract.TIER_HORIZON))
              .withColumn("own_probability", own if digits is None else F.round(own, digits)))
    counted = listed.groupBy("risk_tier", "own_probability").agg(F.count("*").alias("_n"))
    places = running_sums(counted, ["risk_tier"], "own_probability", {"_upto": "_n"}, descending=True).select(
        "risk_tier", "own_probability", (F.col("_upto") - F.col("_n") + 1).alias("priority"))
    return listed.join(places, ["risk_tier", "own_probability"])


def action_summary(scores: DataFrame) -> DataFrame:
    """Per actionable tier: customers and mean probability of its own horizon."""
    own = F.coalesce(*[F.when(F.col("risk_tier") == t, F.col(probability_name(h)))
                       for t, h in contract.TIER_HORIZON.items()])
    return (scores.where(F.col("risk_tier").isin(*contract.TIER_HORIZON))
            .groupBy("risk_tier").agg(F.count("*").alias("customers"),
                                      F.avg(own).alias("avg_own_probability")))


def drilldown(scores: DataFrame, tiers: Sequence[str] = ("RED", "AMBER"),
              min_probability: float = 0.3) -> DataFrame:
    return (scores.where(F.col("risk_tier").isin(*tiers)
                         & (F.col("churn_prob_30d") >= min_probability))
            .orderBy(F.desc("churn_prob_30d"), ENTITY))


def top_risks(scores: DataFrame, k: int = 20, digits: int = 3) -> DataFrame:
    """The k highest 30-day probabilities, ties by entity."""
    return (scores.orderBy(F.desc("churn_prob_30d"), ENTITY).limit(k)
            .select(ENTITY, "risk_tier",
                    *[F.round(probability_name(h), digits).alias(f"prob_{h}d") for h in HORIZONS]))


def long_probabilities(scores: DataFrame, keep: Sequence[str] = (ENTITY,)) -> DataFrame:
    """Wide to long: one row per (row, horizon) with a readable horizon; nulls left out."""
    return (scores.unpivot(list(keep), [probability_name(h) for h in HORIZONS],
                           "horizon", "probability")
            .where(F.col("probability").isNotNull())
            .withColumn("horizon", horizon_text("horizon")))


def tier_heatmap(scores: DataFrame) -> DataFrame:
    return scores.groupBy("risk_tier").agg(
        *[F.avg(probability_name(h)).alias(f"avg_{h}d") for h in HORIZONS])


def score_trend(scores: DataFrame, date: str = "score_date", digits: int | None = None) -> DataFrame:
    """Mean, deviation and median probability per (score date, horizon).

    Mean and deviation are merged sums; medians come from counts per probability, summed up over
    ranges of probabilities. ``digits`` cuts probabilities to so many decimals.
    """
    def p(h: int) -> Column:
        return F.col(probability_name(h)) if digits is None else F.round(probability_name(h), digits)

    pairs = F.array(*[F.struct(F.lit(h).alias("horizon"), p(h).alias("p")) for h in HORIZONS])
    lines = scores.select(date, F.inline(pairs)).where(F.col("p").isNotNull())
    keys = [date, "horizon"]
    moments = lines.groupBy(*keys).agg(F.avg("p").alias("mean_probability"), F.stddev_samp("p").alias("std_probability"))
    medians = interpolated(lines.groupBy(*keys, "p").agg(F.count("*").alias("n")), keys, "p", "n", [0.5]).select(
        *keys, F.col("points")[0].alias("median_probability"))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    return (moments.alias("a").join(medians.alias("b"), same)
            .select(*[f"a.{k}" for k in keys], "mean_probability", "std_probability", "median_probability"))


def decile_means(scores: DataFrame) -> DataFrame:
    """Mean probability and rows per (horizon, decile)."""
    lines = F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(decile_name(h)).alias("decile"),
                               F.col(probability_name(h)).alias("p")) for h in HORIZONS])
    return (scores.select(F.inline(lines)).groupBy("horizon", "decile")
            .agg(F.avg("p").alias("avg_probability"), F.count("*").alias("count")))


def prediction_summary(scores: DataFrame) -> DataFrame:
    """Per horizon: mean probability and the mean inside the highest decile."""
    lines = F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(decile_name(h)).alias("decile"),
                               F.col(probability_name(h)).alias("p")) for h in HORIZONS])
    per_decile = (scores.select(F.inline(lines)).groupBy("horizon", "decile")
                  .agg(F.sum("p").alias("s"), F.count("p").alias("n")))
    return per_decile.groupBy("horizon").agg(
        (F.sum("s") / F.sum("n")).alias("mean_probability"),
        F.max_by(F.col("s") / F.col("n"), "decile").alias("top_decile_mean"))
