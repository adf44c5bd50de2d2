"""Ranking quality, calibration, lift, attribution and the promotion gate.

Every ranking metric is computed from one histogram (horizon, score) ->
(positives, negatives). Scores are taken as they are; running sums work in two levels,
over ranges with equal numbers of scores and inside each range (``running``), so no task sees
all scores of a horizon, however they are concentrated. ``digits`` cuts scores to so many decimals, which bounds the histogram where
that is wanted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import contract
from tidemark.contract import HORIZONS, label_name, probability_name
from tidemark.functions.risk import bin_of
from tidemark.operators.running import CELLS, running_sums


def score_histogram(df: DataFrame, horizons: Sequence[int] = HORIZONS, digits: int | None = None,
                    by: Sequence[str] = ()) -> DataFrame:
    """(by..., horizon, score, pos, neg); the label and probability columns are those of the contract."""
    def score(h: int) -> Column:
        p = F.col(probability_name(h))
        return (p if digits is None else F.round(p, digits)).alias("score")

    lines = F.array(*[F.struct(F.lit(h).alias("horizon"), score(h),
                               F.col(label_name(h)).cast("bigint").alias("y")) for h in horizons])
    return (df.select(*by, F.inline(lines))
            .where(F.col("score").isNotNull() & F.col("y").isNotNull())
            .groupBy(*by, "horizon", "score")
            .agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")))


def ranking_curve(hist: DataFrame, by: Sequence[str] = (), cells: int | None = CELLS) -> DataFrame:
    """Running true and false positives from the highest score down, with the totals.

    None as ``cells`` sums in one level, for histograms known to be small.
    """
    return running_sums(hist, [*by, "horizon"], "score", {"tp": "pos", "fp": "neg"}, {"P": "pos", "N": "neg"},
                        descending=True, cells=cells)


def _ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def roc_points(hist: DataFrame) -> DataFrame:
    """(horizon, threshold, fpr, tpr) for every distinct score."""
    return ranking_curve(hist).select(
        "horizon", F.col("score").alias("threshold"),
        _ratio(F.col("fp"), F.col("N")).alias("fpr"), _ratio(F.col("tp"), F.col("P")).alias("tpr"))


def pr_points(hist: DataFrame) -> DataFrame:
    """(horizon, threshold, precision, recall) for every distinct score."""
    return ranking_curve(hist).select(
        "horizon", F.col("score").alias("threshold"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _ratio(F.col("tp"), F.col("P")).alias("recall"))


def precision_at_recall(hist: DataFrame, recall: float = 0.7) -> DataFrame:
    """The best precision among the thresholds that reach the recall."""
    return (pr_points(hist).where(F.col("recall") >= recall).groupBy("horizon")
            .agg(F.max("precision").alias("precision_at_recall")))


def ranking_metrics(hist: DataFrame, by: Sequence[str] = (), cells: int | None = CELLS
                    ) -> DataFrame:
    """Area under ROC (ties count half), average precision, sizes and rates.

    Both areas are null where a horizon has no positives.
    """
    tp, fp, pos, neg = (F.col(c).cast("double") for c in ("tp", "fp", "pos", "neg"))
    P, N = F.max("P").cast("double"), F.max("N").cast("double")
    return ranking_curve(hist, by, cells).groupBy(*by, "horizon").agg(
        F.try_divide(F.sum(neg * (tp - pos / 2)), P * N).alias("auc_roc"),
        F.try_divide(F.sum(pos * tp / (tp + fp)), P).alias("auc_pr"),
        (F.max("P") + F.max("N")).alias("n_customers"),
        F.max("P").alias("actual_churn_count"),
        F.try_divide(P, P + N).alias("actual_churn_rate"),
        F.try_divide(F.sum(F.col("score") * (pos + neg)), P + N).alias("predicted_churn_rate"))


def compare_horizons(metrics: DataFrame, splits: Sequence[str] = ("validation", "test")
                     ) -> DataFrame:
    """Metrics per (split, horizon) side by side: one row per horizon."""
    return metrics.groupBy("horizon").agg(*[
        F.max(F.when(F.col("split") == s, F.col(m))).alias(f"{s}_{m}")
        for s in splits for m in ("auc_roc", "auc_pr")])


def quantile_edges(hist: DataFrame, bins: int = 10) -> DataFrame:
    """(horizon, edges): the interpolated quantiles i / bins, from running counts.

    Each edge lies between the scores at two ranks; the score at a rank is the one whose run
    of rows holds it. No aggregate keeps the distinct scores.
    """
    n = F.col("P") + F.col("N")
    below = n - F.col("tp") - F.col("fp")
    upto = below + F.col("pos") + F.col("neg")

    def at(rank: Column) -> Column:
        return F.max(F.when((below <= rank) & (rank < upto), F.col("score")))

    places = [(n - 1) * F.lit(i / bins) for i in range(bins + 1)]
    found = ranking_curve(hist).groupBy("horizon").agg(
        F.max(n).alias("n"), *[at(F.floor(p)).alias(f"lo{i}") for i, p in enumerate(places)],
        *[at(F.ceil(p)).alias(f"hi{i}") for i, p in enumerate(places)])

    def edge(i: int) -> Column:
        place, lo, hi = (F.col("n") - 1) * F.lit(i / bins), F.col(f"lo{i}"), F.col(f"hi{i}")
        return F.when((F.floor(place) == F.ceil(place)) | (lo == hi), lo).otherwise(
            (F.ceil(place) - place) * lo + (place - F.floor(place)) * hi)

    return found.select("horizon", F.array(*[edge(i) for i in range(bins + 1)]).alias("edges"))


def binned(hist: DataFrame, bins: int = 10) -> DataFrame:
    """The histogram with its quantile bin. Edges: one array per horizon, broadcast."""
    edges = quantile_edges(hist, bins).withColumn("edges", F.array_sort(F.array_distinct("edges")))
    return (hist.join(F.broadcast(edges), "horizon")
            .withColumn("bin", bin_of("score", "edges", bins)).drop("edges"))


def calibration_curve(hist: DataFrame, bins: int = 10) -> DataFrame:
    """Mean prediction and share of positives per quantile bin; bins without rows are left out.

    Unlike the deciles of the lift table, repeated edges are not merged, so the
    numbers of the remaining bins can have gaps.
    """
    edges = quantile_edges(hist, bins)
    inner = F.slice("edges", 2, bins - 1)
    place = F.size(F.filter(inner, lambda e: e < F.col("score"))) + 1
    n = F.col("pos") + F.col("neg")
    return (hist.join(F.broadcast(edges), "horizon").withColumn("bin", place)
            .groupBy("horizon", "bin")
            .agg(F.sum(n).alias("count"),
                 (F.sum(F.col("score") * n) / F.sum(n)).alias("mean_predicted"),
                 (F.sum("pos") / F.sum(n)).alias("fraction_positive")))


def lift_table(hist: DataFrame, bins: int = 10) -> DataFrame:
    """Rate and lift over the base rate per score decile; ``is_top`` marks the highest one."""
    n = F.col("pos") + F.col("neg")
    per_bin = binned(hist, bins).groupBy("horizon", F.col("bin").alias("decile")).agg(
        F.sum(n).alias("count"), F.sum("pos").alias("_pos"))
    horizon = Window.partitionBy("horizon")        # at most `bins` rows each
    base = F.sum("_pos").over(horizon) / F.sum("count").over(horizon)
    return (per_bin.withColumns({
        "churn_rate": F.col("_pos") / F.col("count"),
        "lift": F.try_divide(F.col("_pos") / F.col("count"), base),
        "is_top": F.col("decile") == F.max("decile").over(horizon)}).drop("_pos"))


def confusion(df: DataFrame, threshold: float = 0.5,
              horizons: Sequence[int] = HORIZONS) -> DataFrame:
    lines = F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(label_name(h)).alias("actual"),
                               F.when(F.col(probability_name(h)) > threshold, 1).otherwise(0)
                               .alias("predicted")) for h in horizons])
    return (df.select(F.inline(lines)).groupBy("horizon", "actual", "predicted")
            .agg(F.count("*").alias("count")))


def class_weights(labelled: DataFrame, horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """Per horizon: positives, negatives and the weight that balances them."""
    lines = F.array(*[F.struct(F.lit(h).alias("horizon"),
                               F.col(label_name(h)).cast("bigint").alias("y")) for h in horizons])
    return (labelled.select(F.inline(lines)).groupBy("horizon")
            .agg(F.sum("y").alias("positives"), F.sum(1 - F.col("y")).alias("negatives"))
            .withColumn("pos_weight",
                        F.col("negatives") / F.greatest(F.col("positives"), F.lit(1))))


def linear_attribution(features: DataFrame, weights: Mapping[int, Mapping[str, float]]
                       ) -> DataFrame:
    """(horizon, feature, importance): mean absolute contribution against the average row.

    Exact for linear scores. The means enter the second pass as scalar subqueries.
    """
    names = sorted({f for per in weights.values() for f in per})
    means = features.agg(F.struct(*[F.avg(f).alias(f) for f in names]).alias("m")).scalar()
    spread = features.agg(*[F.avg(F.abs(F.col(f) - means.getField(f))).alias(f) for f in names])
    lines = F.array(*[F.struct(F.lit(h).alias("horizon"), F.lit(f).alias("feature"),
                               (F.col(f) * abs(w)).alias("importance"))
                      for h, per in sorted(weights.items()) for f, w in per.items()])
    return spread.select(F.inline(lines))


def rank_shift(importance: DataFrame, horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """Rank of each feature per horizon (ties get their mean rank, cut to whole) and the shift.

    One row per model feature enters, a count fixed by the contract.
    """
    by_value = Window.partitionBy("horizon").orderBy(F.desc("importance"))
    ties = Window.partitionBy("horizon", "importance")
    mean_rank = F.floor(F.rank().over(by_value) + (F.count("*").over(ties) - 1) / 2).cast("int")
    wide = (importance.withColumn("_rank", mean_rank).groupBy("feature")
            .agg(*[F.max(F.when(F.col("horizon") == h, F.col("_rank"))).alias(f"rank_{h}d")
                   for h in horizons]))
    first, last = horizons[0], horizons[-1]
    return wide.withColumn(f"rank_shift_{first}_to_{last}",
                           F.col(f"rank_{first}d") - F.col(f"rank_{last}d"))


def top_features(importance: DataFrame, k: int = 15) -> DataFrame:
    """The k features with the highest mean importance over the horizons."""
    return (importance.groupBy("feature").agg(F.avg("importance").alias("overall_avg"))
            .orderBy(F.desc("overall_avg"), "feature").limit(k))


def promotion(challengers: DataFrame, versions: DataFrame,
              min_auc_pr: float = contract.MIN_AUC_PR, tolerance_pct: float = 0.0,
              enforce_floor_on_first: bool = False) -> DataFrame:
    """Decide Champion or Challenger per horizon against the newest champion.

    ``challengers``: (horizon, test_auc_pr). ``versions``: an append-only log
    (horizon, version, alias, test_auc_pr). The first model of a horizon is
    promoted; the floor holds for it only on request. A challenger without a value is never
    promoted, and a champion without one is replaced by whatever passes the floor.
    """
    champions = (versions.where(F.col("alias") == "Champion").groupBy("horizon")
                 .agg(F.max_by("test_auc_pr", "version").alias("champion_auc_pr"), F.lit(True).alias("_has")))
    new, old = F.col("test_auc_pr"), F.col("champion_auc_pr")
    first = F.col("_has").isNull()
    unmeasured = new.isNull() | F.isnan(new)
    unknown = ~first & (old.isNull() | F.isnan(old))      # a champion nobody measured: the floor decides
    change = F.try_divide(new - old, old) * 100
    below = new < min_auc_pr
    worse = ~unknown & (new < old * (1 - tolerance_pct / 100))
    floored = below if enforce_floor_on_first else (~first & below)
    reason = (F.when(unmeasured, "Not measured")
              .when(floored, F.format_string(f"Below minimum threshold (%.4f < {min_auc_pr})", new))
              .when(first, "First model")
              .when(unknown, "Champion was not measured")
              .when(worse, F.format_string("Regression detected (%+.2f%%)", change))
              .otherwise(F.format_string("Performance improvement: %+.2f%%", change)))
    promoted = ~unmeasured & ~floored & (first | ~worse)
    return (challengers.join(champions, "horizon", "left")
            .withColumns({"promoted": promoted,
                          "alias": F.when(promoted, "Champion").otherwise("Challenger"),
                          "reason": reason, "requires_review": ~promoted}).drop("_has"))


def run_log(params: Mapping[int, Mapping[str, float]], spark, run_id: str) -> DataFrame:
    """Parameters and metrics of a training run as long rows (run_id, horizon, name, value)."""
    return spark.createDataFrame(
        [(run_id, h, name, float(v)) for h, per in params.items() for name, v in per.items()],
        "run_id string, horizon int, name string, value double")
