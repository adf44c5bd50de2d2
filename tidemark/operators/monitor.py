"""Profiles, drift, retrospective performance and alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import contract
from tidemark.contract import ENTITY, HORIZONS, OBSERVED, probability_name
from tidemark.functions.columns import month_key
from tidemark.operators.evaluation import ranking_metrics, score_histogram
from tidemark.operators.quantiles import edges_frame, exact_quantiles, long_values, values_at_rank
from tidemark.operators.temporal import horizon_labels

QUARTILES = (.25, .5, .75)


def feature_profile(df: DataFrame, features: Sequence[str],
                    slices: Sequence[str] = ("technology", "sales_channel"),
                    date: str = OBSERVED) -> DataFrame:
    """(month, slice_key, slice_value, feature, statistics), overall and per slice.

    Each row is aggregated wide for all features under grouping sets, and only the finished
    groups are turned long. Quartiles are the values at the rank, exact at any size, from counts
    per (month, slice, feature, value).
    """
    found = _profile(df, features, slices, date, None)
    names = [c for c in found.columns if c not in ("p25", "median", "p75")]
    group = F.struct("month", "slice_key", "slice_value", "feature").alias("_group")
    month = month_key(date).alias("month")
    each = (long_values(df.withColumns({"_month": month, "_slices": F.struct(*slices)}), features, ["_month", "_slices"])
            .where(F.col("value").isNotNull()).groupBy("_month", "_slices", "feature", "value")
            .agg(F.count("*").alias("n")))
    sliced = F.array(F.struct(F.lit("all").alias("slice_key"), F.lit("all").alias("slice_value")), *[
        F.struct(F.lit(s).alias("slice_key"), F.col("_slices")[s].cast("string").alias("slice_value")) for s in slices])
    counted = (each.select(F.col("_month").alias("month"), "feature", "value", "n", F.inline(sliced))
               .groupBy(group, "value").agg(F.sum("n").alias("n")))
    points = values_at_rank(counted, "_group", "value", "n", QUARTILES)
    return (found.select(*names).withColumn("_group", group).join(points, "_group", "left")
            .select(*[F.col("points")[("p25", "median", "p75").index(c)].alias(c) if c not in names else c
                      for c in found.columns]))


def sketched_profile(df: DataFrame, features: Sequence[str],
                     slices: Sequence[str] = ("technology", "sales_channel"),
                     date: str = OBSERVED, accuracy: int = 10000) -> DataFrame:
    """`feature_profile` in one pass, with approximate quartiles from sketches of fixed size."""
    return _profile(df, features, slices, date, accuracy)


def _profile(df: DataFrame, features: Sequence[str], slices: Sequence[str], date: str,
             accuracy: int | None) -> DataFrame:
    """The statistics of each group; without an accuracy the quartiles are null."""
    stats = []
    for f in features:
        v = F.col(f).cast("double")
        points = (F.lit(None).cast("array<double>") if accuracy is None else
                  F.percentile_approx(v, F.array(*[F.lit(q) for q in QUARTILES]), accuracy))
        stats.append(F.struct(F.count(v).alias("count"),
                              F.avg(F.when(v.isNull(), 1.0).otherwise(0.0)).alias("null_rate"),
                              F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
                              F.min(v).alias("min"), points.alias("points"),
                              F.max(v).alias("max")).alias(f))
    monthly = df.select(month_key(date).alias("month"), *slices, *features)
    sets = [["month"], *[["month", s] for s in slices]]
    grouped = monthly.groupingSets(sets, "month", *slices).agg(
        F.grouping_id().alias("_gid"), *stats)
    # grouping_id has a 0 bit for each column that is part of the set
    bits = len(slices)
    key, value = F.lit("all"), F.lit("all")
    for i, s in enumerate(slices):
        mine = ((1 << bits) - 1) & ~(1 << (bits - 1 - i))
        key = F.when(F.col("_gid") == mine, F.lit(s)).otherwise(key)
        value = F.when(F.col("_gid") == mine, F.col(s)).otherwise(value)
    lines = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("s")) for f in features])
    s = F.col("s")
    return (grouped.select("month", key.alias("slice_key"), value.alias("slice_value"),
                           F.inline(lines))
            .select("month", "slice_key", "slice_value", "feature",
                    s["count"].alias("count"), s["null_rate"].alias("null_rate"),
                    s["mean"].alias("mean"), s["std"].alias("std"), s["min"].alias("min"),
                    s["points"][0].alias("p25"), s["points"][1].alias("median"),
                    s["points"][2].alias("p75"), s["max"].alias("max")))


def population_stability(baseline: DataFrame, current: DataFrame, features: Sequence[str],
                         bins: int = 10, floor: float = 1e-4,
                         limit: float = contract.MAX_PSI) -> DataFrame:
    """(feature, psi, drifted): population stability over baseline quantile bins.

    Bins are right-closed and open at both ends; empty ones count as ``floor``.
    Rows of both sides are counted per (feature, bin) in one shuffle of that size.
    """
    inner = [i / bins for i in range(1, bins)]
    cuts = exact_quantiles(long_values(baseline, features), "feature", "value", inner)
    edges = F.broadcast(edges_frame(baseline.sparkSession, cuts))
    rows = (long_values(baseline, features, [F.lit(1).alias("_base")])
            .unionByName(long_values(current, features, [F.lit(0).alias("_base")]))
            .where(F.col("value").isNotNull()))
    counts = (rows.join(edges, "feature")
              .groupBy("feature", F.size("edges").alias("_cuts"),
                       F.size(F.filter("edges", lambda e: e < F.col("value"))).alias("_bin"))
              .agg(F.sum("_base").alias("b"), F.sum(1 - F.col("_base")).alias("c")))
    per_bin = counts.groupBy("feature").agg(
        F.sum("b").alias("B"), F.sum("c").alias("C"), F.max("_cuts").alias("cuts"),
        F.collect_list(F.struct("b", "c")).alias("cells"))        # at most `bins` cells

    def term(b: Column, c: Column) -> Column:
        q = F.greatest(b / F.col("B"), F.lit(floor))
        p = F.greatest(c / F.col("C"), F.lit(floor))
        return (p - q) * F.log(p / q)

    psi = F.aggregate("cells", F.lit(0.0), lambda acc, x: acc + term(x["b"], x["c"]))
    # bins without a row on either side have equal floors and add nothing
    return (per_bin.select("feature", F.when((F.col("B") > 0) & (F.col("C") > 0), psi).alias("psi"))
            .withColumn("drifted", F.coalesce(F.col("psi") > limit, F.lit(False))))


def null_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    rates = df.agg(*[F.avg(F.when(F.col(c).isNull(), 1.0).otherwise(0.0)).alias(c)
                     for c in columns])
    return rates.unpivot([], list(columns), "column", "null_rate")


def null_rate_alerts(baseline: DataFrame, current: DataFrame, columns: Sequence[str],
                     limit: float = contract.MAX_NULL_RATE_RISE) -> DataFrame:
    """Columns with their null rates then and now, and whether the rise passes the limit."""
    then = null_rates(baseline, columns).withColumnRenamed("null_rate", "baseline_rate")
    now = null_rates(current, columns).withColumnRenamed("null_rate", "current_rate")
    return then.join(now, "column").withColumn(
        "alert", F.col("current_rate") - F.col("baseline_rate") > limit)


def retrospective(scores: DataFrame, ceases: DataFrame, horizons: Sequence[int] = HORIZONS,
                  digits: int | None = None, date: str = "score_date", as_of: Column | None = None) -> DataFrame:
    """Quality of past scores against what happened, per score date and horizon.

    One row per (entity, score date) is expected, as scoring writes them. With ``as_of``, the date of
    asking, only windows that have closed by then are measured; without it all are, as if closed.
    """
    wanted = scores.select(ENTITY, date, *[probability_name(h) for h in horizons])
    if as_of is not None:       # before the join with the events: open dates need none
        wanted = wanted.where(F.date_add(date, min(horizons)) <= as_of)
    actual = horizon_labels(wanted, ceases, horizons, observed=date)
    counted = score_histogram(actual, horizons, digits, by=[date])
    if as_of is not None:
        counted = counted.where(F.expr(f"date_add(`{date}`, horizon)") <= as_of)
    return ranking_metrics(counted, by=[date])


def newly_measured(measured: DataFrame, ledger: DataFrame, keys: Sequence[str] = ("score_date", "horizon")) -> DataFrame:
    """The measured windows that the ledger does not hold yet: each is entered once."""
    return measured.join(ledger.select(*keys).distinct(), list(keys), "left_anti")


def metric_log(metrics: DataFrame, keys: Sequence[str] = ("score_date", "horizon")) -> DataFrame:
    """Wide metrics as long rows of the append-only log; missing values are left out."""
    names = [c for c in metrics.columns if c not in keys]
    lines = F.array(*[F.struct(F.lit(c).alias("metric_name"),
                               F.col(c).cast("double").alias("metric_value")) for c in names])
    return metrics.select(*keys, F.inline(lines)).where(F.col("metric_value").isNotNull())


def score_alerts(scores: DataFrame, baseline_means: DataFrame | None = None) -> DataFrame:
    """(code, horizon, value, message) for one scoring run; no rows means all clear.

    All checks come from one aggregation row. ``baseline_means`` (horizon,
    mean_probability) adds the check for a shifted mean.
    """
    aggs = [F.count("*").alias("n"),
            F.count_if(F.col("risk_tier") == "RED").alias("red"),
            F.count_if(F.col("risk_tier") == "GREEN").alias("green")]
    for h in HORIZONS:
        p = F.col(probability_name(h))
        aggs += [F.avg(p).alias(f"m{h}"), F.stddev_samp(p).alias(f"s{h}")]
    totals = scores.agg(*aggs)

    def line(code: str, horizon: int | None, value: Column, fires: Column, text: Column) -> Column:
        return F.struct(F.lit(code).alias("code"), F.lit(horizon).cast("int").alias("horizon"),
                        value.alias("value"), text.alias("message"), fires.alias("_fires"))

    lines = []
    for h in HORIZONS:
        mean, std = F.col(f"m{h}"), F.col(f"s{h}")
        lines.append(line("mean_too_high", h, mean, mean > contract.MAX_MEAN_PROBABILITY,
                          F.format_string(f"{h}d mean prediction (%.3f) is unusually high", mean)))
        lines.append(line("collapsed_variance", h, std, std < contract.MIN_PROBABILITY_STD,
                          F.format_string(f"{h}d prediction deviation (%.4f) is very low", std)))
    red, green = F.col("red") / F.col("n"), F.col("green") / F.col("n")
    lines.append(line("red_concentration", None, red, red > contract.MAX_RED_SHARE,
                      F.format_string("%.1f%% of customers in RED tier", red * 100)))
    lines.append(line("green_concentration", None, green, green > contract.MAX_GREEN_SHARE,
                      F.format_string("%.1f%% of customers in GREEN tier", green * 100)))
    alerts = totals.where(F.col("n") > 0).select(F.inline(F.array(*lines)))
    if baseline_means is not None:
        now = totals.select(F.inline(F.array(*[
            F.struct(F.lit(h).alias("horizon"), F.col(f"m{h}").alias("now")) for h in HORIZONS])))
        shift = F.try_divide(F.col("now"), F.col("mean_probability")) - 1
        alerts = alerts.unionByName(
            baseline_means.select("horizon", "mean_probability").join(F.broadcast(now), "horizon")
            .select(F.lit("mean_shift").alias("code"), F.col("horizon").cast("int"),
                    shift.alias("value"),
                    F.format_string("%dd mean prediction moved by %+.1f%%", F.col("horizon"),
                                    shift * 100).alias("message"),
                    (F.abs(shift) > contract.MAX_MEAN_SHIFT).alias("_fires")))
    return alerts.where(F.col("_fires")).drop("_fires")


def quality_drop(metrics: DataFrame, versions: DataFrame,
                 limit: float = contract.MAX_AUC_PR_DROP) -> DataFrame:
    """Measured average precision against the newest champion of each horizon."""
    champions = (versions.where(F.col("alias") == "Champion").groupBy("horizon")
                 .agg(F.max_by("test_auc_pr", "version").alias("champion_auc_pr")))
    drop = 1 - F.try_divide(F.col("auc_pr"), F.col("champion_auc_pr"))
    return (metrics.join(F.broadcast(champions), "horizon")
            .withColumns({"relative_drop": drop,
                          "retrain": F.coalesce(drop > limit, F.lit(False))}))


def retrain_flag(alerts: DataFrame) -> DataFrame:
    """One row: is there any alert, and how many."""
    return alerts.agg((F.count("*") > 0).alias("retrain_needed"), F.count("*").alias("alerts"))
