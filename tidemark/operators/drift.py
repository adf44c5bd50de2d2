"""Drift from stored counts: bins per (month, slice, column) that merge by addition.

Rows are binned once, at the baseline's quantiles, and only counts are kept. A new month or a late day adds
counts; stability of any month and slice is read from them, without going back to the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import contract
from tidemark.contract import OBSERVED
from tidemark.functions.columns import month_key
from tidemark.operators.quantiles import long_values
from tidemark.operators.running import interpolated

CUBE_KEYS = ("month", "slice_key", "slice_value", "feature", "bin")


def baseline_edges(baseline: DataFrame, features: Sequence[str], bins: int = 10) -> DataFrame:
    """(feature, edges): the inner quantile edges of each column, distinct and in order; a row per column."""
    counted = (long_values(baseline, features).where(F.col("value").isNotNull() & ~F.isnan("value"))
               .groupBy("feature", "value").agg(F.count("*").alias("n")))
    return interpolated(counted, ["feature"], "value", "n", [i / bins for i in range(1, bins)]).select(
        "feature", F.array_sort(F.array_distinct("points")).alias("edges"))


def drift_cube(df: DataFrame, features: Sequence[str], edges: DataFrame, slices: Sequence[str] = (),
               date: str = OBSERVED) -> DataFrame:
    """(month, slice_key, slice_value, feature, bin, n): counts overall and per value of each slice.

    Bins are right-closed and open at both ends, so infinite values are in the outer ones; bin -1 counts
    nulls. Rows are counted per bin and all slices together first, on the map side, and only
    those counts are copied to the slices.
    """
    held = df.withColumns({"_month": month_key(date), "_slices": F.struct(F.lit("all").alias("all"), *[
        F.col(s).cast("string").alias(s) for s in slices])})
    value = F.col("value")
    place = F.when(value.isNull(), -1).otherwise(F.size(F.filter("edges", lambda e: e < value)))
    counted = (long_values(held, features, ["_month", "_slices"]).join(F.broadcast(edges), "feature")
               .groupBy("_month", "_slices", "feature", place.alias("bin")).agg(F.count("*").alias("n")))
    lines = F.array(*[F.struct(F.lit(s).alias("slice_key"), F.col("_slices")[s].alias("slice_value"))
                      for s in ("all", *slices)])
    return (counted.select(F.col("_month").alias("month"), F.inline(lines), "feature", "bin", "n")
            .groupBy(*CUBE_KEYS).agg(F.sum("n").alias("n")))


def merged_cube(cubes: DataFrame) -> DataFrame:
    """One row per cell from several cubes laid together."""
    return cubes.groupBy(*CUBE_KEYS).agg(F.sum("n").alias("n"))


def cube_stability(cube: DataFrame, baseline: Column, floor: float = 1e-4, limit: float = contract.MAX_PSI
                   ) -> DataFrame:
    """(month, slice_key, slice_value, feature, psi, drifted) of every month outside the baseline.

    ``baseline`` is a condition on ``month``. Each slice is held against the same slice of the baseline
    months; where that has no rows, ``psi`` is null. Empty bins count as ``floor``.
    """
    known = cube.where(F.col("bin") >= 0)
    group = ["slice_key", "slice_value", "feature"]
    cells = F.map_from_entries(F.collect_list(F.struct("bin", "n")))        # at most one entry per bin

    def cells_of(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
        per_bin = df.groupBy(*keys, "bin").agg(F.sum("n").alias("n"))
        return per_bin.groupBy(*keys).agg(cells.alias(name), F.sum("n").alias(f"{name}_all"))

    then = cells_of(known.where(baseline), group, "then").withColumn("_key", F.struct(*group))
    now = cells_of(known.where(~baseline), ["month", *group], "now").withColumn("_key", F.struct(*group))
    both = now.join(then.select("_key", "then", "then_all"), "_key", "left")

    def share(counts: str, place: Column) -> Column:
        n = F.coalesce(F.try_element_at(F.col(counts), place), F.lit(0))
        return F.greatest(n / F.col(f"{counts}_all"), F.lit(floor))

    def term(place: Column) -> Column:
        p, q = share("now", place), share("then", place)
        return (p - q) * F.log(p / q)

    places = F.array_sort(F.array_union(F.map_keys("now"), F.map_keys("then")))
    psi = F.aggregate(places, F.lit(0.0), lambda total, place: total + term(place))
    return both.select("month", *group, F.when(F.col("then_all") > 0, psi).alias("psi")).withColumn(
        "drifted", F.coalesce(F.col("psi") > limit, F.lit(False)))
