"""Running sums over a long order, for values of any distribution.

The order is cut into ranges of nearly equal length at sketched quantiles of its own values, as a range
partitioning does. Sums of whole ranges give each range its offset; a second pass adds up inside the
ranges. A range holds at most ``1 / cells + 2 / accuracy`` of a group's rows, however they lie, so no task
sees a group whole. The cuts only say which rows work together: the sums are exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELLS = 256             # a power of two
ACCURACY = 16 * CELLS   # so a cell has at most 1.125 times its share


def _cell(value: Column, cuts: Column, cells: int) -> Column:
    """How many of the sorted cuts lie below the value, by halving. Nulls are in cell 0."""
    steps = [1 << i for i in reversed(range(cells.bit_length() - 1))]
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: at + F.when(
        F.get(cuts, at + step - 1) < value, step).otherwise(0))


def with_cells(df: DataFrame, by: Sequence[str], order: str, cells: int = CELLS) -> DataFrame:
    """Add ``_key``, the group as a struct, and ``_cell``, the place of the row's range in its group.

    ``order`` is a number or a time; rows should be unique by group and order, as equal ones stay together.
    NaN is the largest value. Null groups are groups.
    """
    if cells & (cells - 1):
        raise ValueError(f"cells must be a power of two: {cells}")
    held = df.withColumn("_key", F.struct(*[F.col(c) for c in by]) if by else F.struct(F.lit(0).alias("all")))
    points = F.array(*[F.lit(i / cells) for i in range(1, cells)])
    cuts = held.groupBy("_key").agg(F.percentile_approx(order, points, ACCURACY).alias("_cuts"))
    return held.join(cuts, "_key").withColumn("_cell", _cell(F.col(order), F.col("_cuts"), cells)).drop("_cuts")


def running_sums(df: DataFrame, by: Sequence[str], order: str, sums: Mapping[str, str],
                 totals: Mapping[str, str] | None = None, descending: bool = False,
                 cells: int | None = CELLS) -> DataFrame:
    """Add running sums up to and with the row, {new column: summed one}, and totals of the group.

    One row per (group, value of ``order``) is expected. ``cells=None`` sums in one level, for
    groups known to be small.
    """
    def along(name: str) -> Column:
        return F.desc(name) if descending else F.asc(name)

    totals = totals or {}
    upto = (Window.unboundedPreceding, 0)
    if cells is None:
        group = Window.partitionBy(*(by or [F.lit(0)]))
        ordered = group.orderBy(along(order)).rowsBetween(*upto)
        return df.withColumns({out: F.sum(c).over(ordered) for out, c in sums.items()}
                              | {out: F.sum(c).over(group) for out, c in totals.items()})
    placed = with_cells(df, by, order, cells)
    group = Window.partitionBy("_key")
    earlier = group.orderBy(along("_cell")).rowsBetween(Window.unboundedPreceding, -1)
    summed = sorted({*sums.values(), *totals.values()})
    whole = placed.groupBy("_key", "_cell").agg(*[F.sum(c).alias(f"_sum_{c}") for c in summed])
    offsets = whole.select("_key", "_cell",
                           *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_before_{out}")
                             for out, c in sums.items()],
                           *[F.sum(f"_sum_{c}").over(group).alias(out) for out, c in totals.items()])
    inside = Window.partitionBy("_key", "_cell").orderBy(along(order)).rowsBetween(*upto)
    return (placed.join(offsets, ["_key", "_cell"])
            .withColumns({out: F.col(f"_before_{out}") + F.sum(c).over(inside) for out, c in sums.items()})
            .select(*df.columns, *sums, *totals))


def interpolated(counted: DataFrame, by: Sequence[str], value: str, n: str, points: Sequence[float]) -> DataFrame:
    """(by..., points): linearly interpolated quantiles of each group, exact at any size.

    ``counted`` has a row per (group, value) with its number of rows.
    """
    known = counted.where(F.col(value).isNotNull() & (F.col(n) > 0))
    summed = running_sums(known, by, value, {"_upto": n}, {"_all": n})

    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("_upto") > rank, F.col(value)))

    places = [(F.col("_all") - 1) * F.lit(p) for p in points]
    found = summed.groupBy(*by).agg(
        F.max("_all").alias("_all"), *[at(F.floor(x)).alias(f"_lo{i}") for i, x in enumerate(places)],
        *[at(F.ceil(x)).alias(f"_hi{i}") for i, x in enumerate(places)])

    def between(i: int) -> Column:
        place, lo, hi = places[i], F.col(f"_lo{i}"), F.col(f"_hi{i}")
        return F.when((F.floor(place) == F.ceil(place)) | (lo == hi), lo).otherwise(
            (F.ceil(place) - place) * lo + (place - F.floor(place)) * hi)

    return found.select(*by, F.array(*[between(i) for i in range(len(points))]).alias("points"))
