"""Exploratory reports: null rates, frequencies, group means, volumes, summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.contract import ENTITY
from tidemark.functions.columns import month_key
from tidemark.operators.quantiles import exact_quantiles, long_values


def null_report(df: DataFrame, name: str) -> DataFrame:
    """(dataset, column, null_count, null_pct) for all columns in one pass."""
    counts = df.agg(F.count("*").alias("_rows"),
                    *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return (counts.unpivot(["_rows"], df.columns, "column", "null_count")
            .select(F.lit(name).alias("dataset"), "column", "null_count",
                    F.round(F.col("null_count") / F.col("_rows") * 100, 2).alias("null_pct")))


def frequency(df: DataFrame, column: str) -> DataFrame:
    """Values by descending count, ties by value."""
    return (df.groupBy(column).agg(F.count("*").alias("count"))
            .orderBy(F.desc("count"), F.asc_nulls_first(column)))


def distinct_by(df: DataFrame, by: str, key: str = ENTITY, approximate: bool = False) -> DataFrame:
    """Distinct keys and rows per group."""
    distinct = F.approx_count_distinct(key) if approximate else F.count_distinct(key)
    return df.groupBy(by).agg(distinct.alias("unique_customers"), F.count("*").alias("total_rows"))


def group_means(df: DataFrame, by: str, means: Mapping[str, str], count: str) -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias(count),
                              *[F.avg(c).alias(out) for out, c in means.items()])


def monthly_volume(df: DataFrame, date: str, month: str, count: str) -> DataFrame:
    return (df.groupBy(month_key(F.col(date).try_cast("date")).alias(month))
            .agg(F.count("*").alias(count)).orderBy(month))


def repeat_entities(events: DataFrame, entity: str = ENTITY, more_than: int = 1,
                    count: str = "cease_count") -> DataFrame:
    return events.groupBy(entity).agg(F.count("*").alias(count)).where(F.col(count) > more_than)


def count_of_counts(events: DataFrame, entity: str = ENTITY, count: str = "cease_count",
                    more_than: int = 0) -> DataFrame:
    """How many entities had k events."""
    return (repeat_entities(events, entity, more_than, count)
            .groupBy(count).agg(F.count("*").alias("customers")).orderBy(count))


def summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, count, mean, stddev, min, p25, p50, p75, max), quartiles exact and interpolated.

    The moments come from one pass over the wide table; the quartiles from
    histograms that are narrowed until each order statistic is known.
    """
    stats = [F.struct(F.lit(c).alias("column"), F.count(c).alias("count"), F.avg(c).alias("mean"),
                      F.stddev_samp(c).alias("stddev"), F.min(c).alias("min"),
                      F.max(c).alias("max")) for c in columns]
    moments = df.agg(F.array(*stats).alias("_s")).select(F.inline("_s"))
    quartiles = exact_quantiles(long_values(df, columns), "feature", "value", (.25, .5, .75))
    points = df.sparkSession.createDataFrame(
        [(c, *quartiles.get(c, (None, None, None))) for c in columns],
        "column string, p25 double, p50 double, p75 double")
    return (moments.join(points, "column", "left")
            .select("column", "count", "mean", "stddev", "min", "p25", "p50", "p75", "max"))
