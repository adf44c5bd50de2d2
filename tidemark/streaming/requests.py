"""Request-log metrics on an unbounded log.

Two ways: windows that close for good when the watermark passes them (``windowed_requests``,
``counted_tiers``), and counts per minute that are merged batch by batch (``minute_table``,
``session_table``), from which every window, also the newest, can be read at any time and which a late
row still changes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.requests import sliding
from tidemark.streaming.merging import MergedTable


def windowed_requests(log: DataFrame, by: Sequence[str] = ("endpoint",),
                      length: str = "5 minutes", step: str = "1 minute",
                      late: str = "10 minutes") -> DataFrame:
    """Requests, errors and error ratio per sliding window and key.

    Rows later than ``late`` behind the newest time seen are left out, and the
    state of a window is freed once it is emitted.
    """
    counted = (log.withWatermark("ts", late)
               .groupBy(F.window("ts", length, step).alias("_w"), *by)
               .agg(F.count("*").alias("requests"),
                    F.count_if(F.col("status") == "error").alias("errors")))
    return counted.select(
        F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *by,
        "requests", "errors", (F.col("errors") / F.col("requests")).alias("error_ratio"))


def counted_tiers(log: DataFrame, by: str = "tier", length: str = "1 hour",
                  late: str = "10 minutes") -> DataFrame:
    return (log.withWatermark("ts", late).groupBy(F.window("ts", length).alias("_w"), by)
            .agg(F.count("*").alias("count"))
            .select(F.col("_w.start").alias("window_start"), by, "count"))


def minute_counts(log: DataFrame, by: Sequence[str]) -> DataFrame:
    """Requests and errors per (minute, key): the partial rows of a ``minute_table``."""
    return (log.where(F.col("ts").isNotNull()).groupBy(F.date_trunc("minute", "ts").alias("minute"), *by)
            .agg(F.count("*").alias("requests"), F.count_if(F.col("status") == "error").alias("errors")))


def minute_table(log: DataFrame, path: str, by: Sequence[str], keep: int = 8) -> MergedTable:
    def merge(partial: DataFrame) -> DataFrame:
        return partial.groupBy("minute", *by).agg(F.sum("requests").alias("requests"), F.sum("errors").alias("errors"))

    return MergedTable(log.sparkSession, path, minute_counts(log, by).schema, merge, keep=keep)


def windows_of(minutes: DataFrame, by: Sequence[str] = ("endpoint",), length: str = "5 minutes") -> DataFrame:
    """Requests, errors and error ratio per window of ``length``, one starting each minute, up to the newest row."""
    counted = sliding(minutes, by, {"requests": F.sum("requests"), "errors": F.sum("errors")}, length, ts="minute")
    return counted.withColumn("error_ratio", F.col("errors") / F.col("requests"))


def counts_of(minutes: DataFrame, by: str = "tier", length: str = "1 hour") -> DataFrame:
    """Rows per tumbling window and value, up to the newest row."""
    return (minutes.groupBy(F.window("minute", length).alias("_w"), by).agg(F.sum("requests").alias("count"))
            .select(F.col("_w.start").alias("window_start"), by, "count"))


def sessions(log: DataFrame, by: Sequence[str], minutes: int = 30) -> DataFrame:
    """Stretches without a silence of ``minutes``, per key: the partial rows of a ``session_table``."""
    return (log.where(F.col("ts").isNotNull()).groupBy(F.session_window("ts", f"{minutes} minutes").alias("_s"), *by)
            .agg(F.min("ts").alias("first"), F.max("ts").alias("last")).select(*by, "first", "last"))


def joined_sessions(partial: DataFrame, by: Sequence[str], minutes: int = 30) -> DataFrame:
    """Stretches of several batches as one: those that overlap, or follow within ``minutes``, are joined.

    A key's stretches lie in one task: at most one for each half ``minutes`` of the calendar and folder.
    """
    order = Window.partitionBy(*by).orderBy("first", "last")
    reached = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.unix_micros("first") - F.unix_micros(reached) < minutes * 60_000_000, 0).otherwise(1)
    numbered = partial.withColumn("_opens", opens).withColumn(
        "_number", F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return (numbered.groupBy(*by, "_number").agg(F.min("first").alias("first"), F.max("last").alias("last"))
            .drop("_number"))


def session_table(log: DataFrame, path: str, by: Sequence[str], minutes: int = 30, keep: int = 8) -> MergedTable:
    return MergedTable(log.sparkSession, path, sessions(log, by, minutes).schema,
                       lambda partial: joined_sessions(partial, by, minutes), keep=keep)


def silences_of(stretches: DataFrame, by: Sequence[str], until: Column, known: DataFrame | None = None,
                minutes: int = 30) -> DataFrame:
    """Silences longer than ``minutes`` per key: (by..., silent_from, silent_until, seconds).

    The last one lasts to ``until``. Keys of ``known`` that never spoke have no beginning and no length.
    """
    following = F.coalesce(F.lead("first").over(Window.partitionBy(*by).orderBy("first")), until.cast("timestamp"))
    gap = (F.unix_micros("silent_until") - F.unix_micros("silent_from")) / 1e6
    found = (stretches.select(*by, F.col("last").alias("silent_from"), following.alias("silent_until"))
             .withColumn("seconds", gap).where(F.col("seconds") > minutes * 60))
    if known is None:
        return found
    same = [F.col(f"k.{c}").eqNullSafe(F.col(f"s.{c}")) for c in by]
    never = known.select(*by).distinct().alias("k").join(stretches.select(*by).distinct().alias("s"), same, "left_anti")
    return found.unionByName(never.select(
        *by, F.lit(None).cast("timestamp").alias("silent_from"), until.cast("timestamp").alias("silent_until"),
        F.lit(None).cast("double").alias("seconds")))


def spoken_until(stretches: DataFrame) -> Column:
    """The newest time in a session table, as a scalar for ``silences_of``."""
    return stretches.agg(F.max("last")).scalar()
