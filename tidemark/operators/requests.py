"""Windowed metrics of a request log: rates, error ratio, latency, silence, sustained conditions.

Sliding windows are fed from one-minute counts: rows are first reduced to
(minute, key), and only these counts are copied into the windows that overlap
them. A log has ``ts, endpoint, status, latency_seconds``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.contract import LATENCY_BUCKETS, MAX_ERROR_RATIO, MAX_P99_SECONDS
from tidemark.operators.quantiles import values_at_rank
from tidemark.operators.running import running_sums

_STEP = "1 minute"
_DAY = 1440             # minutes


def sliding(log: DataFrame, by: Sequence[str], counts: Mapping[str, Column], length: str,
            step: str = _STEP, ts: str = "ts") -> DataFrame:
    """Sums of per-row counts over sliding windows: (window_start, window_end, by..., counts...)."""
    cells = (log.groupBy(F.window(ts, step).alias("_cell"), *by)
             .agg(*[c.alias(n) for n, c in counts.items()]))
    return (cells.withColumn("_at", F.col("_cell.start")).drop("_cell")
            .groupBy(F.window("_at", length, step).alias("_w"), *by)
            .agg(*[F.sum(n).alias(n) for n in counts])
            .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                    *by, *counts))


def request_rate(log: DataFrame, by: Sequence[str] = ("endpoint",), length: str = "5 minutes"
                 ) -> DataFrame:
    """Requests and requests per second over the trailing window, each minute."""
    seconds = F.unix_timestamp("window_end") - F.unix_timestamp("window_start")
    return (sliding(log, by, {"requests": F.count("*")}, length)
            .withColumn("per_second", F.col("requests") / seconds))


def error_ratio(log: DataFrame, by: Sequence[str] = (), length: str = "5 minutes",
                limit: float = MAX_ERROR_RATIO) -> DataFrame:
    return (sliding(log, by, {"requests": F.count("*"),
                              "errors": F.count_if(F.col("status") == "error")}, length)
            .withColumn("error_ratio", F.col("errors") / F.col("requests"))
            .withColumn("alert", F.col("error_ratio") > limit))


def _interpolated(q: float, edges: Sequence[float], total: Column) -> Column:
    """Quantile from cumulative bucket counts ``le_i``, linear inside the bucket.

    A rank beyond the last edge gives the last edge.
    """
    rank = total * q
    result = F.lit(float(edges[-1]))
    for i in range(len(edges) - 1, -1, -1):
        low = F.lit(float(edges[i - 1]) if i else 0.0)
        before = F.col(f"le_{i - 1}") if i else F.lit(0)
        inside = F.col(f"le_{i}") - before
        at = low + (F.lit(float(edges[i])) - low) * F.try_divide(rank - before, inside)
        result = F.when(F.col(f"le_{i}") >= rank, at).otherwise(result)
    return result


def latency_quantiles(log: DataFrame, by: Sequence[str] = (), length: str = "5 minutes",
                      quantiles: Sequence[float] = (.5, .95, .99),
                      edges: Sequence[float] = LATENCY_BUCKETS,
                      limit: float = MAX_P99_SECONDS) -> DataFrame:
    """Latency quantiles estimated from fixed buckets, so a window holds nine counts, not rows."""
    counts = {f"le_{i}": F.count_if(F.col("latency_seconds") <= e) for i, e in enumerate(edges)}
    counts["requests"] = F.count("latency_seconds")
    windows = sliding(log, by, counts, length)
    named = {f"p{round(q * 100)}": _interpolated(q, edges, F.col("requests")) for q in quantiles}
    return (windows.withColumns(named)
            .withColumn("alert", F.col(list(named)[-1]) > limit)
            .drop(*[f"le_{i}" for i in range(len(edges))]))


def latency_at_rank(log: DataFrame, by: Sequence[str] = (), length: str = "5 minutes",
                    quantiles: Sequence[float] = (.5, .95, .99)) -> DataFrame:
    """Latency quantiles at the rank over tumbling windows, exact at any size.

    Rows are counted per (window, key, latency) first, with partial sums; running counts then go over
    ranges of a window's latencies, so a window of any size is many tasks' work. Rows without a latency
    count as requests only.
    """
    keys = F.struct(F.window("ts", length).alias("w"), *by).alias("_keys")
    cells = log.groupBy(keys, "latency_seconds").agg(F.count("*").alias("_n"))
    requests = cells.groupBy("_keys").agg(F.sum("_n").alias("requests"))
    found = values_at_rank(cells.where(F.col("latency_seconds").isNotNull()), "_keys", "latency_seconds", "_n", quantiles)
    return requests.join(found, "_keys", "left").select(
        F.col("_keys.w.start").alias("window_start"), *[F.col("_keys")[b].alias(b) for b in by], "requests",
        *[F.col("points")[i].alias(f"p{round(q * 100)}") for i, q in enumerate(quantiles)])


def sketched_latency(log: DataFrame, by: Sequence[str] = (), length: str = "5 minutes",
                     quantiles: Sequence[float] = (.5, .95, .99)) -> DataFrame:
    """Approximate latency quantiles over tumbling windows, from sketches of fixed size."""
    points = F.percentile_approx("latency_seconds", F.array(*[F.lit(q) for q in quantiles]), 10000)
    return (log.groupBy(F.window("ts", length).alias("_w"), *by)
            .agg(F.count("*").alias("requests"), points.alias("_p"))
            .select(F.col("_w.start").alias("window_start"), *by, "requests",
                    *[F.col("_p")[i].alias(f"p{round(q * 100)}") for i, q in enumerate(quantiles)]))


def counts_per(log: DataFrame, by: str, length: str = "1 hour") -> DataFrame:
    """Rows per tumbling window and value."""
    return (log.groupBy(F.window("ts", length).alias("_w"), by)
            .agg(F.count("*").alias("count"))
            .select(F.col("_w.start").alias("window_start"), by, "count"))


def silences(log: DataFrame, minutes: int = 30, by: Sequence[str] = (),
             until: Column | None = None) -> DataFrame:
    """Stretches longer than ``minutes`` without a row, per key: (silent_from, silent_until, seconds).

    With ``until``, the time of asking, a silence that is still going on counts up to then.
    Rows are reduced to first and last time per (key, minute) before the ordered
    window, which then holds one row per minute of the calendar at most.
    """
    cells = (log.where(F.col("ts").isNotNull()).groupBy(F.date_trunc("minute", "ts").alias("_m"), *by)
             .agg(F.min("ts").alias("_first"), F.max("ts").alias("_last")))
    following = F.lead("_first").over(Window.partitionBy(*(by or [F.lit(0)])).orderBy("_m"))
    if until is not None:
        following = F.coalesce(following, until.cast("timestamp"))
    gap = (F.unix_micros("silent_until") - F.unix_micros("silent_from")) / 1e6
    return (cells.select(*by, F.col("_last").alias("silent_from"), following.alias("silent_until"))
            .withColumn("seconds", gap).where(F.col("seconds") > minutes * 60))


def bursts(log: DataFrame, by: Sequence[str], more_than: int = 3,
           length: str = "15 minutes") -> DataFrame:
    """Windows in which a key has more rows than allowed."""
    return (sliding(log, by, {"increase": F.count("*")}, length)
            .where(F.col("increase") > more_than))


def sustained(states: DataFrame, condition: str, minutes: int = 5, by: Sequence[str] = (),
              at: str = "window_end") -> DataFrame:
    """Runs of consecutive minutes in which the condition held for at least ``minutes``.

    ``states`` has one row per (key, minute); a missing minute ends a run. A segmented scan: runs are found
    day by day, and only those that touch midnight are joined with their neighbours, their chains being
    numbered by running sums over ranges. So no task holds more than a day of a key.
    """
    index = (F.unix_seconds(at) / 60).cast("bigint")
    day = F.floor(index / _DAY)
    held = states.where(F.col(condition)).withColumns({"_i": index, "_day": day})
    order = Window.partitionBy(*by, "_day").orderBy("_i")
    daily = (held.withColumn("_run", F.col("_i") - F.row_number().over(order)).groupBy(*by, "_day", "_run")
             .agg(F.min(at).alias("held_from"), F.max(at).alias("held_until"), F.count("*").alias("samples"),
                  F.min("_i").alias("_first"), F.max("_i").alias("_last")))
    out = ["held_from", "held_until", "samples"]
    edge = (F.col("_first") % _DAY == 0) | (F.col("_last") % _DAY == _DAY - 1)
    inner = daily.where(~edge).select(*by, *out)
    # at most two runs of a day touch its ends; one that is carried on begins where another has ended
    touching = daily.where(edge)
    ends = touching.select(*by, (F.col("_last") + 1).alias("_next"))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in by]
    carried = touching.alias("a").join(ends.alias("b"), [*same, F.col("a._first") == F.col("b._next")], "left")
    marked = carried.select("a.*", F.when(F.col("b._next").isNull(), 1).otherwise(0).alias("_new"))
    joined = (running_sums(marked, by, "_first", {"_chain": "_new"}).groupBy(*by, "_chain")
              .agg(F.min("held_from").alias("held_from"), F.max("held_until").alias("held_until"),
                   F.sum("samples").alias("samples")).select(*by, *out))
    return inner.unionByName(joined).where(F.col("samples") > minutes)
