"""Point-in-time operators: what was known about an entity before an observation, what followed.

All of them share one shape. Events are first counted per (entity, day), so a
key that holds a large share of all rows shrinks on the map side before any
shuffle, and what remains of an entity is bounded by the days of the calendar.
Spine rows and event days are then stacked, shuffled once by entity, and every
lookback, history and horizon is a frame of the same sorted window. No pairs of
spine rows and events are ever formed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tidemark.contract import (CALL_FLAGS, CALL_TYPE_WINDOW, CALL_WINDOWS, ENTITY, HORIZONS,
                               OBSERVED, label_name)
from tidemark.functions.columns import flag

_DAY = "_day"
_IS_SPINE = "_is_spine"


class Frames:
    """Window frames around the day of a spine row, for one entity."""

    def __init__(self, entity: str) -> None:
        self._by_day = Window.partitionBy(entity).orderBy(_DAY)

    def before(self, days: int) -> WindowSpec:
        """The ``days`` days before the row, its own day left out."""
        return self._by_day.rangeBetween(-days, -1)

    def ever_before(self) -> WindowSpec:
        return self._by_day.rangeBetween(Window.unboundedPreceding, -1)

    def within(self, days: int) -> WindowSpec:
        """``days`` days starting with the row's own day."""
        return self._by_day.rangeBetween(0, days - 1)


@dataclass(frozen=True)
class EventView:
    """Events per (entity, day) and the features drawn from them for each spine row."""

    daily: DataFrame
    features: Callable[[Frames, Column], dict[str, Column]]


def observation_spine(snapshots: DataFrame, date: str = "datevalue", entity: str = ENTITY,
                      observed: str = OBSERVED) -> DataFrame:
    """Distinct (entity, observation date)."""
    return snapshots.select(entity, F.col(date).alias(observed)).distinct()


def per_day(events: DataFrame, date: str, measures: Mapping[str, Column],
            entity: str = ENTITY) -> DataFrame:
    """Events reduced to one row per (entity, day). Rows without entity or date match nothing."""
    return (events.where(F.col(entity).isNotNull() & F.col(date).isNotNull())
            .groupBy(entity, F.unix_date(date).alias(_DAY))
            .agg(*[c.alias(name) for name, c in measures.items()]))


def point_in_time(spine: DataFrame, *views: EventView, entity: str = ENTITY,
                  observed: str = OBSERVED) -> DataFrame:
    """The spine, with its other columns, plus the features of every view. One shuffle by entity.

    The spine must hold one row per (entity, observation date).
    """
    marks = spine.withColumns({_DAY: F.unix_date(observed), _IS_SPINE: F.lit(True)})
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                     [v.daily for v in views], marks)
    frames = Frames(entity)
    derived: dict[str, Column] = {}
    for view in views:
        derived.update(view.features(frames, F.col(_DAY)))
    return (stacked.withColumns(derived).where(F.col(_IS_SPINE))
            .select(*spine.columns, *derived))


def call_view(calls: DataFrame, date: str = "event_date", entity: str = ENTITY,
              windows: Sequence[int] = CALL_WINDOWS, type_window: int = CALL_TYPE_WINDOW,
              flags: Sequence[str] = tuple(CALL_FLAGS), talk: str = "talk_time_seconds",
              hold: str = "hold_time_seconds") -> EventView:
    """Counts over nested lookbacks, counts by type, duration statistics and recency.

    The widest lookback bounds the duration statistics and the recency.
    """
    measures = {"_calls": F.count("*"),
                "_talk_sum": F.sum(talk), "_talk_n": F.count(talk),
                "_hold_sum": F.sum(hold), "_hold_n": F.count(hold), "_hold_max": F.max(hold)}
    measures |= {f"_n_{f}": F.sum(F.col(f).cast("bigint")) for f in flags}
    widest = max(windows)

    def features(frames: Frames, day: Column) -> dict[str, Column]:
        def total(column: str, days: int) -> Column:
            return F.coalesce(F.sum(column).over(frames.before(days)), F.lit(0))

        def mean(kind: str) -> Column:
            span = frames.before(widest)
            return F.try_divide(F.sum(f"_{kind}_sum").over(span), F.sum(f"_{kind}_n").over(span))

        last = F.max(F.when(F.col("_calls").isNotNull(), day)).over(frames.before(widest))
        out = {f"calls_{w}d": total("_calls", w) for w in windows}
        for f in flags:
            name = f.removeprefix("is_").removesuffix("_call")
            out[f"{name}_calls_{type_window}d"] = total(f"_n_{f}", type_window)
        out["avg_talk_time"] = mean("talk")
        out["avg_hold_time"] = mean("hold")
        out["max_hold_time"] = F.max("_hold_max").over(frames.before(widest))
        out["days_since_last_call"] = day - last
        return out

    return EventView(per_day(calls, date, measures, entity), features)


def cease_view(ceases: DataFrame, date: str = "cease_placed_date", entity: str = ENTITY,
               horizons: Sequence[int] = HORIZONS, history: bool = True,
               labels: bool = True) -> EventView:
    """Count and recency of earlier events, and 0/1 labels for the horizons ahead.

    A label needs only the next event on or after the observation, so one frame,
    as wide as the longest horizon, serves all of them: the event falls in
    ``[observation, observation + h)``.
    """
    def features(frames: Frames, day: Column) -> dict[str, Column]:
        happened = F.when(F.col("_ceases").isNotNull(), day)
        out: dict[str, Column] = {}
        if history:
            past = frames.ever_before()
            out["prior_cease_count"] = F.coalesce(F.sum("_ceases").over(past), F.lit(0))
            out["days_since_last_cease"] = day - F.max(happened).over(past)
        if labels:
            wait = F.min(happened).over(frames.within(max(horizons))) - day
            out |= {label_name(h): flag(wait < h) for h in horizons}
        return out

    return EventView(per_day(ceases, date, {"_ceases": F.count("*")}, entity), features)


def match_count_view(events: DataFrame, date: str, horizons: Sequence[int],
                     entity: str = ENTITY) -> EventView:
    """How many events fall in each horizon (the fan-out a range join would have)."""
    def features(frames: Frames, day: Column) -> dict[str, Column]:
        return {f"matches_{h}d": F.coalesce(F.sum("_matches").over(frames.within(h)), F.lit(0))
                for h in horizons}

    return EventView(per_day(events, date, {"_matches": F.count("*")}, entity), features)


def horizon_labels(spine: DataFrame, ceases: DataFrame, horizons: Sequence[int] = HORIZONS,
                   date: str = "cease_placed_date", entity: str = ENTITY,
                   observed: str = OBSERVED) -> DataFrame:
    """1 if an event follows within the horizon, observation day included, horizon day not."""
    view = cease_view(ceases, date, entity, horizons, history=False)
    return point_in_time(spine, view, entity=entity, observed=observed)


def lookback_features(spine: DataFrame, calls: DataFrame, entity: str = ENTITY,
                      observed: str = OBSERVED, **options) -> DataFrame:
    """Call features from strictly before the observation. Options as in :func:`call_view`."""
    return point_in_time(spine, call_view(calls, entity=entity, **options),
                         entity=entity, observed=observed)


def prior_history(spine: DataFrame, ceases: DataFrame, date: str = "cease_placed_date",
                  entity: str = ENTITY, observed: str = OBSERVED) -> DataFrame:
    """Count of all earlier events and days since the last one, strictly before."""
    return point_in_time(spine, cease_view(ceases, date, entity, labels=False),
                         entity=entity, observed=observed)


def snapshot_rates(spine: DataFrame, events: DataFrame, horizons: Sequence[int] = HORIZONS,
                   date: str = "cease_placed_date", entity: str = ENTITY,
                   observed: str = OBSERVED) -> DataFrame:
    """Event rate per snapshot that counts repeats, as the rows of a left range join would.

    A spine row without match is one row, one with k matches is k rows.
    """
    counted = point_in_time(spine, match_count_view(events, date, horizons, entity),
                            entity=entity, observed=observed)
    aggs = []
    for h in horizons:
        hits = F.col(f"matches_{h}d")
        aggs += [F.sum(F.greatest(hits, F.lit(1))).alias(f"total_{h}d"),
                 F.sum(hits).alias(f"churned_{h}d")]
    rates = {f"churn_rate_{h}d": F.round(F.col(f"churned_{h}d") / F.col(f"total_{h}d") * 100, 2)
             for h in horizons}
    return (counted.groupBy(F.col(observed).alias("snapshot_month")).agg(*aggs)
            .withColumns(rates))


def label_rates(labelled: DataFrame, by: Sequence[str] = (),
                horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """Rows and mean label per horizon, over all rows or per group, in one pass."""
    aggs = [F.count("*").alias("rows")]
    aggs += [F.avg(label_name(h)).alias(f"churn_rate_{h}d") for h in horizons]
    return labelled.groupBy(*by).agg(*aggs)


def leaking_rows(features: DataFrame, source_day: str, observed: str = OBSERVED) -> DataFrame:
    """Feature rows drawn from a day that is not strictly before the observation."""
    return features.where(F.col(source_day) >= F.col(observed))
