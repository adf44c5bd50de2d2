"""Point-in-time operators against brute force, including skewed and broken keys."""

import datetime as dt
import random
import re

import pytest
from conftest import values
from pyspark.sql import functions as F

from tidemark.contract import ENTITY, HORIZONS, OBSERVED
from tidemark.operators import temporal

D = dt.date


def day(text):
    return dt.date.fromisoformat(text)


def make_spine(spark, rows):
    return spark.createDataFrame(rows, f"{ENTITY} string, {OBSERVED} date")


def make_ceases(spark, rows):
    return spark.createDataFrame(rows, f"{ENTITY} string, cease_placed_date date")


CALLS = (f"{ENTITY} string, event_date date, is_loyalty_call int, is_complaint_call int, "
         "is_tech_call int, talk_time_seconds int, hold_time_seconds int")


def test_event_after_15_days_is_in_every_horizon(spark):
    out = temporal.horizon_labels(make_spine(spark, [("A", D(2024, 1, 1))]),
                                  make_ceases(spark, [("A", D(2024, 1, 16))]))
    assert values(out, "churned_in_30d", "churned_in_60d", "churned_in_90d") == [(1, 1, 1)]


def test_event_after_45_days_and_other_entity(spark):
    out = temporal.horizon_labels(make_spine(spark, [("A", D(2024, 1, 1)), ("B", D(2024, 1, 1))]),
                                  make_ceases(spark, [("A", D(2024, 2, 15))]))
    assert values(out, ENTITY, "churned_in_30d", "churned_in_60d", "churned_in_90d") == [
        ("A", 0, 1, 1), ("B", 0, 0, 0)]


@pytest.mark.parametrize("offset, expected", [(-1, 0), (0, 1), (29, 1), (30, 0)])
def test_horizon_edges(spark, offset, expected):
    observed = D(2024, 1, 1)
    out = temporal.horizon_labels(make_spine(spark, [("A", observed)]),
                                  make_ceases(spark, [("A", observed + dt.timedelta(offset))]))
    assert values(out, "churned_in_30d") == [(expected,)]


def test_lookback_is_strictly_before(spark):
    calls = spark.createDataFrame(
        [("A", day(x), 1, 0, 0, 10, 5) for x in
         ("2024-02-10", "2024-02-20", "2024-03-01", "2024-03-05")], CALLS)
    out = temporal.lookback_features(make_spine(spark, [("A", D(2024, 3, 1))]), calls)
    assert values(out, "calls_30d", "calls_180d", "loyalty_calls_90d", "days_since_last_call") == [
        (2, 2, 2, 10)]


def test_no_calls_gives_zero_counts_and_null_durations(spark):
    calls = spark.createDataFrame([], CALLS)
    out = temporal.lookback_features(make_spine(spark, [("A", D(2024, 3, 1))]), calls)
    assert values(out, "calls_30d", "calls_90d", "calls_180d", "tech_calls_90d", "avg_talk_time",
                  "max_hold_time", "days_since_last_call") == [(0, 0, 0, 0, None, None, None)]


def test_history_grows_by_snapshot(spark):
    ceases = make_ceases(spark, [("A", day(x)) for x in
                                 ("2023-12-01", "2024-01-15", "2024-02-15", "2024-03-01")])
    spine = make_spine(spark, [("A", day(x)) for x in ("2024-01-01", "2024-02-01", "2024-03-01")])
    out = temporal.prior_history(spine, ceases)
    assert values(out, OBSERVED, "prior_cease_count", "days_since_last_cease") == [
        (D(2024, 1, 1), 1, 31), (D(2024, 2, 1), 2, 17), (D(2024, 3, 1), 3, 15)]


def test_missing_keys_and_dates_match_nothing(spark):
    spine = make_spine(spark, [(None, D(2024, 1, 1)), ("A", None), ("A", D(2024, 1, 1))])
    ceases = make_ceases(spark, [(None, D(2024, 1, 2)), ("A", None), ("A", D(2024, 1, 5)),
                                 (None, D(2023, 12, 1))])
    labels = temporal.horizon_labels(spine, ceases)
    assert values(labels, ENTITY, OBSERVED, "churned_in_30d") == [
        (None, D(2024, 1, 1), 0), ("A", None, 0), ("A", D(2024, 1, 1), 1)]
    history = temporal.prior_history(spine, ceases)
    assert [r[2] for r in values(history, ENTITY, OBSERVED, "prior_cease_count")] == [0, 0, 0]


def random_world(seed, hot_share):
    rng = random.Random(seed)
    base = D(2024, 1, 1)

    def entity():
        return "HOT" if rng.random() < hot_share else f"c{rng.randrange(12)}"

    spine = sorted({(entity(), base + dt.timedelta(rng.randrange(300))) for _ in range(150)})
    calls = [(entity(), base + dt.timedelta(rng.randrange(-60, 330)), rng.randrange(2),
              rng.randrange(2), rng.randrange(2), rng.randrange(900),
              rng.choice([None, rng.randrange(300)])) for _ in range(500)]
    ceases = [(entity(), base + dt.timedelta(rng.randrange(-60, 400))) for _ in range(120)]
    return spine, calls, ceases


@pytest.mark.parametrize("seed, hot_share", [(1, 0.0), (2, 0.4), (3, 0.9)])
def test_all_features_against_brute_force(spark, seed, hot_share):
    spine, calls, ceases = random_world(seed, hot_share)
    out = temporal.point_in_time(
        make_spine(spark, spine), temporal.call_view(spark.createDataFrame(calls, CALLS)),
        temporal.cease_view(make_ceases(spark, ceases)))
    got = {(r[ENTITY], r[OBSERVED]): r for r in out.collect()}
    assert len(got) == len(spine)
    for e, o in spine:
        r = got[e, o]
        back = [(c, (o - c[1]).days) for c in calls if c[0] == e]
        for w in (30, 90, 180):
            assert r[f"calls_{w}d"] == sum(0 < k <= w for _, k in back)
        for i, name in ((2, "loyalty"), (3, "complaint"), (4, "tech")):
            assert r[f"{name}_calls_90d"] == sum(c[i] for c, k in back if 0 < k <= 90)
        wide = [c for c, k in back if 0 < k <= 180]
        talk, hold = [c[5] for c in wide], [c[6] for c in wide if c[6] is not None]
        assert r["avg_talk_time"] == (pytest.approx(sum(talk) / len(talk)) if talk else None)
        assert r["avg_hold_time"] == (pytest.approx(sum(hold) / len(hold)) if hold else None)
        assert r["max_hold_time"] == (max(hold) if hold else None)
        assert r["days_since_last_call"] == (
            min(k for _, k in back if 0 < k <= 180) if wide else None)
        past = [(o - c[1]).days for c in ceases if c[0] == e and c[1] < o]
        assert r["prior_cease_count"] == len(past)
        assert r["days_since_last_cease"] == (min(past) if past else None)
        ahead = [(c[1] - o).days for c in ceases if c[0] == e and c[1] >= o]
        for h in HORIZONS:
            assert r[f"churned_in_{h}d"] == int(any(k < h for k in ahead))


def test_labels_and_counts_are_monotone(spark):
    spine, calls, ceases = random_world(7, 0.3)
    out = temporal.point_in_time(
        make_spine(spark, spine), temporal.call_view(spark.createDataFrame(calls, CALLS)),
        temporal.cease_view(make_ceases(spark, ceases)))
    wrong = out.where((F.col("churned_in_30d") > F.col("churned_in_60d"))
                      | (F.col("churned_in_60d") > F.col("churned_in_90d"))
                      | (F.col("calls_30d") > F.col("calls_90d"))
                      | (F.col("calls_90d") > F.col("calls_180d")))
    assert wrong.count() == 0


def test_snapshot_rates_count_every_match(spark):
    spine = make_spine(spark, [("A", D(2024, 1, 1)), ("B", D(2024, 1, 1))])
    ceases = make_ceases(spark, [("A", D(2024, 1, 5)), ("A", D(2024, 1, 5)), ("A", D(2024, 2, 20))])
    out = temporal.snapshot_rates(spine, ceases)
    assert values(out, "total_30d", "churned_30d", "churn_rate_30d", "total_60d", "churned_60d") == [
        (3, 2, 66.67, 4, 3)]


def test_one_shuffle_by_entity_and_no_join(spark, folder):
    from tidemark.sources import given
    from tidemark.workload import inputs
    out = temporal.point_in_time(inputs.spine(spark, folder),
                                 temporal.call_view(inputs.calls(spark, folder)),
                                 temporal.cease_view(given.cease_days(spark, folder)))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert len(re.findall(rf"hashpartitioning\({ENTITY}#\d+, \d+\)", plan)) == 1
    assert plan.count("Sort [") == 1


def test_leaking_rows(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), D(2023, 12, 31)), (D(2024, 1, 1), D(2024, 1, 1))],
                               f"{OBSERVED} date, last date")
    assert temporal.leaking_rows(df, "last").count() == 1
