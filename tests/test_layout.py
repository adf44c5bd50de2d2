"""Z-order: rows kept, files skipped by either key; sustained conditions over midnights."""

import datetime as dt
import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from tidemark.operators import requests
from tidemark.sources import tables


@pytest.fixture(scope="module")
def grid(spark):
    rng = random.Random(7)
    rows = [(f"customer-{rng.randrange(400):05d}", dt.date(2024, 1, 1) + dt.timedelta(days=int(rng.paretovariate(1)) % 365), i)
            for i in range(6_000)] + [(None, None, -1), (None, dt.date(2024, 1, 1), -2), ("customer-00001", None, -3)]
    return spark.createDataFrame(rows, "id string, day date, n long").repartition(4).cache()


def stored(spark, df, path):
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_rows_are_kept_and_both_keys_skip_files(spark, grid, tmp_path):
    laid = stored(spark, tables.z_order(grid, ["id", "day"], 32), f"{tmp_path}/z")
    plain = stored(spark, tables.cluster_layout(grid, ["id", "day"], 32), f"{tmp_path}/s")
    assert laid.columns == grid.columns
    assert laid.exceptAll(grid).count() == 0 and laid.count() == grid.count()
    shares = {(n, c): tables.opened_share(t, c).first()["share"] for n, t in (("z", laid), ("s", plain)) for c in ("id", "day")}
    assert shares["s", "day"] > 0.6 and shares["z", "day"] < 0.6 * shares["s", "day"] and shares["z", "id"] < 0.5


def test_bits_are_dealt_in_turn(spark):
    rows = [(a, b) for a in range(4) for b in range(4)]
    df = spark.createDataFrame(rows, "a int, b int")
    got = {(r["a"], r["b"]): r["z"] for r in df.withColumn("z", tables.z_value(df, ["a", "b"], 2)).collect()}
    ranks = {v: i for i, v in enumerate(sorted(set(got.values())))}
    starts = tables.range_starts(df, "a", 3)
    place = {v: sum(s <= v for s in starts) for v in range(4)}
    want = {(a, b): sum(((place[a] >> k) & 1) << (2 * k + 1) | ((place[b] >> k) & 1) << (2 * k) for k in range(2))
            for a, b in rows}
    assert got == want and len(ranks) >= 9
    with pytest.raises(ValueError, match="do not fit"):
        tables.z_value(df, ["a", "b"], 40)


def test_empty_table(spark, grid):
    assert tables.z_order(grid.limit(0), ["id", "day"], 4).count() == 0


@pytest.mark.parametrize("by", [[], ["k"]])
def test_runs_over_midnights(spark, by):
    t0 = dt.datetime(2024, 1, 1)
    rng = random.Random(3)
    minutes = {k: {m for m in range(6 * 1440) if not (m % 997 == 5 or 3_000 < m < 3_100 or rng.random() < .002)}
               for k in ("a", None)}
    minutes[None] = set(range(100, 5 * 1440 + 3))               # five midnights in one run
    used = minutes if by else {"a": minutes["a"]}
    rows = [(k, t0 + dt.timedelta(minutes=m), m in on) for k, on in used.items() for m in range(6 * 1440)]
    df = spark.createDataFrame(rows, "k string, window_end timestamp, bad boolean")
    want = []
    for k, on in used.items():
        start = None
        for m in range(6 * 1440 + 1):
            if m in on and start is None:
                start = m
            if m not in on and start is not None:
                if m - start > 5:
                    want.append((*([k] if by else []), t0 + dt.timedelta(minutes=start), t0 + dt.timedelta(minutes=m - 1), m - start))
                start = None
    found = requests.sustained(df, "bad", by=by)
    assert values(found, *by, "held_from", "held_until", "samples") == sorted(
        want, key=lambda t: tuple((x is not None, x) for x in t))


def test_one_partition_only_for_sums_of_ranges(spark):
    """What comes together in one task is a sum per range, at most 256, or a sketch."""
    df = spark.range(10).select(F.timestamp_seconds(F.col("id") * 60).alias("window_end"), F.lit(True).alias("bad"))
    found = requests.sustained(df, "bad")
    plan = found._jdf.queryExecution().executedPlan().toString().splitlines()
    below = [plan[i + 1] for i, line in enumerate(plan) if "SinglePartition" in line]
    assert below and all("_cell" in line or "percentile_approx" in line for line in below)
    assert found.first()["samples"] == 10
