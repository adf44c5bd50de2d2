"""Running sums over ranges of equal length: exact, and evenly dealt whatever the distribution."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import evaluation, quantiles, requests
from tidemark.operators.running import interpolated, running_sums, with_cells


@pytest.fixture(scope="module")
def heavy(spark):
    """Log-normal values, of which nearly all lie in the first thousandth of their span, and equal weights."""
    rng = np.random.default_rng(3)
    rows = [(g, float(v), int(n)) for g, v, n in zip(
        rng.choice(["a", "b"], 60_000, p=[.9, .1]), np.exp(3 * rng.standard_normal(60_000)), rng.integers(1, 4, 60_000),
        strict=True)]
    return spark.createDataFrame(rows, "g string, v double, n long").groupBy("g", "v").agg(F.sum("n").alias("n")).cache()


def test_no_range_holds_over_twice_its_share(heavy):
    for row in (with_cells(heavy, ["g"], "v", 256).groupBy("g", "_cell").agg(F.count("*").alias("n"))
                .groupBy("g").agg(F.max("n").alias("most"), F.sum("n").alias("all")).collect()):
        assert row["most"] <= 2 * row["all"] / 256
    # cells of equal width would not do
    wide = heavy.groupBy("g", F.floor(F.col("v") / F.lit(1e5) * 256)).count()
    assert wide.agg(F.max("count")).first()[0] > 50_000


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("cells", [None, 2, 16])
def test_sums_are_exact(spark, descending, cells):
    rng = random.Random(1)
    values = [None, float("nan"), float("inf"), float("-inf"), 0.0, -1e300] + [rng.lognormvariate(0, 3) for _ in range(300)]
    rows = [(g, v, rng.randint(0, 9)) for g in (None, "x") for v in values]
    df = spark.createDataFrame(rows, "g string, v double, n long").repartition(3)
    got = running_sums(df, ["g"], "v", {"upto": "n"}, {"whole": "n"}, descending, cells)
    assert got.columns == ["g", "v", "n", "upto", "whole"]

    def place(v):       # nulls first, NaN last
        return (v is not None, v is not None and math.isnan(v), 0.0 if v is None or math.isnan(v) else v)

    for g in (None, "x"):
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: place(r[1]), reverse=descending)
        want, total = [], 0
        for _, v, n in mine:
            total += n
            want.append((repr(v), total))
        found = [r for r in got.collect() if r["g"] == g]
        assert {r["whole"] for r in found} == {total}
        assert sorted((repr(r["v"]), r["upto"]) for r in found) == sorted(want)


def test_no_group_and_no_rows(spark):
    df = spark.createDataFrame([(float(i), 1) for i in range(50)], "v double, n long")
    assert sorted(r["s"] for r in running_sums(df, [], "v", {"s": "n"}, cells=8).collect()) == list(range(1, 51))
    assert running_sums(df.limit(0), [], "v", {"s": "n"}).count() == 0
    with pytest.raises(ValueError, match="power of two"):
        with_cells(df, [], "v", 100)


def test_quantiles_of_heavy_tails(heavy):
    rows = heavy.collect()
    points = [0, .1, .25, .5, .9, .999, 1]
    for g, got in ((r["g"], r["points"]) for r in interpolated(heavy, ["g"], "v", "n", points).collect()):
        plain = np.sort(np.repeat(*zip(*[(r["v"], r["n"]) for r in rows if r["g"] == g], strict=True)))
        assert np.allclose(got, np.quantile(plain, points), rtol=1e-12, atol=0)
    for row in quantiles.values_at_rank(heavy, "g", "v", "n", (.25, .5, .999)).collect():
        plain = np.sort(np.repeat(*zip(*[(r["v"], r["n"]) for r in rows if r["g"] == row["g"]], strict=True)))
        assert row["points"] == [plain[math.ceil(q * len(plain)) - 1] for q in (.25, .5, .999)]


def test_scores_of_a_rare_event(spark):
    rng = np.random.default_rng(5)
    p = rng.random(4_000) ** 12
    y = (rng.random(4_000) < p).astype(int)
    df = spark.createDataFrame([(30, float(a), int(b), int(1 - b)) for a, b in zip(p, y, strict=True)],
                               "horizon int, score double, pos long, neg long")
    curve = {r["score"]: (r["tp"], r["fp"]) for r in evaluation.ranking_curve(df).collect()}
    order = np.argsort(-p)
    assert [curve[float(p[i])] for i in order] == list(zip(np.cumsum(y[order]), np.cumsum(1 - y[order]), strict=True))
    assert len(curve) == 4_000


def test_close_scores_are_no_ties(spark):
    values = [0.5 + i * 1e-12 for i in range(100)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, p double")
    got = {r["id"]: r["bin"] for r in quantiles.quantile_bin(df, {"p": "bin"}).collect()}
    assert [got[i] for i in range(100)] == [max(1, math.ceil((i * 10) / 99)) for i in range(100)]


def test_latency_of_one_busy_window(spark):
    rng = random.Random(9)
    slow = [rng.lognormvariate(-3, 3) for _ in range(5_000)] + [None] * 7
    rows = [("2024-01-01 00:0%d:00" % (i % 5), "a", v) for i, v in enumerate(slow)]
    log = spark.createDataFrame(rows, "at string, endpoint string, latency_seconds double").withColumn(
        "ts", F.to_timestamp("at"))
    row = requests.latency_at_rank(log, ["endpoint"]).first()
    known = sorted(v for v in slow if v is not None)
    assert row["requests"] == 5_007
    assert [row[c] for c in ("p50", "p95", "p99")] == [known[2_499], known[4_749], known[4_949]]
