"""What is kept between runs: drift counts that add up, the ledger of closed windows, expectations per batch."""

import datetime as dt
import math
import random
from collections import Counter

import numpy as np
import pytest
from conftest import values
from pyspark.sql import functions as F

from tidemark.contract import ENTITY, HORIZONS, probability_name
from tidemark.operators import drift, monitor
from tidemark.operators.quality import DROP, WARN, Rule
from tidemark.sources import readers
from tidemark.streaming import ingest

DAY = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    out = []
    for month in range(1, 7):
        for _ in range(300):
            v = rng.lognormvariate(0.2 * month, 1)
            out.append((dt.date(2024, month, rng.randint(1, 28)), rng.choice(("x", "y", None)), rng.choice(
                (v, v, v, v, None, math.inf, -math.inf) if month != 2 else (v,)), rng.random()))
    return out + [(dt.date(2024, 5, 1), "only late", 1.0, 0.5)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "observation_date date, tech string, a double, b double")


def test_cubes_add_up_and_hold_infinite_values(spark, rows):
    base = [r for r in rows if r[0].month <= 2 and r[2] is not None and math.isfinite(r[2])]
    edges = drift.baseline_edges(frame(spark, base), ["a", "b"], 10).cache()
    found = {r["feature"]: r["edges"] for r in edges.collect()}
    for i, name in ((2, "a"), (3, "b")):
        assert np.allclose(found[name], np.quantile([r[i] for r in base], [k / 10 for k in range(1, 10)]), rtol=1e-12)
    whole = drift.drift_cube(frame(spark, rows), ["a", "b"], edges, ["tech"])
    halves = [drift.drift_cube(frame(spark, rows[i::2]), ["a", "b"], edges, ["tech"]) for i in (0, 1)]
    merged = drift.merged_cube(halves[0].unionByName(halves[1]))
    assert merged.exceptAll(whole).count() == 0 and whole.exceptAll(merged).count() == 0
    want = Counter()
    for day, tech, a, b in rows:
        for name, v in (("a", a), ("b", b)):
            place = -1 if v is None else sum(e < v for e in found[name])
            for key, value in (("all", "all"), ("tech", tech)):
                want[day.replace(day=1), key, value, name, place] += 1
    assert {tuple(r[:5]): r[5] for r in whole.select(*drift.CUBE_KEYS, "n").collect()} == want

    stable = drift.cube_stability(whole, F.col("month") <= F.lit(dt.date(2024, 2, 1)))
    got = {tuple(r[:4]): (r["psi"], r["drifted"]) for r in stable.collect()}
    assert {k[0].month for k in got} == {3, 4, 5, 6}
    assert got[dt.date(2024, 5, 1), "tech", "only late", "a"] == (None, False)
    for (month, key, value, name), (psi, drifted) in got.items():
        p = Counter({k[4]: n for k, n in want.items() if k[:4] == (month, key, value, name) and k[4] >= 0})
        q = Counter()
        for k, n in want.items():
            if k[0].month <= 2 and k[1:4] == (key, value, name) and k[4] >= 0:
                q[k[4]] += n
        if q:
            share = [(max(p[i] / p.total(), 1e-4), max(q[i] / q.total(), 1e-4)) for i in range(10)]
            assert math.isclose(psi, sum((a - b) * math.log(a / b) for a, b in share), rel_tol=1e-9, abs_tol=1e-12)
            assert drifted == (psi > 0.2)


def test_windows_are_measured_when_closed_and_once(spark):
    rng = random.Random(4)
    scores = [(f"c{i}", DAY + dt.timedelta(days=30 * k), *[rng.random() for _ in HORIZONS]) for k in range(4) for i in range(30)]
    df = spark.createDataFrame(scores, f"{ENTITY} string, score_date date, " + ", ".join(f"{probability_name(h)} double" for h in HORIZONS))
    ceases = spark.createDataFrame([(f"c{i}", (DAY + dt.timedelta(days=7 * i)).isoformat()) for i in range(30)],
                                   f"{ENTITY} string, cease_placed_date string").withColumn(
        "cease_placed_date", F.to_date("cease_placed_date"))

    def measured(days):
        return monitor.retrospective(df, ceases, as_of=F.lit(DAY + dt.timedelta(days=days)))

    def keys(found):
        return {((r["score_date"] - DAY).days // 30, r["horizon"]) for r in found.collect()}

    assert keys(measured(29)) == set()
    assert keys(measured(30)) == {(0, 30)}
    assert keys(measured(95)) == {(0, 30), (0, 60), (0, 90), (1, 30), (1, 60), (2, 30)}
    ledger = measured(95)
    assert keys(monitor.newly_measured(measured(95), ledger)) == set()
    assert keys(monitor.newly_measured(measured(120), ledger)) == {(1, 90), (2, 60), (3, 30)}
    assert values(measured(500), "score_date", "horizon", "auc_roc") == values(
        monitor.retrospective(df, ceases), "score_date", "horizon", "auc_roc")


def test_expectations_of_each_batch(spark, tmp_path):
    rules = (Rule("small", "n < 5", WARN), Rule("named", "id IS NOT NULL", DROP))
    batches = [[("a", 1), (None, 9)], [("b", 7)], [(None, None), (None, 2), ("c", 3)]]
    for batch in batches:
        spark.createDataFrame(batch, "id string, n int").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    for check in ("one", "two"):        # the second run repeats all batches, as after a lost checkpoint
        stream = readers.stream_raw(spark, f"{tmp_path}/in", "parquet", "id string, n int", max_files=1)
        ingest.run(ingest.land_checked(stream, lambda df: df, rules, "t", f"{tmp_path}/out", f"{tmp_path}/log", f"{tmp_path}/{check}"))
        log = spark.read.parquet(f"{tmp_path}/log")
        assert log.count() == 6 and {r["batch"] for r in log.collect()} == {0, 1, 2}
        assert values(log.groupBy("rule", "severity").agg(F.sum("rows").alias("rows"), F.sum("violations").alias("bad")),
                      "rule", "severity", "rows", "bad") == [("named", "drop", 6, 3), ("small", "warn", 6, 3)]
        assert spark.read.parquet(f"{tmp_path}/out").count() == 3
