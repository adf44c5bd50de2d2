import datetime as dt
import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from tidemark.operators import requests as R

T0 = dt.datetime(2024, 1, 1, 10, 0)
LOG = "ts timestamp, endpoint string, status string, latency_seconds double, tier string"


def log(spark, seconds, endpoint="/p", status="success", latency=.1):
    return spark.createDataFrame([(T0 + dt.timedelta(seconds=s), endpoint, status, latency, "RED")
                                  for s in seconds], LOG)


def test_sliding_equals_direct_windows(spark):
    rng = random.Random(4)
    df = log(spark, [rng.random() * 3000 for _ in range(200)])
    direct = (df.groupBy(F.window("ts", "5 minutes", "1 minute").alias("w"), "endpoint")
              .agg(F.count("*").alias("n")).select("w.start", "endpoint", "n"))
    ours = R.request_rate(df).select(F.col("window_start").alias("start"), "endpoint",
                                     F.col("requests").alias("n"))
    assert ours.exceptAll(direct).count() == 0 and direct.exceptAll(ours).count() == 0


def test_error_ratio_alert(spark):
    df = log(spark, range(0, 60, 3)).unionByName(log(spark, [1, 2], status="error"))
    out = R.error_ratio(df)
    assert out.count() == 5 and out.where("alert").count() == 5
    assert out.first()["error_ratio"] == pytest.approx(2 / 22)


@pytest.mark.parametrize("latencies, p50", [([.02] * 4, .03), ([9.0] * 3, 5.0), ([.005, .005], .005)])
def test_bucket_interpolation(spark, latencies, p50):
    df = spark.createDataFrame([(T0, "/p", "success", v, "RED") for v in latencies], LOG)
    assert R.latency_quantiles(df).first()["p50"] == pytest.approx(p50)


def test_p99_alert(spark):
    df = spark.createDataFrame([(T0, "/p", "success", 3.0, "RED")], LOG)
    assert R.latency_quantiles(df).first()["alert"]


def test_silence_needs_more_than_the_limit(spark):
    df = log(spark, [0, 10, 1800 + 10, 1800 + 11, 4000])
    out = R.silences(df)
    assert values(out, "seconds") == [(2189.0,)]


def test_a_silence_that_goes_on(spark):
    df = log(spark, [0, 10])
    last = df.agg(F.max("ts")).first()[0]
    assert R.silences(df).count() == 0
    for minutes, found in ((31, 1), (29, 0)):
        asked = F.lit(last) + F.expr(f"interval {minutes} minutes")
        assert values(R.silences(df, until=asked), "seconds") == [(minutes * 60.0,)] * found


def test_exact_latency_at_rank(spark):
    rows = [(T0, "/p", "success", float(i % 977), "RED") for i in range(20_000)] + [(T0, "/p", "success", None, "RED")]
    r = R.latency_at_rank(spark.createDataFrame(rows, LOG)).first()
    every = sorted(x[3] for x in rows[:-1])
    assert r["requests"] == 20_001
    assert [r["p50"], r["p95"], r["p99"]] == [every[9_999], every[18_999], every[19_799]]


def test_bursts(spark):
    df = log(spark, [0, 60, 120, 180])
    assert R.bursts(df, ["endpoint"]).agg(F.max("increase")).first()[0] == 4
    assert R.bursts(df.limit(3), ["endpoint"]).count() == 0


def test_sustained_runs(spark):
    minutes = [0, 1, 2, 3, 4, 5, 8, 9]
    states = spark.createDataFrame([(T0 + dt.timedelta(minutes=m), True) for m in minutes],
                                   "window_end timestamp, alert boolean")
    out = R.sustained(states, "alert")
    assert values(out, "samples") == [(6,)]
    broken = states.withColumn("alert", F.minute("window_end") != 3)
    assert R.sustained(broken, "alert").count() == 0


def test_sketch_is_exact_on_small_windows(spark):
    df = spark.createDataFrame([(T0, "/p", "success", float(v), "RED") for v in range(1, 101)], LOG)
    r = R.sketched_latency(df).first()
    assert (r["p50"], r["p95"], r["p99"]) == (50.0, 95.0, 99.0)
