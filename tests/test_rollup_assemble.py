import datetime as dt
import random
import statistics

import pytest
from conftest import values
from pyspark.sql import functions as F

from tidemark import contract
from tidemark.contract import ENTITY, OBSERVED
from tidemark.operators import assemble, rollup
from tidemark.plans import cleaning, features
from tidemark.sources import given
from tidemark.workload import inputs

D = dt.date


def test_monthly_rollup(spark):
    raw = spark.createDataFrame(
        [("A", "2024-01-01", "10", "1"), ("A", "2024-01-02", "20", "2"), ("A", "2024-01-09", "bad", "4"),
         ("A", "2024-02-01", "5", "5")],
        f"{ENTITY} string, calendar_date string, usage_download_mbs string, usage_upload_mbs string")
    out = rollup.monthly_rollup(cleaning.clean_usage(raw)).where("month_key = '2024-01-01'").first()
    assert out["monthly_download_mb"] == 30 and out["monthly_upload_mb"] == 7
    assert out["monthly_total_mb"] == 33 and out["active_days_in_month"] == 3
    assert out["avg_daily_total_mb"] == pytest.approx(16.5)
    assert out["std_daily_total_mb"] == pytest.approx(statistics.stdev([11, 22]))
    assert out["peak_daily_total_mb"] == 22 and out["min_daily_total_mb"] == 11


def months(spark, rows):
    return spark.createDataFrame(rows, f"{ENTITY} string, month_key date, monthly_total_mb double")


def test_trend_over_months(spark):
    df = months(spark, [("A", D(2024, m, 1), v) for m, v in ((1, 10000.0), (2, 12000.0), (3, 9000.0))])
    out = values(rollup.usage_trends(df), "month_key", "usage_mom_change")
    assert [r[1] for r in out] == [None, pytest.approx(0.2), pytest.approx(-0.25)]


def test_trend_gap_by_rows_and_by_calendar(spark):
    df = months(spark, [("A", D(2024, 1, 1), 10.0), ("A", D(2024, 6, 1), 20.0), ("B", D(2024, 5, 1), 1.0)])
    by_rows = values(rollup.usage_trends(df), ENTITY, "month_key", "usage_mom_change", "prev_3mo_avg_total")
    assert by_rows[1][2:] == (1.0, 10.0) and by_rows[2][2:] == (None, None)
    calendar = values(rollup.usage_trends(df, calendar=True), ENTITY, "month_key", "usage_mom_change")
    assert calendar[1][2] is None


def test_month_join_offset(spark):
    usage = months(spark, [("A", D(2024, 1, 1), 10.0), ("A", D(2024, 2, 1), 20.0)])
    spine = spark.createDataFrame([("A", D(2024, 2, 1)), ("B", D(2024, 2, 1))],
                                  f"{ENTITY} string, {OBSERVED} date")
    now = rollup.join_month(spine, usage, ["monthly_total_mb"])
    closed = rollup.join_month(spine, usage, ["monthly_total_mb"], month_offset=-1)
    assert values(now, ENTITY, "monthly_total_mb") == [("A", 20.0), ("B", None)]
    assert values(closed, ENTITY, "monthly_total_mb") == [("A", 10.0), ("B", None)]


def test_keep_first_is_deterministic_and_whole(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < .6 else f"k{rng.randrange(5)}", rng.randrange(9), rng.randrange(100))
            for _ in range(400)]
    out = assemble.keep_first(spark.createDataFrame(rows, "k string, a int, b int").repartition(7),
                              ["k"], ["a"])
    want = {k: min((a, b) for kk, a, b in rows if kk == k) for k in {r[0] for r in rows}}
    assert {r["k"]: (r["a"], r["b"]) for r in out.collect()} == want
    assert out.columns == ["k", "a", "b"]


def test_keep_first_with_null_values(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 2, 1)], "k string, x int, y int")
    assert values(assemble.keep_first(df, ["k"], ["y"]),
                  "k", "x") == [("a", None)]


def test_fill_policy(spark):
    df = spark.createDataFrame([(None, None, "x")], "calls_30d int, days_since_last_call int, t string")
    assert values(assemble.fill_missing(df), "calls_30d", "days_since_last_call") == [(0, 9999)]


def test_record_defaults(spark):
    out = assemble.with_defaults(spark.createDataFrame([("id1",)], "customer_id string")).first()
    assert out["ooc_days"] == -9999 and out["technology"] == "Unknown"
    assert out["tenure_bucket"] == "0-90d" and out["sales_channel"] == "Unknown"
    assert all(out[f] == 0 for f in contract.NUMERIC_FEATURES if f != "ooc_days")


def test_latest_and_empty(spark):
    df = spark.createDataFrame([("a", D(2024, 1, 1)), ("b", D(2024, 2, 1)), ("c", D(2024, 2, 1))],
                               f"k string, {OBSERVED} date")
    assert values(assemble.latest(df), "k") == [("b",), ("c",)]
    assert assemble.latest(df.where("k = 'z'")).count() == 0


def test_quantile_split_shares(spark):
    rows = [(D(2024, 1, 1) + dt.timedelta(i),) for i in range(100)]
    out = assemble.quantile_split(spark.createDataFrame(rows, f"{OBSERVED} date"))
    counts = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert counts == {"train": 70, "validation": 15, "test": 15}


def test_stratified_sample_sizes_and_repeatability(spark):
    everyone = spark.range(1000).select(F.col("id").cast("string").alias(ENTITY))
    churned = spark.range(0, 1000, 4).select(F.col("id").cast("string").alias(ENTITY))
    first = assemble.stratified_entities(everyone, churned, 100)
    again = assemble.stratified_entities(everyone.repartition(5), churned.repartition(3), 100)
    assert values(first, ENTITY, "stratum") == values(again, ENTITY, "stratum")
    counts = {r["stratum"]: r["count"] for r in first.groupBy("stratum").count().collect()}
    assert counts == {"positive": 30, "other": 70}
    few = assemble.stratified_entities(everyone, churned.limit(10), 100)
    assert few.where("stratum = 'positive'").count() == 10 and few.count() == 100


def test_hash_sample_share(spark):
    df = spark.range(20000)
    n = assemble.hash_sample(df, "id", 0.1).count()
    assert 1800 < n < 2200


def test_feature_table_meets_the_contract(spark, folder):
    from tidemark.operators.quality import contract_gaps, key_violations
    table = features.training_set(
        inputs.customer_info(spark, folder), inputs.calls(spark, folder),
        given.cease_days(spark, folder), inputs.usage_monthly(spark, folder),
        given.TRAIN_END, given.VALIDATION_END)
    assert contract_gaps(table) == []
    assert key_violations(table, assemble.KEYS).count() == 0
    assert table.count() == inputs.spine(spark, folder).count()
    unique = features.training_set(
        inputs.customer_info(spark, folder), inputs.calls(spark, folder),
        given.cease_days(spark, folder), inputs.usage_monthly(spark, folder),
        given.TRAIN_END, given.VALIDATION_END, unique=True)
    assert unique.columns == table.columns
    assert unique.exceptAll(table).count() == 0


def test_duplicate_snapshots_collapse(spark):
    cols = ", ".join(f"{c} {'string' if c in ('technology', 'sales_channel', 'crm_package_name', 'tenure_bucket') else 'double'}"
                     for c in contract.SNAPSHOT_FEATURES)
    row = ("A", D(2024, 1, 1), *["x" if c in ("technology", "sales_channel", "crm_package_name", "tenure_bucket")
                                 else 1.0 for c in contract.SNAPSHOT_FEATURES])
    info = spark.createDataFrame([row] * 50, f"{ENTITY} string, datevalue date, {cols}")
    assert features.snapshot_features(info).count() == 1


def test_partial_features(spark):
    df = spark.createDataFrame([(80.0, 65.0, 50000.0, 400)],
                               "speed double, line_speed double, monthly_total_mb double, tenure_days int")
    r = assemble.partial_features(df).first()
    assert r["speed_gap_pct"] == 18.75 and r["tenure_bucket"] == "1y-2y"
    assert r["monthly_download_mb"] == pytest.approx(42500) and r["monthly_upload_mb"] == pytest.approx(7500)
    assert r["avg_daily_download_mb"] == pytest.approx(42500 / 30)
