import pytest
from conftest import values
from pyspark.sql import functions as F

from tidemark import contract
from tidemark.contract import TierThresholds
from tidemark.functions import columns as C
from tidemark.functions import risk as R


def one(spark, rows, schema, **cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(
        *[c.alias(n) for n, c in cols.items()]).collect()]


def test_sentinel_keeps_known_values(spark):
    got = one(spark, [(30.0,), (None,), (-15.0,)], "x double", x=C.or_sentinel("x"))
    assert got == [(30.0,), (-9999.0,), (-15.0,)]


def test_prefix_ordinal(spark):
    got = one(spark, [("01 Early",), ("02 Mid",), ("06 OOC",), ("XX",), (None,)], "s string",
              x=C.prefix_ordinal("s"))
    assert got == [(1,), (2,), (6,), (None,), (None,)]


def test_percentage_gap(spark):
    got = one(spark, [(100, 80.0), (50, 50.0), (0, 0.0), (80, 90.0), (None, 5.0), (10, None)],
              "a int, b double", x=C.pct_gap("a", "b"))
    assert got == [(20.0,), (0.0,), (0.0,), (-12.5,), (0.0,), (None,)]


def test_tenure_bucket_edges(spark):
    got = one(spark, [(30,), (90,), (200,), (500,), (800,), (1095,), (1500,), (None,), (-3,)], "d int",
              x=C.tenure_bucket("d"))
    assert [g[0] for g in got] == ["0-90d", "90d-1y", "90d-1y", "1y-2y", "2y-3y", "3y+", "3y+",
                                   "3y+", "0-90d"]


def test_bucket_needs_matching_labels():
    with pytest.raises(ValueError):
        C.bucket_label("x", [1, 2], ["a", "b"])


def test_lenient_casts(spark):
    got = one(spark, [("1234.567",), ("0.000",), ("n/a",), (None,)], "s string", x=C.to_double("s"))
    assert got == [(1234.567,), (0.0,), (None,), (None,)]
    got = one(spark, [("2024-01-15",), ("nonsense",)], "s string", x=C.to_date("s").cast("string"))
    assert got == [("2024-01-15",), (None,)]


def test_impute_and_flags(spark):
    df = spark.createDataFrame([("Loyalty",), (None,), ("Tech",)], "call_type string")
    df = df.withColumns({"call_type": C.or_unknown("call_type"),
                         **C.category_flags("call_type", contract.CALL_FLAGS)})
    assert values(df, "call_type", "is_loyalty_call", "is_complaint_call", "is_tech_call") == [
        ("Loyalty", 1, 0, 0), ("Tech", 0, 0, 1), ("Unknown", 0, 0, 0)]


def test_completion(spark):
    got = one(spark, [("2024-01-01",), (None,)], "s string", a=C.flag(F.col("s").isNotNull()),
              b=C.completion_text("s"))
    assert got == [(1, "Completed"), (0, "Pending/Retracted")]


def test_growth_needs_positive_base(spark):
    got = one(spark, [(12.0, 10.0), (5.0, 0.0), (5.0, None), (None, 3.0), (5.0, -1.0)],
              "a double, b double", x=C.growth("a", "b"))
    assert got == [(pytest.approx(0.2),), (None,), (None,), (None,), (None,)]


def test_split_label(spark):
    dates = ["2024-01-01", "2024-03-31", "2024-04-01", "2024-06-30", "2024-07-01"]
    got = one(spark, [(d,) for d in dates], "d string", x=C.split_label(F.col("d").cast("date")))
    assert [g[0] for g in got] == ["train", "train", "validation", "validation", "test"]


def test_clip_keeps_null(spark):
    got = one(spark, [(-5.0,), (5.0,), (500.0,), (None,)], "x double", x=C.clip("x", 0, 100))
    assert got == [(0.0,), (5.0,), (100.0,), (None,)]


@pytest.mark.parametrize("p, expected", [
    ((0.5, 0.5, 0.5), "GREEN"), ((0.500001, 0, 0), "RED"), ((0.9, 0.9, 0.9), "RED"),
    ((0.3, 0.6, 0.9), "AMBER"), ((0.1, 0.2, 0.7), "YELLOW"), ((0, 0, 0), "GREEN"),
    ((1.0, 1.0, 1.0), "RED")])
def test_tier_cascade(spark, p, expected):
    got = one(spark, [tuple(map(float, p))], "a double, b double, c double",
              t=R.risk_tier("a", "b", "c"))
    assert got == [(expected,)]


def test_tier_thresholds_from_conf(spark):
    spark.conf.set("tidemark.tier.red", "0.8")
    try:
        limits = TierThresholds.from_conf(spark)
    finally:
        spark.conf.unset("tidemark.tier.red")
    assert limits == TierThresholds(red=0.8)
    got = one(spark, [(0.7, 0.1, 0.1), (0.81, 0.1, 0.1)], "a double, b double, c double",
              t=R.risk_tier("a", "b", "c", limits))
    assert got == [("GREEN",), ("RED",)]


def test_absolute_decile(spark):
    ps = [0.0, 0.05, 0.1, 0.55, 0.95, 1.0]
    got = one(spark, [(p,) for p in ps], "p double", d=R.absolute_decile("p"))
    assert [g[0] for g in got] == [1, 1, 2, 6, 10, 10]


def test_horizon_text(spark):
    assert one(spark, [("churn_prob_30d",)], "n string", t=R.horizon_text("n")) == [("30-day",)]


def test_probability_bands(spark):
    assert one(spark, [(None,)], "p double", b=R.probability_band("p")) == one(
        spark, [(None,)], "p double", b=F.lit(None).cast("string"))
    got = one(spark, [(0.0,), (0.3,), (0.5,), (0.7,), (1.0,)], "p double", b=R.probability_band("p"))
    assert [g[0] for g in got] == ["0-30", "30-50", "50-70", "70-100", "70-100"]


def test_contract_is_consistent():
    assert len(contract.NUMERIC_FEATURES) == 29 and len(contract.CATEGORICAL_FEATURES) == 3
    assert len(set(contract.MODEL_FEATURES)) == 32
    assert set(contract.RECORD_RANGES) == set(contract.NUMERIC_FEATURES)
    assert set(contract.RECORD_TEXT_DEFAULTS) == set(contract.CATEGORICAL_FEATURES)
    assert set(contract.TIER_ACTIONS) == set(contract.TIER_ORDER)
