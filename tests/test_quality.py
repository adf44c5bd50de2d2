import datetime as dt

import pytest
from conftest import values
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemark import contract
from tidemark.contract import ENTITY
from tidemark.operators import quality as Q
from tidemark.operators.assemble import with_defaults


def snapshots(spark):
    return spark.createDataFrame(
        [("A", dt.date(2024, 1, 1), 80, 10), (None, dt.date(2024, 1, 1), 0, 10),
         ("C", None, None, -5)],
        f"{ENTITY} string, datevalue date, speed int, tenure_days int")


def test_drop_rule_and_counts(spark):
    seen = Observation("snapshots")
    kept = Q.enforce(snapshots(spark), Q.SNAPSHOT_RULES, seen)
    assert values(kept, ENTITY) == [("A",)]
    assert seen.get == {"rows": 3, "valid_customer_id": 1, "valid_datevalue": 1, "valid_speed": 2,
                        "valid_tenure": 1}


def test_quarantine_is_the_complement(spark):
    df = snapshots(spark)
    out = Q.quarantine(df, Q.SNAPSHOT_RULES)
    assert out.count() + Q.enforce(df, Q.SNAPSHOT_RULES).count() == df.count()
    assert {tuple(r["broken_rules"]) for r in out.collect()} == {("valid_speed",)}


def test_fail_rule_raises(spark):
    df = spark.createDataFrame([(None, 1.0, 1.0)],
                               f"{ENTITY} string, usage_download_mbs double, usage_upload_mbs double")
    with pytest.raises(Exception, match="valid_customer_id failed"):
        Q.enforce(df, Q.USAGE_RULES).collect()


def test_report(spark):
    out = Q.report(snapshots(spark), Q.SNAPSHOT_CHECKS, "customer_info")
    assert values(out, "rule", "total_rows", "violations", "status") == [
        ("negative_speed", 3, 1, "WARN"), ("negative_tenure", 3, 1, "WARN"),
        ("null_customer_id", 3, 1, "FAIL"), ("null_datevalue", 3, 1, "FAIL")]


BASE = {"customer_id": "TEST-001", "speed": 80.0, "line_speed": 65.0, "technology": "FTTP",
        "tenure_bucket": "90d-1y", "usage_mom_change": -0.05, "active_days_in_month": 30.0}


@pytest.mark.parametrize("change, problem", [
    ({}, None), ({"customer_id": "a" * 51}, "customer_id"), ({"customer_id": ""}, "customer_id"),
    ({"customer_id": None}, "customer_id"), ({"speed": 99999.0}, "speed"), ({"speed": -100.0}, "speed"),
    ({"technology": "5G"}, "technology"), ({"tenure_bucket": "invalid"}, "tenure_bucket"),
    ({"usage_mom_change": 50.0}, "usage_mom_change"), ({"active_days_in_month": 35.0}, "active_days_in_month"),
    ({"speed": 10000.0}, None), ({"speed": 0.0}, None)])
def test_record_rules(spark, change, problem):
    record = BASE | change
    schema = ", ".join(f"{k} {'string' if k in ('customer_id', 'technology', 'tenure_bucket') else 'double'}"
                       for k in record)
    df = with_defaults(spark.createDataFrame([tuple(record.values())], schema))
    problems = Q.record_problems(df).first()["problems"]
    assert problems == ([problem] if problem else [])
    assert Q.valid_records(df).count() == (0 if problem else 1)
    assert Q.rejected_records(df).count() == (1 if problem else 0)


def test_key_violations(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 2)], "k string, n int")
    assert values(Q.key_violations(df, ["k"]), "k", "rows") == [(None, 1), ("a", 2)]


def test_failed_casts(spark):
    df = spark.createDataFrame([("1", "x"), (None, "2"), ("?", "y")], "a string, b string")
    assert values(Q.failed_casts(df, ["a", "b"]), "column", "failed") == [("a", 1), ("b", 2)]


def test_contract_gaps(spark):
    df = with_defaults(spark.createDataFrame([("x",)], "customer_id string"))
    assert Q.contract_gaps(df) == []
    assert Q.contract_gaps(df.drop("speed").withColumn("calls_30d", F.lit("x"))) == [
        "missing: speed", "not numeric: calls_30d"]


def test_reconcile_and_shapes(spark):
    tables = {"a": spark.range(3), "b": spark.range(5)}
    assert values(Q.reconcile(tables, {"a": 3, "b": 4}), "table_name", "status") == [
        ("a", "PASS"), ("b", "WARN")]
    assert values(Q.shapes(tables), "table_name", "rows", "columns") == [("a", 3, 1), ("b", 5, 1)]
    assert values(Q.schema_report(spark.range(1), "t"), "column_name", "data_type") == [("id", "bigint")]


def test_default_of_every_field_is_valid(spark):
    df = with_defaults(spark.createDataFrame([("x",)], "customer_id string"))
    assert Q.record_problems(df).first()["problems"] == []
    assert len(contract.RECORD_RANGES) == 29


def test_a_failure_is_not_hidden_by_a_drop(spark):
    df = spark.createDataFrame([(None, 1)], "a int, b int")
    rules = [Q.Rule("a_set", "a IS NOT NULL", Q.DROP), Q.Rule("b_even", "b % 2 = 0", Q.FAIL)]
    for some in (rules, rules[::-1]):
        with pytest.raises(Exception, match="b_even"):
            Q.enforce(df, some).collect()
    assert Q.enforce(df, rules[:1]).count() == 0
