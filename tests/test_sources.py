import datetime as dt

import pytest
from conftest import values
from pyspark.sql import functions as F

from tidemark import session
from tidemark.contract import ENTITY, OBSERVED, TIER_ACTIONS
from tidemark.operators import rollup
from tidemark.sources import given, readers, tables
from tidemark.workload import inputs


def test_namespace():
    assert tables.namespace("telecoms") == "telecoms"
    assert tables.namespace("telecoms", "dev") == "telecoms_dev"
    assert tables.database("telecoms", "gold", "staging") == "telecoms_staging_gold"


def test_csv_with_and_without_schema(spark, tmp_path):
    path = str(tmp_path / "calls")
    tables.export_csv(spark.createDataFrame([("A", 5, None), ("B", 7, "x")], "id string, n int, t string"), path)
    inferred = readers.read_raw(spark, path, "csv")
    assert dict(inferred.dtypes)["n"] == "int" and values(inferred, "id", "n", "t") == [
        ("A", 5, None), ("B", 7, "x")]
    fixed = readers.read_raw(spark, path, "csv", "id string, n string, t string")
    assert values(fixed, "n") == [("5",), ("7",)]
    with pytest.raises(ValueError):
        readers.read_raw(spark, path, "xml")


def test_ingest_meta_names_the_file(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.range(3).coalesce(1).write.parquet(path)
    out = readers.with_ingest_meta(readers.read_raw(spark, path)).first()
    assert out["_source_file"].endswith(".parquet") and out["_ingested_at"] is not None


def test_schema_is_kept(spark, tmp_path):
    path, kept = str(tmp_path / "in"), str(tmp_path / "schema")
    spark.createDataFrame([(1, "a")], "n int, s string").write.parquet(path)
    first = readers.load_or_infer_schema(spark, path, "parquet", kept)
    spark.createDataFrame([(1.5,)], "other double").write.mode("overwrite").parquet(path)
    assert readers.load_or_infer_schema(spark, path, "parquet", kept) == first


def test_layers_and_overwrite_with_new_schema(spark):
    tables.create_layers(spark, "tm", "dev")
    name = f"{tables.database('tm', 'silver', 'dev')}.things"
    assert tables.write_table(spark.range(5), name) == 5
    assert tables.write_table(spark.range(2).withColumn("x", F.lit(1)), name) == 2
    assert tables.read_table(spark, "tm", "silver", "things", "dev").columns == ["id", "x"]


def test_partition_refresh_and_pruning(spark):
    tables.create_layers(spark, "tm")
    name = "tm_silver.daily"
    df = spark.createDataFrame([("A", 1.0, dt.date(2024, 1, 1)), ("A", 2.0, dt.date(2024, 2, 1))],
                               f"{ENTITY} string, v double, month_key date")
    tables.write_table(df, name, partition_by=["month_key"])
    tables.write_table(df.where("v = 2").withColumn("v", F.lit(9.0)).select(ENTITY, "v", "month_key"),
                       name, mode="refresh")
    assert values(spark.table(name), "v") == [(1.0,), (9.0,)]
    plan = spark.table(name).where("month_key = date'2024-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_key" in plan


def test_feature_publish_checks_the_key(spark):
    tables.create_layers(spark, "tm")
    good = spark.createDataFrame([("A", dt.date(2024, 1, 1), 1)], f"{ENTITY} string, {OBSERVED} date, x int")
    assert tables.publish_features(good, "tm_gold.features") == 1
    with pytest.raises(ValueError, match="repeat"):
        tables.publish_features(good.union(good), "tm_gold.features")
    assert spark.table("tm_gold.features").count() == 1
    props = {r["key"]: r["value"] for r in spark.sql("SHOW TBLPROPERTIES tm_gold.features").collect()}
    assert props["primary_key"] == f"{ENTITY},{OBSERVED}"


def test_properties_and_comment(spark):
    tables.create_layers(spark, "tm")
    tables.write_table(spark.range(1), "tm_bronze.raw_calls")
    tables.set_properties(spark, "tm_bronze.raw_calls", {"quality": "bronze", "source": "it's csv"}, "one row per call")
    props = {r["key"]: r["value"] for r in spark.sql("SHOW TBLPROPERTIES tm_bronze.raw_calls").collect()}
    assert props["quality"] == "bronze" and props["source"] == "it's csv"
    described = spark.sql("DESCRIBE TABLE EXTENDED tm_bronze.raw_calls").where("col_name = 'Comment'").first()
    assert described["data_type"] == "one row per call"


def test_action_lists_and_log(spark):
    tables.create_layers(spark, "tm")
    scores = spark.createDataFrame([("a", "RED", .9, .1, .1), ("b", "RED", .95, .1, .1), ("c", "AMBER", .1, .7, .1),
                                    ("d", "GREEN", .1, .1, .1)],
                                   f"{ENTITY} string, risk_tier string, churn_prob_30d double, "
                                   "churn_prob_60d double, churn_prob_90d double")
    assert tables.write_action_lists(scores, "tm_gold") == {"loyalty": 2, "marketing": 1, "customer_success": 0}
    log = spark.createDataFrame([(30, "auc_pr", .4)], "horizon int, metric_name string, metric_value double")
    tables.append_log(log, "tm_ml.metrics")
    tables.append_log(log, "tm_ml.metrics")
    assert spark.table("tm_ml.metrics").count() == 2 and "computed_at" in spark.table("tm_ml.metrics").columns


def test_layout_sorts_ranges(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    laid = tables.cluster_layout(df, ["k"], 4)
    parts = (laid.withColumn("p", F.spark_partition_id()).groupBy("p")
             .agg(F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("lo").collect())
    assert all(a["hi"] < b["lo"] for a, b in zip(parts, parts[1:]))


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.fresh_folder(spark, "x") != session.fresh_folder(spark, "x")


def test_tier_actions_reach_every_row(spark):
    from tidemark.operators.actions import with_actions
    out = with_actions(spark.createDataFrame([("a", t) for t in TIER_ACTIONS], "id string, risk_tier string"))
    assert {r["risk_tier"]: (r["recommended_action"], r["action_owner"], r["action_sla"])
            for r in out.collect()} == TIER_ACTIONS


def test_usage_gets_tasks_by_its_lines(spark, tmp_path, monkeypatch):
    """Lines of a task are bounded; keys may be null or repeat, and the rows stay the same."""
    day = F.timestamp_add("DAY", F.col("id") % 40, F.lit("1996-01-01").cast("timestamp"))
    key = F.when(F.col("id") % 11 > 0, F.col("id") % 300)
    spark.range(2000).select(
        key.alias("l_orderkey"), day.alias("l_shipdate"), (F.col("id") % 50).cast("double").alias("l_quantity"),
        (F.col("id") * 1.5).alias("l_extendedprice")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(320).select((F.col("id") % 310).alias("o_orderkey"), F.when(F.col("id") % 7 > 0, F.col("id") % 9).alias(
        "o_custkey")).write.parquet(f"{tmp_path}/orders.parquet")
    few = given.raw_usage(spark, str(tmp_path))
    monkeypatch.setattr(given, "LINES_IN_TASK", 100)
    many = given.raw_usage(spark, str(tmp_path))
    assert few.count() > 100 and few.exceptAll(many).count() == many.exceptAll(few).count() == 0
    assert many.rdd.getNumPartitions() == 20


def test_months_and_their_join_get_tasks_by_lines(spark, tmp_path, monkeypatch):
    """However few partitions the session shuffles to; the rows stay the same."""
    day = F.timestamp_add("DAY", F.col("id") % 75, F.lit("1996-01-01").cast("timestamp"))
    spark.range(2000).select(
        (F.col("id") % 300).alias("l_orderkey"), F.when(F.col("id") % 13 > 0, day).alias("l_shipdate"),
        (F.col("id") % 50).cast("double").alias("l_quantity"),
        (F.col("id") * 1.5).alias("l_extendedprice")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(320).select(
        (F.col("id") % 310).alias("o_orderkey"), F.when(F.col("id") % 7 > 0, F.col("id") % 9).alias("o_custkey"),
        F.lit("1996-02-10").cast("timestamp").alias("o_orderdate")).write.parquet(f"{tmp_path}/orders.parquet")

    def joined():
        monthly = inputs.usage_monthly(spark, str(tmp_path))
        return monthly, rollup.join_month(inputs.spine(spark, str(tmp_path)), monthly, ["monthly_total_mb"])

    few = joined()
    monkeypatch.setattr(given, "LINES_IN_TASK", 100)
    many = joined()
    assert many[0].rdd.getNumPartitions() == 20
    assert few[1].count() >= 9
    for one, other in zip(few, many, strict=True):
        one, other = (x.select(*[F.round(c, 6) if t == "double" else F.col(c) for c, t in x.dtypes]) for x in (one, other))
        assert one.exceptAll(other).count() == other.exceptAll(one).count() == 0
