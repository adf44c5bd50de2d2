"""Contributions and rounds of boosted trees against plain Python."""

import pytest
from pyspark import SparkContext
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.common import _py2java
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidemark.plans import trees
from tidemark.plans.trees import Node, Trees
from tidemark.workload import QUERIES

NUMERIC, CATEGORICAL = ["speed", "noise"], ["technology"]


@pytest.fixture(scope="module")
def table(spark):
    df = spark.range(400).select(
        F.col("id").alias("row"), (F.rand(1) * 10).alias("speed"), F.rand(2).alias("noise"),
        F.element_at(F.array(*[F.lit(t) for t in "abcde"]), (F.col("id") % 5 + 1).cast("int")).alias("technology"))
    df = df.withColumn("y", (F.col("speed") + F.col("technology").isin("b", "d").cast("int") * 4 > 7).cast("double"))
    path = spark.conf.get("spark.checkpoint.dir") + "/trees-table"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def model(table):
    encode = StringIndexer(inputCol="technology", outputCol="_technology", handleInvalid="keep").fit(table)
    same = VectorAssembler(inputCols=["speed", "noise", "_technology"], outputCol="_features")
    fitted = GBTClassifier(featuresCol="_features", labelCol="y", maxIter=4, maxDepth=3, seed=1).fit(
        same.transform(encode.transform(table)))
    return PipelineModel(stages=[encode, same, fitted])


def told(table, model):
    return trees.contributions(table, {30: model}, ["row"], NUMERIC, CATEGORICAL)


def test_contributions_and_base_add_up_to_the_models_own_margin(table, model):
    added = told(table, model).groupBy("row", "margin").agg((F.first("base") + F.sum("contribution")).alias("sum"))
    own = model.transform(table).select("row", vector_to_array("rawPrediction")[1].alias("raw"))
    both = own.join(added, "row")
    assert both.count() == 400
    assert both.where("abs(raw - margin) > 1e-9 or abs(raw - sum) > 1e-9 or raw is null or sum is null").count() == 0


def test_every_contribution_agrees_with_a_walk_in_python(table, model):
    boosted = model.stages[-1]
    found = {(r["row"], r["feature"]): r["contribution"] for r in told(table, model).collect()}
    rows = {r["row"]: r["_features"].toArray() for r in model.transform(table).collect()}
    for row, vector in rows.items():
        sums = dict.fromkeys(("speed", "noise", "technology"), 0.0)
        for weight, tree in zip(boosted.treeWeights, boosted.trees, strict=True):
            node = tree._call_java("rootNode")
            while node.subtreeDepth() > 0:
                split = node.split()
                on = node.leftChild() if split.shouldGoLeft(_java(vector)) else node.rightChild()
                sums[("speed", "noise", "technology")[split.featureIndex()]] += weight * (on.prediction() - node.prediction())
                node = on
        for feature, value in sums.items():
            assert found[row, feature] == pytest.approx(value, abs=1e-9)


def _java(values):
    return _py2java(SparkContext.getOrCreate(), Vectors.dense(values))


def test_categories_missing_values_and_trees_without_a_split(spark):
    hand = Trees(("a", "b"), (0, 3), (
        Node(1.0, 1, 0.0, (1, 12), 1, 2), Node(3.0), Node(-1.0), Node(0.5)), 1)
    rows = spark.createDataFrame([(1, 0.0, 1.0), (2, 0.0, 2.0), (3, 0.0, 12.0), (4, 0.0, None)], "id int, a double, b double")
    found = {r["id"]: tuple(r["e"]) for r in rows.select("id", trees.explained(F.array("a", "b"), hand).alias("e")).collect()}
    assert found == {1: (1.5, 3.5, [0.0, 2.0]), 2: (1.5, -0.5, [0.0, -2.0]),
                     3: (1.5, 3.5, [0.0, 2.0]), 4: (1.5, -0.5, [0.0, -2.0])}


def test_the_signal_moves_the_margin_most_and_nothing_is_shuffled(table, model):
    rows = told(table, model)
    mean = {r["feature"]: r["mean_abs"] for r in trees.mean_contributions(rows).collect()}
    assert mean["speed"] > mean["technology"] > mean["noise"]
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()


def test_horizons_that_prepare_alike_are_walked_together(table, model):
    rows = trees.contributions(table, {30: model, 60: model}, ["row"], NUMERIC, CATEGORICAL)
    assert rows._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert rows.count() == 2 * told(table, model).count()


def test_lists_that_are_null_or_too_short(spark):
    hand = Trees(("a", "b"), (0,), (Node(1.0, 1, 0.0, (), 1, 2), Node(3.0), Node(-1.0)), 1)
    rows = spark.createDataFrame([(1, [5.0, -1.0]), (2, [5.0]), (3, None), (4, [5.0, -1.0, 7.0])], "id int, v array<double>")
    found = {r["id"]: tuple(r["e"]) for r in rows.coalesce(1).select("id", trees.explained(F.col("v"), hand).alias("e")).collect()}
    assert found == {1: (1.0, 3.0, [0.0, 2.0]), 2: (1.0, -1.0, [0.0, -2.0]), 3: (1.0, -1.0, [0.0, -2.0]),
                     4: (1.0, 3.0, [0.0, 2.0])}


def test_first_rounds_score_as_the_running_margin_says(spark, table, model):
    values = vector_to_array("_features")
    rows = model.stages[1].transform(model.stages[0].transform(table))
    margins = rows.select("row", trees.prefix_margins(values, trees.read_trees(spark, model)).alias("m"))
    for n in (1, 3):
        cut = trees.first_rounds(spark, model, n)
        assert cut.stages[-1].getNumTrees == n
        both = cut.transform(table).select("row", vector_to_array("rawPrediction")[1].alias("raw")).join(margins, "row")
        assert both.where(F.abs(F.col("raw") - F.col("m")[n - 1]) > 1e-9).count() == 0


def test_quality_of_a_round_is_average_precision(spark, table, model):
    rows = model.stages[1].transform(model.stages[0].transform(table))
    nodes, values = trees.read_trees(spark, model), vector_to_array("_features")
    found = {r["rounds"]: r["auc_pr"] for r in trees.round_quality(rows, values, F.col("y"), nodes, 30).collect()}
    plain = rows.select("y", trees.prefix_margins(values, nodes).alias("m")).collect()
    assert sorted(found) == [1, 2, 3, 4]
    for n, value in found.items():
        scores = sorted({r["m"][n - 1] for r in plain}, reverse=True)
        total = 0.0
        for s in scores:
            above = [r["y"] for r in plain if r["m"][n - 1] >= s]
            total += sum(r["y"] for r in plain if r["m"][n - 1] == s) * sum(above) / len(above)
        assert value == pytest.approx(total / sum(r["y"] for r in plain), abs=1e-9)


@pytest.mark.parametrize(("quality", "patience", "expected"), [
    ([.1, .3, .2, .2, .5], 2, (2, .3, 4)),      # stopped before the later rise
    ([.1, .3, .2, .2, .5], 3, (5, .5, 5)),
    ([.4, .4, .4], 50, (1, .4, 3)),             # the first of equal rounds
    ([.2], 50, (1, .2, 1))])
def test_patience(spark, quality, patience, expected):
    rows = spark.createDataFrame([(i + 1, 30, q) for i, q in enumerate(quality)], "rounds int, horizon int, auc_pr double")
    r = trees.stop_rounds(rows, patience).first()
    assert (r["rounds"], r["auc_pr"], r["seen"]) == expected


def test_a_horizon_without_positives_has_no_stop_round(spark):
    none = spark.createDataFrame([(1, 30, None)], "rounds int, horizon int, auc_pr double")
    assert trees.stop_rounds(none).count() == 0


def test_fit_patient_cuts_each_model_at_its_round(spark, table):
    labelled = table.select(
        "row", "speed", "noise", "technology", F.col("y").cast("int").alias("churned_in_30d"),
        F.when(F.col("row") % 3 == 0, "validation").otherwise("train").alias("split"))
    labelled = labelled.withColumnRenamed("churned_in_30d", trees.label_name(30))
    models, choice = trees.fit_patient(labelled, [30], NUMERIC, CATEGORICAL, 5, 1, {"maxDepth": 2, "stepSize": 0.3})
    chosen = choice.collect()
    assert [r["horizon"] for r in chosen] == [30]
    assert models[30].stages[-1].getNumTrees == chosen[0]["rounds"] <= chosen[0]["seen"] <= 5
    assert chosen[0]["seen"] == 5 or chosen[0]["seen"] - chosen[0]["rounds"] == 1


def test_an_empty_table_gives_no_rows(table, model):
    assert told(table.limit(0), model).count() == 0


def test_registered(spark):
    assert {"ml_tree_contributions", "ml_mean_contributions", "ml_round_quality"} <= set(QUERIES)
