"""Boosted trees as arrays of nodes, walked for whole Arrow batches of rows: contributions and patience.

Every split on a row's way changes the value of the node it stands on. The change belongs to the
feature of the split, so a row's contributions and the ensemble's base add up to its margin.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.contract import CATEGORICAL_FEATURES, HORIZONS, NUMERIC_FEATURES, label_name
from tidemark.operators.assemble import KEYS
from tidemark.operators.evaluation import ranking_metrics
from tidemark.plans.training import TREE_SETTINGS, fit_horizons, prepared, prepared_by
from tidemark.session import fresh_folder

LEAF = -1


class Node(NamedTuple):
    """A leaf, or a split: up to ``threshold``, or in ``categories`` where there are any, a row goes left."""
    value: float
    feature: int = LEAF
    threshold: float = 0.0
    categories: tuple[int, ...] = ()
    left: int = LEAF        # places in the list of all nodes
    right: int = LEAF


class Trees(NamedTuple):
    """Nodes of all trees end to end, their values times the weight of their tree."""
    features: tuple[str, ...]
    roots: tuple[int, ...]
    nodes: tuple[Node, ...]
    depth: int


def read_trees(spark: SparkSession, model: PipelineModel) -> Trees:
    """The nodes of a fitted model, as its saved form lists them: rounds * 2^(depth + 1) at most."""
    boosted, folder = model.stages[-1], fresh_folder(spark, "trees")
    boosted.write().save(folder)
    saved = spark.read.parquet(f"{folder}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect()
    nodes: list[Node] = []
    roots: list[int] = []
    for row in saved:                       # nodes of a tree are numbered from 0 at its root
        if row["id"] == 0:
            roots.append(len(nodes))
        weight, split, first = boosted.treeWeights[row["treeID"]], row["split"], roots[-1]
        if row["leftChild"] < 0:
            nodes.append(Node(weight * row["prediction"]))
            continue
        by_category = split["numCategories"] >= 0
        bound = split["leftCategoriesOrThreshold"]
        nodes.append(Node(weight * row["prediction"], split["featureIndex"], 0.0 if by_category else bound[0],
                          tuple(int(c) for c in bound) if by_category else (),
                          first + row["leftChild"], first + row["rightChild"]))
    names = tuple(c.removeprefix("_") for c in model.stages[-2].getInputCols())
    return Trees(names, tuple(roots), tuple(nodes), max(t.depth for t in boosted.trees))


def _constant(values: Sequence[object], kind: str) -> Column:
    # one literal the optimiser folds into an array, not an expression for each node
    return F.split(F.lit(",".join(str(v) for v in values)), ",").cast(f"array<{kind}>")


def _table(trees: Trees) -> dict[str, np.ndarray]:
    """Columns of the nodes. A leaf leads to itself, so a walk may go on past it."""
    nodes, places = trees.nodes, np.arange(len(trees.nodes))
    leaf = np.array([n.left == LEAF for n in nodes])
    listed = [i for i, n in enumerate(nodes) if n.categories]
    by_category, named = np.full(len(nodes), -1), np.zeros(
        (len(listed), 1 + max((c for i in listed for c in nodes[i].categories), default=0)), bool)
    for at, i in enumerate(listed):
        by_category[i] = at
        named[at, list(nodes[i].categories)] = True
    return {"feature": np.where(leaf, 0, [n.feature for n in nodes]), "value": np.array([n.value for n in nodes], float),
            "threshold": np.array([n.threshold for n in nodes], float), "by_category": by_category, "named": named,
            "left": np.where(leaf, places, [n.left for n in nodes]), "right": np.where(leaf, places, [n.right for n in nodes])}


def _dense(lists: pa.ListArray, width: int) -> np.ndarray:
    """A line for each row and a column for each feature; nulls and what a list lacks are NaN."""
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.full((len(lists), width), np.nan)
    row = np.repeat(np.arange(len(lists)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    kept = place < width
    out[row[kept], place[kept]] = flat[kept]
    return out


def _steps(dense: np.ndarray, root: int, depth: int, table: Mapping[str, np.ndarray]) -> Iterator[np.ndarray]:
    """The node of every row, from the root on, ``depth`` steps down one tree. A missing value goes right."""
    first, flat, named = np.arange(len(dense)) * dense.shape[1], dense.ravel(), table["named"]
    at = np.full(len(dense), root)
    yield at
    for _ in range(depth):
        value = flat[first + table["feature"][at]]
        goes_left = value <= table["threshold"][at]
        if len(named):
            which = table["by_category"][at]
            here = np.flatnonzero(which >= 0)
            code = np.trunc(value[here])
            known = (code >= 0) & (code < named.shape[1])
            goes_left[here] = known & named[which[here], np.where(known, code, 0).astype(int)]
        at = np.where(goes_left, table["left"][at], table["right"][at])
        yield at


def _lists(matrix: np.ndarray) -> pa.ListArray:
    lines, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(lines + 1, dtype=np.int32) * width), pa.array(matrix.ravel()))


def _width(trees: Trees) -> int:
    return max(len(trees.features), 1 + max((n.feature for n in trees.nodes), default=0), 1)


def explained(values: Column, trees: Trees) -> Column:
    """Struct of ``base``, ``margin`` and ``contributions``, one for each feature in order."""
    table, width = _table(trees), _width(trees)
    roots, depth, features = trees.roots, trees.depth, len(trees.features)
    base = float(sum(trees.nodes[r].value for r in roots))

    def told(lists: pa.Array) -> pa.Array:
        dense = _dense(lists, width)
        margin, moved = np.zeros(len(dense)), np.zeros((len(dense), width))
        first, flat = np.arange(len(dense)) * width, moved.ravel()
        for root in roots:
            before = None
            for at in _steps(dense, root, depth, table):
                if before is not None:
                    flat[first + table["feature"][before]] += table["value"][at] - table["value"][before]
                before = at
            margin += table["value"][before]
        return pa.StructArray.from_arrays(
            [pa.array(np.full(len(dense), base)), pa.array(margin), _lists(moved[:, :features])], ["base", "margin", "contributions"])

    return F.arrow_udf(told, "base double, margin double, contributions array<double>")(values.cast("array<double>"))


def contributions(features: DataFrame, models: Mapping[int, PipelineModel], keys: Sequence[str] = KEYS,
                  numeric: Sequence[str] = NUMERIC_FEATURES,
                  categorical: Sequence[str] = CATEGORICAL_FEATURES) -> DataFrame:
    """``keys, horizon, base, margin, feature, contribution``: a row per row, horizon and feature.

    The probability is the logistic function of twice the margin. Nothing is shuffled.
    """
    spark, together, out = features.sparkSession, {}, None
    for h, model in models.items():
        together.setdefault(tuple(prepared_by(model)), {})[h] = model
    for alike in together.values():         # rows are prepared once for models that prepare alike
        known = {h: read_trees(spark, model) for h, model in alike.items()}
        model = next(iter(alike.values()))
        rows = prepared(features, model, numeric, categorical).select(
            *keys, vector_to_array("_features").alias("_values"))
        told = F.array(*[F.struct(F.lit(h).alias("horizon"), explained(F.col("_values"), t).alias("told")) for h, t in known.items()])
        names = _constant(next(iter(known.values())).features, "string")
        each = rows.select(*keys, F.explode(told).alias("_of"))
        long = each.select(*keys, "_of.horizon", "_of.told.base", "_of.told.margin",
                           F.posexplode("_of.told.contributions").alias("_f", "contribution"))
        long = long.select(*keys, "horizon", "base", "margin", F.get(names, F.col("_f")).alias("feature"), "contribution")
        out = long if out is None else out.unionByName(long)
    if out is None:
        raise ValueError("no model")
    return out


def mean_contributions(explained_rows: DataFrame) -> DataFrame:
    """``horizon, feature, mean_abs, mean``: how far each feature moves the margin; partial sums meet, not rows."""
    return explained_rows.groupBy("horizon", "feature").agg(
        F.avg(F.abs("contribution")).alias("mean_abs"), F.avg("contribution").alias("mean"))


def prefix_margins(values: Column, trees: Trees) -> Column:
    """The margin after each round, first to last; all from one walk of the trees."""
    table, width, roots, depth = _table(trees), _width(trees), trees.roots, trees.depth

    def summed(lists: pa.Array) -> pa.Array:
        dense = _dense(lists, width)
        sums, total = np.empty((len(dense), len(roots))), np.zeros(len(dense))
        for i, root in enumerate(roots):
            *_, leaf = _steps(dense, root, depth, table)
            total += table["value"][leaf]
            sums[:, i] = total
        return _lists(sums)

    return F.arrow_udf(summed, "array<double>")(values.cast("array<double>"))


def round_quality(rows: DataFrame, values: Column, outcome: Column, trees: Trees, horizon: int) -> DataFrame:
    """``rounds, horizon, auc_pr``: average precision of the first 1, 2, ... trees, in one pass over the rows.

    Rows without an outcome are left out. What is shuffled are counts per (round, margin).
    """
    long = rows.select(outcome.cast("bigint").alias("y"), F.posexplode(prefix_margins(values, trees)).alias("_r", "score"))
    hist = (long.where("y IS NOT NULL").groupBy((F.col("_r") + 1).alias("rounds"), F.lit(horizon).alias("horizon"), "score")
            .agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")))
    return ranking_metrics(hist, by=["rounds"]).select("rounds", "horizon", "auc_pr")


def stop_rounds(quality: DataFrame, patience: int = 50) -> DataFrame:
    """``horizon, rounds, auc_pr, seen``: the best round before ``patience`` rounds went by without a better one.

    Of equal rounds the first stays. ``seen`` is the round at which to stop; a row per round and
    horizon comes in, so one horizon's rounds make one small window.
    """
    order = Window.partitionBy("horizon").orderBy("rounds")
    best = F.max_by(F.struct("rounds", "auc_pr"), F.struct("auc_pr", -F.col("rounds"))).over(order)
    walked = quality.where("auc_pr IS NOT NULL").withColumn("best", best)
    last = F.max("rounds").over(Window.partitionBy("horizon"))
    walked = walked.withColumn("ends", (F.col("rounds") - F.col("best.rounds") >= patience) | (F.col("rounds") == last))
    return (walked.where("ends").groupBy("horizon").agg(F.min_by("best", "rounds").alias("best"), F.min("rounds").alias("seen"))
            .select("horizon", "best.rounds", "best.auc_pr", "seen"))


def first_rounds(spark: SparkSession, model: PipelineModel, rounds: int) -> PipelineModel:
    """The model with its first trees only, by way of its saved form."""
    full, short = fresh_folder(spark, "all-rounds"), fresh_folder(spark, "first-rounds")
    model.stages[-1].write().save(full)
    for part in ("data", "treesMetadata"):
        saved = spark.read.parquet(f"{full}/{part}")
        saved.where(saved[saved.columns[0]] < rounds).write.parquet(f"{short}/{part}")   # the tree's number comes first
    count = F.regexp_replace("value", r'"numTrees":\d+', f'"numTrees":{rounds}')
    spark.read.text(f"{full}/metadata").select(count).coalesce(1).write.text(f"{short}/metadata")
    return PipelineModel(stages=[*model.stages[:-1], GBTClassificationModel.load(short)])


def fit_patient(labelled: DataFrame, horizons: Sequence[int] = HORIZONS,
                numeric: Sequence[str] = NUMERIC_FEATURES, categorical: Sequence[str] = CATEGORICAL_FEATURES,
                rounds: int = 100, patience: int = 50, settings: Mapping[str, object] = TREE_SETTINGS,
                seed: int = 42) -> tuple[dict[int, PipelineModel], DataFrame]:
    """A model per horizon cut at its stop round, and ``horizon, rounds, auc_pr, seen`` of the choice.

    All ``rounds`` are grown on the train rows; average precision on the validation rows chooses.
    A horizon without a positive there, or without rows there, keeps all rounds and has no row in the choice.
    """
    spark = labelled.sparkSession
    models = fit_horizons(labelled, horizons, numeric, categorical, rounds, False, settings, seed)
    validation, choice = labelled.where(F.col("split") == "validation"), None
    for h, model in models.items():
        rows = prepared(validation, model, numeric, categorical)
        quality = round_quality(rows, vector_to_array("_features"), F.col(label_name(h)), read_trees(spark, model), h)
        choice = quality if choice is None else choice.unionByName(quality)
    if choice is None:
        raise ValueError("no horizon")
    folder = fresh_folder(spark, "stop-rounds")     # a row per horizon, read twice
    stop_rounds(choice, patience).write.parquet(folder)
    chosen = spark.read.parquet(folder)
    kept = {r["horizon"]: r["rounds"] for r in chosen.collect()}
    return {h: first_rounds(spark, m, kept[h]) if h in kept else m for h, m in models.items()}, chosen
