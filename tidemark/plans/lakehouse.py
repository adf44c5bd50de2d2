"""The whole chain over layered tables: land, clean, derive, train, score, watch.

Plain functions called one after another; each reads tables and writes tables,
so a step can be run again on its own. The driver sees row counts only.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark import contract
from tidemark.contract import (ENTITY, HORIZONS, MODEL_FEATURES, OBSERVED, TierThresholds,
                               label_name)
from tidemark.functions.columns import split_label
from tidemark.operators import evaluation, monitor, quality
from tidemark.operators.assemble import latest
from tidemark.operators.rollup import monthly_rollup
from tidemark.operators.temporal import horizon_labels, observation_spine
from tidemark.plans import cleaning, training, trees
from tidemark.plans.features import feature_table
from tidemark.plans.scoring import score_table
from tidemark.sources import tables
from tidemark.sources.readers import read_raw, with_ingest_meta


@dataclass(frozen=True)
class Source:
    """A raw input: where it lies, its format, and its schema if it has none of its own."""

    path: str
    fmt: str = "parquet"
    schema: str | None = None
    properties: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Lakehouse:
    """Names of the layered tables of one project in one environment."""

    spark: SparkSession
    base: str
    env: str = "prod"

    def name(self, layer: str, table: str) -> str:
        return f"{tables.database(self.base, layer, self.env)}.{table}"

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    # --- bronze ---------------------------------------------------------------

    def ingest(self, sources: Mapping[str, Source]) -> dict[str, int]:
        """Raw files to ``bronze.raw_*`` with ingestion time and source file."""
        tables.create_layers(self.spark, self.base, self.env)
        rows = {}
        for table, source in sources.items():
            raw = with_ingest_meta(read_raw(self.spark, source.path, source.fmt, source.schema))
            name = self.name("bronze", f"raw_{table}")
            rows[table] = tables.write_table(raw, name)
            tables.set_properties(self.spark, name, {"quality": "bronze", **source.properties})
        return rows

    # --- silver ---------------------------------------------------------------

    def clean(self, batch: str = "full") -> dict[str, int]:
        """Cleaned tables, laid out for lookups by entity or by date; daily usage by month.

        What each rule has found is kept in ``ml.expectations`` under the name of the batch, which is
        replaced when the batch is cleaned again.
        """
        raw = {t: self.read("bronze", f"raw_{t}") for t in ("customer_info", "usage", "calls", "cease")}
        gated = {"customer_info": (cleaning.clean_customer_info, quality.SNAPSHOT_RULES),
                 "usage": (cleaning.clean_usage, quality.USAGE_RULES),
                 "calls": (cleaning.clean_calls, quality.CALL_RULES),
                 "cease": (cleaning.clean_cease, quality.CEASE_RULES)}
        seen = {t: Observation() for t in gated}
        info, usage, calls, cease = (quality.enforce(clean(raw[t]), rules, seen[t]) for t, (clean, rules) in gated.items())
        put = self._put_silver
        rows = {
            "customer_info": put("customer_info", tables.z_order(info, [ENTITY, "datevalue"])),
            # one range of entities per file of a month, not one file per task and month
            "usage_daily": put("usage_daily", tables.cluster_layout(
                usage, ["month_key", ENTITY, "calendar_date"]), ["month_key"]),
            "calls": put("calls", tables.z_order(calls, [ENTITY, "event_date"])),
            "cease": put("cease", tables.z_order(cease, [ENTITY, "cease_placed_date"])),
        }
        for table, (_, rules) in gated.items():
            self._replace("ml", "expectations", quality.recorded(self.spark, table, batch, rules, seen[table].get),
                          ["table_name", "batch"])
        monthly = monthly_rollup(self.read("silver", "usage_daily"))
        rows["usage_monthly"] = put("usage_monthly", tables.cluster_layout(monthly, [ENTITY, "month_key"]))
        return rows

    def _replace(self, layer: str, table: str, df: DataFrame, partition_by) -> int:
        """Write the partitions that the rows touch; the table is made where there is none."""
        name = self.name(layer, table)
        return tables.write_table(df, name, partition_by, mode="refresh" if self.exists(layer, table) else "overwrite")

    def _put_silver(self, table: str, df: DataFrame, partition_by=()) -> int:
        return tables.write_table(df, self.name("silver", table), partition_by, laid_out=True)

    def quality_report(self) -> DataFrame:
        """One line per check of the four cleaned tables."""
        checks = {"customer_info": quality.SNAPSHOT_CHECKS, "usage_daily": quality.USAGE_CHECKS,
                  "calls": quality.CALL_CHECKS, "cease": quality.CEASE_CHECKS}
        lines = [quality.report(self.read("silver", t), c, t) for t, c in checks.items()]
        out = lines[0]
        for line in lines[1:]:
            out = out.unionByName(line)
        return out

    # --- gold -----------------------------------------------------------------

    def derive(self, train_end: str = contract.TRAIN_END,
               validation_end: str = contract.VALIDATION_END, month_offset: int = 0) -> dict[str, int]:
        """Labels, features and the training set."""
        info, cease = self.read("silver", "customer_info"), self.read("silver", "cease")
        labels = horizon_labels(observation_spine(info), cease)
        rows = {"churn_labels": tables.write_table(labels, self.name("gold", "churn_labels"))}
        features = feature_table(info, self.read("silver", "calls"), cease,
                                 self.read("silver", "usage_monthly"), month_offset=month_offset)
        rows["churn_features"] = tables.publish_features(
            tables.materialise(features, "features"), self.name("gold", "churn_features"))
        joined = (self.read("gold", "churn_features")
                  .join(self.read("gold", "churn_labels"), [ENTITY, OBSERVED])
                  .withColumn("split", split_label(OBSERVED, train_end, validation_end)))
        rows["churn_training_set"] = tables.write_table(
            tables.cluster_layout(joined, [OBSERVED, ENTITY]), self.name("gold", "churn_training_set"))
        return rows

    # --- models ---------------------------------------------------------------

    def train(self, model_folder: str, rounds: int = 100, settings=training.TREE_SETTINGS,
              patience: int | None = None) -> DataFrame:
        """Fit, judge, log and promote; returns the decisions. Champions are kept under their version.

        With ``patience`` all rounds are grown and each model is cut at its best round on the validation
        rows; without, the fit stops where the validation error first grows.
        """
        table = self.read("gold", "churn_training_set").select(
            ENTITY, OBSERVED, *MODEL_FEATURES, *[label_name(h) for h in HORIZONS], "split")
        models = (training.fit_horizons(table, rounds=rounds, settings=settings) if patience is None else
                  trees.fit_patient(table, rounds=rounds, patience=patience, settings=settings)[0])
        metrics = training.evaluate(training.predict(table, models)).where(F.col("split") == "test")
        measured = tables.materialise(metrics.select(
            "horizon", F.col("auc_pr").alias("test_auc_pr"), F.col("auc_roc").alias("test_auc_roc")))
        log = self.name("ml", "model_versions")
        schema = ("horizon int, version int, alias string, test_auc_pr double, test_auc_roc double, "
                  "run_id string, path string")
        known = (self.read("ml", "model_versions") if self.exists("ml", "model_versions")
                 else self.spark.createDataFrame([], schema))
        decided = evaluation.promotion(measured, known)
        version = (known.agg(F.max("version")).first()[0] or 0) + 1
        training.save_models(models, f"{model_folder}/v{version}")
        run = uuid.uuid4().hex
        decided = tables.materialise(decided.withColumns({
            "version": F.lit(version), "run_id": F.lit(run),
            "path": F.concat(F.lit(f"{model_folder}/v{version}/"), F.col("horizon").cast("string"), F.lit("d"))}))
        names = [c.split(" ")[0] for c in schema.split(", ")]
        tables.write_table(decided.select(*names), log, mode="append")
        rates = evaluation.class_weights(table.where(F.col("split") == "train"))
        tables.write_table(
            rates.join(measured, "horizon").select(
                F.lit(run).alias("run_id"), "horizon", F.inline(F.array(*[
                    F.struct(F.lit(n).alias("name"), F.col(n).cast("double").alias("value"))
                    for n in ("positives", "negatives", "pos_weight", "test_auc_pr", "test_auc_roc")]))),
            self.name("ml", "model_runs"), mode="append")
        return decided

    def champions(self) -> dict:
        """The newest champion of each horizon, loaded."""
        rows = (self.read("ml", "model_versions").where(F.col("alias") == "Champion")
                .groupBy("horizon").agg(F.max_by("path", "version").alias("path")).collect())
        return {r["horizon"]: training.load_model(r["path"]) for r in rows}

    # --- scores ---------------------------------------------------------------

    def score(self, thresholds: TierThresholds = TierThresholds(), models=None) -> dict[str, int]:
        """Score the newest snapshot; publish scores and action lists, and keep the scores by their date."""
        features = latest(self.read("gold", "churn_features"))
        scored = training.predict(features, dict(sorted((models or self.champions()).items())))
        scores = score_table(tables.materialise(scored.select(
            ENTITY, OBSERVED, *[f"churn_prob_{h}d" for h in HORIZONS]), "scored"), thresholds)
        rows = {"churn_scores": tables.write_table(scores, self.name("gold", "churn_scores"))}
        self._replace("gold", "churn_score_history", self.read("gold", "churn_scores"), ["score_date"])
        rows |= tables.write_action_lists(self.read("gold", "churn_scores"),
                                          tables.database(self.base, "gold", self.env))
        return rows

    # --- monitoring -----------------------------------------------------------

    def watch(self, as_of: str | None = None) -> DataFrame:
        """Measure the windows that have closed by ``as_of`` (today), each once; returns the alerts.

        All scores ever published are looked at. A window goes into ``ml.performance_ledger`` and the metric
        log when it is measured, so asking again adds nothing.
        """
        day = F.current_date() if as_of is None else F.lit(as_of).cast("date")
        measured = monitor.retrospective(self.read("gold", "churn_score_history"), self.read("silver", "cease"), as_of=day)
        if self.exists("ml", "performance_ledger"):
            measured = monitor.newly_measured(measured, self.read("ml", "performance_ledger"))
        measured = tables.materialise(measured, "measured")
        tables.write_table(measured, self.name("ml", "performance_ledger"), mode="append")
        tables.append_log(monitor.metric_log(measured), self.name("ml", "monitoring_metrics"))
        return monitor.score_alerts(self.read("gold", "churn_scores"))
