"""The chain end to end on the smallest tables: raw files in, alerts out."""

import pytest
from pyspark.sql import functions as F

from tidemark.contract import ENTITY, HORIZONS, OBSERVED, TIER_ORDER
from tidemark.operators.quality import contract_gaps
from tidemark.plans import training
from tidemark.plans.lakehouse import Lakehouse, Source
from tidemark.sources import given, tables

CALLS = (f"{ENTITY} string, event_date string, call_type string, talk_time_seconds int, hold_time_seconds int")
CEASE = (f"{ENTITY} string, cease_placed_date string, cease_completed_date string, "
         "reason_description_insight string")


@pytest.fixture(scope="module")
def house(spark, folder, tmp_path_factory):
    raw = str(tmp_path_factory.mktemp("raw"))
    given.raw_customer_info(spark, folder).write.parquet(f"{raw}/customer_info")
    given.raw_usage(spark, folder).write.parquet(f"{raw}/usage")
    tables.export_csv(given.raw_calls(spark, folder), f"{raw}/calls")
    tables.export_csv(given.raw_cease(spark, folder), f"{raw}/cease")
    house = Lakehouse(spark, "chain", "dev")
    house.ingest({"customer_info": Source(f"{raw}/customer_info", properties={"grain": "customer x month"}),
                  "usage": Source(f"{raw}/usage"), "calls": Source(f"{raw}/calls", "csv", CALLS),
                  "cease": Source(f"{raw}/cease", "csv", CEASE)})
    house.clean()
    house.derive(given.TRAIN_END, given.VALIDATION_END)
    return house


def test_silver_and_quality(house):
    report = {(r["table_name"], r["rule"]): r["status"] for r in house.quality_report().collect()}
    assert len(report) == 10 and report["cease", "null_placed_date"] == "PASS"
    assert report["usage_daily", "null_download"] == "WARN"
    assert house.read("silver", "customer_info").where("speed <= 0").count() == 0


def test_gold_meets_the_contract(house):
    table = house.read("gold", "churn_training_set")
    assert contract_gaps(table) == []
    assert table.count() == house.read("gold", "churn_labels").count()
    assert {r[0] for r in table.select("split").distinct().collect()} == {"train", "validation", "test"}


def test_train_score_watch(house, tmp_path):
    small = training.TREE_SETTINGS | {"maxDepth": 3, "minInstancesPerNode": 5}
    first = house.train(str(tmp_path), rounds=2, settings=small)
    assert {r["reason"] for r in first.collect()} == {"First model"}
    again = house.train(str(tmp_path), rounds=2, settings=small, patience=1)
    assert {r["version"] for r in again.collect()} == {2}
    log = house.read("ml", "model_versions")
    assert log.count() == 6 and log.where("version = 1 and alias = 'Champion'").count() == 3
    assert house.read("ml", "model_runs").count() == 30

    rows = house.score()
    scores = house.read("gold", "churn_scores")
    newest = house.read("gold", "churn_features").agg(F.max(OBSERVED)).first()[0]
    assert rows["churn_scores"] == scores.count() == house.read("gold", "churn_features").where(
        F.col(OBSERVED) == F.lit(newest)).count()
    assert set(scores.columns) == {ENTITY, OBSERVED, "score_date", "risk_tier",
                                   *[f"churn_prob_{h}d" for h in HORIZONS],
                                   *[f"risk_decile_{h}d" for h in HORIZONS]}
    assert scores.where(~F.col("risk_tier").isin(*TIER_ORDER)).count() == 0
    listed = rows["loyalty"] + rows["marketing"] + rows["customer_success"]
    assert listed == scores.where("risk_tier <> 'GREEN'").count()

    alerts = house.watch()
    assert set(alerts.columns) == {"code", "horizon", "value", "message"}
    metrics = house.read("ml", "monitoring_metrics")
    assert {r[0] for r in metrics.select("horizon").distinct().collect()} == set(HORIZONS)


def test_history_ledger_and_expectations(house):
    """After training and scoring above: closed windows are entered once, counts of a batch replaced."""
    history, ledger = house.read("gold", "churn_score_history"), house.read("ml", "performance_ledger")
    assert history.count() == house.read("gold", "churn_scores").count() > 0
    entered, logged = ledger.count(), house.read("ml", "monitoring_metrics").count()
    assert entered == len(HORIZONS)
    house.watch()
    house.watch(as_of="1990-01-01")
    assert house.read("ml", "performance_ledger").count() == entered
    assert house.read("ml", "monitoring_metrics").count() == logged
    found = house.read("ml", "expectations")
    rows = found.count()
    assert {r[0] for r in found.select("table_name").distinct().collect()} == {"customer_info", "usage", "calls", "cease"}
    assert found.where("rows > 0").count() == rows
    house.clean()
    assert house.read("ml", "expectations").count() == rows
