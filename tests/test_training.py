"""Models on a seeded synthetic feature table: fit, judge, save, reload, importance."""

import threading

import pytest
from pyspark.sql import functions as F

from tidemark import contract
from tidemark.contract import ENTITY, HORIZONS, OBSERVED, label_name, probability_name
from tidemark.operators.evaluation import promotion
from tidemark.plans import training
from tidemark.workload import QUERIES


@pytest.fixture(scope="module")
def table(spark):
    """Outcome depends on two features; the others are noise or empty."""
    rows = spark.range(1200).withColumn("u", F.rand(7)).withColumn("v", F.rand(8))
    df = rows.select(
        F.col("id").cast("string").alias(ENTITY),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias(OBSERVED),
        *[(F.rand(i) * 10).alias(f) for i, f in enumerate(contract.NUMERIC_FEATURES)
          if f not in ("calls_30d", "speed_gap_pct", "std_daily_total_mb")],
        (F.col("u") * 10).alias("calls_30d"), F.when(F.col("v") > .2, F.col("v")).alias("speed_gap_pct"),
        F.lit(None).cast("double").alias("std_daily_total_mb"),
        F.when(F.col("u") > .5, "FTTP").otherwise(F.lit(None).cast("string")).alias("technology"),
        F.lit("Online").alias("sales_channel"), F.lit("3y+").alias("tenure_bucket"),
        *[(F.col("u") + F.rand(90 + h) * .3 > 1.0 - h / 300).cast("int").alias(label_name(h)) for h in HORIZONS],
        F.when(F.col("id") % 10 < 6, "train").when(F.col("id") % 10 < 8, "validation").otherwise("test").alias("split"))
    path = spark.conf.get("spark.checkpoint.dir") + "/synthetic"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def models(table):
    return training.fit_horizons(table, rounds=4, settings=training.TREE_SETTINGS | {
        "maxDepth": 3, "minInstancesPerNode": 10})


def test_probabilities_rank_well_and_beat_the_floor(table, models):
    scored = training.predict(table, models)
    assert scored.columns == table.columns + [probability_name(h) for h in HORIZONS]
    assert scored.count() == table.count()
    metrics = {(r["split"], r["horizon"]): r for r in training.evaluate(scored).collect()}
    assert set(metrics) == {(s, h) for s in ("validation", "test") for h in HORIZONS}
    assert all(m["auc_roc"] > .8 for m in metrics.values())
    gate = promotion(training.evaluate(scored).where("split = 'test'")
                     .select("horizon", F.col("auc_pr").alias("test_auc_pr")),
                     table.sparkSession.createDataFrame([], "horizon int, version int, alias string, test_auc_pr double"))
    assert gate.where("promoted").count() == 3


def test_reload_gives_the_same_scores(table, models, tmp_path):
    training.save_models(models, str(tmp_path))
    again = training.predict(table, training.load_models(str(tmp_path)))
    first = training.predict(table, models)
    assert again.exceptAll(first).count() == 0


def test_every_fit_reads_rows_that_are_prepared_once(table, monkeypatch):
    fit, plans = training.GBTClassifier.fit, []

    def looked_at(self, rows):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return fit(self, rows)

    monkeypatch.setattr(training.GBTClassifier, "fit", looked_at)
    training.fit_horizons(table, rounds=1, settings={"maxDepth": 1})
    assert len(plans) == 3 and all("InMemoryTableScan" in plan for plan in plans)
    assert table.sparkSession._jsparkSession.sharedState().cacheManager().isEmpty()


@pytest.mark.parametrize("room, together", [(0, 1), (1 << 40, 3)])
def test_fits_run_side_by_side_only_where_their_rows_have_room(table, monkeypatch, room, together):
    lock, met, running, most, kept = threading.Lock(), threading.Barrier(3), [], [], []

    def looked_at(self, rows):
        kept.append(rows._jdf.queryExecution().withCachedData().toString())
        with lock:
            running.append(self)
            most.append(len(running))
        if room:
            met.wait(60)
        with lock:
            running.remove(self)
        raise LookupError

    monkeypatch.setattr(training.GBTClassifier, "fit", looked_at)
    monkeypatch.setattr(training, "storage_bytes", lambda spark: room)
    with pytest.raises(LookupError):
        training.fit_horizons(table, rounds=1, settings={"maxDepth": 1})
    assert max(most) == together
    # the prepared rows leave the memory to the fits
    assert all("StorageLevel(disk, 1 replicas)" in plan for plan in kept)


def test_room_for_fits():
    row = training.ROW_BYTES + 4 * 32
    assert training.fits_at_once(1000, 32, 3, 3 * 1000 * row) == 3
    assert training.fits_at_once(1000, 32, 3, 3 * 1000 * row - 1) == 2
    assert training.fits_at_once(1000, 32, 3, 1000 * row // 9) == 1
    assert training.fits_at_once(0, 32, 3, 1 << 20) == 3


def test_room_is_what_executors_report(spark):
    heap = spark._jvm.java.lang.Runtime.getRuntime().maxMemory()
    assert .3 * heap < training.storage_bytes(spark) < .7 * heap


def test_rows_are_prepared_once_for_all_horizons(table, models, tmp_path, monkeypatch):
    prepare, calls = training.prepared, []
    monkeypatch.setattr(training, "prepared", lambda *given: calls.append(given) or prepare(*given))
    training.save_models(models, str(tmp_path))
    again = training.predict(table, training.load_models(str(tmp_path)))
    assert len(calls) == 1
    assert again.columns == table.columns + [probability_name(h) for h in HORIZONS]


def test_unseen_category_is_scored(spark, table, models):
    odd = table.limit(5).withColumn("technology", F.lit("never seen"))
    assert training.predict(odd, models).where("churn_prob_30d is null").count() == 0


def test_permutation_importance_finds_the_signal(table, models):
    test = table.where("split = 'test'")
    imp = training.permutation_importance(test, {30: models[30]}, ["calls_30d", "line_speed"])
    found = {r["feature"]: r["importance"] for r in imp.collect()}
    assert found["calls_30d"] > .03 > abs(found["line_speed"])


def test_redraw_is_repeatable_and_keeps_rows(table):
    a = training.redraw(table, "calls_30d")
    b = training.redraw(table.repartition(5), "calls_30d")
    assert a.columns == table.columns and a.count() == table.count()
    assert a.exceptAll(b).count() == 0
    moved = [*training.KEYS, "calls_30d"]       # the values stay, but with other rows
    assert a.select(*moved).exceptAll(table.select(*moved)).count() > table.count() / 10
    assert a.where("calls_30d is null").count() == 0


def test_redraw_uses_every_value_once(table):
    def counted(df):
        return df.groupBy("calls_30d").count()

    for rows in (16, 1 << 13):
        moved = training.redraw(table, "calls_30d", cell_rows=rows)
        assert counted(moved).exceptAll(counted(table)).count() == 0


def test_the_registered_query_trains_with_production_settings(spark, folder, monkeypatch):
    asked = {}

    class Asked(Exception):
        pass

    def fit(rows, *args, **options):
        asked.update(options, args=args)
        raise Asked

    monkeypatch.setattr(training, "fit_horizons", fit)
    with pytest.raises(Asked):
        QUERIES["ml_gbt_scores"](spark, folder)
    assert asked == {"args": (), "settings": training.TREE_SETTINGS | {"validationTol": 0.0}}
