import random

import numpy as np
import pytest
from conftest import values
from pyspark.sql import functions as F

from tidemark.contract import HORIZONS
from tidemark.operators import actions, evaluation as E, monitor


def scored(seed=1, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        ps = [round(rng.random() ** 2, 2) for _ in HORIZONS]
        rows.append((f"c{i}", *ps, *[int(rng.random() < p) for p in ps]))
    return rows


SCHEMA = ("unique_customer_identifier string, churn_prob_30d double, churn_prob_60d double, "
          "churn_prob_90d double, churned_in_30d int, churned_in_60d int, churned_in_90d int")


def brute_auc(p, y):
    pos = [a for a, b in zip(p, y) if b]
    neg = [a for a, b in zip(p, y) if not b]
    return sum((a > b) + .5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def brute_ap(p, y):
    total, last = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        tp = sum(b for a, b in zip(p, y) if a >= t)
        n = sum(1 for a in p if a >= t)
        recall = tp / sum(y)
        total += (recall - last) * tp / n
        last = recall
    return total


def test_metrics_against_brute_force(spark):
    rows = scored()
    hist = E.score_histogram(spark.createDataFrame(rows, SCHEMA))
    got = {r["horizon"]: r for r in E.ranking_metrics(hist).collect()}
    for i, h in enumerate(HORIZONS):
        p, y = [r[1 + i] for r in rows], [r[4 + i] for r in rows]
        assert got[h]["auc_roc"] == pytest.approx(brute_auc(p, y), abs=1e-12)
        assert got[h]["auc_pr"] == pytest.approx(brute_ap(p, y), abs=1e-12)
        assert got[h]["n_customers"] == len(rows) and got[h]["actual_churn_count"] == sum(y)
        assert got[h]["predicted_churn_rate"] == pytest.approx(np.mean(p))


def test_unrounded_scores_in_two_levels(spark):
    rng = random.Random(9)
    rows = []
    for i in range(300):
        p = rng.choice([0.0, 1.0, 0.5, rng.random(), rng.random() * 1e-7])
        rows.append((f"c{i}", p, p / 3, 1 - p, *[int(rng.random() < .4) for _ in HORIZONS]))
    hist = E.score_histogram(spark.createDataFrame(rows, SCHEMA), digits=None)
    got = {r["horizon"]: r for r in E.ranking_metrics(hist, cells=16).collect()}
    for i, h in enumerate(HORIZONS):
        p, y = [r[1 + i] for r in rows], [r[4 + i] for r in rows]
        assert got[h]["auc_roc"] == pytest.approx(brute_auc(p, y), abs=1e-12)
        assert got[h]["auc_pr"] == pytest.approx(brute_ap(p, y), abs=1e-12)
        assert got[h]["n_customers"] == len(rows)


def test_metrics_without_positives_are_null(spark):
    rows = [("a", .1, .2, .3, 0, 0, 0), ("b", .2, .3, .4, 0, 0, 0)]
    got = E.ranking_metrics(E.score_histogram(spark.createDataFrame(rows, SCHEMA))).first()
    assert got["auc_roc"] is None and got["auc_pr"] is None and got["n_customers"] == 2


def test_curves_end_at_one(spark):
    hist = E.score_histogram(spark.createDataFrame(scored(), SCHEMA))
    last = E.roc_points(hist).groupBy("horizon").agg(F.max("fpr").alias("f"), F.max("tpr").alias("t"))
    assert {(r["f"], r["t"]) for r in last.collect()} == {(1.0, 1.0)}
    assert E.pr_points(hist).where("precision > 1 or recall > 1").count() == 0


def test_calibration_and_lift_cover_all_rows(spark):
    rows = scored(2)
    hist = E.score_histogram(spark.createDataFrame(rows, SCHEMA))
    for table in (E.calibration_curve(hist), E.lift_table(hist)):
        assert {r["n"] for r in table.groupBy("horizon").agg(F.sum("count").alias("n")).collect()} == {400}
    lift = E.lift_table(hist)
    weighted = lift.groupBy("horizon").agg((F.sum(F.col("lift") * F.col("count")) / F.sum("count")).alias("m"))
    assert all(r["m"] == pytest.approx(1.0) for r in weighted.collect())
    assert lift.where("is_top").count() == 3


def test_confusion_and_weights(spark):
    rows = [("a", .6, .6, .6, 1, 0, 0), ("b", .5, .9, .1, 1, 1, 0), ("c", .1, .1, .1, 0, 0, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert values(E.confusion(df).where("horizon = 30"), "actual", "predicted", "count") == [
        (0, 0, 1), (1, 0, 1), (1, 1, 1)]
    assert values(E.class_weights(df), "horizon", "positives", "negatives", "pos_weight") == [
        (30, 2, 1, 0.5), (60, 1, 2, 2.0), (90, 0, 3, 3.0)]


def test_quantile_edges_are_interpolated_percentiles(spark):
    rng = random.Random(8)
    rows = [(h, rng.random() if rng.random() < .7 else .25, rng.randint(0, 3), rng.randint(1, 4))
            for h in (30, 60) for _ in range(400)]
    hist = (spark.createDataFrame(rows, "horizon int, score double, pos long, neg long")
            .groupBy("horizon", "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
    got = {r["horizon"]: r["edges"] for r in E.quantile_edges(hist, 10).collect()}
    for h in (30, 60):
        every = np.repeat([r[1] for r in rows if r[0] == h], [r[2] + r[3] for r in rows if r[0] == h])
        assert np.allclose(got[h], np.quantile(every, [i / 10 for i in range(11)]), atol=1e-12)


def test_rank_shift_takes_mean_rank_of_ties(spark):
    imp = [(h, f, v) for h in HORIZONS for f, v in (("a", 3.0), ("b", 1.0), ("c", 1.0), ("d", .5))]
    out = E.rank_shift(spark.createDataFrame(imp, "horizon int, feature string, importance double"))
    assert values(out, "feature", "rank_30d", "rank_shift_30_to_90") == [
        ("a", 1, 0), ("b", 2, 0), ("c", 2, 0), ("d", 4, 0)]


@pytest.mark.parametrize("new, champion, options, promoted, reason", [
    (0.1, None, {}, True, "First model"),
    (0.1, None, {"enforce_floor_on_first": True}, False, "Below minimum threshold (0.1000 < 0.2)"),
    (0.19, 0.1, {}, False, "Below minimum threshold (0.1900 < 0.2)"),
    (0.3, 0.4, {}, False, "Regression detected (-25.00%)"),
    (0.4, 0.4, {}, True, "Performance improvement: +0.00%"),
    (0.39, 0.4, {"tolerance_pct": 5.0}, True, "Performance improvement: -2.50%"),
    (None, 0.4, {}, False, "Not measured"),
    (None, None, {}, False, "Not measured"),
    (0.1, "unknown", {}, False, "Below minimum threshold (0.1000 < 0.2)"),
    (0.3, "unknown", {}, True, "Champion was not measured")])
def test_promotion(spark, new, champion, options, promoted, reason):
    value = None if champion == "unknown" else champion
    log = [] if champion is None else [(30, 1, "Champion", value if value is None else 0.9),
                                       (30, 2, "Champion", value), (30, 3, "Challenger", 0.99)]
    versions = spark.createDataFrame(log, "horizon int, version int, alias string, test_auc_pr double")
    out = E.promotion(spark.createDataFrame([(30, new)], "horizon int, test_auc_pr double"), versions,
                      **options).first()
    assert "_has" not in out
    assert (out["promoted"], out["reason"]) == (promoted, reason)
    assert out["alias"] == ("Champion" if promoted else "Challenger")


SCORES = ("unique_customer_identifier string, risk_tier string, churn_prob_30d double, "
          "churn_prob_60d double, churn_prob_90d double")


def test_alerts_fire_and_clear(spark):
    high = spark.createDataFrame([("a", "RED", .9, .9, .9), ("b", "RED", .91, .9, .9)], SCORES)
    codes = {(r["code"], r["horizon"]) for r in monitor.score_alerts(high).collect()}
    assert codes == {("mean_too_high", h) for h in HORIZONS} | {
        ("collapsed_variance", h) for h in HORIZONS} | {("red_concentration", None)}
    calm = spark.createDataFrame([("a", "RED", .9, .6, .6), ("b", "GREEN", .1, .1, .1),
                                  ("c", "AMBER", .2, .6, .1), ("d", "GREEN", .1, .1, .1)], SCORES)
    assert monitor.score_alerts(calm).count() == 0
    assert monitor.retrain_flag(monitor.score_alerts(calm)).first()["retrain_needed"] is False
    base = spark.createDataFrame([(30, .1), (60, .35), (90, .225)], "horizon int, mean_probability double")
    assert values(monitor.score_alerts(calm, base), "code", "horizon") == [("mean_shift", 30)]
    assert monitor.score_alerts(calm.limit(0)).count() == 0


def test_psi_zero_for_same_and_large_for_shift(spark):
    df = spark.range(2000).select((F.col("id") % 100).cast("double").alias("x"))
    same = monitor.population_stability(df, df, ["x"]).first()
    assert same["psi"] == pytest.approx(0) and not same["drifted"]
    moved = monitor.population_stability(df, df.withColumn("x", F.col("x") + 60), ["x"]).first()
    assert moved["drifted"]


def test_null_rate_alert(spark):
    then = spark.createDataFrame([(1,), (2,), (3,), (4,)], "x int")
    now = spark.createDataFrame([(1,), (None,), (3,), (4,)], "x int")
    assert values(monitor.null_rate_alerts(then, now, ["x"]), "column", "current_rate", "alert") == [
        ("x", .25, True)]


def test_action_ranks_and_lists(spark):
    df = spark.createDataFrame([("a", "RED", .9, .1, .1), ("b", "RED", .9, .1, .1), ("c", "RED", .6, .1, .1),
                                ("d", "AMBER", .1, .7, .1), ("e", "GREEN", .1, .1, .1)], SCORES)
    assert values(actions.action_ranks(df), "unique_customer_identifier", "priority") == [
        ("a", 1), ("b", 1), ("c", 3), ("d", 1)]
    assert [r[0] for r in actions.action_list(df, "RED").select("unique_customer_identifier").collect()] == [
        "a", "b", "c"]
    assert values(actions.tier_distribution(df), "risk_tier", "count", "pct") == [
        ("AMBER", 1, 20.0), ("GREEN", 1, 20.0), ("RED", 3, 60.0), ("YELLOW", 0, 0.0)]
    assert values(actions.drilldown(df), "unique_customer_identifier") == [("a",), ("b",), ("c",)]


def test_tiers_partition_the_scores(spark, folder):
    from tidemark.workload import inputs
    scores = inputs.scores(spark, folder)
    counts = actions.tier_distribution(scores).agg(F.sum("count")).first()[0]
    assert counts == inputs.spine(spark, folder).count()
