"""Models on a small separable table."""

import pytest
from pyspark.sql import functions as F

from offeranalytics.functions.scalars import standardise
from offeranalytics.operators import features as ft, models as md, segments as sg


@pytest.fixture(scope="module")
def split(spark):
    u = lambda n: F.conv(F.substring(F.md5(F.concat(F.col("id").cast("string"), F.lit(n))), 1, 8), 16, 10).cast("double") / 2**32
    raw = spark.range(1200).select(F.col("id").cast("string").alias("key"), u("a").alias("x1"), u("b").alias("x2"), u("c").alias("x3"), u("d").alias("noise"))
    df = raw.withColumn("y", (F.col("x1") + 0.3 * F.col("x2") + 0.2 * F.col("noise") > 0.9).cast("int")).drop("noise")
    rows = ft.stratified_split(standardise(df, ["x1", "x2", "x3"]), "y", "key").cache()
    return rows.filter("is_test = 0"), rows.filter("is_test = 1")


COLUMNS = ["x1", "x2", "x3"]


def test_comparison_ranks_by_auc_and_importance_finds_the_signal(spark, split):
    train, test = split
    table, fitted = md.compare({"logistic": md.logistic(), "forest": md.random_forest(numTrees=10), "boosting": md.boosting(maxIter=5),
                                "weighted": md.weighted_boosting(maxIter=5, maxDepth=3)}, train, test, COLUMNS, "y")
    rows = table.collect()
    assert len(rows) == 4 and all(r["auc_roc"] > 0.85 for r in rows)
    assert [r["auc_roc"] for r in rows] == sorted((r["auc_roc"] for r in rows), reverse=True)
    for model in (fitted["logistic"], fitted["forest"]):
        assert md.importances(model, COLUMNS, spark).first()["feature"] == "x1"
    losses = {r["feature"]: r["importance"] for r in md.permutation_importance(fitted["forest"], test, COLUMNS, "y", "key").collect()}
    assert losses["x1"] > 0.2 > abs(losses["x3"])


def test_cross_validation_and_grid(split):
    table, _ = md.cross_validate(md.logistic(maxIter=20), split[0], COLUMNS, "y", "key", folds=3, grid={"regParam": [0.0, 0.5]})
    rows = table.collect()
    assert len(rows) == 2 and all(r["cv_auc_mean"] > 0.8 for r in rows)
    tuned = md.tune_boosting(split[0], COLUMNS, "y", "key", folds=2, grid={"trees": [2], "depth": [2, 3]})
    assert tuned.count() == 2


def test_attribution_adds_up(split):
    parts = md.linear_attribution(split[1], {"x1": 2.0, "x2": -1.0})
    assert parts.agg(F.avg("x1")).first()[0] == pytest.approx(0, abs=1e-9)
    assert md.attribution_ranking(parts, ["x1", "x2"]).first()["feature"] == "x1"


def test_kmeans_sweep_stability_and_components(spark):
    blob = F.col("id") % 3
    u = lambda n: F.conv(F.substring(F.md5(F.concat(F.col("id").cast("string"), F.lit(n))), 1, 8), 16, 10).cast("double") / 2**32
    df = spark.range(150).select("id", (blob * 10 + u("a")).alias("a"), (F.when(blob == 1, 10).otherwise(0) + u("b")).alias("b"), u("c").alias("c"))
    points = sg.durable(sg.as_array(df, ["a", "b", "c"], ["id"]))
    curve = sg.durable(sg.sweep(points, 5, (0, 1)))
    costs = [r["wcss"] for r in curve.orderBy("k").collect()]
    assert costs == sorted(costs, reverse=True) and len(costs) == 4
    best = sg.best_k(curve).first()
    assert best["optimal_k_silhouette"] == 3 and best["optimal_k_elbow"] == 3
    assert sg.gap_choice(sg.gap_statistic(points, 4, 2, (0,))).first()[0] == 3
    assert sg.stability(points, "id", 3, (1, 2, 3), 2).first()["stability"] == "highly stable"
    model = sg.fit_kmeans(points, 3, (0, 1))
    assert sg.labelling_quality(sg.assign_nearest(points, sg.centres(model, spark))).first()["wcss"] == pytest.approx(costs[1], rel=1e-6)
    projected, shares = sg.principal_components(df, ["a", "b", "c"], ["id"])
    assert projected.count() == 150 and sum(shares) > 0.95 and projected.agg(F.avg("pc1")).first()[0] == pytest.approx(0, abs=1e-9)


def test_logistic_folds_are_fitted_together(split, monkeypatch):
    """One packed table for all folds, and the areas of Spark's own validator."""
    packings, plain = [], md.newton.packed
    monkeypatch.setattr(md.newton, "packed", lambda rows: packings.append(1) or plain(rows))
    table, fitted = md.cross_validate(md.logistic(), split[0], COLUMNS, "y", "key", folds=3)
    penalty = 3 / (2 * split[0].count())
    theirs, other = md.cross_validate(md.logistic(regParam=penalty, tol=1e-10), split[0], COLUMNS, "y", "key", folds=3)
    assert len(packings) == 1 and fitted.bestModel.stages[-1].getRegParam() == penalty
    assert fitted.bestModel.stages[-1].coefficients.toArray() == pytest.approx(other.bestModel.stages[-1].coefficients.toArray(), abs=1e-5)
    ours, theirs = table.first(), theirs.first()
    assert ours.parameters == theirs.parameters == "default"
    assert (ours.cv_auc_mean, ours.cv_auc_std) == pytest.approx((theirs.cv_auc_mean, theirs.cv_auc_std), abs=1e-4)
