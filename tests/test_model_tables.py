"""What model queries store, and when."""

from pyspark.sql import functions as F

from offeranalytics.operators import models as md
from offeranalytics.plans import model_plans


def rows(spark):
    return spark.range(300).select((F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"),
                                   (F.col("id") % 7 + F.col("id") % 5 > 5).cast("int").alias("completed"))


def test_comparing_fitted_models_stores_no_training_rows(spark, monkeypatch):
    df, estimators = rows(spark), {"forest": md.random_forest(numTrees=3, maxDepth=2), "logistic": md.logistic(maxIter=5)}
    first, fitted = md.compare(estimators, df, df, ["a", "b"], "completed")
    stored, plain = [], md.durable
    monkeypatch.setattr(md, "durable", lambda t: stored.append(t.columns) or plain(t))
    again, same = md.compare(estimators, df, df, ["a", "b"], "completed", fitted)
    assert same == fitted and again.collect() == first.collect()
    assert not any("weight" in columns and "a" in columns for columns in stored)


def test_tree_models_share_one_stored_table_and_the_logistic_model_needs_none(spark, monkeypatch):
    df, stored, fitted_on = rows(spark), [], []
    monkeypatch.setattr(model_plans, "_modelling", lambda d: (df, df, ["a", "b"]))
    monkeypatch.setattr(model_plans, "_STORED", {})
    monkeypatch.setattr(model_plans, "_FITTED", {})
    monkeypatch.setattr(model_plans, "durable", lambda t: stored.append(t.columns) or t)
    monkeypatch.setattr(md, "fit", lambda estimator, train, *a: fitted_on.append(train) or object())
    d = type("D", (), {"spark": spark, "sf_dir": "none"})()
    models = [model_plans._fitted(d, n) for n in model_plans.ESTIMATORS]
    assert models == [model_plans._fitted(d, n) for n in model_plans.ESTIMATORS] and len(fitted_on) == 4
    assert stored == [["a", "b", "completed", "weight"]] and fitted_on[0] is df
    assert all(t is fitted_on[1] for t in fitted_on[1:])
