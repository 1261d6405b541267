"""Registered model and segment queries hand the operators the whole job."""

from inspect import signature

from pyspark.sql import functions as F

from offeranalytics.operators import models as md, segments as sg
from offeranalytics.plans import model_plans, segment_plans


def caught(monkeypatch, module, name, result):
    """Replace an operator by one that notes its bound arguments, defaults included."""
    calls, bind = [], signature(getattr(module, name)).bind

    def note(*args, **options):
        bound = bind(*args, **options)
        bound.apply_defaults()
        calls.append(bound.arguments)
        return result

    monkeypatch.setattr(module, name, note)
    return calls


def test_model_queries_run_in_full(spark, monkeypatch):
    rows = spark.range(8).select(F.col("id").alias("x"), (F.col("id") % 2).cast("int").alias("completed"), F.col("id").alias("pair"))
    monkeypatch.setattr(model_plans, "_modelling", lambda d: (rows, rows, ["x"]))
    monkeypatch.setattr(model_plans, "_fitted", lambda d, name: None)
    table = spark.range(1).selectExpr("'default' parameters", "0.5D cv_auc_mean", "0.1D cv_auc_std")
    calls = caught(monkeypatch, md, "cross_validate", (table, None))
    boosted = caught(monkeypatch, md, "cross_validate_boosting", table)
    names = {r.model for r in model_plans.cross_validation(None).collect()}
    assert set(model_plans.BOOSTED) | names >= set(model_plans.ESTIMATORS)
    assert all(c["folds"] == 5 and "weight" in c["train"].columns for c in calls + boosted)
    full = [e() for n, e in model_plans.ESTIMATORS.items() if n not in model_plans.BOOSTED]
    assert [{p.name: v for p, v in c["estimator"].extractParamMap().items()} for c in calls] == [{p.name: v for p, v in e.extractParamMap().items()} for e in full]
    for name, s in boosted[0]["points"].items():
        same = model_plans.ESTIMATORS[name]()
        assert (s.trees, s.depth, s.rate, s.weighted) == (same.getMaxIter(), same.getMaxDepth(), same.getStepSize(), same.isSet("weightCol")) and boosted[0]["weight"] == "weight"
    boosted.clear()
    model_plans.grid(None)
    assert len(boosted[0]["points"]) == 48 and boosted[0]["folds"] == 3 and len(set(boosted[0]["points"].values())) == 48
    assert {s.columns for s in boosted[0]["points"].values()} == {0.8, 1.0} and {s.trees for s in boosted[0]["points"].values()} == {100, 200}
    calls = caught(monkeypatch, md, "permutation_importance", None)
    model_plans.permutation(None)
    assert calls[0]["features"] in (None, calls[0]["columns"])


def test_segment_queries_run_in_full(monkeypatch):
    monkeypatch.setattr(segment_plans, "_customer_points", lambda d: None)
    sweep, gap, stability = (caught(monkeypatch, sg, name, None) for name in ("sweep", "gap_statistic", "stability"))
    segment_plans.sweep(None), segment_plans.gap(None), segment_plans.stability(None)
    assert sweep[0]["max_k"] == 10 and len(set(sweep[0]["seeds"])) == 10
    assert gap[0]["max_k"] == 10 and gap[0]["references"] == 10 and len(set(gap[0]["seeds"])) == 10
    assert set(stability[0]["seeds"]) == {42, 123, 456, 789, 2024} and stability[0]["starts"] == 10


def test_default_penalty_is_fitted(spark):
    rows = spark.range(200).select(F.col("id").cast("string").alias("key"), (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 3).cast("double").alias("b"),
                                   (F.col("id") % 7 > 2).cast("int").alias("y"))
    fitted = md.cross_validate(md.logistic(maxIter=5), rows, ["a", "b"], "y", "key", folds=2)[1]
    assert fitted.bestModel.stages[-1].getRegParam() == 2 / 200
