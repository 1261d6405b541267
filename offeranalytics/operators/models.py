"""Completion models on Spark ML and exact evaluation from (label, score) tables."""

from itertools import product

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression, LogisticRegressionModel, RandomForestClassifier
from pyspark.ml.common import _py2java
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import ordered
from ..functions.scalars import column_stats, safe_ratio
from ..functions.scale import durable
from . import attribution, boosting as boosting_engine, newton
from .boosting import Setting
from .features import stratified_folds, stratified_numbers


def score_counts(scored: DataFrame, by=(), label: str = "label", score: str = "score") -> DataFrame:
    """Stored counts per distinct score: all rows and positives; the input of every curve below."""
    rows = scored.select(*by, F.col(score).alias("score"), F.col(label).cast("int").alias("y"))
    return ordered.value_counts(rows, "score", by, {"n": F.lit(1), "n1": F.col("y")})


def roc_auc(counted: DataFrame, by=()) -> DataFrame:
    """Exact area under the ROC curve: the share of (positive, negative) pairs ranked right, ties half."""
    by = list(by)
    ranked = ordered.prefix_sums(counted.withColumn("n0", F.col("n") - F.col("n1")), "score", {"below": "n0"}, by)
    sums = ranked.groupBy(*by).agg(F.sum(F.col("n1") * (F.col("below") + F.col("n0") / 2)).alias("right"),
                                   F.sum("n1").cast("double").alias("p"), F.sum("n0").cast("double").alias("q"))
    return sums.select(*by, (F.col("right") / F.when((F.col("p") > 0) & (F.col("q") > 0), F.col("p") * F.col("q"))).alias("auc_roc"))


def curve(counted: DataFrame, by=()) -> DataFrame:
    """True and false positives at every distinct score taken as threshold."""
    by = list(by)
    down = counted.withColumn("_down", -F.col("score")).withColumn("n0", F.col("n") - F.col("n1"))
    return ordered.prefix_sums(down, "_down", {"tp": "n1", "fp": "n0"}, by).select(
        *by, F.col("score").alias("threshold"), (F.col("tp") + F.col("n1")).alias("tp"), (F.col("fp") + F.col("n0")).alias("fp"), "n1")


def roc_points(counted: DataFrame) -> DataFrame:
    p, q = (counted.agg(e).toDF("n").scalar() for e in (F.sum("n1"), F.sum(F.col("n") - F.col("n1"))))
    return curve(counted).select("threshold", (F.col("fp") / q).alias("fpr"), (F.col("tp") / p).alias("tpr"))


def precision_recall_points(counted: DataFrame) -> DataFrame:
    p = counted.agg(F.sum("n1")).toDF("n").scalar()
    return curve(counted).select("threshold", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), (F.col("tp") / p).alias("recall"))


def average_precision(counted: DataFrame) -> DataFrame:
    points = curve(counted)
    total = F.sum("n1").cast("double")
    return points.agg((F.sum(F.col("n1") * F.col("tp") / (F.col("tp") + F.col("fp"))) / F.when(total > 0, total)).alias("average_precision"))


def brier_score(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    return scored.agg(F.avg(F.pow(F.col(score) - F.col(label), 2)).alias("brier_score"))


def _scores(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    return {"precision": safe_ratio(tp, tp + fp), "recall": safe_ratio(tp, tp + fn), "f1": safe_ratio(2 * tp, 2 * tp + fp + fn)}


def confusion(scored: DataFrame, threshold: float = 0.5, label: str = "label", score: str = "score") -> DataFrame:
    """Per class: true and false positives, false negatives, precision, recall, F1 and support."""
    said, truth = (F.col(score) >= threshold).cast("int"), F.col(label)
    count = lambda y, p: F.count_if((truth == y) & (said == p))
    cells = scored.agg(count(1, 1).alias("c11"), count(1, 0).alias("c10"), count(0, 1).alias("c01"), count(0, 0).alias("c00"))

    def row(cls: int, name: str, tp: str, fp: str, fn: str) -> DataFrame:
        tp, fp, fn = F.col(tp), F.col(fp), F.col(fn)
        return cells.select(F.lit(cls).alias("class"), F.lit(name).alias("class_name"), tp.alias("tp"), fp.alias("fp"), fn.alias("fn"),
                            *[c.alias(k) for k, c in _scores(tp, fp, fn).items()], (tp + fn).alias("support"))

    return row(0, "Not Completed", "c00", "c10", "c01").unionByName(row(1, "Completed", "c11", "c01", "c10"))


def threshold_sweep(scored: DataFrame, label: str = "label", score: str = "score", low: float = 0.10, step: float = 0.01, n: int = 81) -> DataFrame:
    """Precision, recall and F1 at each threshold. Scores fall into the gaps between thresholds in one pass."""
    thresholds = [low + i * step for i in range(n)]
    placed = ordered.with_range(scored.select(F.col(score).alias("s"), F.col(label).cast("long").alias("y")), "s", thresholds, "passed")
    bins = durable(placed.groupBy("passed").agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("q")))
    positives = bins.agg(F.sum("p")).toDF("n").scalar()
    grid = scored.sparkSession.createDataFrame([(i + 1, t) for i, t in enumerate(thresholds)], "passed int, threshold double")
    above = Window.orderBy(F.desc("passed"))
    filled = grid.join(bins, "passed", "full_outer").fillna(0, ["p", "q"])
    counted = filled.select("threshold", F.sum("p").over(above).alias("tp"), F.sum("q").over(above).alias("fp")).filter("threshold is not null")
    return counted.select("threshold", *[c.alias(k) for k, c in _scores(F.col("tp"), F.col("fp"), positives - F.col("tp")).items()])


def best_threshold(swept: DataFrame) -> DataFrame:
    """The first threshold with the largest F1."""
    return swept.agg(F.max_by(F.struct("threshold", "f1", "precision", "recall"), F.struct("f1", -F.col("threshold"))).alias("b")).select("b.*")


def logistic(**options) -> LogisticRegression:
    """Baseline: unit L2 penalty is set per fit, inputs are already standardised."""
    return LogisticRegression(**{"maxIter": 1000, "standardization": False, **options})


def random_forest(**options) -> RandomForestClassifier:
    return RandomForestClassifier(**{"numTrees": 100, "maxDepth": 10, "seed": 42, "subsamplingRate": 1.0, **options})


def boosting(**options) -> GBTClassifier:
    return GBTClassifier(**{"maxIter": 100, "maxDepth": 3, "stepSize": 0.1, "seed": 42, **options})


def weighted_boosting(**options) -> GBTClassifier:
    """Boosting with positives weighted by negatives over positives (see ``with_weights``)."""
    return GBTClassifier(**{"maxIter": 100, "maxDepth": 6, "stepSize": 0.3, "seed": 42, "weightCol": "weight", **options})


def with_weights(train: DataFrame, label: str) -> DataFrame:
    ratio = train.agg((F.count_if(F.col(label) == 0) / F.when(F.count_if(F.col(label) == 1) > 0, F.count_if(F.col(label) == 1)))).first()[0]
    return train.withColumn("weight", F.when(F.col(label) == 1, F.lit(ratio).cast("double")).otherwise(1.0))


def fit(estimator, train: DataFrame, columns: list[str], label: str, groups: tuple[str, ...] = ()) -> PipelineModel:
    """Assemble and fit; a logistic model without a penalty gets the equivalent of C = 1 and is found by Newton's method.

    ``groups``: keys that columns may follow (see ``newton``); they change the work, not the model."""
    estimator = estimator.copy({estimator.labelCol: label, estimator.featuresCol: "_v"})
    assembler = VectorAssembler(inputCols=columns, outputCol="_v")
    if isinstance(estimator, LogisticRegression) and not estimator.isSet("regParam"):
        if plain_logistic(estimator) and (found := newton.logistic(train, columns, label, estimator.getMaxIter(), groups=groups)):
            return PipelineModel([assembler, logistic_model(estimator, *found)])
        estimator = estimator.copy({estimator.regParam: 1.0 / max(1, train.count())})
    return Pipeline(stages=[assembler, estimator]).fit(train)


def plain_logistic(estimator) -> bool:
    """A logistic model, unweighted, with a constant, a squared penalty on the inputs as they are, and no bounds."""
    if not isinstance(estimator, LogisticRegression):
        return False
    given = {p.name for p in estimator.extractParamMap() if estimator.isSet(p)}
    return estimator.getFitIntercept() and not estimator.getStandardization() and given <= {"maxIter", "standardization", "labelCol", "featuresCol"}


def logistic_model(estimator: LogisticRegression, coefficients: np.ndarray, constant: float, penalty: float) -> LogisticRegressionModel:
    """Spark's model with the given coefficients and the parameters of ``estimator``."""
    sc = SparkSession.active().sparkContext
    java = sc._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(estimator.uid, _py2java(sc, Vectors.dense(coefficients)), constant)
    model = LogisticRegressionModel(java)
    set_ = {p.name: v for p, v in estimator.extractParamMap().items() if estimator.isSet(p)} | {"regParam": penalty}
    for name, value in set_.items():
        model.set(model.getParam(name), value)
    model._transfer_params_to_java()
    return model


def score(model: PipelineModel, df: DataFrame, label: str, keep=()) -> DataFrame:
    return model.transform(df).select(*keep, F.col(label).alias("label"), vector_to_array("probability")[1].alias("score"))


def evaluate(scored: DataFrame, name: str) -> DataFrame:
    """One comparison row: AUC, precision, recall, F1 at one half, average precision and Brier score."""
    counted = score_counts(scored)
    at_half = confusion(scored).filter("class = 1")
    return at_half.select(
        F.lit(name).alias("model"), roc_auc(counted).scalar().alias("auc_roc"), "precision", "recall", "f1",
        average_precision(counted).scalar().alias("average_precision"), brier_score(scored).scalar().alias("brier_score"))


def compare(estimators: dict[str, object], train: DataFrame, test: DataFrame, columns: list[str], label: str,
            fitted: dict[str, PipelineModel] | None = None) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Fit every estimator that is not in ``fitted`` and rank by AUC; also returns the fitted models. Training rows are stored only
    if there is a model to fit."""
    fitted = fitted or {}
    if any(not fitted.get(name) for name in estimators):
        train = durable(with_weights(train, label))
    models = {name: fitted.get(name) or fit(e, train, columns, label) for name, e in estimators.items()}
    rows = [evaluate(durable(score(m, test, label)), name) for name, m in models.items()]
    return ordered.union_all(rows).orderBy(F.desc("auc_roc"), "model"), models


def cross_validate(estimator, train: DataFrame, columns: list[str], label: str, key: str, folds: int = 5, grid: dict | None = None, parallelism: int = 4):
    """Stratified k-fold AUC: one row per parameter combination with mean and deviation, and the fitted validator.

    A logistic model without a penalty gets the equivalent of C = 1 on the rows of all folds but one, and without a grid its fits
    are found together by Newton's method.
    """
    folded = durable(stratified_folds(train, label, key, folds))
    if isinstance(estimator, LogisticRegression) and not estimator.isSet("regParam"):
        penalty = folds / max(1, (folds - 1) * folded.count())
        if not grid and plain_logistic(estimator) and (fitted := _logistic_folds(estimator, folded, columns, label, folds, penalty)):
            rows = [("default", float(fitted.avgMetrics[0]), float(fitted.stdMetrics[0]))]
            return train.sparkSession.createDataFrame(rows, "parameters string, cv_auc_mean double, cv_auc_std double"), fitted
        estimator = estimator.copy({estimator.regParam: penalty})
    estimator = estimator.copy({estimator.labelCol: label, estimator.featuresCol: "_v"})
    builder = ParamGridBuilder()
    for param, values in (grid or {}).items():
        builder = builder.addGrid(estimator.getParam(param), values)
    combinations = builder.build()
    validator = CrossValidator(
        estimator=Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="_v"), estimator]), estimatorParamMaps=combinations,
        evaluator=BinaryClassificationEvaluator(labelCol=label, numBins=0), numFolds=folds, foldCol="fold", parallelism=parallelism)
    fitted = validator.fit(folded)
    named = [", ".join(f"{p.name}={v}" for p, v in sorted(c.items(), key=lambda i: i[0].name)) or "default" for c in combinations]
    rows = [(n, float(m), float(s)) for n, m, s in zip(named, fitted.avgMetrics, fitted.stdMetrics)]
    return train.sparkSession.createDataFrame(rows, "parameters string, cv_auc_mean double, cv_auc_std double"), fitted


def _logistic_folds(estimator: LogisticRegression, folded: DataFrame, columns: list[str], label: str, folds: int, penalty: float) -> CrossValidatorModel | None:
    """What Spark's validator gives, from one packed table: a model without each fold, its area on that fold, and a model of all rows."""
    found = newton.logistic_folds(folded, columns, label, F.col("fold"), [newton.NO_FOLD, *range(folds)], estimator.getMaxIter(), penalty)
    if not found:
        return None
    estimator = estimator.copy({estimator.labelCol: label, estimator.featuresCol: "_v"})
    assembler = VectorAssembler(inputCols=columns, outputCol="_v")
    models = {f: PipelineModel([assembler, logistic_model(estimator, *v)]) for f, v in found.items()}
    evaluator = BinaryClassificationEvaluator(labelCol=label, numBins=0)
    areas = [evaluator.evaluate(models[f].transform(folded.filter(F.col("fold") == f))) for f in range(folds)]
    return CrossValidatorModel(models[newton.NO_FOLD], [float(np.mean(areas))], None, [float(np.std(areas))])


# The search grid of the boosted model
BOOSTING_GRID = {"trees": [100, 200], "depth": [4, 6, 8], "rate": [0.01, 0.1], "rows": [0.8, 1.0], "columns": [0.8, 1.0]}


def cross_validate_boosting(points: dict[str, Setting], train: DataFrame, columns: list[str], label: str, key: str, folds: int = 5,
                            weight: str | None = None, groups: tuple[str, ...] = ()) -> DataFrame:
    """Stratified k-fold AUC of boosted models, all points and folds grown in the same passes.

    Points that differ in their number of trees only are one fit, scored on the way. A fold of one class has no AUC and is left
    out of the mean, as is a point without any. ``groups``: keys that columns may follow (see ``boosting.fit_many``).
    """
    folded = durable(stratified_folds(train, label, key, folds))
    longest: dict[Setting, int] = {}
    for p in points.values():
        alike = p._replace(trees=0)
        longest[alike] = max(p.trees, longest.get(alike, 0))
    fits = [alike._replace(trees=n, fold=f) for alike, n in longest.items() for f in range(folds)]
    stages = {p.trees for p in points.values()}
    measure = lambda scored: roc_auc(score_counts(scored, ["model", "trees"]), ["model", "trees"])
    found = boosting_engine.fit_many(folded, columns, label, key, fits, stages, "fold", weight, measure, groups=groups)[2]
    areas: dict[Setting, list[float]] = {}
    for r in found:
        if r["auc_roc"] is not None:
            areas.setdefault(fits[r["model"]]._replace(trees=r["trees"], fold=-1), []).append(r["auc_roc"])
    rows = [(name, float(np.mean(a)), float(np.std(a))) for name, p in points.items() if (a := areas.get(p._replace(fold=-1)))]
    return train.sparkSession.createDataFrame(rows, "parameters string, cv_auc_mean double, cv_auc_std double")


def tune_boosting(train: DataFrame, columns: list[str], label: str, key: str, folds: int = 3, grid: dict | None = None,
                  groups: tuple[str, ...] = ()) -> DataFrame:
    """Cross-validated AUC of every point of a grid over the fields of ``Setting``."""
    grid = grid or BOOSTING_GRID
    chosen = [dict(zip(sorted(grid), values)) for values in product(*(grid[n] for n in sorted(grid)))]
    points = {", ".join(f"{n}={v}" for n, v in c.items()): Setting(**c) for c in chosen}
    return cross_validate_boosting(points, train, columns, label, key, folds, groups=groups)


def importances(model: PipelineModel, columns: list[str], spark) -> DataFrame:
    """Feature importances of a tree model, absolute coefficients of a linear one."""
    last = model.stages[-1]
    values = last.featureImportances.toArray() if hasattr(last, "featureImportances") else [abs(c) for c in last.coefficients.toArray()]
    rows = [(c, float(v)) for c, v in zip(columns, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def linear_attribution(df: DataFrame, coefficients: dict[str, float], keep=()) -> DataFrame:
    """Exact contribution of each feature to a linear score, relative to the average row."""
    fitted = column_stats(df, list(coefficients), mean=F.avg)
    return df.select(*keep, *[((F.col(c) - fitted[c]["mean"]) * float(w)).alias(c) for c, w in coefficients.items()])


def attribution_ranking(attributions: DataFrame, columns: list[str], top: int = 15) -> DataFrame:
    """Features by mean absolute contribution. Each column is averaged in its place, so rows are not unpivoted."""
    means = attributions.agg(F.count(F.lit(1)).alias("_n"), *[F.avg(F.abs(F.col(f"`{c}`").cast("double"))).alias(c) for c in columns]).filter("_n > 0")
    return ordered.unpivot(means, columns, metric="feature", value="mean_abs_attribution").orderBy(F.desc("mean_abs_attribution"), "feature").limit(top)


def attribution_summary(attributions: DataFrame, columns: list[str]) -> DataFrame:
    """Overall mean, deviation, largest and smallest absolute contribution."""
    size = F.abs("value")
    return ordered.unpivot(attributions, columns, metric="feature").agg(
        F.avg(size).alias("mean_abs"), F.stddev_pop(size).alias("std_abs"), F.max(size).alias("max_abs"), F.min(size).alias("min_abs"))


def stratified_sample(df: DataFrame, label: str, key: str, n: int = 1000, seed: int = 42) -> DataFrame:
    """About ``n`` rows in the proportions of the classes, repeatable."""
    total = df.agg(F.count(F.lit(1))).toDF("n").scalar()
    numbered = stratified_numbers(df, label, key, seed)
    return numbered.filter(F.col("class_position") <= F.round(F.col("class_rows") * n / total)).drop("class_position", "class_rows")


def permutation_importance(model: PipelineModel, df: DataFrame, columns: list[str], label: str, key: str, features: list[str] | None = None) -> DataFrame:
    """Loss of AUC when one feature's values move to other rows, for any model.

    Rows are numbered by a hash of their key; a permuted feature comes from the row half the table away. Tree models score all
    variants of a row side by side in one pass, others take a pass for each feature.
    """
    features = features or columns
    numbered = durable(stratified_numbers(df.withColumn("_all", F.lit(1)), "_all", key).drop("_all", "class_rows").withColumnRenamed("class_position", "_p"))
    rows = numbered.count()
    one_pass = isinstance(model.stages[-1], attribution.TREE_MODELS)
    moved = columns if one_pass else features
    donors = numbered.select(((F.col("_p") + rows // 2) % rows + 1).alias("_p"), *[F.col(c).alias(f"_new_{c}") for c in moved])
    paired = numbered.join(donors, "_p")
    if one_pass:
        scored = variant_scores(model, paired, columns, label).filter(F.col("feature").isin("(none)", *features))
    else:
        paired = durable(paired)
        frames = [score(model, paired, label).withColumn("feature", F.lit("(none)"))]
        for c in features:
            frames.append(score(model, paired.withColumn(c, F.col(f"_new_{c}")), label).withColumn("feature", F.lit(c)))
        scored = ordered.union_all(frames)
    areas = durable(roc_auc(score_counts(scored, ["feature"]), ["feature"]))
    base = areas.filter("feature = '(none)'").select("auc_roc").scalar()
    return areas.filter("feature <> '(none)'").select("feature", "auc_roc", (base - F.col("auc_roc")).alias("importance"))


def variant_scores(model: PipelineModel, paired: DataFrame, columns: list[str], label: str) -> DataFrame:
    """(feature, label, score) of each row as it is, feature "(none)", and with each feature taken from its ``_new_`` column.

    Scores are rounded to ten places, so that sums taken in another order still tie.
    """
    trees = attribution.tree_nodes(model, paired.sparkSession)
    rows = paired.select(F.col(label).alias("label"), attribution.values_of(columns).alias("_x"), attribution.values_of(columns, "_new_").alias("_new"))
    found = attribution.per_row(rows, ["_x", "_new"], lambda x, new: np.round(attribution.variants(trees, x, new), 10) + 0.0, "_scores")
    names = F.array(*[F.lit(c) for c in ["(none)", *columns]])
    return found.select("label", F.posexplode("_scores").alias("_at", "score")).select(F.get(names, F.col("_at")).alias("feature"), "label", "score")


def attribution_check(model: PipelineModel, df: DataFrame, columns: list[str], tolerance: float = 1e-6) -> DataFrame:
    """Rows, and rows whose attributions and base value do not add up to the value Spark's model gives."""
    boosted = isinstance(model.stages[-1], GBTClassificationModel)
    value = vector_to_array("rawPrediction" if boosted else "probability")[1]
    parts = attribution.tree_attribution(model, model.transform(df).withColumn("_value", value), columns, ["_value"])
    total = sum((F.col(f"`{c}`") for c in columns), F.col("base_value"))
    return parts.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~(F.abs(total - F.col("_value")) <= tolerance)).alias("n_off"))
