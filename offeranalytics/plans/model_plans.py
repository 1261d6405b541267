"""Completion models on customer-offer pairs and evaluation of given scores."""

from pyspark.sql import functions as F

from ..functions.scale import durable
from ..operators import certificates, features as ft, models as md
from .feature_plans import LABELS
from .registry import Inputs, query

RANKED = "SELECT *, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 rk FROM scored"
AUC = f"""
SELECT (sum(rk) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2) / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)) auc_roc FROM ({RANKED})"""
POINTS = """
SELECT score threshold, sum(p) OVER (ORDER BY score DESC) tp, sum(q) OVER (ORDER BY score DESC) fp, sum(p) OVER () pp, sum(q) OVER () qq, p
FROM (SELECT score, count(*) FILTER (label = 1) p, count(*) FILTER (label = 0) q FROM scored GROUP BY score)"""


@query("m07_roc_auc", AUC, doubles="auc_roc")
def auc(d: Inputs):
    return md.roc_auc(md.score_counts(d.scored))


@query("v03_roc_points", f"SELECT threshold, fp / qq fpr, tp / pp tpr FROM ({POINTS})", doubles="fpr tpr")
def roc(d: Inputs):
    return md.roc_points(md.score_counts(d.scored))


@query("v04_precision_recall_points", f"SELECT threshold, tp / (tp + fp) AS precision, tp / pp recall FROM ({POINTS})", doubles="precision recall")
def precision_recall(d: Inputs):
    return md.precision_recall_points(md.score_counts(d.scored))


@query("m11_average_precision", f"SELECT sum(p * tp / (tp + fp)) / max(pp) average_precision FROM ({POINTS})", doubles="average_precision")
def average_precision(d: Inputs):
    return md.average_precision(md.score_counts(d.scored))


@query("m10_brier_score", "SELECT avg(pow(score - label, 2)) brier_score FROM scored", doubles="brier_score")
def brier(d: Inputs):
    return md.brier_score(d.scored)


@query("m08_confusion", """
SELECT CAST(c AS INT) AS class, CASE WHEN c = 1 THEN 'Completed' ELSE 'Not Completed' END class_name, tp, fp, fn, tp / (tp + fp) AS precision, tp / (tp + fn) recall,
       2 * tp / (2 * tp + fp + fn) f1, tp + fn support FROM (
SELECT c, count(*) FILTER (label = c AND said = c) tp, count(*) FILTER (label <> c AND said = c) fp, count(*) FILTER (label = c AND said <> c) fn
FROM (SELECT label, CAST(score >= 0.5 AS INT) said FROM scored) CROSS JOIN (VALUES (0), (1)) k(c) GROUP BY c)""", doubles="precision recall f1")
def confusion(d: Inputs):
    return md.confusion(d.scored)


SWEEP = """
SELECT t threshold, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision, CASE WHEN pp > 0 THEN tp / pp ELSE 0 END recall,
       CASE WHEN tp + fp + pp > 0 THEN 2 * tp / (tp + fp + pp) ELSE 0 END f1 FROM (
SELECT t, count(*) FILTER (label = 1 AND score >= t) tp, count(*) FILTER (label = 0 AND score >= t) fp, count(*) FILTER (label = 1) pp
FROM scored CROSS JOIN (SELECT CAST(0.1 AS DOUBLE) + i * CAST(0.01 AS DOUBLE) t FROM range(0, 81) r(i)) GROUP BY t)"""


@query("m09_threshold_sweep", SWEEP, doubles="threshold precision recall f1")
def thresholds(d: Inputs):
    return md.threshold_sweep(d.scored)


@query("m09_best_threshold", f"SELECT threshold, f1, precision, recall FROM ({SWEEP}) ORDER BY f1 DESC, threshold LIMIT 1", doubles="threshold f1 precision recall")
def best_threshold(d: Inputs):
    return md.best_threshold(md.threshold_sweep(d.scored))


COEFFICIENTS = {"l_quantity": 0.02, "l_extendedprice": -0.00001, "l_discount": 3.0, "l_tax": -1.5}
LINE_COEFFICIENTS = list(COEFFICIENTS)
PARTS = " UNION ALL ".join(
    f"SELECT '{c}' feature, {w}::DOUBLE * ({c} - avg({c}) OVER ()) v FROM lineitem" for c, w in COEFFICIENTS.items())


@query("m14_attribution_ranking", f"SELECT feature, avg(abs(v)) mean_abs_attribution FROM ({PARTS}) GROUP BY feature ORDER BY 2 DESC LIMIT 15", doubles="mean_abs_attribution")
def ranking(d: Inputs):
    return md.attribution_ranking(md.linear_attribution(d.table("lineitem"), COEFFICIENTS), LINE_COEFFICIENTS)


@query("m14_attribution_summary", f"SELECT avg(abs(v)) mean_abs, stddev_pop(abs(v)) std_abs, max(abs(v)) max_abs, min(abs(v)) min_abs FROM ({PARTS})",
       doubles="mean_abs std_abs max_abs min_abs")
def attribution_summary(d: Inputs):
    return md.attribution_summary(md.linear_attribution(d.table("lineitem"), COEFFICIENTS), LINE_COEFFICIENTS)


@query("m15_stratified_sample", """
SELECT row_id, label FROM (SELECT row_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(concat(CAST(row_id AS VARCHAR), ':42'))) p, count(*) OVER (PARTITION BY label) n,
       count(*) OVER () t FROM scored) WHERE p <= round(n * 1000 / t)""")
def sample(d: Inputs):
    return md.stratified_sample(d.scored.select("row_id", "label"), "label", "row_id")


_STORED: dict[tuple, object] = {}


def _modelling(d: Inputs):
    """Train and test rows of the pair table with its standardised inputs, made once per session and folder.

    Stored are the customer rows and the figures of the split; each pass forms the wide pair table anew from them. What takes many
    passes stores its own part (``_weighted_train``, ``_stored_test``).
    """
    key = (d.spark.sparkContext.applicationId, d.sf_dir)
    if key not in _STORED:
        _STORED[key] = _build_modelling(d)
    return _STORED[key]


def _build_modelling(d: Inputs):
    pairs = ft.interaction_features(d.features, d.events, d.portfolio, store=True)
    matrix = ft.model_matrix(pairs).withColumn("pair", F.concat_ws(":", "customer_id", "offer_id"))
    rows = ft.stratified_split(matrix, "completed", "pair")
    columns = [c for c in rows.columns if c not in ("customer_id", "offer_id", "completed", "pair", "is_test")]
    return rows.filter("is_test = 0"), rows.filter("is_test = 1"), columns


ESTIMATORS = {"Logistic Regression (Baseline)": md.logistic, "Random Forest": md.random_forest, "Gradient Boosting": md.boosting,
              "Weighted Boosting": md.weighted_boosting}
PAIR_KEYS = ("customer_id", "offer_id")
_FITTED: dict[tuple[str, str, str], object] = {}


def _weighted_train(d: Inputs):
    """The training rows with their weights, stored for the tree models, which Spark's learners read several times each."""
    key = (d.spark.sparkContext.applicationId, d.sf_dir, "train")
    if key not in _STORED:
        _STORED[key] = durable(md.with_weights(_modelling(d)[0], "completed"))
    return _STORED[key]


def _stored_test(d: Inputs):
    """The test rows, stored where all models score them."""
    key = (d.spark.sparkContext.applicationId, d.sf_dir, "test")
    if key not in _STORED:
        _STORED[key] = durable(_modelling(d)[1])
    return _STORED[key]


def _fitted(d: Inputs, name: str):
    """The model with its full settings, fitted once per session and folder. The logistic model reads its rows once."""
    key = (d.spark.sparkContext.applicationId, d.sf_dir, name)
    if key not in _FITTED:
        train, _, columns = _modelling(d)
        estimator = ESTIMATORS[name]()
        rows = train if md.plain_logistic(estimator) else _weighted_train(d)
        _FITTED[key] = md.fit(estimator, rows, columns, "completed", PAIR_KEYS)
    return _FITTED[key]


def _row(d: Inputs, name: str):
    _, test, _ = _modelling(d)
    return md.evaluate(durable(md.score(_fitted(d, name), test, "completed")), name)


@query("f02_model_matrix_columns", f"SELECT count(*) n_rows, CAST(sum(completed) AS BIGINT) n_positive, CAST(69 AS INT) n_features FROM ({LABELS})")
def matrix_columns(d: Inputs):
    pairs = ft.interaction_features(d.features, d.events, d.portfolio)
    counted = pairs.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("completed").alias("n_positive"))
    return counted.withColumn("n_features", F.lit(len(ft.numeric_features(pairs))))


@query("m01_logistic")
def logistic(d: Inputs):
    return _row(d, "Logistic Regression (Baseline)")


@query("m02_random_forest")
def forest(d: Inputs):
    return _row(d, "Random Forest")


@query("m03_gradient_boosting")
def boosting(d: Inputs):
    return _row(d, "Gradient Boosting")


@query("m04_weighted_boosting")
def weighted(d: Inputs):
    return _row(d, "Weighted Boosting")


BOOSTED = {"Gradient Boosting": md.Setting(trees=100, depth=3, rate=0.1), "Weighted Boosting": md.Setting(trees=100, depth=6, rate=0.3, weighted=True)}


@query("m05_cross_validation")
def cross_validation(d: Inputs):
    """The two boosted models of all folds grow together; the forest and the logistic model are fitted fold by fold."""
    train, _, columns = _modelling(d)
    weighted_rows = md.with_weights(train, "completed")
    rows = [md.cross_validate(e(), weighted_rows, columns, "completed", "pair")[0].select(F.lit(n).alias("model"), "*")
            for n, e in ESTIMATORS.items() if n not in BOOSTED]
    boosted = md.cross_validate_boosting(BOOSTED, weighted_rows, columns, "completed", "pair", weight="weight", groups=PAIR_KEYS)
    return md.ordered.union_all([*rows, boosted.select(F.col("parameters").alias("model"), F.lit("default").alias("parameters"), "cv_auc_mean", "cv_auc_std")])


@query("m06_grid_search")
def grid(d: Inputs):
    train, _, columns = _modelling(d)
    return md.tune_boosting(train, columns, "completed", "pair", groups=PAIR_KEYS)


@query("m12_model_comparison")
def comparison(d: Inputs):
    train, _, columns = _modelling(d)
    return md.compare({n: e() for n, e in ESTIMATORS.items()}, train, _stored_test(d), columns, "completed", {n: _fitted(d, n) for n in ESTIMATORS})[0]


@query("m13_feature_importance")
def importance(d: Inputs):
    return md.importances(_fitted(d, "Random Forest"), _modelling(d)[2], d.spark)


@query("m15_permutation_importance")
def permutation(d: Inputs):
    _, test, columns = _modelling(d)
    return md.permutation_importance(_fitted(d, "Random Forest"), test, columns, "completed", "pair")


SPLIT_COUNTS = f"""
SELECT CAST(sum(n - test) AS BIGINT) n_train, CAST(sum(n - test) FILTER (completed = 1) AS BIGINT) n_train_positive, CAST(sum(test) AS BIGINT) n_test
FROM (SELECT completed, count(*) n, round(count(*) * CAST(0.2 AS DOUBLE)) test FROM ({LABELS}) GROUP BY completed)"""


@query("m01_logistic_check", f"SELECT n_train n_rows, n_train_positive n_positive, TRUE is_optimal FROM ({SPLIT_COUNTS})")
def logistic_check(d: Inputs):
    """No coefficient of the baseline model can be moved to lower its penalised loss over the training rows."""
    train, _, columns = _modelling(d)
    found = certificates.logistic_slope(_fitted(d, "Logistic Regression (Baseline)"), train, columns, "completed")
    return found.select("n_rows", "n_positive", (F.col("slope") < 1e-3).alias("is_optimal"))


@query("m12_comparison_check", f"""
SELECT model, n_test n_rows, TRUE agrees, TRUE beats_chance FROM ({SPLIT_COUNTS}) CROSS JOIN (VALUES {", ".join(f"('{n}')" for n in ESTIMATORS)}) m(model)""")
def comparison_check(d: Inputs):
    """The area under the curve of every model over all test rows, the library's against Spark's evaluator."""
    found = certificates.area_agreement({n: _fitted(d, n) for n in ESTIMATORS}, _stored_test(d), "completed")
    return found.select("model", "n_rows", (F.abs(F.col("auc_roc") - F.col("auc_spark")) < 1e-9).alias("agrees"), (F.col("auc_roc") > 0.5).alias("beats_chance"))


@query("m15_tree_attribution")
def tree_attribution(d: Inputs):
    """Features of the boosted model by mean absolute Shapley value over all test rows."""
    _, test, columns = _modelling(d)
    parts = md.attribution.tree_attribution(_fitted(d, "Gradient Boosting"), test, columns)
    return md.attribution_ranking(parts, columns, len(columns))


@query("m15_attribution_check", f"SELECT n_test n_rows, CAST(0 AS BIGINT) n_off FROM ({SPLIT_COUNTS})")
def attribution_check(d: Inputs):
    """Shapley values of all test rows add up to the boosted model's margin."""
    _, test, columns = _modelling(d)
    return md.attribution_check(_fitted(d, "Gradient Boosting"), test, columns)
