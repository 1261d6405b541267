"""Segmentation: k-means, quality of a labelling, choice of k, stability, profiles and names."""

import math

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import ordered
from ..functions.constants import GENDERS, PROFILE_METRICS, SEGMENT_NAMES
from ..functions.scalars import column_stats
from ..functions.scale import durable
from . import kmeans


def as_array(df: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    return df.select(*keep, F.array(*[F.col(c).cast("double") for c in columns]).alias("features"))


def squared_distance(a, b) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def cluster_summaries(points: DataFrame, label: str = "cluster") -> DataFrame:
    """Size, centroid and mean squared norm per cluster, from one map-side combined aggregation."""
    vectors = points.withColumn("_v", array_to_vector("features")).withColumn("_q", dot("features", "features"))
    summary = vectors.groupBy(label).agg(Summarizer.mean(F.col("_v")).alias("m"), F.count(F.lit(1)).alias("n"), F.avg("_q").alias("q"))
    return summary.select(label, "n", vector_to_array("m").alias("centroid"), "q")


def _collected(summaries: DataFrame, label: str = "cluster") -> Column:
    """All cluster rows (as many as clusters) as one array-valued scalar."""
    row = F.struct(F.col(label).alias("cluster"), *[c for c in summaries.columns if c != label])
    return summaries.agg(F.array_sort(F.collect_list(row)).alias("clusters")).scalar()


def assign_nearest(points: DataFrame, centres: DataFrame, label: str = "cluster") -> DataFrame:
    """Nearest given centre of each point (ties: lowest cluster) and the squared distance to it."""
    placed = points.withColumn("_centres", _collected(centres.select(label, "centroid"), label))
    scored = F.transform("_centres", lambda c: F.struct(
        squared_distance(F.col("features"), c["centroid"]).alias("d"), c["cluster"].alias("cluster")))
    best = placed.withColumn("_best", F.array_min(scored))
    return best.withColumn(label, F.col("_best.cluster")).withColumn("squared_distance", F.col("_best.d")).drop("_best", "_centres")


def labelling_quality(points: DataFrame, label: str = "cluster") -> DataFrame:
    """WCSS, Calinski-Harabasz, Davies-Bouldin and squared-Euclidean silhouette of a labelling in one row.

    Everything follows from sizes, centroids and mean squared norms per cluster, so the cost is linear in rows.
    """
    stored = durable(cluster_summaries(points, label))
    clusters = _collected(stored, label)
    own = F.filter(F.col("_c"), lambda c: c["cluster"] == F.col(label))[0]
    norm = dot("features", "features")
    to = lambda c: norm - 2 * dot("features", c["centroid"]) + c["q"]
    others = F.array_min(F.transform(F.filter(F.col("_c"), lambda c: c["cluster"] != F.col(label)), lambda c: to(c)))
    placed = points.withColumn("_c", clusters).withColumn("_own", own).withColumn("d2", squared_distance("features", F.col("_own.centroid")))
    scored = placed.withColumns({"a": to(F.col("_own")) * F.col("_own.n") / F.when(F.col("_own.n") > 1, F.col("_own.n") - 1), "b": others})
    silhouette = F.when(F.col("a").isNull(), 0.0).otherwise(
        F.coalesce((F.col("b") - F.col("a")) / F.when(F.greatest("a", "b") > 0, F.greatest("a", "b")), F.lit(0.0)))
    per_cluster = scored.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"), F.sum("d2").alias("w"), F.avg(F.sqrt("d2")).alias("scatter"), F.sum(silhouette).alias("s"))
    stats = durable(per_cluster.join(stored.select(label, "centroid"), label))
    size = stats.agg(F.sum("n")).toDF("n").scalar()
    axes = stats.select(F.posexplode("centroid").alias("i", "x"), "n").groupBy("i").agg((F.sum(F.col("x") * F.col("n")) / F.sum("n")).alias("x"))
    centre = axes.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda g: g["x"]).alias("g")).scalar()
    beside = stats.withColumn("_all", _collected(stats.select(label, "scatter", "centroid"), label)).withColumn("_centre", centre)
    ratio = F.array_max(F.transform(F.filter("_all", lambda o: o["cluster"] != F.col(label)), lambda o: (
        F.col("scatter") + o["scatter"]) / F.sqrt(squared_distance(F.col("centroid"), o["centroid"]))))
    rows = beside.select("n", "w", "s", (F.col("n") * squared_distance("centroid", "_centre")).alias("between"), ratio.alias("r"))
    total = rows.agg(F.count(F.lit(1)).alias("k"), F.sum("w").alias("wcss"), F.sum("between").alias("b"), F.avg("r").alias("davies_bouldin"), F.sum("s").alias("s"))
    k = F.col("k")
    return total.select(
        k, "wcss", ((F.col("b") / (k - 1)) / (F.col("wcss") / (size - k))).alias("calinski_harabasz"), "davies_bouldin",
        (F.col("s") / size).alias("silhouette_squared"))


#: Blocks that the points of a Euclidean silhouette are dealt into, and the most rows of one.
SILHOUETTE_BLOCKS = 16
SILHOUETTE_BLOCK_ROWS = 100_000


def silhouette_euclidean(points: DataFrame, key: str, label: str = "cluster", block_rows: int = 2_000) -> DataFrame:
    """Exact mean silhouette with plain Euclidean distance.

    The definition needs every pairwise distance. Points are dealt into a fixed number of blocks (more only where one would pass
    ``SILHOUETTE_BLOCK_ROWS``), so each point is sent the same number of times whatever the table. Each pair of blocks is one
    task, which holds the distances of ``block_rows`` by ``block_rows`` points at a time and returns sums per point and cluster.
    The work still grows with the square of the rows: for large tables use ``labelling_quality``.
    """
    import numpy as np
    import pandas as pd

    rows = points.count()
    blocks = 1 if rows <= block_rows else max(SILHOUETTE_BLOCKS, math.ceil(rows / SILHOUETTE_BLOCK_ROWS))
    dealt = points.select(F.col(key).alias("k"), F.col(label).cast("long").alias("c"), "features",
                          F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias("own"))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = dealt.withColumn("i", F.col("own")).withColumn("j", every)
    right = dealt.withColumn("j", F.col("own")).withColumn("i", every)

    def sums(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"k": [], "c": [], "other": [], "s": [], "n": []})
        x, y, ka, kb = np.stack(a["features"]), np.stack(b["features"]), a["k"].to_numpy(), b["k"].to_numpy()
        clusters = np.unique(b["c"])
        member = (b["c"].to_numpy()[:, None] == clusters[None]).astype(np.float64)
        total = np.zeros((len(x), len(clusters)))
        for i in range(0, len(x), block_rows):
            for j in range(0, len(y), block_rows):
                p, q = x[i:i + block_rows], y[j:j + block_rows]
                d = np.sqrt(np.maximum((p * p).sum(1)[:, None] + (q * q).sum(1)[None] - 2 * p @ q.T, 0))
                d[ka[i:i + block_rows, None] == kb[None, j:j + block_rows]] = 0.0
                total[i:i + block_rows] += d @ member[j:j + block_rows]
        return pd.concat([pd.DataFrame({"k": a["k"], "c": a["c"], "other": other, "s": total[:, at], "n": int(member[:, at].sum())})
                          for at, other in enumerate(clusters)])

    kind = points.schema[key].dataType.simpleString()
    partial = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInPandas(sums, f"k {kind}, c long, other long, s double, n long")
    per_point = partial.groupBy("k", "c", "other").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    mine = F.col("c") == F.col("other")
    ab = per_point.groupBy("k", "c").agg(
        F.max(F.when(mine, F.col("s") / F.when(F.col("n") > 1, F.col("n") - 1))).alias("a"), F.min(F.when(~mine, F.col("s") / F.col("n"))).alias("b"))
    value = F.when(F.col("a").isNull(), 0.0).otherwise((F.col("b") - F.col("a")) / F.greatest("a", "b"))
    return ab.agg(F.avg(value).alias("silhouette"), F.count(F.lit(1)).alias("n"))


def fit_kmeans(points: DataFrame, k: int, seeds=tuple(range(10)), max_iter: int = 300, tol: float = 0.01) -> kmeans.Fit:
    """Best of several starts, all advanced in the same passes.

    A start ends when no centre moves by more than ``tol``, one hundredth of a standard deviation on scaled data.
    """
    fits = kmeans.fit_many(points, [(kmeans.POINTS, k, s) for s in seeds], max_iter, tol)
    return kmeans.best(fits)[kmeans.POINTS, k]


def predict(model: kmeans.Fit, points: DataFrame, name: str = "cluster") -> DataFrame:
    """``points`` with the number of the nearest centre (ties: the lowest)."""
    found = F.array(*[F.struct(squared_distance("features", F.array(*[F.lit(float(x)) for x in c])).alias("d"), F.lit(i).alias("i"))
                      for i, c in enumerate(model.centres)])
    return points.withColumn(name, F.array_min(found)["i"])


def centres(model: kmeans.Fit, spark) -> DataFrame:
    return spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.centres)], "cluster int, centroid array<double>")


def sweep(points: DataFrame, max_k: int = 15, seeds=tuple(range(10))) -> DataFrame:
    """Quality of the best k-means labelling for each k from 2 to ``max_k``; all starts of all k share their passes."""
    ks = range(2, max_k + 1)
    found = kmeans.best(kmeans.fit_many(points, [(kmeans.POINTS, k, s) for k in ks for s in seeds]))
    return ordered.union_all([labelling_quality(predict(found[kmeans.POINTS, k], points)) for k in ks])


def elbow(curve: DataFrame) -> DataFrame:
    """k at the largest second difference of WCSS (a handful of rows, one per k)."""
    order = Window.orderBy("k")
    bend = F.lead("wcss").over(order) - 2 * F.col("wcss") + F.lag("wcss").over(order)
    bent = curve.select("k", bend.alias("bend")).filter("bend is not null")
    return bent.agg(F.max_by("k", F.struct("bend", -F.col("k"))).alias("optimal_k_elbow"))


def best_k(curve: DataFrame) -> DataFrame:
    """Best k by each index; the smallest k wins ties."""
    top = lambda c, sign: F.max_by("k", F.struct(sign * F.col(c), -F.col("k")))
    picks = curve.agg(top("silhouette_squared", 1).alias("optimal_k_silhouette"), top("davies_bouldin", -1).alias("optimal_k_db"),
                      top("calinski_harabasz", 1).alias("optimal_k_ch"))
    return picks.withColumn("optimal_k_elbow", elbow(curve).scalar())


def gap_statistic(points: DataFrame, max_k: int = 15, references: int = 10, seeds=tuple(range(10)), seed: int = 42) -> DataFrame:
    """Gap of log WCSS against uniform reference tables of the same size and range, with its standard error.

    All models of all tables advance in the same passes; reference rows are drawn where they are used.
    """
    ks = range(2, max_k + 1)
    wanted = [(t, k, s) for t in (kmeans.POINTS, *range(references)) for k in ks for s in seeds]
    found = kmeans.best(kmeans.fit_many(points, wanted, seed=seed))
    rows = []
    for k in ks:
        logs = [math.log(found[b, k].cost) for b in range(references)]
        mean = sum(logs) / len(logs)
        deviation = math.sqrt(sum((v - mean) ** 2 for v in logs) / len(logs))
        rows.append((k, mean - math.log(found[kmeans.POINTS, k].cost), math.sqrt(1 + 1 / len(logs)) * deviation))
    return points.sparkSession.createDataFrame(rows, "k int, gap double, standard_error double")


def gap_choice(gaps: DataFrame) -> DataFrame:
    """Smallest k whose gap reaches the next gap less its standard error; the first k where none does."""
    order = Window.orderBy("k")
    ahead = gaps.select("k", (F.col("gap") >= F.lead("gap").over(order) - F.lead("standard_error").over(order)).alias("ok"))
    return ahead.agg(F.coalesce(F.min(F.when(F.col("ok"), F.col("k"))), F.min("k")).alias("optimal_k_gap"))


def _comb2(n) -> Column:
    n = n.cast("double")
    return n * (n - 1) / 2


def adjusted_rand(labels: DataFrame, columns: list[str]) -> DataFrame:
    """Adjusted Rand index of each pair of label columns: (column_a, column_b, ari)."""
    pairs = [F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
             for i, a in enumerate(columns) for b in columns[i + 1:]]
    cells = durable(labels.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").groupBy("column_a", "column_b", "a", "b").agg(F.count(F.lit(1)).alias("n")))
    key = ["column_a", "column_b"]

    def marginal(side: str) -> DataFrame:
        sizes = cells.groupBy(*key, side).agg(F.sum("n").alias("m"))
        return sizes.groupBy(*key).agg(F.sum(_comb2(F.col("m"))).alias(f"s_{side}"))

    joint = cells.groupBy(*key).agg(F.sum(_comb2(F.col("n"))).alias("s"), F.sum("n").alias("n"))
    joined = joint.join(marginal("a"), key).join(marginal("b"), key)
    expected = F.col("s_a") * F.col("s_b") / F.when(F.col("n") > 1, _comb2(F.col("n")))
    room = (F.col("s_a") + F.col("s_b")) / 2 - expected
    return joined.select(*key, F.when(room != 0, (F.col("s") - expected) / room).otherwise(1.0).alias("ari"))


def stability(points: DataFrame, key: str, k: int, seeds=(42, 123, 456, 789, 2024), starts: int = 10) -> DataFrame:
    """Agreement of k-means labellings from different seeds, with a verdict."""
    fits = kmeans.fit_many(points, [(kmeans.POINTS, k, s + i) for s in seeds for i in range(starts)])
    labels = points
    for n, s in enumerate(seeds):
        labels = predict(kmeans.best(fits[n * starts:(n + 1) * starts])[kmeans.POINTS, k], labels, f"seed_{s}")
    return stability_summary(adjusted_rand(labels, [f"seed_{s}" for s in seeds]))


def stability_summary(pairs: DataFrame) -> DataFrame:
    mean = F.col("mean_ari")
    verdict = (F.when(mean >= 0.9, "highly stable").when(mean >= 0.75, "moderately stable").when(mean >= 0.5, "marginal").otherwise("low"))
    return pairs.agg(F.avg("ari").alias("mean_ari"), F.stddev_pop("ari").alias("std_ari"), F.min("ari").alias("min_ari")).withColumn("stability", verdict)


def cluster_sizes(labels: DataFrame, label: str = "cluster") -> DataFrame:
    total = labels.agg(F.count(F.lit(1))).toDF("n").scalar()
    return labels.groupBy(label).agg(F.count(F.lit(1)).alias("size")).withColumn("share", F.col("size") / total)


def cluster_profiles(features: DataFrame, metrics=PROFILE_METRICS, label: str = "cluster") -> DataFrame:
    """Size, mean and exact median of each metric, and gender shares per cluster."""
    metrics = [m for m in metrics if m in features.columns]
    share = [F.avg((F.col("gender") == g).cast("int")).alias(f"gender_{g}_pct") for g in GENDERS] if "gender" in features.columns else []
    means = features.groupBy(label).agg(F.count(F.lit(1)).alias("size"), *[F.avg(m).alias(f"{m}_mean") for m in metrics], *share)
    middle = ordered.exact_quantiles(features, metrics, {"median": 0.5}, [label]).groupBy(label).agg(
        *[F.max(F.when(F.col("metric") == m, F.col("median"))).alias(f"{m}_median") for m in metrics])
    return means.join(middle, label)


def distinguishing_features(scaled: DataFrame, columns: list[str], label: str = "cluster", top: int = 5) -> DataFrame:
    """The columns whose cluster mean lies furthest from the overall mean, ``top`` per cluster."""
    sums = durable(ordered.unpivot(scaled, columns, [label]).groupBy(label, "metric").agg(F.sum("value").alias("s"), F.count("value").alias("n")))
    overall = sums.groupBy("metric").agg((F.sum("s") / F.sum("n")).alias("global_mean"))
    gaps = sums.join(overall, "metric").select(
        label, "metric", (F.col("s") / F.col("n")).alias("cluster_mean"), "global_mean", (F.col("s") / F.col("n") - F.col("global_mean")).alias("difference"))
    order = Window.partitionBy(label).orderBy(F.desc(F.round(F.abs("difference"), 9)), "metric")
    return gaps.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= top)


def business_metrics(features: DataFrame, reward_cost: str | None = None, label: str = "cluster") -> DataFrame:
    """Revenue, reward cost, return on offers (999 without cost) and the published churn proxy per cluster."""
    total = features.agg(F.count(F.lit(1))).toDF("n").scalar()
    cost = F.avg(reward_cost) if reward_cost else F.lit(0.0)
    stats = features.groupBy(label).agg(
        F.count(F.lit(1)).alias("size"), F.avg("trans_total").alias("revenue_per_customer"), cost.alias("reward_cost_per_customer"),
        F.avg("view_rate").alias("avg_view_rate"), F.avg("completion_rate").alias("avg_completion_rate"), F.avg("trans_count").alias("avg_trans_count"))
    engaged = (F.col("avg_view_rate") + F.col("avg_completion_rate") + F.col("avg_trans_count")) / 3
    return stats.withColumns({
        "pct_of_total": F.col("size") / total,
        "offer_roi": F.when(F.col("reward_cost_per_customer") > 0, F.col("revenue_per_customer") / F.col("reward_cost_per_customer")).otherwise(999.0),
        "churn_risk_proxy": F.greatest(F.lit(0.0), 1 - engaged)})


def best_clusters(metrics: DataFrame, label: str = "cluster") -> DataFrame:
    top = lambda c: F.max_by(label, F.struct(F.col(c), -F.col(label)))
    return metrics.agg(top("revenue_per_customer").alias("best_revenue_cluster"), top("offer_roi").alias("best_roi_cluster"),
                       top("churn_risk_proxy").alias("highest_churn_cluster"))


def name_segments(profiles: DataFrame, label: str = "cluster") -> DataFrame:
    """Segment type and name from rules against the medians across clusters; a type used before becomes moderate."""
    m = lambda c: F.col(f"{c}_mean")
    profiles = durable(profiles)  # one row per segment
    ruled = ("trans_total", "completion_rate", "income_imputed", "tenure_months")
    middle = profiles.agg(*[F.median(f"{c}_mean").alias(c) for c in ruled]).first()
    low_spend = m("trans_total") <= middle["trans_total"]
    kind = (F.when((m("trans_total") > middle["trans_total"]) & (m("completion_rate") > middle["completion_rate"]), "high_value_loyalist")
            .when((m("completion_rate") < 0.30) | (m("view_rate") < 0.40), "low_engagement")
            .when((m("bogo_completion_rate") > m("discount_completion_rate")) & (m("bogo_completion_rate") > 0.50), "bogo_responder")
            .when((m("discount_completion_rate") > m("bogo_completion_rate")) & (m("discount_completion_rate") > 0.50), "discount_seeker")
            .when((m("income_imputed") > middle["income_imputed"]) & low_spend, "high_income_casual")
            .when((m("tenure_months") > middle["tenure_months"]) & low_spend, "tenured_conservative").otherwise("moderate_spender"))
    typed = profiles.select(label, "size", kind.alias("kind"))
    again = F.row_number().over(Window.partitionBy("kind").orderBy(label)) > 1
    named = typed.withColumn("segment_type", F.when(again, "moderate_spender").otherwise(F.col("kind")))
    names = F.create_map(*[F.lit(x) for pair in SEGMENT_NAMES.items() for x in pair])
    return named.select(label, "size", "segment_type", names[F.col("segment_type")].alias("segment_name"))


def principal_components(df: DataFrame, columns: list[str], keep: list[str], k: int = 2) -> tuple[DataFrame, list[float]]:
    """Projection on the first k components of the centred columns and their shares of variance.

    Each component's sign makes its largest loading positive.
    """
    fitted = column_stats(df, columns, mean=F.avg)
    centred = df.select(*keep, *[(F.col(c) - fitted[c]["mean"]).alias(c) for c in columns])
    vectors = durable(VectorAssembler(inputCols=columns, outputCol="v").transform(centred).select(*keep, "v"))
    model = PCA(k=k, inputCol="v", outputCol="p").fit(vectors)
    loadings = model.pc.toArray()
    signs = [1.0 if max(loadings[:, i], key=abs) >= 0 else -1.0 for i in range(k)]
    projected = model.transform(vectors).withColumn("p", vector_to_array("p"))
    return projected.select(*keep, *[(F.col("p")[i] * signs[i]).alias(f"pc{i + 1}") for i in range(k)]), list(model.explainedVariance.toArray())
