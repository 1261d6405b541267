"""Segmentation over the embedding table (given labels) and over customer features."""

from pyspark.sql import functions as F

from ..functions.constants import PROFILE_METRICS
from ..functions.scale import durable
from ..operators import certificates, charts, features as ft, segments as sg
from .registry import Inputs, query

POINTS = "SELECT vec_id, label, CAST(embedding AS DOUBLE[]) e FROM embeddings"
CELLS = f"SELECT vec_id, label, unnest(e) x, generate_subscripts(e, 1) i FROM ({POINTS})"
CENTRES = f"SELECT label, list(m ORDER BY i) c, max(n) n FROM (SELECT label, i, avg(x) m, count(*) n FROM ({CELLS}) GROUP BY label, i) GROUP BY label"
NEAREST = f"""
SELECT vec_id, any_value(label) label, CAST(arg_min(k, (d, k)) AS INT) AS cluster, min(d) squared_distance FROM (
SELECT p.vec_id, p.label, c.label k, pow(list_distance(p.e, c.c), 2) d FROM ({POINTS}) p CROSS JOIN ({CENTRES}) c) GROUP BY vec_id"""


def _points(d: Inputs):
    return d.table("embeddings").select("vec_id", F.col("label").alias("cluster"), F.col("embedding").cast("array<double>").alias("features"))


def _centres(d: Inputs):
    return sg.cluster_summaries(_points(d)).select("cluster", "centroid")


@query("k02_assign_nearest", f"SELECT vec_id, cluster, squared_distance FROM ({NEAREST})", doubles="squared_distance")
def assign(d: Inputs):
    return sg.assign_nearest(_points(d).drop("cluster"), _centres(d)).select("vec_id", "cluster", "squared_distance")


OWN = f"SELECT p.*, c.c, c.n, pow(list_distance(p.e, c.c), 2) d2 FROM ({POINTS}) p JOIN ({CENTRES}) c USING (label)"
QUALITY = f"""
WITH own AS ({OWN}), per AS (SELECT label, any_value(c) c, max(n) n, sum(d2) w, avg(sqrt(d2)) scatter FROM own GROUP BY label),
g AS (SELECT list(m ORDER BY i) g FROM (SELECT i, avg(x) m FROM ({CELLS}) GROUP BY i)),
pair AS (SELECT a.vec_id, a.label, b.label other, avg(pow(list_distance(a.e, b.e), 2)) FILTER (a.vec_id <> b.vec_id) m FROM own a CROSS JOIN own b GROUP BY ALL),
s AS (SELECT vec_id, max(m) FILTER (label = other) a, min(m) FILTER (label <> other) b FROM pair GROUP BY vec_id)
SELECT count(*) k, sum(w) wcss, (sum(n * pow(list_distance(c, (SELECT g FROM g)), 2)) / (count(*) - 1)) / (sum(w) / (sum(n) - count(*))) calinski_harabasz,
       avg(r) davies_bouldin, (SELECT avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END) FROM s) silhouette_squared
FROM (SELECT per.*, (SELECT max((per.scatter + o.scatter) / list_distance(per.c, o.c)) FROM per o WHERE o.label <> per.label) r FROM per)"""


@query("k03_labelling_quality", QUALITY, doubles="wcss calinski_harabasz davies_bouldin silhouette_squared")
def quality(d: Inputs):
    return sg.labelling_quality(_points(d))


@query("k05_calinski_harabasz", f"SELECT calinski_harabasz FROM ({QUALITY})", doubles="calinski_harabasz")
def calinski(d: Inputs):
    return sg.labelling_quality(_points(d)).select("calinski_harabasz")


@query("k06_davies_bouldin", f"SELECT davies_bouldin FROM ({QUALITY})", doubles="davies_bouldin")
def davies(d: Inputs):
    return sg.labelling_quality(_points(d)).select("davies_bouldin")


@query("k04_silhouette_euclidean", f"""
WITH p AS ({POINTS}), pair AS (SELECT a.vec_id, a.label, b.label other, avg(list_distance(a.e, b.e)) FILTER (a.vec_id <> b.vec_id) m FROM p a CROSS JOIN p b GROUP BY ALL)
SELECT avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END) silhouette, count(*) n
FROM (SELECT vec_id, max(m) FILTER (label = other) a, min(m) FILTER (label <> other) b FROM pair GROUP BY vec_id)""", doubles="silhouette")
def silhouette(d: Inputs):
    return sg.silhouette_euclidean(_points(d), "vec_id")


@query("k10_adjusted_rand", f"""
WITH l AS (SELECT vec_id, label, cluster, CAST(vec_id % 3 AS INT) third FROM ({NEAREST})),
p AS (SELECT 'label' column_a, 'cluster' column_b, label a, cluster b FROM l UNION ALL SELECT 'label', 'third', label, third FROM l UNION ALL SELECT 'cluster', 'third', cluster, third FROM l),
c AS (SELECT column_a, column_b, sum(n * (n - 1) / 2) s FROM (SELECT column_a, column_b, a, b, count(*) n FROM p GROUP BY ALL) GROUP BY ALL),
ca AS (SELECT column_a, column_b, sum(n * (n - 1) / 2) sa, sum(n) n FROM (SELECT column_a, column_b, a, count(*) n FROM p GROUP BY ALL) GROUP BY ALL),
cb AS (SELECT column_a, column_b, sum(n * (n - 1) / 2) sb FROM (SELECT column_a, column_b, b, count(*) n FROM p GROUP BY ALL) GROUP BY ALL)
SELECT column_a, column_b, (s - sa * sb / (n * (n - 1) / 2)) / ((sa + sb) / 2 - sa * sb / (n * (n - 1) / 2)) ari FROM c JOIN ca USING (column_a, column_b) JOIN cb USING (column_a, column_b)""",
       doubles="ari")
def rand_index(d: Inputs):
    labels = sg.assign_nearest(_points(d).withColumnRenamed("cluster", "label"), _centres(d)).select(
        "label", "cluster", (F.col("vec_id") % 3).cast("int").alias("third"))
    return sg.adjusted_rand(labels, ["label", "cluster", "third"])


CURVE = " UNION ALL ".join(
    f"SELECT CAST({k} AS BIGINT) k, sum(pow(x - m, 2)) wcss FROM (SELECT x, avg(x) OVER (PARTITION BY vec_id % {k}, i) m FROM ({CELLS}))" for k in range(2, 7))


def _curve(d: Inputs):
    """WCSS of round-robin labellings for k = 2..6, a curve SQL can compute too."""
    points = _points(d)
    return sg.ordered.union_all([sg.labelling_quality(points.withColumn("cluster", (F.col("vec_id") % k).cast("int"))) for k in range(2, 7)])


@query("k08_elbow", f"""
SELECT arg_max(k, (b, -k)) optimal_k_elbow FROM (SELECT k, lead(wcss) OVER (ORDER BY k) - 2 * wcss + lag(wcss) OVER (ORDER BY k) b FROM ({CURVE})) WHERE b IS NOT NULL""")
def elbow(d: Inputs):
    return sg.elbow(_curve(d))


@query("k09_gap_rule", f"""
SELECT coalesce(min(k) FILTER (gap >= g1 - s1), min(k)) optimal_k_gap FROM (SELECT k, gap, lead(gap) OVER (ORDER BY k) g1, lead(se) OVER (ORDER BY k) s1
FROM (SELECT k, -ln(wcss) gap, 0.0001 * k se FROM ({CURVE})))""")
def gap_rule(d: Inputs):
    return sg.gap_choice(_curve(d).select("k", (-F.log("wcss")).alias("gap"), (F.lit(0.0001) * F.col("k")).alias("standard_error")))


LABELLED = "SELECT cf.*, clusters.cluster FROM cf JOIN clusters USING (id)"
MEANS = ", ".join(f"avg({m}) {m}_mean, median({m}) {m}_median" for m in PROFILE_METRICS)
SHARES = ", ".join(f"avg(CAST(gender = '{g}' AS INT)) \"gender_{g}_pct\"" for g in ("M", "F", "O", "Unknown"))
PROFILES = f"SELECT cluster, count(*) size, {MEANS}, {SHARES} FROM ({LABELLED}) GROUP BY cluster"
BIG = "income_imputed trans_avg trans_total".split()


@query("a23_cluster_profiles", PROFILES,
       doubles=" ".join(f"{m}_{s}" for m in PROFILE_METRICS if m not in BIG for s in ("mean", "median")) + " gender_M_pct gender_F_pct gender_O_pct gender_Unknown_pct",
       coarse=" ".join(f"{m}_{s}" for m in BIG for s in ("mean", "median")))
def profiles(d: Inputs):
    return sg.cluster_profiles(durable(d.features.join(d.clusters, "id")))


@query("a24_cluster_sizes", "SELECT cluster, count(*) size, count(*) / (SELECT count(*) FROM clusters) share FROM clusters GROUP BY cluster", doubles="share")
def sizes(d: Inputs):
    return sg.cluster_sizes(d.clusters)


DISTINCT_COLUMNS = ["age_imputed", "tenure_months", "income_missing", "gender_M", "gender_F", "member_month", "tenure_days"]


@query("k11_distinguishing_features", f"""
SELECT * FROM (SELECT cluster, metric, cm cluster_mean, gm global_mean, cm - gm difference, CAST(row_number() OVER (PARTITION BY cluster ORDER BY round(abs(cm - gm), 9) DESC, metric) AS INT) place FROM (
{" UNION ALL ".join(f"SELECT cluster, '{c}' metric, avg({c}) cm, (SELECT avg({c}) FROM demo) gm FROM demo JOIN clusters USING (id) GROUP BY cluster" for c in DISTINCT_COLUMNS)}))
WHERE place <= 5""", doubles="cluster_mean global_mean difference")
def distinguishing(d: Inputs):
    return sg.distinguishing_features(ft.demographic_features(d.profile).join(d.clusters, "id"), DISTINCT_COLUMNS)


BUSINESS = f"""
SELECT cluster, count(*) size, avg(trans_total) revenue_per_customer, CAST(0 AS DOUBLE) reward_cost_per_customer, avg(view_rate) avg_view_rate, avg(completion_rate) avg_completion_rate,
       avg(trans_count) avg_trans_count, count(*) / (SELECT count(*) FROM profile) pct_of_total, CAST(999 AS DOUBLE) offer_roi,
       greatest(0, 1 - (avg(view_rate) + avg(completion_rate) + avg(trans_count)) / 3) churn_risk_proxy FROM beh JOIN clusters USING (id) GROUP BY cluster"""


@query("k12_business_metrics", BUSINESS, doubles="avg_view_rate avg_completion_rate avg_trans_count pct_of_total churn_risk_proxy", coarse="revenue_per_customer")
def business(d: Inputs):
    return sg.business_metrics(ft.behavioural_features(d.profile, d.events, d.portfolio).join(d.clusters, "id"))


@query("w07_best_clusters", f"""
SELECT arg_max(cluster, (round(revenue_per_customer, 6), -cluster)) best_revenue_cluster, arg_max(cluster, (offer_roi, -cluster)) best_roi_cluster,
       arg_max(cluster, (churn_risk_proxy, -cluster)) highest_churn_cluster FROM ({BUSINESS})""")
def best_clusters(d: Inputs):
    return sg.best_clusters(sg.business_metrics(ft.behavioural_features(d.profile, d.events, d.portfolio).join(d.clusters, "id")))


MEDIANS = ", ".join(f"median({m}_mean) OVER () med_{m}" for m in ("trans_total", "completion_rate", "income_imputed", "tenure_months"))


@query("k13_segment_names", f"""
SELECT cluster, size, t segment_type, CASE t WHEN 'high_value_loyalist' THEN 'High-Value Loyalists' WHEN 'discount_seeker' THEN 'Discount Seekers' WHEN 'bogo_responder' THEN 'BOGO Responders'
       WHEN 'low_engagement' THEN 'Low-Engagement Customers' WHEN 'moderate_spender' THEN 'Moderate Spenders' WHEN 'tenured_conservative' THEN 'Tenured Conservatives'
       ELSE 'High-Income Casuals' END segment_name FROM (
SELECT cluster, size, CASE WHEN row_number() OVER (PARTITION BY kind ORDER BY cluster) > 1 THEN 'moderate_spender' ELSE kind END t FROM (
SELECT cluster, size, CASE WHEN trans_total_mean > med_trans_total AND completion_rate_mean > med_completion_rate THEN 'high_value_loyalist'
       WHEN completion_rate_mean < 0.30 OR view_rate_mean < 0.40 THEN 'low_engagement'
       WHEN bogo_completion_rate_mean > discount_completion_rate_mean AND bogo_completion_rate_mean > 0.5 THEN 'bogo_responder'
       WHEN discount_completion_rate_mean > bogo_completion_rate_mean AND discount_completion_rate_mean > 0.5 THEN 'discount_seeker'
       WHEN income_imputed_mean > med_income_imputed AND trans_total_mean <= med_trans_total THEN 'high_income_casual'
       WHEN tenure_months_mean > med_tenure_months AND trans_total_mean <= med_trans_total THEN 'tenured_conservative' ELSE 'moderate_spender' END kind
FROM (SELECT *, {MEDIANS} FROM ({PROFILES}))))""")
def names(d: Inputs):
    return sg.name_segments(sg.cluster_profiles(durable(d.features.join(d.clusters, "id"))))


RADAR = ["trans_total_mean", "completion_rate_mean", "view_rate_mean", "income_imputed_mean", "tenure_months_mean"]


@query("v05_radar", "SELECT cluster, " + ", ".join(f"({m} - min({m}) OVER ()) / nullif(max({m}) OVER () - min({m}) OVER (), 0) {m}" for m in RADAR) + f" FROM ({PROFILES})",
       doubles=" ".join(RADAR))
def radar(d: Inputs):
    return charts.radar(sg.cluster_profiles(durable(d.features.join(d.clusters, "id"))), RADAR)


def _customer_points(d: Inputs):
    scaled = ft.clustering_matrix(d.features)
    return durable(sg.as_array(scaled, [c for c in scaled.columns if c != "id"], ["id"]))


@query("k01_kmeans")
def kmeans(d: Inputs):
    points = _customer_points(d)
    return sg.predict(sg.fit_kmeans(points, 4), points).select("id", "cluster")


@query("k07_sweep")
def sweep(d: Inputs):
    return sg.sweep(_customer_points(d), 10)


@query("k09_gap_statistic")
def gap(d: Inputs):
    return sg.gap_statistic(_customer_points(d), 10)


@query("k10_stability")
def stability(d: Inputs):
    return sg.stability(_customer_points(d), "id", 4)


@query("f07_principal_components")
def components(d: Inputs):
    scaled = ft.clustering_matrix(d.features)
    return sg.principal_components(scaled, [c for c in scaled.columns if c != "id"], ["id"])[0]


@query("k01_kmeans_check", "SELECT count(*) n_rows, CAST(4 AS BIGINT) n_clusters, CAST(0 AS BIGINT) n_misplaced, TRUE is_settled FROM profile")
def kmeans_check(d: Inputs):
    """Every customer is with the nearest centre, and every centre is the mean of its customers within the rule that ends a start."""
    points = _customer_points(d)
    model = sg.fit_kmeans(points, 4)
    found = certificates.kmeans_stationarity(sg.predict(model, points), sg.centres(model, d.spark))
    return found.select("n_rows", "n_clusters", "n_misplaced", (F.col("way") <= 0.01).alias("is_settled"))


@query("f07_components_check", "SELECT count(*) n_rows, TRUE are_eigenvectors FROM profile")
def components_check(d: Inputs):
    """The projections of all customers come from orthonormal eigenvectors of the covariance matrix."""
    scaled = durable(ft.clustering_matrix(d.features))
    columns = [c for c in scaled.columns if c != "id"]
    found = certificates.component_residuals(scaled, sg.principal_components(scaled, columns, ["id"])[0], columns, "id")
    return found.select("n_rows", (F.col("residual") < 1e-6).alias("are_eigenvectors"))
