"""Targeting, KPIs, star schema, measures and chart tables."""

from pyspark.sql import functions as F

from ..functions.scalars import clean_age, is_transaction
from ..operators import causal as c, charts, features as ft, funnel as f, segments as sg, star, targeting as tg
from ..functions.scale import durable, remove, scratch
from ..sources.readers import read_table
from ..sources.writers import export_tables
from .registry import Inputs, query
from .segment_plans import PROFILES
from .stats_plans import PAID

BY_TYPE = """
SELECT offer_type, count(DISTINCT person) FILTER (event = 'offer received') nr, count(DISTINCT person) FILTER (event = 'offer completed') nc,
       CASE WHEN nr > 0 THEN nc / nr ELSE 0 END completion_rate FROM oe WHERE offer_type IS NOT NULL GROUP BY offer_type"""
LIFT = f"""
SELECT b.r random_completion_rate, x.s / z.n rule_based_completion_rate, (x.s / z.n / b.r - 1) * 100 lift_percent FROM (SELECT count(*) n FROM profile) z CROSS JOIN (SELECT avg(completion_rate) r FROM ({BY_TYPE})) b CROSS JOIN (SELECT sum(n * CASE primary_offer WHEN 'bogo' THEN bo WHEN 'discount' THEN di ELSE coalesce(completion_rate, 0) END) s FROM (
SELECT cluster, count(*) n, avg(bogo_completion_rate) bo, avg(discount_completion_rate) di FROM beh JOIN clusters USING (id) GROUP BY cluster) JOIN rules USING (cluster)
LEFT JOIN ({BY_TYPE}) t ON primary_offer = t.offer_type) x"""
NAIVE = f"""
SELECT treatment, coalesce(avg(amount) FILTER (treated = 0), 0) control_mean, coalesce(avg(amount) FILTER (treated = 1), 0) treatment_mean, treatment_mean - control_mean ate,
       CASE WHEN control_mean > 0 THEN ate / control_mean * 100 ELSE 0 END ate_percent FROM ({PAID}) GROUP BY treatment"""


def _behaviour(d: Inputs):
    return ft.behavioural_features(d.profile, d.events, d.portfolio)


def _by_type(d: Inputs):
    return f.persons_by_type(d.events, d.portfolio)


def _lift(d: Inputs):
    return tg.rule_lift(_behaviour(d), d.clusters, d.rules, _by_type(d))


def _effects(d: Inputs):
    return c.naive_effects(c.person_exposure(d.events, d.portfolio))


@query("r01_rule_table", "SELECT r.cluster, primary_offer, secondary_offer, count(*) n_customers FROM rules r JOIN clusters c USING (cluster) GROUP BY ALL")
def rule_table(d: Inputs):
    return d.clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_customers")).join(d.rules, "cluster").select(
        "cluster", "primary_offer", "secondary_offer", "n_customers")


@query("r02_baseline_rate", f"SELECT avg(completion_rate) random_completion_rate FROM ({BY_TYPE})", doubles="random_completion_rate")
def baseline(d: Inputs):
    return tg.baseline_rate(_by_type(d))


@query("r03_rule_lift", LIFT, doubles="random_completion_rate rule_based_completion_rate lift_percent")
def lift(d: Inputs):
    return _lift(d)


@query("r04_recommendations", """
SELECT id customer_id, l.cluster, t.n cluster_size, t.n / (SELECT count(*) FROM profile) cluster_share, primary_offer recommended_offer_type, o.oid recommended_offer_id,
       p.reward, p.difficulty, p.duration, t.a avg_age, t.i avg_income, t.c cluster_completion_rate, t.v cluster_view_rate
FROM (SELECT id, cluster FROM clusters) l JOIN rules r ON l.cluster = r.cluster JOIN (
SELECT cluster, count(*) n, avg(age_imputed) a, avg(income_imputed) i, avg(completion_rate) c, avg(view_rate) v FROM (SELECT id, age_imputed, income_imputed FROM demo) JOIN beh USING (id) JOIN clusters USING (id) GROUP BY cluster) t
ON l.cluster = t.cluster LEFT JOIN (SELECT offer_type, min(id) oid FROM portfolio GROUP BY offer_type) o ON o.offer_type = primary_offer LEFT JOIN (SELECT id pid, reward, difficulty, duration FROM portfolio) p ON p.pid = o.oid""",
       doubles="cluster_share avg_age cluster_completion_rate cluster_view_rate", coarse="avg_income")
def recommendations(d: Inputs):
    features = durable(ft.join_features(ft.demographic_features(d.profile).select("id", "age_imputed", "income_imputed"), _behaviour(d)))
    return tg.recommendations(features, d.clusters, d.rules, d.portfolio)


@query("r05_rules_from_effects", f"""
SELECT cluster, max(offer_type) FILTER (k = 1) primary_offer, max(offer_type) FILTER (k = 2) secondary_offer FROM (
SELECT cluster, offer_type, row_number() OVER (PARTITION BY cluster ORDER BY round(ate, 6) DESC, offer_type) k FROM (
SELECT cluster, treatment offer_type, avg(a) FILTER (treated = 1) - avg(a) FILTER (treated = 0) ate FROM (SELECT k.cluster, treatment, person, max(treated) treated, avg(amount) a
FROM ({PAID}) JOIN clusters k ON person = k.id WHERE treatment <> 'any_offer' GROUP BY ALL) GROUP BY ALL HAVING count(*) FILTER (treated = 1) >= 3 AND count(*) FILTER (treated = 0) >= 3)) GROUP BY cluster""")
def derived_rules(d: Inputs):
    return tg.rules_from_effects(c.segment_effects(c.person_exposure(d.events, d.portfolio).filter("n > 0"), d.clusters))


SEGMENTS = """
SELECT cluster, n size, primary_offer, s avg_spend_30d, o offers_received, r completion_rate, s * 12 annual_spend, CASE WHEN o > 0 THEN s / o ELSE 0 END revenue_per_offer,
       o * r completed_offers_30d, coalesce(w, 0) reward_cost_per_offer, o * r * coalesce(w, 0) total_reward_cost_30d, s / nullif(o * r * coalesce(w, 0), 0) offer_roi FROM (
SELECT cluster, count(*) n, avg(trans_total) s, avg(offers_received) o, avg(completion_rate) r FROM beh JOIN clusters USING (id) GROUP BY cluster) JOIN rules USING (cluster)
LEFT JOIN (SELECT offer_type, avg(reward) w FROM portfolio GROUP BY offer_type) ON offer_type = primary_offer"""


@query("r06_segment_kpis", SEGMENTS, doubles="offers_received completion_rate completed_offers_30d reward_cost_per_offer total_reward_cost_30d",
       coarse="avg_spend_30d annual_spend revenue_per_offer offer_roi")
def segment_kpis(d: Inputs):
    return tg.segment_kpis(_behaviour(d), d.clusters, d.rules, d.portfolio)


@query("r07_portfolio_kpis", f"""
SELECT CAST(n AS BIGINT) total_customers, t total_revenue_30d, t / n avg_revenue_per_customer_30d, t * 12 annual_revenue_estimate, n * g incremental_completions, w avg_reward_per_offer, n * g * w incremental_reward_cost,
       tn / n * 100 high_value_segment_pct, ts / t * 100 high_value_revenue_share, ate * n incremental_revenue_30d, ate * n * 12 incremental_revenue_annual FROM (
SELECT sum(size) n, sum(avg_spend_30d * size) t, sum(size) FILTER (cluster IN (1, 2)) tn, sum(avg_spend_30d * size) FILTER (cluster IN (1, 2)) ts FROM ({SEGMENTS}))
CROSS JOIN (SELECT rule_based_completion_rate - random_completion_rate g FROM ({LIFT})) CROSS JOIN (SELECT avg(reward) w FROM portfolio) CROSS JOIN (SELECT ate FROM ({NAIVE}) WHERE treatment = 'any_offer')""",
       doubles="avg_reward_per_offer high_value_segment_pct high_value_revenue_share incremental_completions",
       coarse="total_revenue_30d avg_revenue_per_customer_30d annual_revenue_estimate incremental_reward_cost incremental_revenue_30d incremental_revenue_annual")
def portfolio_kpis(d: Inputs):
    return tg.portfolio_kpis(tg.segment_kpis(_behaviour(d), d.clusters, d.rules, d.portfolio), _lift(d), d.portfolio, _effects(d))


@query("r07_revenue_shares", """
SELECT cluster, sum(trans_total) revenue, sum(trans_total) / (SELECT sum(trans_total) FROM beh) revenue_share FROM beh JOIN clusters USING (id) GROUP BY cluster""",
       doubles="revenue_share", coarse="revenue")
def shares(d: Inputs):
    return tg.revenue_shares(_behaviour(d), d.clusters)


FACTS = """
SELECT DISTINCT person customer_id, offer_id, replace(event, 'offer ', '') event_type, time time_hours, TIMESTAMP '2018-07-26' - to_hours(time) event_date,
       strftime(TIMESTAMP '2018-07-26' - to_hours(time), '%Y-%m-%d') event_date_key, CAST(time // 24 AS INT) day_since_start
FROM ev WHERE event IN ('offer received', 'offer viewed', 'offer completed') AND offer_id IS NOT NULL"""


@query("b01_fact_offer_interactions", FACTS)
def facts(d: Inputs):
    return star.fact_offer_interactions(d.events)


@query("u04_deduplicated_events", "SELECT DISTINCT person, offer_id, event FROM ev WHERE offer_id IS NOT NULL")
def distinct_events(d: Inputs):
    return d.events.filter("offer_id is not null").select("person", "offer_id", "event").dropDuplicates()


LABEL = "CASE cluster WHEN 0 THEN 'Unknown Demographics' WHEN 1 THEN 'Discount Responders' WHEN 2 THEN 'BOGO Responders' WHEN 3 THEN 'Low Engagement' END"
LEVEL = "CASE WHEN completion_rate <= {} THEN NULL WHEN completion_rate <= 0.3 THEN 'Low' WHEN completion_rate <= 0.6 THEN 'Medium' WHEN completion_rate <= 1.0 THEN 'High' END"
DIM_CUSTOMERS = f"""
SELECT id customer_id, age_imputed, income_imputed, gender, tenure_months, cluster, {LABEL} cluster_label, {LEVEL.format(-0.001)} engagement_level,
       CASE WHEN rfm_score >= 9 THEN 'Champions' WHEN rfm_score >= 7 THEN 'Loyal' WHEN rfm_score >= 5 THEN 'Potential' WHEN rfm_score >= 3 THEN 'At Risk' END rfm_segment,
       clv_proxy, completion_rate, view_rate, trans_total, trans_avg, trans_count FROM cf LEFT JOIN clusters USING (id)"""


@query("b02_dim_customers", DIM_CUSTOMERS, doubles="age_imputed income_imputed tenure_months clv_proxy completion_rate view_rate trans_total trans_avg")
def dim_customers(d: Inputs):
    return star.dim_customers(d.features, d.clusters)


@query("p22_cluster_labels", f"SELECT cluster, id, {LABEL} cluster_label FROM clusters")
def cluster_labels(d: Inputs):
    return star.with_labels(d.clusters)


@query("b03_dim_offers", """
SELECT id offer_id, offer_type, difficulty, reward, duration duration_days, list_contains(channels, 'email') channel_email, list_contains(channels, 'mobile') channel_mobile,
       list_contains(channels, 'social') channel_social, list_contains(channels, 'web') channel_web, reward / nullif(duration, 0) reward_per_day, difficulty / nullif(duration, 0) difficulty_per_day,
       CAST(len(channels) AS INT) channel_count, CASE WHEN offer_type IN ('bogo', 'discount') THEN 'Promotional' ELSE 'Informational' END offer_type_category FROM portfolio""",
       doubles="reward_per_day difficulty_per_day")
def dim_offers(d: Inputs):
    return star.dim_offers(d.portfolio)


@query("p13_offer_rates_per_day", "SELECT id, reward / nullif(duration, 0) reward_per_day FROM portfolio", doubles="reward_per_day")
def per_day(d: Inputs):
    return star.dim_offers(d.portfolio).select(F.col("offer_id").alias("id"), "reward_per_day")


DATES = f"""
SELECT CAST(t AS DATE) date, strftime(t, '%Y-%m-%d') date_key, CAST(year(t) AS INT) AS year, CAST(quarter(t) AS INT) AS quarter, 'FQ' || quarter(t) fiscal_quarter, CAST(month(t) AS INT) AS month, monthname(t) month_name,
       CAST(day(t) AS INT) AS day, CAST(isodow(t) - 1 AS INT) day_of_week, dayname(t) day_name, CAST(weekofyear(t) AS INT) week_of_year, isodow(t) >= 6 is_weekend, isodow(t) < 6 is_weekday,
       t BETWEEN DATE '2018-07-01' AND DATE '2018-07-07' is_holiday_period, CAST(date_diff('day', DATE '2018-06-27', CAST(t AS DATE)) AS INT) day_since_start
FROM (SELECT unnest(generate_series(min(CAST(event_date AS DATE)), max(CAST(event_date AS DATE)), INTERVAL 1 DAY)) t FROM ({FACTS}))"""


@query("b04_dim_date", DATES)
def dim_date(d: Inputs):
    return star.dim_date_of(star.fact_offer_interactions(d.events))


KPIS = f"""
SELECT 'Total Customers' metric_name, CAST(count(*) AS DOUBLE) metric_value, 'Customer' metric_category, 'Whole Number' format FROM beh UNION ALL
SELECT 'Total Revenue', sum(trans_total), 'Financial', 'Currency' FROM beh UNION ALL SELECT 'Average Completion Rate', avg(completion_rate), 'Engagement', 'Percentage' FROM beh UNION ALL
SELECT 'Average View Rate', avg(view_rate), 'Engagement', 'Percentage' FROM beh UNION ALL SELECT 'Average Transaction Amount', avg(trans_avg), 'Financial', 'Currency' FROM beh UNION ALL
SELECT 'Recommendation Lift %', lift_percent, 'Business', 'Percentage' FROM ({LIFT}) UNION ALL
SELECT 'ATE ' || upper(treatment[1]) || treatment[2:], ate, 'Causal Impact', 'Currency' FROM ({NAIVE}) WHERE treatment <> 'any_offer' UNION ALL
SELECT 'ATE ' || upper(treatment[1]) || treatment[2:] || ' %', ate_percent, 'Causal Impact', 'Percentage' FROM ({NAIVE}) WHERE treatment <> 'any_offer'"""


@query("b05_fact_kpi_metrics", KPIS, coarse="metric_value")
def kpis(d: Inputs):
    return star.kpi_rows(_behaviour(d), _effects(d), _lift(d))


SEGMENT_PERFORMANCE = f"""
SELECT cluster cluster_id, {LABEL} cluster_label, n segment_size, r avg_completion_rate, v avg_view_rate, a avg_transaction_amount, i avg_income, g avg_age, t total_revenue, t / n revenue_per_customer,
       coalesce(primary_offer, 'unknown') best_offer_type, (SELECT max(CASE WHEN cluster = 0 AND offer_type <> 'informational' OR cluster = 1 AND offer_type <> 'discount' OR cluster = 2 AND offer_type <> 'bogo'
       THEN NULL ELSE completion_rate END) FROM ({BY_TYPE})) best_offer_completion_rate FROM (
SELECT cluster, count(*) n, avg(completion_rate) r, avg(view_rate) v, avg(trans_avg) a, avg(income_imputed) i, avg(age_imputed) g, sum(CAST(trans_total AS DECIMAL(18,2)))::DOUBLE t
FROM beh JOIN (SELECT id, income_imputed, age_imputed FROM demo) USING (id) JOIN clusters USING (id) GROUP BY cluster) LEFT JOIN rules USING (cluster)"""


def _segment_features(d: Inputs, behaviour=None):
    return ft.join_features(ft.demographic_features(d.profile).select("id", "age_imputed", "income_imputed"), _behaviour(d) if behaviour is None else behaviour)


@query("b06_fact_segment_performance", SEGMENT_PERFORMANCE, doubles="avg_completion_rate avg_view_rate avg_age best_offer_completion_rate",
       coarse="avg_transaction_amount avg_income total_revenue revenue_per_customer")
def segment_performance(d: Inputs):
    return star.fact_segment_performance(_segment_features(d), d.clusters, d.rules, _by_type(d))


@query("a26_segment_averages", f"SELECT cluster_id AS cluster, segment_size, avg_completion_rate, avg_view_rate, total_revenue FROM ({SEGMENT_PERFORMANCE})",
       doubles="avg_completion_rate avg_view_rate", coarse="total_revenue")
def segment_averages(d: Inputs):
    return star.segment_averages(_segment_features(d), d.clusters).select("cluster", "segment_size", "avg_completion_rate", "avg_view_rate", "total_revenue")


@query("w08_revenue_rank", f"SELECT cluster_id, total_revenue, CAST(rank() OVER (ORDER BY total_revenue DESC) AS INT) revenue_rank, rank() OVER (ORDER BY total_revenue DESC) = 1 is_best FROM ({SEGMENT_PERFORMANCE})",
       coarse="total_revenue")
def revenue_rank(d: Inputs):
    return star.revenue_rank(star.segment_averages(_segment_features(d), d.clusters).withColumnRenamed("cluster", "cluster_id"))


@query("b07_customers", f"""
SELECT id customer_id, age_imputed age, income_imputed income, tenure_months, "gender_M" is_male, "gender_F" is_female, "gender_O" is_other_gender, "gender_Unknown" is_unknown_gender,
       trans_count transaction_count, trans_total total_spend, trans_avg avg_transaction, offers_received, offers_viewed, offers_completed, view_rate, completion_rate, cluster cluster_id,
       {LABEL} cluster_label, {LABEL} customer_segment, {LEVEL.format(0)} engagement_level
FROM (SELECT id, age_imputed, income_imputed, tenure_months, "gender_M", "gender_F", "gender_O", "gender_Unknown" FROM demo) JOIN beh USING (id) LEFT JOIN clusters USING (id)""",
       doubles="age income tenure_months total_spend avg_transaction view_rate completion_rate")
def customers(d: Inputs):
    return star.customers_table(ft.join_features(ft.demographic_features(d.profile), _behaviour(d)), d.clusters)


@query("b08_offers", """
SELECT id offer_id, offer_type, difficulty, reward, duration duration_days, unnest(channels) channel, upper(offer_type) offer_type_upper, reward / duration reward_per_day,
       difficulty / duration difficulty_per_day FROM portfolio""", doubles="reward_per_day difficulty_per_day")
def offers(d: Inputs):
    return star.offers_table(d.portfolio)


TRANSACTIONS = """
SELECT person customer_id, amount transaction_amount, time time_hours, TIMESTAMP '2018-07-26' - to_hours(time) transaction_date, dayname(TIMESTAMP '2018-07-26' - to_hours(time)) day_of_week,
       CAST(hour(TIMESTAMP '2018-07-26' - to_hours(time)) AS INT) hour_of_day FROM ev WHERE event = 'transaction' AND amount IS NOT NULL"""


@query("b09_transactions", TRANSACTIONS)
def transactions(d: Inputs):
    return star.transactions_table(d.events)


@query("b10_offer_events", """
SELECT person customer_id, offer_id, event event_type, time time_hours, TIMESTAMP '2018-07-26' - to_hours(time) event_date, dayname(TIMESTAMP '2018-07-26' - to_hours(time)) day_of_week
FROM ev WHERE event IN ('offer received', 'offer viewed', 'offer completed') AND offer_id IS NOT NULL""")
def offer_events(d: Inputs):
    return star.offer_events_table(d.events)


LONG = {"completion_rate": "Completion Rate", "view_rate": "View Rate", "trans_avg": "Trans Avg", "income_imputed": "Income Imputed", "age_imputed": "Age Imputed"}


@query("b11_cluster_profiles_long", " UNION ALL ".join(
    f"SELECT cluster cluster_id, {LABEL} cluster_label, '{t}' metric, {m}_mean AS value FROM ({PROFILES})" for m, t in LONG.items()), coarse="value")
def long_profiles(d: Inputs):
    return star.long_cluster_profiles(sg.cluster_profiles(durable(_segment_features(d).join(d.clusters, "id")), list(LONG)))


@query("a25_melted_profiles", " UNION ALL ".join(
    f"SELECT cluster, '{m}' metric, avg({m}) AS value FROM beh JOIN clusters USING (id) GROUP BY cluster" for m in ("view_rate", "completion_rate")), doubles="value")
def melted(d: Inputs):
    means = _behaviour(d).join(d.clusters, "id").groupBy("cluster").agg(F.avg("view_rate").alias("view_rate"), F.avg("completion_rate").alias("completion_rate"))
    return means.unpivot("cluster", ["view_rate", "completion_rate"], "metric", "value")


@query("b12_ate_results", f"""
SELECT CASE treatment WHEN 'any_offer' THEN 'Any Offer' ELSE upper(treatment[1]) || treatment[2:] END offer_type, control_mean, treatment_mean, ate ate_dollars, ate_percent FROM ({NAIVE})""",
       doubles="control_mean treatment_mean ate_dollars ate_percent")
def ate_results(d: Inputs):
    return star.ate_results_table(_effects(d))


@query("b12_recommendation_results", f"""
SELECT 'Random Targeting' AS method, random_completion_rate completion_rate, CAST(0 AS DOUBLE) lift_percent FROM ({LIFT}) UNION ALL
SELECT 'Rule-Based Targeting', rule_based_completion_rate, lift_percent FROM ({LIFT})""", doubles="completion_rate lift_percent")
def recommendation_results(d: Inputs):
    return star.recommendation_results_table(_lift(d))


@query("b13_customer_measures", f"""
SELECT count(*) total_customers, avg(completion_rate) avg_completion_rate, avg(view_rate) avg_view_rate, avg(trans_avg) avg_transaction, count(*) FILTER ({LEVEL.format(-0.001)} = 'High') high_engagement_customers FROM beh""",
       doubles="avg_completion_rate avg_view_rate", coarse="avg_transaction")
def customer_measures(d: Inputs):
    return star.customer_measures(star.dim_customers(_behaviour(d).withColumn("rfm_score", F.lit(None).cast("int")), d.clusters))


@query("b13_funnel_measures", f"""
SELECT count(*) transaction_count, count(*) FILTER (event_type = 'received') offers_received, count(*) FILTER (event_type = 'viewed') offers_viewed, count(*) FILTER (event_type = 'completed') offers_completed,
       count(*) FILTER (event_type = 'received' AND offer_type = 'bogo') bogo_offers_received, count(*) FILTER (event_type = 'received' AND offer_type = 'discount') discount_offers_received,
       count(*) FILTER (event_type = 'received' AND offer_type = 'informational') info_offers_received, offers_viewed / nullif(offers_received, 0) view_rate_pct,
       offers_completed / nullif(offers_received, 0) completion_rate_pct FROM ({FACTS}) x LEFT JOIN portfolio p ON x.offer_id = p.id""", doubles="view_rate_pct completion_rate_pct")
def funnel_measures(d: Inputs):
    return star.funnel_measures(star.fact_offer_interactions(d.events), star.dim_offers(d.portfolio))


@query("b14_holiday_interactions", f"""
SELECT count(*) holiday_interactions FROM ({FACTS}) WHERE event_date_key BETWEEN '2018-07-01' AND '2018-07-07'""")
def holidays(d: Inputs):
    facts = star.fact_offer_interactions(d.events)
    return star.holiday_interactions(facts, star.dim_date(d.spark))


@query("b16_kpi_by_name", f"SELECT sum(metric_value) kpi_value FROM ({KPIS}) WHERE metric_name = 'Total Revenue'", coarse="kpi_value")
def kpi_by_name(d: Inputs):
    return star.kpi_value(star.kpi_rows(_behaviour(d), _effects(d), _lift(d)), "Total Revenue")


@query("b16_selected_kpi", """
SELECT 'View Rate' metric, avg(view_rate) selected_kpi FROM beh UNION ALL SELECT 'Avg Spend', avg(trans_avg) FROM beh UNION ALL SELECT 'Anything', avg(completion_rate) FROM beh""", coarse="selected_kpi")
def selected_kpi(d: Inputs):
    customers = _behaviour(d)
    rows = [star.selected_kpi(customers, None, m).select(F.lit(m).alias("metric"), "selected_kpi") for m in ("View Rate", "Avg Spend", "Anything")]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("b15_best_model", """
SELECT max(r) best_auc_roc, arg_max(m, r) best_model FROM (SELECT m, (sum(rk) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2)
 / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)) r FROM (
SELECT 'score' m, label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 rk FROM scored UNION ALL
SELECT 'inverse', label, rank() OVER (ORDER BY -score) + (count(*) OVER (PARTITION BY score) - 1) / 2 FROM scored) GROUP BY m)""", doubles="best_auc_roc")
def best_model(d: Inputs):
    from ..operators import models as md
    both = d.scored.select(F.lit("score").alias("model"), "label", "score").unionByName(d.scored.select(F.lit("inverse").alias("model"), "label", (-F.col("score")).alias("score")))
    areas = md.roc_auc(md.score_counts(both, ["model"]), ["model"])
    return star.best_model(star.long_model_performance(areas))


@query("w09_running_spend", f"""
SELECT date, spend, sum(spend) OVER (PARTITION BY year(date) ORDER BY date) running_spend FROM (
SELECT CAST(transaction_date AS DATE) date, CAST(sum(CAST(transaction_amount AS DECIMAL(18,2))) AS DOUBLE) spend FROM ({TRANSACTIONS}) GROUP BY 1)""", coarse="spend running_spend")
def running_spend(d: Inputs):
    return star.running_spend(star.transactions_table(d.events))


@query("w10_trailing_interactions", f"""
SELECT day_since_start, n n_interactions, CAST(sum(n) OVER (ORDER BY day_since_start RANGE BETWEEN 7 PRECEDING AND CURRENT ROW) AS BIGINT) trailing_interactions
FROM (SELECT day_since_start, count(*) n FROM ({FACTS}) GROUP BY 1)""")
def trailing(d: Inputs):
    return star.trailing_interactions(star.fact_offer_interactions(d.events))


@query("v01_histogram_age", """
SELECT CAST(b AS INT) AS bin, lo + w * b bin_start, lo + w * (b + 1) bin_end, count(age) n FROM (SELECT min(age)::DOUBLE lo, (max(age) - min(age)) / 30 w FROM profile WHERE age <> 118)
CROSS JOIN range(0, 30) r(b) LEFT JOIN (SELECT age FROM profile WHERE age <> 118) ON least(floor((age - lo) / w), 29) = b GROUP BY b, lo, w""", doubles="bin_start bin_end")
def histogram(d: Inputs):
    return charts.histogram(d.profile.select(clean_age().alias("age")), "age")


@query("v01_histogram_amount", """
SELECT CAST(b AS INT) AS bin, lo + w * b bin_start, lo + w * (b + 1) bin_end, count(amount) n FROM (SELECT min(amount) lo, (max(amount) - min(amount)) / 30 w FROM ev WHERE event = 'transaction')
CROSS JOIN range(0, 30) r(b) LEFT JOIN (SELECT amount FROM ev WHERE event = 'transaction') ON least(floor((amount - lo) / w), 29) = b GROUP BY b, lo, w""", doubles="bin_start bin_end")
def amount_histogram(d: Inputs):
    return charts.histogram(d.events.filter(is_transaction()), "amount")


@query("v02_box_plot", """
SELECT l_returnflag, q1, median, q3, min(l_extendedprice) min, max(l_extendedprice) max, min(l_extendedprice) FILTER (i) lower_whisker, max(l_extendedprice) FILTER (i) upper_whisker, count(*) FILTER (NOT i) n_outliers
FROM (SELECT *, l_extendedprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) i FROM lineitem JOIN (
SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) q1, median(l_extendedprice) median, quantile_cont(l_extendedprice, 0.75) q3 FROM lineitem GROUP BY l_returnflag) USING (l_returnflag))
GROUP BY l_returnflag, q1, median, q3""", doubles="q1 median q3")
def box_plot(d: Inputs):
    return charts.box_plot(d.table("lineitem"), "l_extendedprice", ["l_returnflag"])


def _exports(d: Inputs):
    """All tables of the export. What several of them are built from is stored, so each is made from the events once."""
    activity = durable(ft.customer_activity(d.events, d.portfolio))
    d.features = durable(ft.customer_features(d.profile, d.events, d.portfolio, activity=activity))
    behaviour, by_type, effects = (durable(t) for t in (ft.behavioural_features(d.profile, d.events, d.portfolio, activity), _by_type(d), _effects(d)))
    lift = durable(tg.rule_lift(behaviour, d.clusters, d.rules, by_type))
    profiles = sg.cluster_profiles(durable(_segment_features(d, behaviour).join(d.clusters, "id")), list(LONG))
    return star.export_tables(d.portfolio, d.events, d.features, d.clusters, d.rules, profiles, effects, lift, by_type)


EXPORTS = {
    "fact_offer_interactions": (f"({FACTS})", 7), "dim_customers": ("profile", 15), "dim_offers": ("portfolio", 13), "dim_date": ("range(0, 61)", 15),
    "fact_segment_performance": (f"({SEGMENT_PERFORMANCE})", 12), "customers": ("profile", 20), "offers": ("(SELECT unnest(channels) FROM portfolio)", 9), "transactions": (f"({TRANSACTIONS})", 6),
    "offer_events": ("(SELECT * FROM ev WHERE event <> 'transaction' AND offer_id IS NOT NULL)", 6),
    "cluster_profiles": ("(SELECT DISTINCT cluster, m FROM clusters, range(0, 5) t(m))", 4), "ate_results": (f"({NAIVE})", 5), "recommendation_results": ("range(0, 2)", 3),
    "fact_kpi_metrics": (f"({KPIS})", 4)}


INPUTS = {"portfolio": ("portfolio", 6), "profile": ("profile", 5), "events": ("ev", 5)}


@query("s09_export_row_counts", " UNION ALL ".join(
    f"SELECT '{name}' dataset, count(*) n_rows, CAST({columns} AS INT) n_columns FROM {rows}" for name, (rows, columns) in EXPORTS.items()))
def export_counts(d: Inputs):
    """Rows and columns as observed while all tables are written."""
    path = scratch(d.spark, "export")
    try:
        return export_tables(_exports(d), path)
    finally:
        remove(d.spark, path)


@query("s10_export_manifest", " UNION ALL ".join(
    f"SELECT '{name}' dataset, count(*) n_rows, CAST({columns} AS INT) n_columns, count(*) n_read, CAST({columns} AS INT) columns_read FROM {rows}"
    for name, (rows, columns) in {**EXPORTS, **INPUTS}.items()))
def manifest(d: Inputs):
    """The manifest of all exported and input tables beside what is read back."""
    path, tables = scratch(d.spark, "export"), {**_exports(d), "portfolio": d.portfolio, "profile": d.profile, "events": d.events}
    try:
        written = export_tables(tables, path)
        back = [(name, (df := read_table(d.spark, f"{path}/{name}")).count(), len(df.columns)) for name in tables]
    finally:
        remove(d.spark, path)
    return written.join(F.broadcast(d.spark.createDataFrame(back, "dataset string, n_read bigint, columns_read int")), "dataset")
