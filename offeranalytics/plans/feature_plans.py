"""Scalar expressions, joins and features."""

from pyspark.sql import functions as F

from ..functions import constants as k, scalars as s
from ..operators import features as ft
from .registry import Inputs, query

MONEY = "trans_total trans_avg"
BEH_RATES = ("view_rate completion_rate view_to_completion_rate bogo_view_rate bogo_completion_rate discount_view_rate "
             "discount_completion_rate info_view_rate")


@query("p01_payload", "SELECT person, event, offer_id, amount, count(*) n FROM ev GROUP BY ALL")
def payload(d: Inputs):
    return d.events.groupBy("person", "event", "offer_id", "amount").agg(F.count(F.lit(1)).alias("n"))


@query("p02_event_filters", """
SELECT event, count(*) n FROM ev WHERE event IN ('offer received', 'offer viewed', 'offer completed') AND offer_id IS NOT NULL GROUP BY event""")
def event_filters(d: Inputs):
    return d.events.filter(s.is_offer_event()).groupBy("event").agg(F.count(F.lit(1)).alias("n"))


@query("p03_upper_offer_type", "SELECT id, upper(offer_type) offer_type_normalized FROM portfolio")
def upper_type(d: Inputs):
    return d.portfolio.select("id", F.upper("offer_type").alias("offer_type_normalized"))


@query("p04_clean_age", "SELECT id, CAST(nullif(age, 118) AS DOUBLE) age_clean, CAST(age = 118 AS INT) age_missing FROM profile")
def clean_age(d: Inputs):
    return d.profile.select("id", s.clean_age().alias("age_clean"), s.missing_flag(s.clean_age()).alias("age_missing"))


@query("p05_tenure", "SELECT id, tenure_days, tenure_months FROM demo", doubles="tenure_months")
def tenure(d: Inputs):
    return d.profile.select("id", s.tenure_days().alias("tenure_days"), s.tenure_months().alias("tenure_months"))


DEMO_DOUBLES = "age_imputed income_imputed tenure_months"


@query("p06_demographic_features", "SELECT * FROM demo", doubles=DEMO_DOUBLES)
def demographics(d: Inputs):
    return ft.demographic_features(d.profile)


@query("p07_gender_filled", "SELECT gender, count(*) n FROM demo GROUP BY gender")
def gender_filled(d: Inputs):
    return d.profile.groupBy(F.coalesce("gender", F.lit("Unknown")).alias("gender")).agg(F.count(F.lit(1)).alias("n"))


@query("p08_bins", """
SELECT age_bin, income_bin, tenure_bin, count(*) n FROM demo GROUP BY ALL""")
def bins(d: Inputs):
    return ft.demographic_features(d.profile).groupBy("age_bin", "income_bin", "tenure_bin").agg(F.count(F.lit(1)).alias("n"))


@query("p09_chart_bins", """
SELECT CASE WHEN i <= 0 THEN NULL WHEN i <= 30000 THEN '<30K' WHEN i <= 50000 THEN '30-50K' WHEN i <= 75000 THEN '50-75K' WHEN i <= 100000 THEN '75-100K'
            WHEN i <= 200000 THEN '100K+' END income_group,
       CASE WHEN age_imputed <= 0 THEN NULL WHEN age_imputed <= 25 THEN '18-25' WHEN age_imputed <= 35 THEN '26-35' WHEN age_imputed <= 50 THEN '36-50'
            WHEN age_imputed <= 65 THEN '51-65' WHEN age_imputed <= 120 THEN '65+' END age_group, count(*) n
FROM (SELECT coalesce(income, 0) i, age_imputed FROM demo) GROUP BY 1, 2""")
def chart_bins(d: Inputs):
    people = ft.demographic_features(d.profile)
    return people.groupBy(s.cut(F.coalesce("income", F.lit(0.0)), *k.CHART_INCOME_BINS).alias("income_group"),
                          s.cut("age_imputed", *k.CHART_AGE_BINS).alias("age_group")).agg(F.count(F.lit(1)).alias("n"))


@query("p10_one_hot", """
SELECT sum("gender_M")::BIGINT n_m, sum("gender_F")::BIGINT n_f, sum("gender_O")::BIGINT n_o, sum("gender_Unknown")::BIGINT n_unknown FROM demo""")
def one_hot(d: Inputs):
    gender = F.coalesce("gender", F.lit("Unknown"))
    return d.profile.agg(*[F.sum(s.one_hot(gender, g)).alias(f"n_{g.lower()}") for g in k.GENDERS])


@query("p11_member_dates", "SELECT member_year, member_month, count(*) n FROM demo GROUP BY ALL")
def member_dates(d: Inputs):
    return d.profile.groupBy(F.year(s.member_date()).alias("member_year"), F.month(s.member_date()).alias("member_month")).agg(
        F.count(F.lit(1)).alias("n"))


@query("p12_guarded_ratios", """
SELECT person, CASE WHEN offers_received > 0 THEN offers_viewed / offers_received ELSE 0.0 END view_rate_or_zero,
       offers_viewed / nullif(offers_received, 0) view_rate_or_null FROM beh_cnt""", doubles="view_rate_or_zero view_rate_or_null")
def ratios(d: Inputs):
    counts = d.events.filter(F.col("offer_id").isNotNull()).groupBy("person").agg(
        F.count_if(s.is_received()).alias("r"), F.count_if(s.is_viewed()).alias("v"))
    return counts.select("person", s.safe_ratio("v", "r").alias("view_rate_or_zero"), s.ratio_or_null("v", "r").alias("view_rate_or_null"))


@query("p14_offer_features", """
SELECT id, offer_type, difficulty, reward, duration, CAST(offer_type = 'bogo' AS INT) offer_type_bogo, CAST(offer_type = 'discount' AS INT) offer_type_discount,
       CAST(offer_type = 'informational' AS INT) offer_type_informational, CAST(list_contains(channels, 'email') AS INT) channel_email,
       CAST(list_contains(channels, 'mobile') AS INT) channel_mobile, CAST(list_contains(channels, 'social') AS INT) channel_social,
       CAST(list_contains(channels, 'web') AS INT) channel_web, difficulty * reward difficulty_x_reward, difficulty * duration difficulty_x_duration,
       reward / duration reward_per_day, difficulty / duration difficulty_per_day FROM portfolio""", doubles="reward_per_day difficulty_per_day")
def offers(d: Inputs):
    return ft.offer_features(d.portfolio)


@query("p15_channel_flags", """
SELECT id, CAST(list_contains(channels, 'email') AS INT) email, CAST(list_contains(channels, 'web') AS INT) web,
       CAST(len(channels) AS INT) channel_count FROM portfolio""")
def channel_flags(d: Inputs):
    return d.portfolio.select("id", s.has_channel("email").alias("email"), s.has_channel("web").alias("web"), F.size("channels").alias("channel_count"))


@query("p16_exploded_channels", "SELECT id, unnest(channels) channel FROM portfolio")
def exploded(d: Inputs):
    return d.portfolio.select("id", F.explode("channels").alias("channel"))


@query("p17_channel_universe", "SELECT DISTINCT channel FROM (SELECT unnest(channels) channel FROM portfolio)")
def universe(d: Inputs):
    return ft.channel_universe(d.portfolio)


@query("p18_event_dates", """
SELECT strftime(t, '%Y-%m-%d') date_key, dayname(t) day_name, CAST(hour(t) AS INT) hour_of_day, count(*) n
FROM (SELECT TIMESTAMP '2018-07-26' - to_hours(time) t FROM ev) GROUP BY ALL""")
def event_dates(d: Inputs):
    when = d.events.select(s.event_time().alias("t"))
    return when.groupBy(F.date_format("t", "yyyy-MM-dd").alias("date_key"), F.date_format("t", "EEEE").alias("day_name"),
                        F.hour("t").alias("hour_of_day")).agg(F.count(F.lit(1)).alias("n"))


@query("p19_day_index", "SELECT CAST(time // 24 AS INT) day_since_start, count(*) n FROM ev GROUP BY 1")
def day_index(d: Inputs):
    return d.events.groupBy(F.floor(F.col("time") / 24).cast("int").alias("day_since_start")).agg(F.count(F.lit(1)).alias("n"))


@query("p20_clean_names", """
SELECT replace(event, 'offer ', '') event_type,
       list_aggregate(list_transform(string_split(replace(event, '_', ' '), ' '), lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ') title, count(*) n
FROM ev GROUP BY event""")
def clean_names(d: Inputs):
    return d.events.groupBy("event").agg(F.count(F.lit(1)).alias("n")).select(
        F.regexp_replace("event", "offer ", "").alias("event_type"), s.title_case("event").alias("title"), "n")


@query("p21_tiers", """
SELECT id, CASE WHEN rfm_score IS NULL THEN 'Unknown' WHEN rfm_score >= 9 THEN 'Champions' WHEN rfm_score >= 7 THEN 'Loyal' WHEN rfm_score >= 5 THEN 'Potential'
                WHEN rfm_score >= 3 THEN 'At Risk' ELSE 'Lost' END rfm_segment,
       CASE WHEN completion_rate <= -0.001 THEN NULL WHEN completion_rate <= 0.3 THEN 'Low' WHEN completion_rate <= 0.6 THEN 'Medium'
            WHEN completion_rate <= 1.0 THEN 'High' END engagement_level
FROM rf JOIN beh USING (id)""")
def tiers(d: Inputs):
    return d.features.select("id", s.rfm_segment().alias("rfm_segment"), s.cut("completion_rate", *k.ENGAGEMENT_BINS).alias("engagement_level"))


@query("p23_clv_proxy", "SELECT id, trans_total * (1 + completion_rate) clv_proxy FROM beh", doubles="clv_proxy")
def clv(d: Inputs):
    return ft.behavioural_features(d.profile, d.events, d.portfolio).select("id", s.clv_proxy().alias("clv_proxy"))


@query("p24_select_existing", "SELECT id customer_id, income FROM profile")
def existing(d: Inputs):
    return s.select_existing(d.profile, {"id": "customer_id", "income": "income", "not_there": "dropped"})


@query("p25_min_max", """
SELECT id, (income - (SELECT min(income) FROM profile)) / ((SELECT max(income) FROM profile) - (SELECT min(income) FROM profile)) income,
       (age - (SELECT min(age) FROM profile)) / ((SELECT max(age) FROM profile) - (SELECT min(age) FROM profile)) age FROM profile""", doubles="income age")
def min_max(d: Inputs):
    return s.min_max_scale(d.profile.select("id", "income", "age"), ["income", "age"])


@query("a01_transaction_stats", "SELECT * FROM beh_txn", doubles=MONEY, coarse="trans_std")
def transaction_stats(d: Inputs):
    activity = ft.customer_activity(d.events, d.portfolio)
    return activity.filter("frequency > 0").select("person", *ft.SPEND).fillna(0.0, ["trans_std"])


@query("a02_event_counts", "SELECT person, offers_received, offers_viewed, offers_completed FROM beh_cnt")
def event_counts(d: Inputs):
    activity = ft.customer_activity(d.events.filter(F.col("offer_id").isNotNull()), d.portfolio)
    return activity.select("person", *ft.OFFERS)


@query("a03_type_event_counts", "SELECT * EXCLUDE (offers_received, offers_viewed, offers_completed) FROM beh_cnt")
def type_event_counts(d: Inputs):
    activity = ft.customer_activity(d.events.filter(F.col("offer_id").isNotNull()), d.portfolio)
    return activity.select("person", *ft.TYPE_COUNTS)


@query("j01_behavioural_features", "SELECT * FROM beh", doubles=f"{MONEY} {BEH_RATES}", coarse="trans_std")
def behaviour(d: Inputs):
    return ft.behavioural_features(d.profile, d.events, d.portfolio)


@query("a04_response_rates", f"SELECT id, {BEH_RATES.replace(' ', ', ')} FROM beh", doubles=BEH_RATES)
def response_rates(d: Inputs):
    return ft.behavioural_features(d.profile, d.events, d.portfolio).select("id", *ft.RATES)


@query("j02_offer_join", """
SELECT offer_id, event, offer_type, difficulty, count(*) n FROM oe GROUP BY ALL""")
def offer_join(d: Inputs):
    from ..operators.funnel import with_offer
    return with_offer(d.events, d.portfolio, ["offer_type", "difficulty"]).groupBy("offer_id", "event", "offer_type", "difficulty").agg(
        F.count(F.lit(1)).alias("n"))


@query("j06_customer_offer_pairs", """
SELECT p.id customer_id, o.id offer_id, p.age, o.offer_type FROM profile p CROSS JOIN portfolio o""")
def pairs(d: Inputs):
    return ft.customer_offer_pairs(d.profile.select("id", "age"), d.portfolio.select("id", "offer_type"))


LABELS = """
SELECT p.id customer_id, o.id offer_id, CAST(c.person IS NOT NULL AS INT) completed
FROM profile p CROSS JOIN portfolio o LEFT JOIN (SELECT * FROM ev WHERE event = 'offer completed' AND offer_id IS NOT NULL) c ON p.id = c.person AND o.id = c.offer_id"""


@query("j07_labelled_pairs", LABELS)
def labels(d: Inputs):
    return ft.all_labelled_pairs(d.profile.select("id"), d.portfolio.select("id"), d.events)


@query("j07_labelled_pairs_once", f"SELECT DISTINCT * FROM ({LABELS})")
def labels_once(d: Inputs):
    return ft.all_labelled_pairs(d.profile.select("id"), d.portfolio.select("id"), d.events, dedupe=True)


@query("j10_full_outer", """
SELECT coalesce(p.id, e.id) id, p.age, e.n_events FROM profile p FULL JOIN (SELECT person id, count(*) n_events FROM ev GROUP BY person) e ON p.id = e.id""")
def outer(d: Inputs):
    counts = d.events.groupBy(F.col("person").alias("id")).agg(F.count(F.lit(1)).alias("n_events"))
    return ft.full_outer(d.profile.select("id", "age"), counts)


@query("j11_feature_chain", """
SELECT d.id, d.age_imputed, y.*EXCLUDE (id), t.* EXCLUDE (id) FROM demo d LEFT JOIN decay y USING (id) LEFT JOIN timing t USING (id)""",
       doubles="age_imputed spend_last_7d spend_last_14d spend_trend offer_recency_days avg_time_to_view avg_time_to_complete")
def chain(d: Inputs):
    return ft.join_features(ft.demographic_features(d.profile).select("id", "age_imputed"),
                            ft.time_decay_features(d.profile, d.events, d.portfolio), ft.timing_features(d.profile, d.events))


VIEWED_SQL = """
SELECT v.person customer_id, v.offer_id, CAST(list_contains(channels, 'email') AS INT) viewed_via_email, CAST(list_contains(channels, 'mobile') AS INT) viewed_via_mobile,
       CAST(list_contains(channels, 'social') AS INT) viewed_via_social, CAST(list_contains(channels, 'web') AS INT) viewed_via_web, c.total_channels_used
FROM (SELECT DISTINCT person, offer_id FROM ev WHERE event = 'offer viewed') v LEFT JOIN portfolio p ON v.offer_id = p.id LEFT JOIN channels_used c ON v.person = c.id"""


@query("a20_channels_used", "SELECT * FROM channels_used")
def channels_used(d: Inputs):
    return ft.channels_used(d.events, d.portfolio)


@query("a21_viewed_channels", VIEWED_SQL)
def viewed_channels(d: Inputs):
    return ft.viewed_channels(d.events, d.portfolio)


@query("j13_pair_view_flags", f"""
SELECT p.customer_id, p.offer_id, coalesce(viewed_via_email, 0) viewed_via_email, coalesce(viewed_via_mobile, 0) viewed_via_mobile,
       coalesce(viewed_via_social, 0) viewed_via_social, coalesce(viewed_via_web, 0) viewed_via_web, v.total_channels_used
FROM (SELECT p.id customer_id, o.id offer_id FROM profile p CROSS JOIN portfolio o) p LEFT JOIN ({VIEWED_SQL}) v
ON p.customer_id = v.customer_id AND p.offer_id = v.offer_id""")
def pair_view_flags(d: Inputs):
    return ft.all_view_flags(d.profile.select("id"), d.portfolio, d.events)


@query("t01_rfm_features", "SELECT * FROM rf", doubles="recency_days monetary")
def rfm(d: Inputs):
    return ft.rfm_features(d.profile, d.events, d.portfolio)


@query("t03_time_decay", "SELECT * FROM decay", doubles="spend_last_7d spend_last_14d spend_trend offer_recency_days")
def decay(d: Inputs):
    return ft.time_decay_features(d.profile, d.events, d.portfolio)


@query("t06_response_times", "SELECT * FROM timing", doubles="avg_time_to_view avg_time_to_complete")
def timing(d: Inputs):
    return ft.timing_features(d.profile, d.events)


FEATURE_DOUBLES = (f"{DEMO_DOUBLES} {MONEY} {BEH_RATES} recency_days monetary spend_last_7d spend_last_14d spend_trend offer_recency_days "
                   "avg_time_to_view avg_time_to_complete clv_proxy")


@query("f03_customer_features", "SELECT * FROM cf", doubles=FEATURE_DOUBLES, coarse="trans_std")
def features(d: Inputs):
    return d.features


@query("a27_interaction_summary", f"""
SELECT completed, count(*) n_rows FROM ({LABELS}) GROUP BY completed""")
def label_distribution(d: Inputs):
    return ft.pair_label_counts(d.profile, d.portfolio, d.events)


@query("a27_feature_summary", f"""
SELECT 'offer_features' table_name, count(*) n_rows, 11 n_features FROM portfolio UNION ALL
SELECT 'demographic_features', count(*), 18 FROM profile UNION ALL SELECT 'behavioural_features', count(*), 25 FROM profile UNION ALL
SELECT 'rfm_features', count(*), 7 FROM profile UNION ALL SELECT 'time_decay_features', count(*), 4 FROM profile UNION ALL
SELECT 'customer_features', count(*), 54 FROM profile UNION ALL SELECT 'interaction_features', count(*), 74 FROM ({LABELS}) UNION ALL
SELECT 'channel_customer_features', count(*), 1 FROM channels_used""")
def feature_summary(d: Inputs):
    people = ["id"]
    return ft.feature_summary(
        {"offer_features": ft.offer_features(d.portfolio), "demographic_features": ft.demographic_features(d.profile),
         "behavioural_features": ft.behavioural_features(d.profile, d.events, d.portfolio), "rfm_features": ft.rfm_features(d.profile, d.events, d.portfolio),
         "time_decay_features": ft.time_decay_features(d.profile, d.events, d.portfolio), "customer_features": d.features,
         "interaction_features": ft.interaction_features(d.features, d.events, d.portfolio), "channel_customer_features": ft.channels_used(d.events, d.portfolio)},
        {"offer_features": ["id", "offer_type", "difficulty", "reward", "duration"], "demographic_features": people, "behavioural_features": people,
         "rfm_features": people, "time_decay_features": people, "customer_features": people, "channel_customer_features": people,
         "interaction_features": ["customer_id", "offer_id", "completed"]})


@query("f01_standardise", """
SELECT l_orderkey, l_linenumber, (l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER () l_quantity,
       (l_discount - avg(l_discount) OVER ()) / stddev_pop(l_discount) OVER () l_discount FROM lineitem""", coarse="l_quantity l_discount")
def standardised(d: Inputs):
    return s.standardise(d.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount"),
                         ["l_quantity", "l_discount", "not_there"])


POSITIONS = """
SELECT row_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(concat(CAST(row_id AS VARCHAR), ':42'))) p, count(*) OVER (PARTITION BY label) n FROM scored"""


@query("f04_stratified_split", f"SELECT row_id, label, CAST(p <= round(n * CAST(0.2 AS DOUBLE)) AS INT) is_test FROM ({POSITIONS})")
def split(d: Inputs):
    return ft.stratified_split(d.scored.select("row_id", "label"), "label", "row_id")


@query("f05_stratified_folds", f"SELECT row_id, label, CAST(p % 5 AS INT) fold FROM ({POSITIONS})")
def folds(d: Inputs):
    return ft.stratified_folds(d.scored.select("row_id", "label"), "label", "row_id")


@query("f06_class_weights", """
SELECT count(*) FILTER (label = 0) n_negative, count(*) FILTER (label = 1) n_positive, n_negative / n_positive positive_weight FROM scored""", doubles="positive_weight")
def weights(d: Inputs):
    return ft.class_weights(d.scored, "label")


@query("w11_sample_ids", "SELECT id FROM profile ORDER BY md5(concat(id, ':42')), id LIMIT 100")
def sample(d: Inputs):
    return ft.sample_ids(d.profile, "id", 100)
