"""Funnels, response times, cohorts and channels."""

from pyspark.sql import functions as F

from ..functions.constants import COMPLETED, OFFER_TYPES, VIEWED
from ..functions.scalars import is_transaction
from ..operators import funnel as f
from .registry import Inputs, query

RATES = "view_rate completion_rate view_to_completion_rate"


@query("a05_offer_funnel", "SELECT * FROM offer_stats", doubles=RATES)
def offer_funnel(d: Inputs):
    return f.offer_funnel(d.events, d.portfolio)


@query("a06_rates_by_type", """
SELECT offer_type, count(*) n_offers, avg(view_rate) view_rate, avg(completion_rate) completion_rate,
       avg(view_to_completion_rate) view_to_completion_rate FROM offer_stats WHERE offer_type IS NOT NULL GROUP BY offer_type""", doubles=RATES)
def rates_by_type(d: Inputs):
    return f.rates_by_type(f.offer_funnel(d.events, d.portfolio))


@query("a07_overall_funnel", """
SELECT count(*) FILTER (event = 'offer received') total_received, count(*) FILTER (event = 'offer viewed') total_viewed,
       count(*) FILTER (event = 'offer completed') total_completed, total_viewed / total_received view_rate,
       total_completed / total_received completion_rate, total_completed / total_viewed view_to_completion_rate
FROM ev WHERE offer_id IS NOT NULL""", doubles=RATES)
def overall_funnel(d: Inputs):
    return f.overall_funnel(d.events)


@query("a08_funnel_by_type", """
SELECT offer_type, count(*) FILTER (event = 'offer received') received, count(*) FILTER (event = 'offer viewed') viewed,
       count(*) FILTER (event = 'offer completed') completed FROM oe WHERE offer_type IS NOT NULL GROUP BY offer_type""")
def funnel_by_type(d: Inputs):
    return f.funnel_by_type(d.events, d.portfolio)


@query("j04_receipt_view_pairs", """
SELECT r.person, r.offer_id, r.time receive_time, v.time later_time, v.time - r.time gap_hours, count(*) n_pairs
FROM ev r LEFT JOIN (SELECT * FROM ev WHERE event = 'offer viewed') v ON r.person = v.person AND r.offer_id = v.offer_id
WHERE r.event = 'offer received' AND r.offer_id IS NOT NULL GROUP BY ALL""")
def view_pairs(d: Inputs):
    return f.gap_pairs(d.events, VIEWED, "left")


@query("a09_time_to_view", """
SELECT count(*) AS count, avg(g) mean, stddev_samp(g) std, min(g) min, quantile_cont(g, 0.25) p25, median(g) p50,
       quantile_cont(g, 0.75) p75, max(g) max
FROM (SELECT v.time - r.time g FROM ev r JOIN ev v ON r.person = v.person AND r.offer_id = v.offer_id
      WHERE r.event = 'offer received' AND v.event = 'offer viewed')""", doubles="mean std p25 p50 p75")
def time_to_view(d: Inputs):
    return f.gap_statistics(f.gap_pairs(d.events, VIEWED, "inner"))


@query("j05_time_to_complete", """
SELECT r.person, r.offer_id, r.time receive_time, c.time complete_time, c.time - r.time time_to_complete, count(*) n_pairs, any_value(p.offer_type) offer_type
FROM ev r JOIN ev c ON r.person = c.person AND r.offer_id = c.offer_id LEFT JOIN portfolio p ON r.offer_id = p.id
WHERE r.event = 'offer received' AND c.event = 'offer completed' GROUP BY r.person, r.offer_id, r.time, c.time""")
def complete_pairs(d: Inputs):
    return f.time_to_complete(d.events, d.portfolio)


@query("w04_first_times", """
SELECT person, offer_id, rt received_time, vt viewed_time, ct completed_time FROM first_times""")
def first_times(d: Inputs):
    return f.first_times(d.events)


@query("j03_first_view_after_receipt", """
SELECT person, offer_id, rt received_time, vt viewed_time, vt - rt AS hours FROM first_times WHERE vt >= rt""")
def first_views(d: Inputs):
    return f.first_response_pairs(d.events, "viewed")


@query("j03_first_completion_after_receipt", """
SELECT person, offer_id, rt received_time, ct completed_time, ct - rt AS hours FROM first_times WHERE ct >= rt""")
def first_completions(d: Inputs):
    return f.first_response_pairs(d.events, "completed")


@query("a10_describe_amounts", """
SELECT 'amount' metric, count(amount) AS count, avg(amount) mean, stddev_samp(amount) std, min(amount) min, quantile_cont(amount, 0.25) p25,
       median(amount) p50, quantile_cont(amount, 0.75) p75, max(amount) max FROM ev WHERE event = 'transaction'""",
       doubles="p25 p50 p75", coarse="mean std")
def describe_amounts(d: Inputs):
    return f.describe(d.events.filter(is_transaction()), ["amount"])


@query("a11_demographic_summary", """
SELECT 'age' metric, count(age) n, avg(age) mean, median(age) median, CAST(min(age) AS DOUBLE) min, CAST(max(age) AS DOUBLE) max
FROM profile WHERE age <> 118 UNION ALL
SELECT 'income', count(income), avg(income), median(income), min(income), max(income) FROM profile WHERE income IS NOT NULL UNION ALL
SELECT 'tenure_days', count(tenure_days), avg(tenure_days), median(tenure_days), min(tenure_days), max(tenure_days) FROM demo""", doubles="mean median")
def demographics(d: Inputs):
    return f.demographic_summary(d.profile)


@query("a12_customer_transactions", "SELECT * FROM cust_txn", doubles="trans_total trans_avg", coarse="trans_std")
def customer_transactions(d: Inputs):
    return f.customer_transactions(d.events)


@query("a13_responder_comparison", """
SELECT is_responder, count(*) n_customers, avg(trans_count) avg_trans_count, avg(trans_avg) avg_trans_amount, avg(trans_total) avg_total_spend
FROM cust_txn GROUP BY is_responder""", doubles="avg_trans_count", coarse="avg_trans_amount avg_total_spend")
def responder_comparison(d: Inputs):
    return f.responder_comparison(f.customer_transactions(d.events))


@query("j08_responder_transactions", """
SELECT person, count(*) n_transactions FROM ev WHERE event = 'transaction' AND person IN (SELECT person FROM responder) GROUP BY person""")
def responder_rows(d: Inputs):
    kept = d.events.filter(is_transaction()).join(f.responders(d.events), "person", "left_semi")
    return kept.groupBy("person").agg(F.count(F.lit(1)).alias("n_transactions"))


@query("j09_non_responder_transactions", """
SELECT person, count(*) n_transactions FROM ev WHERE event = 'transaction' AND person NOT IN (SELECT person FROM responder) GROUP BY person""")
def non_responder_rows(d: Inputs):
    kept = d.events.filter(is_transaction()).join(f.responders(d.events), "person", "left_anti")
    return kept.groupBy("person").agg(F.count(F.lit(1)).alias("n_transactions"))


COHORT_ROWS = """
SELECT p.id, CAST(p.became_member_on // 10000 AS INT) join_year, coalesce(r.n, 0) n_received, coalesce(c.n, 0) n_completed, coalesce(v.n, 0) n_viewed
FROM profile p LEFT JOIN (SELECT person, count(*) n FROM ev WHERE event = 'offer received' GROUP BY person) r ON p.id = r.person
LEFT JOIN (SELECT person, count(*) n FROM ev WHERE event = 'offer completed' GROUP BY person) c ON p.id = c.person
LEFT JOIN (SELECT person, count(*) n FROM ev WHERE event = 'offer viewed' GROUP BY person) v ON p.id = v.person"""


@query("a14_cohorts", f"""
SELECT join_year, count(id) n_customers, CAST(sum(n_received) AS BIGINT) total_received, CAST(sum(n_completed) AS BIGINT) total_completed,
       CAST(sum(n_viewed) AS BIGINT) total_viewed, total_completed / nullif(total_received, 0) completion_rate,
       total_viewed / nullif(total_received, 0) view_rate, total_completed / n_customers avg_completed_per_person
FROM ({COHORT_ROWS}) GROUP BY join_year""", doubles="completion_rate view_rate avg_completed_per_person")
def cohorts(d: Inputs):
    return f.cohorts(d.profile, d.events)


@query("j12_cohort_rows", COHORT_ROWS)
def cohort_rows(d: Inputs):
    counts = f.person_stage_counts(d.events).withColumnRenamed("person", "id")
    joined = d.profile.select("id", F.year(f.member_date()).alias("join_year")).join(counts, "id", "left")
    return joined.fillna(0, ["n_received", "n_completed", "n_viewed"])


CHANNEL_CTE = """
SELECT c.channel, list_contains(oe.channels, c.channel) used, event, offer_type
FROM oe CROSS JOIN (VALUES ('email'), ('mobile'), ('social'), ('web')) c(channel) WHERE oe.channels IS NOT NULL"""


@query("a15_channel_effectiveness", f"""
SELECT channel, count(*) FILTER (used AND event = 'offer received') n_received_with, count(*) FILTER (NOT used AND event = 'offer received') n_received_without,
       count(*) FILTER (used AND event = 'offer viewed') / nullif(n_received_with, 0) view_rate_with,
       count(*) FILTER (NOT used AND event = 'offer viewed') / nullif(n_received_without, 0) view_rate_without,
       count(*) FILTER (used AND event = 'offer completed') / nullif(n_received_with, 0) completion_rate_with,
       count(*) FILTER (NOT used AND event = 'offer completed') / nullif(n_received_without, 0) completion_rate_without
FROM ({CHANNEL_CTE}) GROUP BY channel""", doubles="view_rate_with view_rate_without completion_rate_with completion_rate_without")
def channel_effectiveness(d: Inputs):
    return f.channel_effectiveness(d.events, d.portfolio)


BY_TYPE = f"""
SELECT offer_type, channel, count(*) FILTER (used AND event = 'offer viewed') / nullif(count(*) FILTER (used AND event = 'offer received'), 0) view_rate,
       count(*) FILTER (used AND event = 'offer completed') / nullif(count(*) FILTER (used AND event = 'offer received'), 0) completion_rate,
       count(*) FILTER (used AND event = 'offer received') n_received
FROM ({CHANNEL_CTE}) WHERE offer_type IS NOT NULL GROUP BY offer_type, channel"""


@query("a16_channel_by_type", BY_TYPE, doubles="view_rate completion_rate")
def channel_by_type(d: Inputs):
    return f.channel_by_type(d.events, d.portfolio)


@query("a17_channel_type_matrix", f"""
SELECT channel, max(view_rate) FILTER (offer_type = 'bogo') bogo, max(view_rate) FILTER (offer_type = 'discount') discount,
       max(view_rate) FILTER (offer_type = 'informational') informational FROM ({BY_TYPE}) GROUP BY channel""", doubles="bogo discount informational")
def channel_type_matrix(d: Inputs):
    return f.channel_type_matrix(f.channel_by_type(d.events, d.portfolio), "view_rate", OFFER_TYPES)


@query("a18_channel_event_counts", """
SELECT offer_type, channel, count(*) FILTER (event = 'offer received') received, count(*) FILTER (event = 'offer viewed') viewed,
       count(*) FILTER (event = 'offer completed') completed, completed / nullif(received, 0) completion_rate
FROM (SELECT offer_type, event, unnest(channels) channel FROM oe) GROUP BY offer_type, channel""", doubles="completion_rate")
def channel_event_counts(d: Inputs):
    return f.channel_event_counts(d.events, d.portfolio)


INDICATOR = """
SELECT offer_type, person, CAST(max(CASE WHEN event = 'offer completed' THEN 1 ELSE 0 END) AS INT) completed,
       count(*) FILTER (event = 'offer received') n_received, count(*) FILTER (event = 'offer completed') n_completed
FROM oe WHERE offer_type IS NOT NULL GROUP BY offer_type, person"""


@query("h13_completion_indicator", INDICATOR)
def completion_indicator(d: Inputs):
    return f.completion_indicator(d.events, d.portfolio)


@query("h13_completion_rates", f"""
SELECT offer_type, count(*) n_persons, avg(completed) person_completion_rate,
       CASE WHEN sum(n_received) > 0 THEN sum(n_completed) / sum(n_received) ELSE 0.0 END event_completion_rate
FROM ({INDICATOR}) GROUP BY offer_type""", doubles="person_completion_rate event_completion_rate")
def completion_rates(d: Inputs):
    return f.completion_rates(f.completion_indicator(d.events, d.portfolio))


@query("a22_persons_by_type", """
SELECT offer_type, count(DISTINCT person) FILTER (event = 'offer received') n_received, count(DISTINCT person) FILTER (event = 'offer completed') n_completed,
       CASE WHEN n_received > 0 THEN n_completed / n_received ELSE 0.0 END completion_rate
FROM oe WHERE offer_type IS NOT NULL GROUP BY offer_type""", doubles="completion_rate")
def persons_by_type(d: Inputs):
    return f.persons_by_type(d.events, d.portfolio)


@query("a07_funnel_stages", """
SELECT 1 AS position, 'received' stage, count(*) FILTER (event = 'offer received') n_events, 1.0::DOUBLE share_of_received FROM oe UNION ALL
SELECT 2, 'viewed', count(*) FILTER (event = 'offer viewed') n, n / count(*) FILTER (event = 'offer received') FROM oe UNION ALL
SELECT 3, 'completed', count(*) FILTER (event = 'offer completed') n, n / count(*) FILTER (event = 'offer received') FROM oe""", doubles="share_of_received")
def funnel_stages(d: Inputs):
    return f.funnel_stages(f.overall_funnel(d.events))


@query("w06_largest_completion_rates", """
SELECT offer_id, offer_type, completion_rate FROM offer_stats ORDER BY completion_rate DESC, offer_id LIMIT 5""", doubles="completion_rate")
def top_offers(d: Inputs):
    return f.largest(f.offer_funnel(d.events, d.portfolio).select("offer_id", "offer_type", "completion_rate"), "completion_rate", 5, "offer_id")


@query("u03_completed_and_paid", """
SELECT person FROM ev WHERE event = 'offer completed' INTERSECT SELECT person FROM ev WHERE event = 'transaction'""")
def intersection(d: Inputs):
    completed = d.events.filter(F.col("event") == COMPLETED).select("person")
    return completed.intersect(d.events.filter(is_transaction()).select("person"))


@query("u02_never_received", """
SELECT id FROM profile EXCEPT SELECT person FROM ev WHERE event = 'offer received'""")
def difference(d: Inputs):
    return d.profile.select("id").subtract(d.events.filter(f.is_received()).select("person"))
