"""Scans and data quality over the test tables."""

from pyspark.sql import functions as F

from ..functions.constants import AGE_SENTINEL, EVENTS, OFFER_TYPES
from ..functions.scale import remove, scratch
from ..operators import quality as q
from ..sources.readers import read_json, read_json_lines, read_table
from ..sources.writers import write_table
from .registry import Inputs, query


def _stored(d: Inputs, name: str, write):
    """Count and sums of what ``write`` (given a path in the shared folder) reads back; the files go again."""
    path = scratch(d.spark, name)
    try:
        return d.spark.createDataFrame(write(path).agg(
            F.count(F.lit(1)).alias("n_rows"), F.count("person").alias("n_persons"), F.count_distinct("person").alias("n_distinct"),
            F.sum(F.col("time").cast("long")).alias("sum_time"), F.count("value_amount").alias("n_amounts"),
            F.sum(F.col("value_amount").cast("decimal(18,2)")).cast("double").alias("sum_amount")).collect(),
            "n_rows long, n_persons long, n_distinct long, sum_time long, n_amounts long, sum_amount double")
    finally:
        remove(d.spark, path)


STORED = """
SELECT count(*) n_rows, count(person) n_persons, count(DISTINCT person) n_distinct, CAST(sum(time) AS BIGINT) sum_time, count(value_amount) n_amounts,
       CAST(sum(CAST(value_amount AS DECIMAL(18,2))) AS DOUBLE) sum_amount FROM transcript"""
FLAT = "person string, event string, time int, value_offer_id_space string, value_offer_id string, value_amount double"


@query("s05_parquet_round_trip", STORED, coarse="sum_amount")
def parquet_round_trip(d: Inputs):
    return _stored(d, "parquet", lambda path: read_table(d.spark, write_table(d.transcript, path)))


@query("s06_csv_round_trip", STORED, coarse="sum_amount")
def csv_round_trip(d: Inputs):
    return _stored(d, "csv", lambda path: read_table(d.spark, write_table(d.transcript, path, "csv"), FLAT))


@query("s02_json_lines_round_trip", STORED, coarse="sum_amount")
def json_lines_round_trip(d: Inputs):
    return _stored(d, "json", lambda path: read_json_lines(d.spark, write_table(d.transcript, path, "json"), FLAT))


@query("s01_json_with_rejects", """
SELECT 'lines' layout, count(*) n_rows, count(*) FILTER (time % 7 = 3) n_rejects, count(DISTINCT person) n_keys, CAST(sum(time) AS BIGINT) total FROM transcript
UNION ALL SELECT 'array', count(*), 1, count(DISTINCT id), CAST(sum(reward) AS BIGINT) FROM portfolio""")
def json_with_rejects(d: Inputs):
    """All events as lines, every row of some hours also cut off; the catalogue as one array with a broken element."""
    lines, array = scratch(d.spark, "lines"), scratch(d.spark, "array")
    try:
        line = F.to_json(F.struct(*d.transcript.columns))
        copies = F.when(F.col("time") % 7 == 3, F.array(line, F.expr("left(line, length(line) - 1)"))).otherwise(F.array(line))
        d.transcript.withColumn("line", line).select(F.explode(copies).alias("value")).write.text(lines)
        elements = F.concat(F.array_sort(F.collect_list(F.to_json(F.struct("id", "reward")))), F.array(F.lit('{"id": "x", "reward": }')))
        d.portfolio.agg(F.concat(F.lit("[\n"), F.array_join(elements, ",\n"), F.lit("\n]")).alias("value")).write.text(array)
        found = []
        for layout, path, schema, key, value in (("lines", lines, FLAT, "person", "time"), ("array", array, "id string, reward int", "id", "reward")):
            good, bad = read_json(d.spark, path, schema)
            sums = good.agg(F.count(F.lit(1)), F.count_distinct(key), F.sum(F.col(value).cast("long"))).first()
            found.append((layout, sums[0], bad.count(), sums[1], sums[2]))
    finally:
        remove(d.spark, lines)
        remove(d.spark, array)
    return d.spark.createDataFrame(found, "layout string, n_rows bigint, n_rejects bigint, n_keys bigint, total bigint")


@query("q02_shape_and_types", """
SELECT 'profile' dataset, (SELECT count(*) FROM profile) n_rows, 5 n_columns, * FROM (VALUES
 ('id', 'string'), ('age', 'int'), ('gender', 'string'), ('income', 'double'), ('became_member_on', 'int')) t(column_name, data_type)""")
def shape(d: Inputs):
    return q.column_types(d.profile, "profile")


@query("q03_null_counts", """
SELECT 'person' column_name, count(*) FILTER (person IS NULL) n_null FROM ev UNION ALL
SELECT 'event', count(*) FILTER (event IS NULL) FROM ev UNION ALL SELECT 'time', count(*) FILTER (time IS NULL) FROM ev UNION ALL
SELECT 'offer_id', count(*) FILTER (offer_id IS NULL) FROM ev UNION ALL SELECT 'amount', count(*) FILTER (amount IS NULL) FROM ev""")
def nulls(d: Inputs):
    return q.null_counts(d.events)


@query("q04_distinct_counts", """
SELECT 'id' column_name, count(DISTINCT id) n_distinct FROM profile UNION ALL SELECT 'age', count(DISTINCT age) FROM profile UNION ALL
SELECT 'gender', count(DISTINCT gender) FROM profile UNION ALL SELECT 'income', count(DISTINCT income) FROM profile UNION ALL
SELECT 'became_member_on', count(DISTINCT became_member_on) FROM profile""")
def distincts(d: Inputs):
    return q.distinct_counts(d.profile)


@query("q05_invalid_events", """
SELECT event invalid_value, count(*) n_rows FROM ev
WHERE event NOT IN ('transaction', 'offer received', 'offer viewed', 'offer completed') GROUP BY event""")
def invalid(d: Inputs):
    return q.invalid_values(d.events, "event", EVENTS)


@query("q05_invalid_offer_types", """
SELECT offer_type invalid_value, count(*) n_rows FROM portfolio WHERE offer_type NOT IN ('bogo', 'discount', 'informational') GROUP BY 1""")
def invalid_types(d: Inputs):
    return q.invalid_values(d.portfolio, "offer_type", OFFER_TYPES)


@query("q06_numeric_checks", """
SELECT 'difficulty' column_name, true is_numeric, CAST(min(difficulty) AS DOUBLE) min_value, min(difficulty) < 0 has_negative FROM portfolio UNION ALL
SELECT 'reward', true, CAST(min(reward) AS DOUBLE), min(reward) < 0 FROM portfolio UNION ALL
SELECT 'duration', true, min(duration), min(duration) < 0 FROM portfolio UNION ALL
SELECT 'offer_type', false, NULL, false""")
def numeric(d: Inputs):
    return q.numeric_checks(d.portfolio, ["difficulty", "reward", "duration", "offer_type"])


@query("q07_sentinel_count", """
SELECT count(*) FILTER (age = 118) n_sentinel, count(*) n_rows, n_sentinel / n_rows sentinel_rate FROM profile""", doubles="sentinel_rate")
def sentinel(d: Inputs):
    return q.sentinel_count(d.profile)


@query("q08_stats_without_sentinel", """
SELECT min(age) min_value, max(age) max_value, avg(age) mean_value, count(age) n_values, median(age) median_value
FROM profile WHERE age <> 118""", doubles="mean_value median_value")
def valid_ages(d: Inputs):
    return q.stats_without_sentinel(d.profile)


@query("q09_gender_frequencies", "SELECT gender, count(*) n_rows FROM profile WHERE gender IS NOT NULL GROUP BY gender")
def genders(d: Inputs):
    return q.value_frequencies(d.profile, "gender")


@query("q09_event_frequencies", "SELECT event, count(*) n_rows FROM ev WHERE event IS NOT NULL GROUP BY event")
def event_mix(d: Inputs):
    return q.value_frequencies(d.events, "event")


@query("q10_time_range", """
SELECT min(time) min_time, max(time) max_time, CAST(CASE WHEN max(time) > 0 THEN max(time) // 24 ELSE 0 END AS INT) duration_days FROM ev""")
def time_range(d: Inputs):
    return q.time_range(d.events)


@query("q11_payload_scan", """
SELECT count(amount) n_amounts, min(amount) min_amount, max(amount) max_amount,
       CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) / count(amount) mean_amount, count(DISTINCT offer_id) n_distinct_offers
FROM ev""", doubles="mean_amount")
def payloads(d: Inputs):
    return q.payload_scan(d.events)


@query("q12_referential_integrity", """
SELECT (SELECT count(*) FROM (SELECT id FROM profile EXCEPT SELECT person FROM ev)) customers_not_in_transcript,
       (SELECT count(*) FROM (SELECT person FROM ev EXCEPT SELECT id FROM profile)) customers_in_transcript_not_in_profile,
       (SELECT count(*) FROM (SELECT id FROM portfolio EXCEPT SELECT offer_id FROM ev)) offers_not_in_transcript,
       (SELECT count(*) FROM (SELECT offer_id FROM ev WHERE offer_id IS NOT NULL EXCEPT SELECT id FROM portfolio)) offers_in_transcript_not_in_portfolio""")
def integrity(d: Inputs):
    return q.referential_integrity(d.portfolio, d.profile, d.events)


@query("q13_dataset_summary", """
SELECT (SELECT count(*) FROM portfolio) total_offers, (SELECT count(*) FROM profile) total_customers, count(*) total_events,
       count(DISTINCT person) unique_customers_in_transcript, CAST(max(time) // 24 AS INT) date_range_days FROM ev""")
def summary(d: Inputs):
    return q.dataset_summary(d.portfolio, d.profile, d.events)


@query("q14_missing_together", """
SELECT count(*) FILTER (gender IS NULL AND income IS NULL AND age = 118) n_missing_all FROM profile""")
def together(d: Inputs):
    return q.missing_together(d.profile)


@query("q15_missing_rates", """
SELECT 'gender' field, count(*) FILTER (gender IS NULL) n_missing, n_missing / count(*) missing_rate FROM profile UNION ALL
SELECT 'income', count(*) FILTER (income IS NULL) m, m / count(*) FROM profile UNION ALL
SELECT 'age', count(*) FILTER (age = 118) m, m / count(*) FROM profile""", doubles="missing_rate")
def rates(d: Inputs):
    return q.null_rates(d.profile, {"gender": "gender", "income": "income", "age": F.col("age") == AGE_SENTINEL})


@query("q01_schema_issues", """
SELECT 'transcript' dataset, 'missing column' issue, 'value' column_name, CAST(NULL AS VARCHAR) detail, CAST(NULL AS BIGINT) n_rows UNION ALL
SELECT 'transcript', 'invalid value', 'event', event, count(*) FROM ev
WHERE event NOT IN ('transaction', 'offer received', 'offer viewed', 'offer completed') GROUP BY event UNION ALL
SELECT 'profile', 'sentinel value', 'age', '118', n FROM (SELECT count(*) FILTER (age = 118) n FROM profile) WHERE n > 0""")
def issues(d: Inputs):
    return q.schema_issues(d.events, "transcript", ["event", "person", "time", "value"], {"event": EVENTS}).unionByName(
        q.schema_issues(d.profile, "profile", ["id", "age"], sentinel=("age", AGE_SENTINEL)))
