"""Data-quality checks and profiles."""

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.constants import AGE_SENTINEL, EVENTS
from ..functions.ordered import exact_quantiles, union_all
from ..functions.scalars import money_mean


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def column_types(df: DataFrame, dataset: str) -> DataFrame:
    """Row count, column count and type per column."""
    names = [F.struct(F.lit(n).alias("column_name"), F.lit(t).alias("data_type")) for n, t in df.dtypes]
    size = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return size.select(F.lit(dataset).alias("dataset"), "n_rows", F.lit(len(names)).alias("n_columns"),
                       F.explode(F.array(*names)).alias("c")).select("dataset", "n_rows", "n_columns", "c.*")


def null_counts(df: DataFrame, columns=None) -> DataFrame:
    """Nulls per column in one pass: (column_name, n_null)."""
    columns = columns or df.columns
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in columns]
    return counted.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def null_rates(df: DataFrame, columns: dict[str, F.Column | str]) -> DataFrame:
    """Share of rows missing per named field; a value may be a column or a condition for "missing"."""
    tests = {k: F.col(v).isNull() if isinstance(v, str) else v for k, v in columns.items()}
    counted = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(t).alias(k) for k, t in tests.items()])
    cells = [F.struct(F.lit(k).alias("field"), F.col(k).alias("n_missing"), (F.col(k) / F.col("_n")).alias("missing_rate"))
             for k in tests]
    return counted.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def distinct_counts(df: DataFrame, columns=None, approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column. The exact form groups on (column, value), so no task holds a whole column."""
    columns = columns or df.columns
    if approximate:
        counted = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
        cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_distinct")) for c in columns]
        return counted.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    values = df.select(F.explode(F.array(*cells)).alias("c")).select("c.*").distinct()
    return values.groupBy("column_name").agg(F.count("value").alias("n_distinct"))


def invalid_values(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Distinct values outside the allowed list, with row counts."""
    return (df.filter(F.col(column).isNotNull() & ~F.col(column).isin(allowed))
            .groupBy(F.col(column).alias("invalid_value")).agg(F.count(F.lit(1)).alias("n_rows")))


def numeric_checks(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: is it numeric, its minimum, does it hold negatives."""
    numeric = [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]
    counted = df.agg(F.count(F.lit(1)), *[F.min(c).cast("double").alias(c) for c in numeric])
    cells = []
    for c in columns:
        low = F.col(c) if c in numeric else F.lit(None).cast("double")
        cells.append(F.struct(F.lit(c).alias("column_name"), F.lit(c in numeric).alias("is_numeric"), low.alias("min_value"),
                              F.coalesce(low < 0, F.lit(False)).alias("has_negative")))
    return counted.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def sentinel_count(df: DataFrame, column: str = "age", sentinel=AGE_SENTINEL) -> DataFrame:
    hit = F.count_if(F.col(column) == sentinel)
    return df.agg(hit.alias("n_sentinel"), F.count(F.lit(1)).alias("n_rows"),
                  (hit / F.count(F.lit(1))).alias("sentinel_rate"))


def flag_sentinel(df: DataFrame, column: str = "age", sentinel=AGE_SENTINEL) -> DataFrame:
    return df.withColumn(f"{column}_missing", F.coalesce(F.col(column) == sentinel, F.lit(False)).cast("int"))


def stats_without_sentinel(df: DataFrame, column: str = "age", sentinel=AGE_SENTINEL) -> DataFrame:
    """Minimum, maximum, mean and exact median of the values that are not the sentinel."""
    valid = df.filter(F.col(column) != sentinel)
    median = exact_quantiles(valid, [column], {"median": 0.5}).select("median").scalar()
    return valid.agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"),
                     F.avg(column).alias("mean_value"), F.count(column).alias("n_values")
                     ).withColumn("median_value", median)


def value_frequencies(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))


def time_range(events: DataFrame) -> DataFrame:
    top = F.max("time")
    return events.agg(F.min("time").alias("min_time"), top.alias("max_time"),
                      F.when(top > 0, F.floor(top / 24)).otherwise(0).cast("int").alias("duration_days"))


def payload_scan(events: DataFrame) -> DataFrame:
    """Distinct offers and amount statistics. Distinct ids are counted over a grouped table."""
    offers = events.filter(F.col("offer_id").isNotNull()).select("offer_id").distinct().agg(F.count(F.lit(1))).toDF("n")
    return events.agg(
        F.count("amount").alias("n_amounts"), F.min("amount").alias("min_amount"), F.max("amount").alias("max_amount"),
        money_mean("amount").alias("mean_amount")).withColumn("n_distinct_offers", offers.scalar())


def referential_integrity(portfolio: DataFrame, profile: DataFrame, events: DataFrame) -> DataFrame:
    """Keys present on one side only: four counts in one row, from one grouping of all keys."""
    def side(df: DataFrame, kind: str, key: str, known: int) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"), F.col(key).alias("key"), F.lit(known).alias("known"), F.lit(1 - known).alias("used"))

    both = F.explode(F.array(F.struct(F.lit("customer").alias("kind"), F.col("person").alias("key")),
                             F.struct(F.lit("offer").alias("kind"), F.col("offer_id").alias("key")))).alias("k")
    used = events.select(both).select("k.kind", "k.key", F.lit(0).alias("known"), F.lit(1).alias("used"))
    keys = side(profile, "customer", "id", 1).unionByName(side(portfolio, "offer", "id", 1)).unionByName(used).filter("key is not null")
    found = keys.groupBy("kind", "key").agg(F.max("known").alias("known"), F.max("used").alias("used"))
    count = lambda kind, known, used: F.count_if((F.col("kind") == kind) & (F.col("known") == known) & (F.col("used") == used))
    return found.agg(count("customer", 1, 0).alias("customers_not_in_transcript"),
                     count("customer", 0, 1).alias("customers_in_transcript_not_in_profile"),
                     count("offer", 1, 0).alias("offers_not_in_transcript"), count("offer", 0, 1).alias("offers_in_transcript_not_in_portfolio"))


def dataset_summary(portfolio: DataFrame, profile: DataFrame, events: DataFrame) -> DataFrame:
    rows = lambda df: df.agg(F.count(F.lit(1)).alias("n")).scalar()
    persons = events.filter("person is not null").select("person").distinct()
    return events.agg(F.count(F.lit(1)).alias("total_events"), F.floor(F.max("time") / 24).cast("int").alias("date_range_days")
                      ).select(rows(portfolio).alias("total_offers"), rows(profile).alias("total_customers"), "total_events",
                               rows(persons).alias("unique_customers_in_transcript"), "date_range_days")


def missing_together(profile: DataFrame, sentinel=AGE_SENTINEL) -> DataFrame:
    return profile.agg(F.count_if(F.col("gender").isNull() & F.col("income").isNull() & (F.col("age") == sentinel))
                       .alias("n_missing_all"))


def schema_issues(df: DataFrame, dataset: str, required: list[str], allowed: dict[str, list[str]] | None = None,
                  non_negative: list[str] = (), sentinel: tuple[str, int] | None = None) -> DataFrame:
    """Everything wrong with one dataset: (dataset, issue, column_name, detail, n_rows)."""
    spark = df.sparkSession
    shape = "dataset string, issue string, column_name string, detail string, n_rows long"
    missing = [(dataset, "missing column", c, None, None) for c in missing_columns(df, required)]
    found = [spark.createDataFrame(missing, shape)]
    present = [c for c in non_negative if c in df.columns]
    labels = F.lit(dataset).alias("dataset")
    if present:
        bad = numeric_checks(df, present)
        found.append(bad.filter("not is_numeric or has_negative").select(
            labels, F.when(F.col("is_numeric"), "negative values").otherwise("not numeric").alias("issue"), "column_name",
            F.col("min_value").cast("string").alias("detail"), F.lit(None).cast("long").alias("n_rows")))
    for column, values in (allowed or {}).items():
        if column in df.columns:
            found.append(invalid_values(df, column, values).select(
                labels, F.lit("invalid value").alias("issue"), F.lit(column).alias("column_name"),
                F.col("invalid_value").alias("detail"), "n_rows"))
    if sentinel and sentinel[0] in df.columns:
        found.append(sentinel_count(df, *sentinel).filter("n_sentinel > 0").select(
            labels, F.lit("sentinel value").alias("issue"), F.lit(sentinel[0]).alias("column_name"),
            F.lit(str(sentinel[1])).alias("detail"), F.col("n_sentinel").alias("n_rows")))
    return union_all(found)


def invalid_events(events: DataFrame, allowed: list[str] = EVENTS) -> DataFrame:
    return invalid_values(events, "event", allowed)
