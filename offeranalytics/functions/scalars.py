"""Column expressions shared by the operators."""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .constants import AGE_SENTINEL, AS_OF, COMPLETED, DAYS_PER_MONTH, OFFER_EVENTS, RECEIVED, TRANSACTION, VIEWED


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(numerator, denominator, otherwise=0.0) -> Column:
    """``numerator / denominator`` where the denominator is positive, else ``otherwise``."""
    n, d = _col(numerator), _col(denominator)
    return F.when(d > 0, n.cast("double") / d).otherwise(F.lit(otherwise).cast("double"))


def ratio_or_null(numerator, denominator) -> Column:
    d = _col(denominator)
    return _col(numerator).cast("double") / F.when(d != 0, d)


def money_sum(amount, when: Column | None = None) -> Column:
    """Exact sum of money: independent of the order in which partitions are merged."""
    value = _col(amount).cast("decimal(18,2)")
    return F.sum(value if when is None else F.when(when, value)).cast("double")


def money_mean(amount, when: Column | None = None) -> Column:
    value = _col(amount) if when is None else F.when(when, _col(amount))
    return money_sum(value) / F.when(F.count(value) > 0, F.count(value))


def cut(value, edges, labels) -> Column:
    """Bins closed on the right; values outside every bin are null."""
    value = _col(value)
    out = None
    for low, high, label in zip(edges[:-1], edges[1:], labels):
        inside = (value > low) & (value <= high)
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out


def one_hot(value, category) -> Column:
    return F.coalesce(_col(value) == category, F.lit(False)).cast("int")


def missing_flag(value) -> Column:
    return _col(value).isNull().cast("int")


def clean_age(age="age", sentinel=AGE_SENTINEL) -> Column:
    return F.nullif(_col(age), F.lit(sentinel)).cast("double")


def member_date(became_member_on="became_member_on") -> Column:
    return F.to_date(_col(became_member_on).cast("string"), "yyyyMMdd")


def tenure_days(became_member_on="became_member_on", as_of=AS_OF) -> Column:
    return F.date_diff(F.lit(as_of), member_date(became_member_on))


def tenure_months(became_member_on="became_member_on", as_of=AS_OF) -> Column:
    return tenure_days(became_member_on, as_of) / F.lit(DAYS_PER_MONTH)


def has_channel(channel: str, channels="channels") -> Column:
    return F.coalesce(F.array_contains(_col(channels), channel), F.lit(False)).cast("int")


def event_time(hours="time", as_of=AS_OF, forward: bool = False) -> Column:
    """Hours counted back from ``as_of`` (the published convention), or forward from it."""
    hours = _col(hours) if forward else -_col(hours)
    return F.lit(as_of).cast("timestamp_ntz") + F.make_dt_interval(hours=hours.cast("int"))


def is_event(name: str) -> Column:
    return F.col("event") == name


def is_transaction() -> Column:
    return is_event(TRANSACTION)


def is_received() -> Column:
    return is_event(RECEIVED) & F.col("offer_id").isNotNull()


def is_viewed() -> Column:
    return is_event(VIEWED) & F.col("offer_id").isNotNull()


def is_completed() -> Column:
    return is_event(COMPLETED) & F.col("offer_id").isNotNull()


def is_offer_event() -> Column:
    return F.col("event").isin(OFFER_EVENTS) & F.col("offer_id").isNotNull()


def payload(transcript: DataFrame, key: str) -> Column:
    """One payload entry, whether ``value`` is a map, a struct or already flattened into columns."""
    flat = {"offer id": "value_offer_id_space", "offer_id": "value_offer_id", "amount": "value_amount"}[key]
    if flat in transcript.columns:
        return F.col(flat)
    kind = transcript.schema["value"].dataType
    if isinstance(kind, T.MapType) or (isinstance(kind, T.StructType) and key in kind.names):
        return F.col("value").getItem(key)
    return F.lit(None).cast("string")


def typed_events(transcript: DataFrame) -> DataFrame:
    """Transcript with the payload pulled apart once: person, event, time, offer_id, amount."""
    blank_to_null = lambda key: F.nullif(payload(transcript, key), F.lit(""))
    return transcript.select(
        "person", "event", "time",
        F.coalesce(blank_to_null("offer id"), blank_to_null("offer_id")).alias("offer_id"),
        payload(transcript, "amount").cast("double").alias("amount"),
    )


def effect_label(d) -> Column:
    size = F.abs(_col(d))
    return F.when(size < 0.2, "negligible").when(size < 0.5, "small").when(size < 0.8, "medium").otherwise("large")


def rfm_segment(score="rfm_score") -> Column:
    score = _col(score)
    return (F.when(score.isNull(), "Unknown").when(score >= 9, "Champions").when(score >= 7, "Loyal")
            .when(score >= 5, "Potential").when(score >= 3, "At Risk").otherwise("Lost"))


def offer_category(offer_type="offer_type") -> Column:
    return F.when(_col(offer_type).isin("bogo", "discount"), "Promotional").otherwise("Informational")


def clv_proxy(spend="trans_total", completion_rate="completion_rate") -> Column:
    return _col(spend) * (1 + _col(completion_rate))


def title_case(name) -> Column:
    return F.initcap(F.regexp_replace(_col(name), "_", " "))


def select_existing(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(old).alias(new) for old, new in mapping.items() if old in df.columns])


def column_stats(df: DataFrame, columns: list[str], **aggregates) -> dict[str, dict[str, float]]:
    """Fitted statistics per column as plain numbers (one row from one pass), e.g. ``mean=F.avg``."""
    row = df.agg(*[f(c).cast("double").alias(f"{name}:{c}") for c in columns for name, f in aggregates.items()]).first()
    return {c: {name: row[f"{name}:{c}"] for name in aggregates} for c in columns}


def min_max_scale(df: DataFrame, columns: list[str]) -> DataFrame:
    """Each column mapped to 0..1; a constant column becomes null (0/0)."""
    limits = column_stats(df, columns, low=F.min, high=F.max)
    return df.withColumns({c: ratio_or_null(F.col(c) - limits[c]["low"], F.lit(limits[c]["high"] - limits[c]["low"]))
                           for c in columns if limits[c]["low"] is not None})


def moments(df: DataFrame, columns: list[str]) -> dict[str, dict[str, float | None]]:
    """Mean and population deviation (``mean``, ``sd``) of many columns, numpy sums in tasks; one row a task reaches the driver.

    Nulls are left out; a column without values has neither. Values are taken from the first one of a batch, so a constant has
    deviation 0 and itself as mean.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, len(columns)))
        for batch in batches:
            total = joined_moments(total, np.stack([_batch_moments(c) for c in batch.columns], 1))
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["sums"])

    narrow = df.select(*[F.col(f"`{c}`").cast("double").alias(f"_{i}") for i, c in enumerate(columns)])
    total = np.zeros((3, len(columns)))
    for r in narrow.mapInArrow(run, "sums array<double>").collect():
        total = joined_moments(total, np.array(r["sums"]).reshape(3, -1))
    n, mean, squares = total
    return {c: {"mean": float(mean[i]) if n[i] else None, "sd": math.sqrt(squares[i] / n[i]) if n[i] else None} for i, c in enumerate(columns)}


def _batch_moments(values: pa.Array) -> np.ndarray:
    """Number, mean and summed squared deviations of the values that are not null."""
    x = np.asarray(values.drop_null())
    if not len(x):
        return np.zeros(3)
    off = x - x[0]
    mean = off.mean()
    return np.array([len(x), x[0] + mean, ((off - mean) ** 2).sum()])


def joined_moments(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(number, mean, squared deviations) by column of two sets of rows together."""
    n = a[0] + b[0]
    share = np.divide(b[0], n, out=np.zeros(len(n)), where=n > 0)
    apart = np.where((a[0] > 0) & (b[0] > 0), b[1] - a[1], 0.0)
    return np.stack([n, np.where(a[0] > 0, a[1] + apart * share, b[1]), a[2] + b[2] + apart**2 * a[0] * share])


def standardise(df: DataFrame, columns: list[str], fitted: dict[str, dict[str, float | None]] | None = None) -> DataFrame:
    """Zero mean and unit population deviation. Unknown columns are ignored, a constant column becomes 0.

    ``fitted``: mean and ``sd`` of the columns, if they are at hand."""
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    fitted = column_stats(df, columns, mean=F.avg, sd=F.stddev_pop) if fitted is None else fitted
    return df.withColumns({
        c: (F.col(c) - fitted[c]["mean"]) / fitted[c]["sd"] if fitted[c]["sd"] else F.when(F.col(c).isNotNull(), 0.0)
        for c in columns})
