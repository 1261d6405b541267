"""Ranks, running sums and exact quantiles over a whole table without a one-task window.

Rows are first counted per distinct value. The distinct values are cut into ranges of about
``ROWS_PER_RANGE`` rows at measured quantiles; a window runs inside each range and a small table of range
totals carries the sums across ranges. A small table is one range.
"""

import math
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from .scale import durable, small_side

ROWS_PER_RANGE = 200_000
MAX_RANGES = 20_000


def range_splits(df: DataFrame, value: str, rows_per_range: int | None = None) -> list[float]:
    """Cut points that spread the rows of ``df`` evenly; few plain numbers, safe to hold on the driver."""
    ranges = min(MAX_RANGES, math.ceil(df.count() / (rows_per_range or ROWS_PER_RANGE)))
    if ranges <= 1:
        return []
    probabilities = [i / ranges for i in range(1, ranges)]
    points = df.agg(F.percentile_approx(F.col(value).cast("double"), probabilities, 10 * ranges)).first()[0]
    return sorted(set(points))


def with_range(df: DataFrame, value: str, splits: list[float], name: str = "_range") -> DataFrame:
    if not splits:
        return df.withColumn(name, F.lit(0))
    numeric = df.withColumn("_value", F.col(value).cast("double"))
    cutter = Bucketizer(splits=[-math.inf, *splits, math.inf], inputCol="_value", outputCol=name)
    return cutter.transform(numeric).drop("_value").withColumn(name, F.col(name).cast("int"))


def prefix_sums(df: DataFrame, value: str, sums: dict[str, str], by=(), then=(), splits=None) -> DataFrame:
    """Add, for each ``new: column`` of ``sums``, the sum over all rows that come before in ``value`` order.

    ``df`` holds one row per (by, value, then) and should be stored, since it is read twice.
    """
    by, then = list(by), list(then)
    splits = range_splits(df, value) if splits is None else splits
    ranged = with_range(df, value, splits)
    keys = [*by, "_range"]
    inside = Window.partitionBy(*keys).orderBy(value, *then).rowsBetween(Window.unboundedPreceding, -1)
    result = ranged.withColumns({new: F.coalesce(F.sum(old).over(inside), F.lit(0)) for new, old in sums.items()})
    if splits:
        earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        totals = ranged.groupBy(*keys).agg(*[F.sum(old).alias(f"_{new}") for new, old in sums.items()])
        totals = totals.select(*keys, *[F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}") for n in sums])
        result = result.join(totals, keys).withColumns({n: F.col(n) + F.col(f"_{n}") for n in sums})
        result = result.drop(*[f"_{n}" for n in sums])
    return result.drop("_range")


def value_counts(df: DataFrame, value: str, by=(), counts: dict[str, Column] | None = None) -> DataFrame:
    """Stored table of one row per (by, value) with row counts; the input of every rank below."""
    counts = counts or {"n": F.lit(1)}
    grouped = df.filter(F.col(value).isNotNull()).groupBy(*by, value)
    return durable(grouped.agg(*[F.sum(c.cast("long")).alias(name) for name, c in counts.items()]))


def average_ranks(counted: DataFrame, value: str, n: str = "n", by=()) -> DataFrame:
    """Mid-rank of each distinct value: rows below plus half of its own ties."""
    ranked = prefix_sums(counted, value, {"before": n}, by)
    return ranked.withColumn("rank", F.col("before") + (F.col(n) + 1) / 2)


def row_numbers(df: DataFrame, columns: dict[str, str], key: str) -> DataFrame:
    """Position 1..n of every row by each ``new: column`` ordering, ties by the md5 of ``key``: (key, new...).

    Ties are also cut into slices of the md5, so a value shared by a third of all rows still spreads over tasks.
    """
    hashed = unpivot(df, columns.values(), [key]).withColumn("_hash", F.md5(F.col(key).cast("string"))).withColumn(
        "_slice", F.substring("_hash", 1, 3))
    counted = durable(hashed.groupBy("metric", "value", "_slice").agg(F.count(F.lit(1)).alias("_n")))
    before = prefix_sums(counted, "value", {"_before": "_n"}, by=["metric"], then=["_slice"]).drop("_n")
    inside = Window.partitionBy("metric", "value", "_slice").orderBy("_hash")
    numbered = hashed.join(before, ["metric", "value", "_slice"]).withColumn("_place", F.col("_before") + F.row_number().over(inside))
    return numbered.groupBy(key).agg(*[F.max(F.when(F.col("metric") == c, F.col("_place"))).alias(new) for new, c in columns.items()])


def quantile_bucket(row_number, rows, q: int = 5) -> Column:
    """Bucket 1..q of position r among n: edges are the linear quantiles of 1..n, closed on the right."""
    return F.greatest(F.lit(1), F.ceil(q * (row_number - 1) / F.when(rows > 1, rows - 1))).cast("int")


def unpivot(df: DataFrame, columns, by=(), metric="metric", value="value") -> DataFrame:
    cells = [F.struct(F.lit(c).alias(metric), F.col(c).cast("double").alias(value)) for c in columns]
    return df.select(*by, F.explode(F.array(*cells)).alias("_cell")).select(*by, "_cell.*")


def exact_quantiles(df: DataFrame, columns, probabilities: dict[str, float], by=()) -> DataFrame:
    """Interpolated quantiles of several columns at once: (by..., metric, n, one column per probability)."""
    by = list(by)
    counted = value_counts(unpivot(df, columns, by), "value", [*by, "metric"])
    return quantiles_of_counts(counted, "value", probabilities, [*by, "metric"])


def quantiles_of_counts(counted: DataFrame, value: str, probabilities: dict[str, float], by=(), n: str = "n",
                        splits=None) -> DataFrame:
    by = list(by)
    ranked = prefix_sums(counted, value, {"_before": n}, by, splits=splits)
    totals = counted.groupBy(*by).agg(F.sum(n).alias("_total"))
    if by:
        ranked = ranked.join(small_side(totals), by)
    else:
        ranked = ranked.withColumn("_total", totals.scalar())

    def at(position):
        return F.max(F.when((F.col("_before") <= position) & (position < F.col("_before") + F.col(n)), F.col(value)))

    picks = []
    for name, p in probabilities.items():
        place = (F.col("_total") - 1) * F.lit(float(p))
        picks += [at(F.floor(place)).alias(f"_low_{name}"), at(F.ceil(place)).alias(f"_high_{name}"),
                  F.max(place - F.floor(place)).alias(f"_part_{name}")]
    picked = ranked.groupBy(*by).agg(F.max("_total").alias("n"), *picks)
    return picked.select(*by, "n", *[
        (F.col(f"_low_{name}") + (F.col(f"_high_{name}") - F.col(f"_low_{name}")) * F.col(f"_part_{name}")).alias(name)
        for name in probabilities])


def medians(df: DataFrame, columns) -> dict[str, float]:
    """Exact medians as plain numbers, for use as constants in later plans."""
    return {r["metric"]: r["median"] for r in exact_quantiles(df, columns, {"median": 0.5}).collect()}


def nearest_marked(df: DataFrame, value: str, mark: Column, payload: Column, splits=None) -> DataFrame:
    """For each row the payload of the nearest marked row at or below (``lower``) and at or above (``upper``).

    ``df`` holds one row per value and should be stored.
    """
    splits = range_splits(df, value) if splits is None else splits
    ranged = with_range(df, value, splits).withColumn("_mark", F.when(mark, payload))
    up = Window.partitionBy("_range").orderBy(value)
    lower = F.last("_mark", ignorenulls=True).over(up.rowsBetween(Window.unboundedPreceding, 0))
    upper = F.first("_mark", ignorenulls=True).over(up.rowsBetween(0, Window.unboundedFollowing))
    result = ranged.withColumns({"lower": lower, "upper": upper})
    if splits:
        edges = ranged.filter(mark).groupBy("_range").agg(
            F.min_by("_mark", value).alias("_first"), F.max_by("_mark", value).alias("_last"))
        ranges = ranged.select("_range").distinct().join(edges, "_range", "left")
        order = Window.orderBy("_range")
        carried = ranges.select(
            "_range",
            F.last("_last", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("_below"),
            F.first("_first", ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing)).alias("_above"))
        result = result.join(carried, "_range").withColumns({
            "lower": F.coalesce("lower", "_below"), "upper": F.coalesce("upper", "_above")}).drop("_below", "_above")
    return result.drop("_range", "_mark")


def union_all(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
