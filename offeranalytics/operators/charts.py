"""Tables behind charts; drawing is left to the caller."""

from pyspark.sql import DataFrame, functions as F

from ..functions import ordered
from ..functions.scalars import min_max_scale
from ..functions.scale import small_side


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between minimum and maximum; the last bin is closed, empty bins are kept."""
    limits = df.agg(F.struct(F.min(column).cast("double").alias("low"), F.max(column).cast("double").alias("high"))).toDF("l").scalar()
    low, width = limits["low"], (limits["high"] - limits["low"]) / bins
    index = F.least(F.floor((F.col(column) - low) / F.when(width > 0, width)), F.lit(bins - 1))
    counted = df.filter(F.col(column).isNotNull()).groupBy(F.coalesce(index, F.lit(0)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return grid.join(counted, "bin", "left").select(
        "bin", (low + width * F.col("bin")).alias("bin_start"), (low + width * (F.col("bin") + 1)).alias("bin_end"), F.coalesce("n", F.lit(0)).alias("n"))


def box_plot(df: DataFrame, column: str, by: list[str]) -> DataFrame:
    """Quartiles, extremes, whiskers at 1.5 IQR and number of outliers per group."""
    quartiles = ordered.exact_quantiles(df, [column], {"q1": 0.25, "median": 0.5, "q3": 0.75}, by).drop("metric", "n")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("v").between(F.col("q1") - reach, F.col("q3") + reach)
    rows = df.select(*by, F.col(column).cast("double").alias("v")).filter("v is not null").join(small_side(quartiles), by)
    return rows.groupBy(*by, "q1", "median", "q3").agg(
        F.min("v").alias("min"), F.max("v").alias("max"), F.min(F.when(inside, F.col("v"))).alias("lower_whisker"),
        F.max(F.when(inside, F.col("v"))).alias("upper_whisker"), F.count_if(~inside).alias("n_outliers"))


def radar(profiles: DataFrame, metrics: list[str], key: str = "cluster") -> DataFrame:
    """Segment metrics scaled to 0..1 across segments."""
    return min_max_scale(profiles.select(key, *metrics), metrics)
