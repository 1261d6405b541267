"""Bootstrap intervals without drawing rows.

Rows fall into slices by a hash of their key and only slice sums are resampled, each slice by a Poisson(1) weight
per replicate. One pass over the data; the resampling cost is slices x replicates whatever the table size.
"""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scale import durable

# Cumulative Poisson(1) probabilities times 2^32
POISSON_STEPS = [1580030168, 3160060337, 3950075421, 4213413783, 4279248373, 4292415291, 4294609777, 4294923276, 4294962463]
SLICES = 512


def _hash32(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def poisson_weight(text: Column) -> Column:
    """Whole-number weight with mean 1 from eight hex digits."""
    # Equal-length hex text compares like the number it stands for.
    return sum(((text >= f"{step:08x}").cast("int") for step in POISSON_STEPS), F.lit(0))


def slice_sums(df: DataFrame, value: str, key: Column, arms: list[str], slices: int = SLICES) -> DataFrame:
    rows = df.filter(F.col(value).isNotNull()).withColumn("slice", _hash32(key) % slices)
    return rows.groupBy(*arms, "slice").agg((F.sum(F.col(value).cast("decimal(18,2)")) * 100).cast("double").alias("cents"), F.count(F.lit(1)).alias("n"))


def replicate_means(sums: DataFrame, arms: list[str], replicates: int) -> DataFrame:
    """Weighted mean per arm and replicate."""
    # A fixed number of partitions: the few slice rows grow by the number of replicates right after.
    parts = int(sums.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = sums.repartition(parts, *arms, "slice").withColumn("replicate", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
    drawn = spread.withColumn("_hex", F.substring(F.md5(F.concat_ws(":", *arms, "slice", "replicate")), 1, 8))
    weighted = drawn.withColumn("w", poisson_weight(F.col("_hex")))
    total = F.sum(F.col("w") * F.col("n"))
    return weighted.groupBy(*arms, "replicate").agg(
        (F.sum(F.col("w") * F.col("cents")) / F.when(total > 0, total) / 100).alias("m"))


def _interval(value, level: float) -> list[Column]:
    tail = (1 - level) / 2
    return [F.percentile(value, tail).alias("ci_lower"), F.percentile(value, 1 - tail).alias("ci_upper")]


def mean_interval(df: DataFrame, value: str, key: Column, arms: list[str], replicates: int = 10_000, level: float = 0.95,
                  slices: int = SLICES) -> DataFrame:
    """Mean and percentile interval per arm."""
    sums = durable(slice_sums(df, value, key, arms, slices))  # slices x arms rows, read twice
    means = replicate_means(sums, arms, replicates).groupBy(*arms).agg(*_interval("m", level))
    observed = sums.groupBy(*arms).agg((F.sum("cents") / F.sum("n") / 100).alias("mean"), F.sum("n").alias("n"))
    return observed.join(means, arms)


def difference_interval(sums: DataFrame, treated: str, by: list[str], replicates: int = 1_000, level: float = 0.95) -> DataFrame:
    """Interval of the difference of means, treated minus control, per ``by`` group of slice sums."""
    means = replicate_means(sums, [*by, treated], replicates).groupBy(*by, "replicate").agg(
        (F.max(F.when(F.col(treated) == 1, F.col("m"))) - F.max(F.when(F.col(treated) == 0, F.col("m")))).alias("d"))
    ends = means.groupBy(*by).agg(*_interval("d", level), F.avg("d").alias("bootstrap_mean"), F.stddev_pop("d").alias("bootstrap_std"))
    zero = (F.col("ci_lower") <= 0) & (F.col("ci_upper") >= 0)
    return ends.withColumn("ci_includes_zero", zero).withColumn("significant", ~zero)
