"""Building blocks that keep jobs safe at any size: durable cuts, measured broadcasts, hot-key splitting."""

import math
import uuid
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

SMALL_ROWS = 100_000
HOT_ROWS = 10_000


def durable(df: DataFrame) -> DataFrame:
    """Keep ``df`` for its several later uses.

    Where the cluster names a shared checkpoint folder the rows are written there once, which also survives lost
    executors; elsewhere they are kept by Spark (memory, then disk) and recomputed if an executor is lost.
    ``spark.catalog.clearCache()`` frees the latter.
    """
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True) if spark.sparkContext.getCheckpointDir() else df.persist(StorageLevel.MEMORY_AND_DISK)


def spread(df: DataFrame, rows: int, *by: str, per_task: int = 400_000) -> DataFrame:
    """Deal ``df`` by ``by`` over at least as many tasks as there are cores, and so many that a task makes ``per_task`` of the
    ``rows`` that come of it. Else a small table that is multiplied later stays in the few tasks it was shuffled to."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / per_task)), *by)


def scratch(spark, name: str) -> str:
    """A new folder name for files of one query: in the shared checkpoint folder where one is named, else in the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{name}_{uuid.uuid4().hex}"


def remove(spark, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def small_side(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast only if a count shows it fits; otherwise leave it to a shuffle join."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def copies(df: DataFrame, count: str, by: list[str], most: int, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Repeat each row ``count`` (at most ``most``) times. Where some row has very many copies, rows are first
    split into shares that spread over tasks."""
    if most <= hot_rows:
        return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col(count).cast("int")))).drop("_copy", count)
    shares = F.ceil(F.col(count) / hot_rows).cast("int")
    shared = df.withColumn("_shares", shares).withColumn("_share", F.explode(F.sequence(F.lit(0), shares - 1)))
    shared = shared.repartition(*by, "_share")
    size = F.floor(F.col(count) / F.col("_shares")) + (F.col("_share") < F.col(count) % F.col("_shares")).cast("int")
    return (shared.withColumn("_copy", F.explode(F.sequence(F.lit(1), size.cast("int"))))
            .drop("_copy", "_share", "_shares", count))


def every_pair_with(df: DataFrame, catalogue: DataFrame, name: str = "item", chunk_rows: int = SMALL_ROWS) -> DataFrame:
    """Each row of ``df`` with each row of a catalogue, as a struct column ``name``.

    The catalogue travels as an array inside the plan, so the large side is never shuffled. A catalogue of more
    than ``chunk_rows`` rows is sent as several arrays, one pass over ``df`` for each.
    """
    item = F.struct(*[F.col(c) for c in sorted(catalogue.columns)])
    chunks = math.ceil(catalogue.count() / chunk_rows)
    if chunks <= 1:
        everything = catalogue.agg(F.array_sort(F.collect_list(item)).alias("items")).scalar()
        return df.withColumn(name, F.explode(everything))
    number = F.pmod(F.xxhash64(*sorted(catalogue.columns)), F.lit(chunks))
    parts = [catalogue.filter(number == c).agg(F.array_sort(F.collect_list(item)).alias("items")).scalar() for c in range(chunks)]
    return reduce(DataFrame.unionByName, [df.withColumn(name, F.explode(p)) for p in parts])
