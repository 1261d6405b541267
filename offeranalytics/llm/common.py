"""Helpers shared by the operators of this subpackage: durable cuts, hot keys, reading tables."""

import tempfile

from pyspark.sql import DataFrame, SparkSession, functions as F

#: A key is hot above this share of all rows, so there are never more hot keys than its inverse.
HOT_SHARE = 1 / 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share. A local session without one gets its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.split("[")[0] == "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(folder)
    return spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there: nothing before it runs again."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def hot_limit(total: int) -> int:
    return max(1, int(total * HOT_SHARE))


def hot_salts(groups: DataFrame, key: list[str], n: str, total: int) -> DataFrame:
    """Keys with over a thousandth of all rows and the number of shares to cut each into (at most 1,000 rows)."""
    limit = hot_limit(total)
    return groups.where(F.col(n) > limit).select(*key, F.ceil(F.col(n) / limit).cast("int").alias("_salts"))


def salted(df: DataFrame, hot: DataFrame, key: list[str]) -> DataFrame:
    """Add ``_salt``: the share a row of a hot key belongs to, 0 for all other rows. ``hot`` is from ``hot_salts``."""
    share = F.when(F.col("_salts").isNull(), F.lit(0)).otherwise(F.pmod(F.monotonically_increasing_id(), F.col("_salts")).cast("int"))
    return df.join(F.broadcast(hot), key, "left").withColumn("_salt", share).drop("_salts")


def join_facts(rows: DataFrame, facts: DataFrame, key: list[str], n: str, total: int, how: str = "inner") -> DataFrame:
    """Join stored ``rows`` with stored ``facts`` (one row per key; ``n`` rows share it) without a hot task.

    Facts of hot keys, at most 1,000, are broadcast; the others meet their rows in a shuffle.
    """
    limit = hot_limit(total)
    hot = facts.where(F.col(n) > limit)
    cold = rows.join(F.broadcast(hot.select(*key)), key, "left_anti").join(facts.where(F.col(n) <= limit), key, how)
    return cold.unionByName(rows.join(F.broadcast(hot), key))



def salted_join(rows: DataFrame, facts: DataFrame, key: list[str], n: str, total: int, how: str = "left") -> DataFrame:
    """Join ``rows``, read once, with stored ``facts`` (one row per key; ``n`` rows share it), hot keys in shares."""
    hot = hot_salts(facts, key, n, total)
    copies = facts.join(F.broadcast(hot), key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return salted(rows, hot, key).join(copies, [*key, "_salt"], how).drop("_salt")


def literal_rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A few driver-side rows as a table, without Python workers or RDDs."""
    import json

    text = F.lit(json.dumps(rows))
    return spark.range(1).select(F.explode(F.from_json(text, f"array<struct<{schema}>>")).alias("r")).select("r.*")
