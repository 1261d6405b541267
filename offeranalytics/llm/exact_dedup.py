"""Exact deduplication by content hash: the smallest id of each group of equal texts stays."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .common import cut, hot_salts, join_facts, salted

WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Runs of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, " ")


def _hash128(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _texts(docs: DataFrame, id_col: str, text_col: str, hash_of: Callable[[Column], Column]) -> DataFrame:
    whole = docs.select(F.col(id_col).alias("_id"), normalised(F.col(text_col)).alias("_text"))
    return whole.withColumn("_hash", hash_of(F.col("_text")))


def _collisions(texts: DataFrame, groups: DataFrame, total: int) -> DataFrame:
    """Hashes whose texts are not all the same bytes.

    Each (hash, share) compares its smallest with its largest text, so a task holds two texts at a time however
    large the group is; the shares of hot hashes are compared with each other in a second, small step.
    """
    hot = hot_salts(groups, ["_hash"], "n", total)
    shares = salted(texts.select("_hash", "_text"), hot, ["_hash"]).repartition("_hash", "_salt")
    edges = shares.groupBy("_hash", "_salt").agg(F.min("_text").alias("low"), F.max("_text").alias("high"))
    # of a hash with one share only the verdict goes on, so its text is not moved again
    one = F.col("_salts").isNull()
    slim = edges.join(F.broadcast(hot), "_hash", "left").select(
        "_hash", (F.col("low") != F.col("high")).alias("differ"), F.when(~one, F.col("low")).alias("low"))
    slim = cut(slim.where(F.col("differ") | F.col("low").isNotNull()))
    return slim.groupBy("_hash").agg(F.max("differ").alias("d"), F.min("low").alias("a"), F.max("low").alias("b")).where(
        F.col("d") | (F.col("a") != F.col("b"))).select("_hash")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 hash_of: Callable[[Column], Column] = _hash128) -> DataFrame:
    """One row per row of ``docs``: its id, keep_id, group_size, kept, text_sha256 and content_hash.

    Texts are equal when identical after white-space runs become one space; a null text counts as empty. Groups
    form by the 128-bit hash; then the bytes inside each group are compared, and a group whose texts differ is
    split by whole text. The smallest id stays; null ids come last, and a group of null ids only has a null
    keep_id. Rows that repeat id and text all carry ``kept``; ``drop_copies`` leaves one of them. Other columns
    of ``docs`` are not read. An empty table gives no rows. ``hash_of`` is there to test weak hashes.
    """
    texts = _texts(docs, id_col, text_col, hash_of)
    keyed = cut(texts.select("_id", "_hash", F.unhex(F.sha2(F.col("_text"), 256)).alias("_sha")))
    groups = cut(keyed.groupBy("_hash").agg(F.count(F.lit(1)).alias("n"), F.min("_id").alias("keep_id")).where("n > 1"))
    total = keyed.count()
    collided = cut(_collisions(texts, groups, total))
    split = not collided.isEmpty()
    if split:
        groups = groups.join(collided, "_hash", "left_anti")
        rest = keyed.join(collided, "_hash", "left_anti")
    else:
        rest = keyed
    joined = join_facts(rest, groups, ["_hash"], "n", total, "left").select(
        "_id", "_hash", "_sha", F.when(F.col("n").isNull(), F.col("_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"))
    if split:
        exact = texts.join(collided, "_hash", "left_semi")
        by_text = exact.groupBy("_hash", "_text").agg(F.count(F.lit(1)).alias("group_size"), F.min("_id").alias("keep_id"))
        joined = joined.unionByName(exact.join(by_text, ["_hash", "_text"]).select(
            "_id", "_hash", F.unhex(F.sha2(F.col("_text"), 256)).alias("_sha"), "keep_id", "group_size"))
    return joined.select(F.col("_id").alias(id_col), "keep_id", "group_size", F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                         F.lower(F.hex("_sha")).alias("text_sha256"), F.col("_hash").alias("content_hash"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept."""
    kept = cut(exact_groups(docs, id_col, text_col).where("kept").select(F.col(id_col).alias("__kept_id"), F.col("text_sha256").alias("__kept_sha")))
    keys = kept.distinct()
    sha = F.sha2(normalised(F.col(text_col)), 256)
    match = F.col(id_col).eqNullSafe(F.col("__kept_id")) & (sha == F.col("__kept_sha"))
    left = docs.join(keys, match, "left_semi")
    if kept.count() != keys.count():  # rows that repeat both id and text
        left = left.withColumn("__kept_sha", sha).dropDuplicates([id_col, "__kept_sha"]).drop("__kept_sha")
    return left
