"""Conversation prefix trie: which conversations share which first turns, and what sharing saves below each node.

A prefix is named by sums over its turns of a 128-bit hash of (place, role, text), so running sums name all prefixes at
once. Subtree totals roll up in bands of ``BAND`` depths: a node adds its values to its ancestors inside its band only.
The roots of bands then form a trie of their own, a ``BAND``-th as deep, which is rolled up the same way. At last the
completed totals of band roots are added to the nodes of the band above. So a node meets at most ``BAND`` ancestors a
level, and the number of levels is the logarithm of the depth.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import cut, join_facts

BAND = 8
EMPTY_HASH = hashlib.sha256(b"").hexdigest()


def numbered_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, no, digest, size): turns in order from 1, a hash of role and text, and the text's code points.

    A null turn comes first; equal turns are ordered by the md5 of role and text. Null roles and texts are empty. Rows
    without a conversation are left out. Texts are hashed where they are read and not shuffled.
    """
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    role, text = named(role_col), named(text_col)
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.length(text).cast("long").alias("size"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("no"), "digest", "size")


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, key, size, ends) of stored ``turns`` (conv_id, depth, digest, size): a row per conversation and prefix.

    Depth 0, with null digest, must be there for every conversation. ``ends`` marks the longest prefix.
    """
    hashed = F.md5(F.concat(F.col("depth").cast("string"), F.lit(":"), F.coalesce(F.hex("digest"), F.lit(""))))
    words = [F.conv(F.substr(F.col("h"), F.lit(8 * i + 1), F.lit(8)), 16, 10).cast("long") for i in range(4)]
    order = Window.partitionBy("conv_id").orderBy("depth")
    until = order.rowsBetween(Window.unboundedPreceding, 0)
    sums = [F.sum(w).over(until) for w in words]
    key = F.unhex(F.md5(F.concat_ws(":", "depth", *[s.cast("string") for s in sums])))
    return turns.withColumn("h", hashed).select(
        "conv_id", "depth", key.alias("key"), "size", F.lead("depth").over(order).isNull().alias("ends"))


def _chains(paths: DataFrame, band: int) -> DataFrame:
    """``paths`` with the keys of up to ``band`` rows before each of its conversation, its own last."""
    near = Window.partitionBy("conv_id").orderBy("depth").rowsBetween(-band, 0)
    return paths.withColumn("chain", F.collect_list("key").over(near))


def _added(rows: DataFrame, chain: Column, values: list[str]) -> DataFrame:
    """Sums of the values over the keys of a chain."""
    return rows.select(F.explode(chain).alias("key"), *values).groupBy("key").agg(*[F.sum(v).alias(v) for v in values])


def rolled_up(nodes: DataFrame, paths: DataFrame, values: list[str], band: int = BAND) -> DataFrame:
    """(key, *values): each value summed over the subtree of every node, the node included.

    ``nodes`` is stored: key, depth, chain (its last ``band`` ancestors and itself) and the values. ``paths`` is stored:
    conv_id, depth, key, from which the chains of band roots come. ``band`` is 2 or more.
    """
    if band < 2:
        raise ValueError("a band has two depths or more")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    levels, step, level = [], 1, nodes.select("key", "depth", "chain", *values)
    while True:
        at = F.floor(F.col("depth") / step) % band
        inside = F.slice("chain", -(at + 1).cast("int"), (at + 1).cast("int"))
        local = cut(_added(level, inside, values))
        levels.append((level, local))
        step *= band
        if deepest < step:
            break
        roots = paths.where(F.col("depth") % step == 0)
        chains = _chains(roots, band).groupBy("key").agg(F.first("depth").alias("depth"), F.first("chain").alias("chain"))
        level = cut(chains.join(local, "key"))
    full = levels[-1][1]
    for level, local in reversed(levels[:-1]):
        step //= band
        # of a band's nodes the root is complete already; the others still lack what hangs below the band
        between = full.join(level.where((F.col("depth") % step == 0) & (F.col("depth") > 0)).select("key", "chain"), "key")
        below = _added(between, F.slice("chain", 2, band - 1), values)
        whole = [F.coalesce(F.col(f"f.{v}"), F.col(f"l.{v}") + F.coalesce(F.col(f"b.{v}"), F.lit(0))).alias(v) for v in values]
        full = cut(local.alias("l").join(full.alias("f"), "key", "left").join(below.alias("b"), "key", "left").select("key", *whole))
    return full


def hashed_ends(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of ``ends`` (key, conv_id): a hash of the ids in ascending order, comma-joined.

    Sorted rows stream through the hash, so a task holds one state and one batch however many ids a node has.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done: list[tuple[bytes, str]] = []
            keys, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for k, i in zip(keys, ids):
                if k == key:
                    state.update(b",%d" % i)
                else:
                    if state is not None:
                        done.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256(b"%d" % i)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done])], names=["key", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], names=["key", "ends_sha256"])

    ordered = ends.select("key", F.col("conv_id").cast("long").alias("conv_id")).repartition("key").sortWithinPartitions("key", "conv_id")
    return ordered.mapInArrow(run, "key binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, band: int = BAND) -> DataFrame:
    """One row per distinct sequence of first turns: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    ``turns``: conv_id (whole number), depth from 1 without gaps, digest of role and text, size of the text, as
    ``numbered_turns`` gives them (no as depth), and a row of depth 0 for every conversation, which may have no other. conv_id is
    the smallest member's, so (conv_id, depth) names a node. The saved tokens of a node are those of its last turn
    times its members but one, summed over its subtree; leaves likewise. Null ids must be left out before. Repeated
    rows are turns like any other. An empty table gives no rows. Other columns are not read.
    """
    paths = cut(prefixes(turns.select("conv_id", "depth", "digest", "size")))
    nodes = cut(_chains(paths, band).groupBy("key").agg(
        F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.first("size").alias("size"), F.first("chain").alias("chain"), F.count_if("ends").alias("n_ends")))
    parents = F.when(F.col("depth") > 0, F.element_at("chain", -2))
    children = nodes.where("depth > 0").groupBy(parents.alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    # a node is unique here, so neither join has a hot key
    known = cut(nodes.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))).select(
        "*", parents.alias("parent"), F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens")))
    totals = rolled_up(known, paths.select("conv_id", "depth", "key"), ["n_leaves", "saved_tokens"], band)
    listed = hashed_ends(paths.where("ends").select("key", "conv_id"))
    each = known.drop("n_leaves", "saved_tokens", "chain", "size", "n_ends").join(totals, "key").join(listed, "key", "left")
    above = known.where("n_children > 0").select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("m"))
    below = join_facts(cut(each.where("depth > 0")), cut(above), ["parent"], "m", known.count())
    top = each.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast(nodes.schema["conv_id"].dataType))
    return below.unionByName(top, allowMissingColumns=True).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_HASH)).alias("ends_sha256"))


def shared_openings(turns: DataFrame, group: int = 100, most: int = 5) -> DataFrame:
    """Rebuilt conversations of stored ``turns`` (conv_id, no, digest, size): (conv_id, depth, digest, size), depth 0 included.

    The first h turns of conversation c come from conversation c - c % ``group`` (all if it has fewer, none if it is
    absent), h being the checksum of c modulo ``most`` + 1; its own turns after the first h follow.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    home = F.col("conv_id") - F.col("conv_id") % group
    donors = cut(turns.where((F.col("conv_id") % group == 0) & (F.col("no") <= most)).select(F.col("conv_id").alias("home"), "no", "digest", "size"))
    lengths = donors.groupBy("home").agg(F.count(F.lit(1)).alias("given"))
    convs = turns.select("conv_id").distinct()
    heads = convs.select("conv_id", home.alias("home"), h.alias("h")).join(donors, "home").where("no <= h").select("conv_id", F.col("no").alias("depth"), "digest", "size")
    tails = turns.select("*", home.alias("home"), h.alias("h")).where("no > h").join(lengths, "home", "left").select(
        "conv_id", (F.col("no") - F.col("h") + F.least("h", F.coalesce("given", F.lit(0)))).alias("depth"), "digest", "size")
    tops = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("size"))
    return tops.unionByName(heads).unionByName(tails)
