"""SimHash near-duplicates: fingerprints, and links found by meeting in the middle of a Hamming ball.

A pair at distance 3 or less differs by at most one bit in one of the two 32-bit halves. So each fingerprint sends
out, for either half, all variants of that half within one bit (half the radius); variants that meet the half of
another fingerprint are the colliding pairs, which are verified on all 64 bits. Where more than ``CROWD``
fingerprints share a half, listing pairs would grow with the square of the crowd: there every fingerprint sends
out variants of all 64 bits instead - within one bit, and the two-bit ones with both bits in the same half. Of the
three bits in which two fingerprints differ two lie in one half, so one of them reaches the other's one-bit variant.
All that meet at a variant to which some member is within one bit are linked with that member: a star, not pairs.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import cut, join_facts
from .components import components

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
CROWD = 64
BLOCK = 1 << 15
RADIUS = 3


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the word shingles of a whole text as a signed integer; no words give zero."""
    if not text:
        return 0
    parts = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not parts:
        return 0
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(words, len(parts))
    first, last = starts[:len(parts) - width + 1].tolist(), ends[width - 1:].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(first), BLOCK):
        hashes = [digest(line[a:b], seed) for a, b in zip(first[at:at + BLOCK], last[at:at + BLOCK])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    value = int(sum(1 << i for i in np.flatnonzero(2 * ones > len(first)).tolist()))
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id, fp) for each row, read in whole; fp as a signed 64-bit number."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            fps = pa.array([fingerprint(texts[i].as_py(), words) for i in range(batch.num_rows)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), fps], names=["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, fp bigint")


def _low(fp):
    return F.shiftright(F.shiftleft(fp, 32), 32)


def _high(fp):
    return F.shiftright(fp, 32)


def _homes(points: DataFrame) -> DataFrame:
    """(key, fp) for either half; a key is the signed half, doubled, plus one for the upper half."""
    return points.select("fp", F.explode(F.array(_low(F.col("fp")) * 2, _high(F.col("fp")) * 2 + 1)).alias("key"))


def _guests(points: DataFrame) -> DataFrame:
    """(key, fp) for all variants of either half within one bit, the half itself included."""
    flips = [0, *[1 << i for i in range(31)], -(1 << 31)]
    doubled = F.array(*[F.lit(2 * f).cast("long") for f in flips])
    return _homes(points).select("fp", "key", F.explode(doubled).alias("f")).select("fp", F.col("key").bitwiseXOR(F.col("f")).alias("key"))


def _crowd_edges(crowded: DataFrame) -> DataFrame:
    """Star edges among crowded fingerprints by whole 64-bit variants; at most 2,081 can meet at one variant."""
    one = F.expr("explode(array_append(transform(sequence(0, 63), i -> shiftleft(1L, i)), 0L))")
    ones = crowded.select("fp", one.alias("m")).select(F.col("fp").bitwiseXOR(F.col("m")).alias("v"), "fp", F.lit(True).alias("near"))
    two = F.expr("explode(flatten(transform(sequence(1, 31), i -> flatten(transform(sequence(0, i - 1), "
                 "j -> array(shiftleft(1L, i) | shiftleft(1L, j), shiftleft(1L, i + 32) | shiftleft(1L, j + 32)))))))")
    twos = crowded.select("fp", two.alias("m")).select(F.col("fp").bitwiseXOR(F.col("m")).alias("v"), "fp", F.lit(False).alias("near"))
    variants = ones.unionByName(twos)
    centre = F.min(F.when(F.col("near"), F.col("fp")))
    met = variants.groupBy("v").agg(centre.alias("c"), F.collect_set("fp").alias("members"))
    stars = met.where("c is not null and size(members) > 1").select("c", F.explode("members").alias("fp"))
    return stars.where("fp <> c").select(F.col("fp").alias("a"), F.col("c").alias("b")).distinct()


def links(points: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Edges (a, b) between distinct fingerprints, enough to connect all pairs within ``RADIUS`` bits.

    ``points`` has distinct ``fp``. No pair is dropped: a half shared by more than ``crowd`` fingerprints is
    handled on whole variants, see the module's text. Every edge is a true link.
    """
    homes = _homes(points)
    sizes = cut(homes.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowd))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS
    busy = not sizes.isEmpty()
    calm = homes.join(sizes, "key", "left_anti") if busy else homes
    met = _guests(points).withColumnRenamed("fp", "a").join(calm.withColumnRenamed("fp", "b"), "key")
    edges = met.where((F.col("a") != F.col("b")) & close).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    if busy:
        crowded = _guests(points).join(sizes, "key").select("fp").distinct()
        edges = edges.unionByName(_crowd_edges(cut(crowded)).where(close))
    return edges.distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hex digits), component_id.

    component_id is the smallest id reachable over links of ``RADIUS`` or fewer differing bits. Null and blank texts
    have fingerprint zero and are linked like any other. Null ids count as larger than all others; a component of
    null ids only has a null component_id. Repeated rows share a component. Other columns are not read.
    """
    rows = cut(fingerprints(docs, id_col, text_col, words))
    classes = cut(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")))
    total = rows.count()
    roots = components(links(classes.select("fp")))
    rooted = cut(classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root")))
    smallest = cut(rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("m")))
    named = cut(join_facts(rooted, smallest, ["root"], "m", total).select("fp", "n", "component_id"))
    return join_facts(rows, named, ["fp"], "n", total).select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """``docs`` with the row of the smallest id of each component, all columns kept.

    Ids must be unique here, as after exact deduplication; rows with a null id stay.
    """
    gone = near_duplicates(docs, id_col, text_col, words).where(
        ~F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col(id_col).alias("__gone")).where("__gone is not null")
    return docs.join(cut(gone), F.col(id_col) == F.col("__gone"), "left_anti")
