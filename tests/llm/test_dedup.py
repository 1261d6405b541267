"""Exact and near duplicates against brute force."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from offeranalytics.llm import components, exact_dedup, simhash

SF = "/root/testdata/sf0.001"


def brute_groups(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(i)
    return sorted((i, min(g), len(g), i == min(g)) for g in groups.values() for i in g)


TEXTS = ["a b", "a  b", "a\tb", "ab", "", None, " ", "  ", "c", "c", "é", "é", "x" * 50_000, "x" * 50_000, "x" * 49_999]


@pytest.mark.parametrize("bits", [None, 0, 1])
def test_exact_groups_with_weak_hashes(spark, bits):
    """A hash of no or one hex digit makes unequal texts collide; comparing bytes has to part them."""
    rows = list(enumerate(TEXTS))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    more = {} if bits is None else {"hash_of": lambda c: F.substring(F.md5(c), 1, bits)}
    got = exact_dedup.exact_groups(docs, **more).select("doc_id", "keep_id", "group_size", "kept").collect()
    assert sorted(tuple(r) for r in got) == brute_groups(rows)


def test_one_text_in_a_third_of_all_rows(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    got = exact_dedup.exact_groups(docs)
    assert got.where("kept").count() == 4001 and got.where("group_size = 2000 and keep_id = 0").count() == 2000
    assert exact_dedup.drop_copies(docs).count() == 4001


def test_drop_copies_leaves_one_of_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c"), (2, "a")], "doc_id bigint, text string")
    assert sorted(exact_dedup.drop_copies(docs).collect(), key=str) == sorted([(1, "a"), (1, "b"), (None, "c")], key=str)


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    counts = [sum(xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def brute_components(fps):
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(fps)
    for a in ids:
        for b in ids:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in fps}


def test_near_duplicates_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(900, None), (901, " \n"), (902, "One word"), (903, "one two"), (904, "ONE two")], "doc_id bigint, text string"))
    fps = {r.doc_id: plain_fingerprint(r.text) for r in docs.collect()}
    want = brute_components(fps)
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {i: (fps[i], want[i]) for i in fps}


@pytest.mark.parametrize("crowd", [0, 2, 64])
def test_links_lose_no_pair(spark, crowd):
    """Clusters of fingerprints around centres; with small crowds all go by whole variants."""
    rng = random.Random(crowd)
    values = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(15):
            v = centre
            for _ in range(rng.randint(0, 4)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    signed = {v - (1 << 64) if v >> 63 else v: v for v in values}
    points = spark.createDataFrame([(s,) for s in signed], "fp bigint")
    edges = simhash.links(points, crowd)
    for a, b in edges.collect():
        assert (signed[a] ^ signed[b]).bit_count() <= 3
    roots = dict(components.components(edges).collect())
    want = brute_components(signed)
    for s in signed:
        assert want[s] == roots.get(s, s)


def test_long_chain_is_one_component(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = components.components(edges).collect()
    assert len(got) == 301 and {r.root for r in got} == {0}
