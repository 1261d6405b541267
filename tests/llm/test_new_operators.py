"""The prefix trie, the id files and the spelling variants against brute force, the library and odd tables."""

import functools
import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from test_llm_queries import ODD, SF, odd

from offeranalytics.llm import id_planes, plans, prefix_trie, spelling


def plain_trie(convs):
    """Nodes of {conv_id: [(role, text), ...]} by walking every prefix."""
    members, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    rows = []
    for node, ids in members.items():
        below = [m for m in members if m[:len(node)] == node]
        leaves = [m for m in below if not any(len(o) == len(m) + 1 and o[:len(m)] == m for o in below)]
        saved = sum((len(members[m]) - 1) * (len(m[-1][1]) if m else 0) for m in below)
        listed = ",".join(map(str, sorted(ends.get(node, []))))
        rows.append((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids),
                     sum(len(m) == len(node) + 1 for m in below), len(leaves), saved, hashlib.sha256(listed.encode()).hexdigest()))
    return sorted(rows, key=str)


def trie_of(spark, turns, band):
    numbered = prefix_trie.numbered_turns(spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string"))
    tops = numbered.select("conv_id").distinct().selectExpr("conv_id", "0L as depth", "cast(null as binary) as digest", "0L as size")
    return prefix_trie.prefix_trie(tops.unionByName(numbered.withColumnRenamed("no", "depth")), band)


@pytest.mark.parametrize("band", [2, 8])
def test_trie_equals_brute_force(spark, rows, band):
    rng = random.Random(band)
    convs = {c: [(rng.choice("ua"), rng.choice(["x", "yy", ""])) for _ in range(rng.randint(1, 9))] for c in range(-3, 40)}
    convs[50] = [("u", "x")] * 30  # deeper than any other
    convs[51] = [("u", "x")] * 27 + [("a", "end")]
    turns = [(c, None if i == 0 else i, role, text) for c, ts in convs.items() for i, (role, text) in enumerate(ts)]
    assert rows(trie_of(spark, turns, band)) == plain_trie(convs)


def test_shared_openings_follow_the_rule(spark):
    own = {0: 3, 1: 2, 2: 8, 150: 1, 151: 9, 305: 2}  # 100 and 300 are absent
    turns = [(c, i, "u", f"{c}/{i}") for c, n in own.items() for i in range(n)]
    text_of = {hashlib.md5(f"1:u{c}/{i}".encode()).digest(): f"{c}/{i}" for c, n in own.items() for i in range(n)}
    numbered = prefix_trie.numbered_turns(spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string"))
    got = {}
    for r in prefix_trie.shared_openings(numbered).orderBy("conv_id", "depth").collect():
        got.setdefault(r.conv_id, []).append(text_of[bytes(r.digest)] if r.depth else None)
    want = {}
    for c, n in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        donor = own.get(c - c % 100, 0)
        want[c] = [None] + [f"{c - c % 100}/{i}" for i in range(min(h, donor))] + [f"{c}/{i}" for i in range(h, n)]
    assert got == want


def test_trie_of_odd_conversations(spark):
    turns = [(1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, None, None, None), (None, 1, "a", ""), (2, None, None, ""), (3, 1, "u", "x" * 300_000)]
    frame = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    for name in ("key", "depth", "chain", "digest", "size", "no", "h", "home", "n_convs"):
        frame = frame.withColumn(name, frame.role)
    got = prefix_trie.prefix_trie(prefix_trie.shared_openings(prefix_trie.numbered_turns(frame), most=0)).orderBy("depth", "conv_id").collect()
    assert [(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens) for r in got] == [
        (1, 0, None, 3, 2, 2, 0), (1, 1, 1, 2, 1, 1, 0), (3, 1, 1, 1, 0, 1, 0), (1, 2, 1, 1, 1, 1, 0), (1, 3, 1, 1, 0, 1, 0)]
    assert prefix_trie.prefix_trie(prefix_trie.shared_openings(prefix_trie.numbered_turns(frame.where("false")))).count() == 0


@pytest.mark.parametrize("mode", ["byte", "bit"])
@pytest.mark.parametrize("lengths", [[0], [1], [7, 0, 1000, 3], [64, 64], [1, 63, 64, 65, 500]])
def test_id_files_give_back_every_document(mode, lengths):
    rng = np.random.default_rng(1)
    docs = [(i, rng.integers(0, 2**32 if i % 2 else 50_000, n, dtype=np.uint32)) for i, n in enumerate(lengths)]
    parts = list(id_planes.file_parts(3, ((i, ids.tobytes()) for i, ids in docs), id_planes.MODES[mode], block=64))
    content = b"".join(p + b"\n" for p in parts)
    file = id_planes.IdFile(content)
    assert file.number == 3 and file.names == [i for i, _ in docs]
    for i, ids in reversed(docs):
        assert (file.ids(i) == ids).all()
    assert len(file.table) == -(-sum(lengths) // 64)
    for at in (30, len(content) - 60):
        with pytest.raises(Exception):
            broken = id_planes.IdFile(content[:at] + bytes([content[at] ^ 255]) + content[at + 1:])
            [broken.ids(i) for i in range(len(docs))]
            assert not sum(lengths)
            raise ValueError("nothing to break")


@functools.lru_cache(maxsize=1)
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(plans.vocabulary_path("word_bpe_49k.json"))


def test_encoder_equals_the_library():
    rng = random.Random(5)
    signs = "aBc É é ǅ ß İ ſ 1٣ ½ ́     　 \x1c \x85 ​ 漢字 👍🏽 'S 'll 're .,;<| |> <|endoftext|> <|startoftext|> \n \t Å ͅ".split(" ") + [" ", "\n", "  "]
    latin = list("abZ 19'.,!-_<|>\n\t\x0b\x0c\x00\x1b\x7f\x80\xa1\xab\xbf") + ["É", "é", "ß", "ÿ", "Ø", "×", "÷", "'s", "'LL", "'Re", "ª", "µ", "²", "\xa0", "\xad"]
    texts = ["".join(rng.choice(latin) for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    texts += ["".join(rng.choice(signs) + rng.choice(["", " "]) for _ in range(rng.randint(0, 60))) for _ in range(400)] + [None, "", " "]
    encoder = id_planes.Encoder(plans.vocabulary_path("word_bpe_49k.json"), None)
    for t, got in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(got, "<u4").tolist() == library().encode(t or "", add_special_tokens=False).ids, repr(t)
    assert encoder.by_piece and not id_planes.cuts_by_pattern(plans.vocabulary_path("byte_bpe_50k.json"))


@pytest.mark.parametrize("name, settings", [("word_bpe_49k.json", {}), ("word_bpe_49k.json", {"mode": "bit", "file_bytes": 20_000, "block": 500}), ("byte_bpe_50k.json", {})])
def test_round_trip_equals_the_library(spark, name, settings):
    from tokenizers import Tokenizer

    docs, path = spark.read.parquet(f"{SF}/documents.parquet"), plans.vocabulary_path(name)
    tokenizer, want, start = Tokenizer.from_file(path), [], 0
    for r in docs.orderBy("doc_id").collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in id_planes.round_trip(docs.repartition(5), path, **settings).select("doc_id", "start", "n_tokens", "ids_crc32").collect()) == want


def test_id_files_of_odd_tables(spark):
    docs = odd(spark)
    got = id_planes.round_trip(docs, plans.vocabulary_path("word_bpe_49k.json"), file_bytes=1000).orderBy("start").collect()
    assert len(got) == len(ODD) and [r.doc_id for r in got] == sorted([r[0] for r in ODD], key=lambda i: (i is not None, i))
    assert [r.start for r in got] == list(itertools.accumulate([0, *[r.n_tokens for r in got[:-1]]]))
    assert {r.n_tokens for r in got if r.doc_id in (2, 3)} == {1}
    assert id_planes.round_trip(docs.where("false"), plans.vocabulary_path("word_bpe_49k.json")).count() == 0
    with pytest.raises(ValueError):
        id_planes.round_trip(docs.selectExpr("cast(doc_id as double) as doc_id", "text"), plans.vocabulary_path("word_bpe_49k.json"))


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def plain_variants(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        top = max(vs, key=lambda v: (counts[v], [-ord(c) for c in v] + [0]), default=None)
        form[w] = top if top is not None and counts[top] >= 2 * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted(((w, n, form[w], counts[form[w]] if form[w] else None, len(near[w]), root(w)) for w, n in counts.items()), key=str)


@pytest.mark.parametrize("alphabet, share, seed", [("ab", 0.05, 1), ("abc", 0.01, 2), ("abcdeéÿ", 0.2, 3), ("ab", 0.5, 4), ("abcd", 0.002, 5)])
def test_variants_equal_brute_force(spark, rows, alphabet, share, seed):
    """Small alphabets give repeated grams, near words in plenty and words whose grams one edit can spoil all."""
    rng = random.Random(seed)
    counts = {"".join(rng.choice(alphabet) for _ in range(rng.randint(5, 9))): rng.choice([3, 4, 7, 8, 16, 40]) for _ in range(500)}
    got = spelling.spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n bigint"), long_list=share)
    assert rows(got) == plain_variants(counts)


def test_one_edit_spoils_no_more_grams_than_the_bound():
    rng = random.Random(9)
    words = ["".join(rng.choice("aabcd") for _ in range(rng.randint(5, 11))) for _ in range(300)]
    every = {}
    for w in words:
        for q in range(2, 5):
            for i in range(len(w) - q + 1):
                every[w[i:i + q]] = every.get(w[i:i + q], 0) + 1
    for limit in (5, 40, 200):
        grams = spelling.Grams({g: n for g, n in every.items() if len(g) == 2 or every[g[:-1]] > limit})
        for w in words[:60]:
            own = grams.cut(w)
            bound = grams.bound(own, len(w))
            for i, c in itertools.product(range(len(w) + 1), "ac"):
                for other, shift in ((w[:i] + c + w[i:], 1), (w[:i] + w[i + 1:], -1), (w[:i] + c + w[i + 1:], 0)):
                    if i == len(w) and shift < 1:
                        continue
                    theirs = {(g, p) for _, g, p, *_ in grams.cut(other)}
                    kept = sum((g, p) in theirs or (g, p + shift) in theirs for _, g, p, *_ in own)
                    assert len(own) - kept <= bound


def test_variants_of_odd_tables(spark):
    docs = odd(spark, [*ODD, (11, "Straße STRASSE strasse Straßen " * 3 + "naïve naive naïve naivé", "de", "a", 1), (None, "naive naive", "fr", "b", 2)])
    got = {r.word: (r.n, r.form, r.n_near, r.root) for r in spelling.spelling_variants(spelling.counted_runs(docs)).collect()}
    assert got["strasse"] == (6, None, 0, "strasse") and got["naive"] == (3, None, 0, "naive") and "lang" not in got
    assert spelling.spelling_variants(spelling.counted_runs(docs.where("false"))).count() == 0
    counts = spark.createDataFrame([("words", 2), ("words", 2), (None, 9), ("wordy", 8), ("", 7)], "word string, n int").withColumn("form", spelling.F.lit(1))
    assert sorted(tuple(r) for r in spelling.spelling_variants(counts).collect()) == [("words", 4, "wordy", 8, 1, "wordy"), ("wordy", 8, None, None, 1, "wordy")]
    with pytest.raises(ValueError):
        spelling.spelling_variants(counts, least_length=4)


def test_damaged_runs_lose_one_code_point(spark):
    words = ["".join(p) for p in itertools.product("abcdé", repeat=4)]
    docs = spark.createDataFrame([(7, " ".join(words)), (None, words[0])], "doc_id bigint, text string")
    want = {}
    for doc, w in [*[("7", w) for w in words], ("", words[0])]:
        h = zlib.crc32(f"{doc}:{w}".encode())
        w = w if h % 5 else w[:h % len(w)] + w[h % len(w) + 1:]
        want[w] = want.get(w, 0) + 1
    assert {r.word: r.n for r in spelling.counted_runs(docs, damage=5).collect()} == want
