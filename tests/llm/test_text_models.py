"""Token counts against the library, models by held-out accuracy, the pipeline against brute force."""

import random
import zlib

import numpy as np
import pytest

from offeranalytics.llm import langid, plans, quality, tokens

SF = "/root/testdata/sf0.01"
SPECIAL = ["", " ", "  ", "\n\n a", "it's 's ''s 're'll'x", "<|endoftext|>", "a<|endoftext|> b <|endoftext|><|endoftext|>", "a" * 700, "\x1c a \x1d",
           "é" * 33 + " ß 中文字 １２ ½ ٣　x  y", "😀😀 ​ x́", "'S I'M", "\r\n \t x ", "x" * 3000]


def mixed_texts():
    rng = random.Random(3)
    return SPECIAL + ["".join(rng.choice("abst'' \n\té中1.,!<|") for _ in range(rng.randint(0, 60))) for _ in range(500)]


@pytest.mark.parametrize("chunk", [1 << 20, 200])
def test_tokens_as_the_library_counts(monkeypatch, chunk):
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokens, "CHUNK", chunk)
    tokens._powers.cache_clear()
    path = plans.vocabulary_path()
    texts = [*mixed_texts(), " ".join(mixed_texts())]
    want = [len(e.ids) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert tokens.count_tokens(tokens.Vocabulary(path), texts).tolist() == want
    tokens._powers.cache_clear()


def test_token_query_against_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(plans.vocabulary_path())
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in plans.op10_token_counts(spark, SF).collect():
        n = len(library.encode(docs[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 512)


def test_language_of_held_out_texts(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = plans.op6_language(spark, SF).collect()
    assert len(rows) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and truth[r.doc_id]]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97


def test_windows_of_a_long_text_all_count():
    network = langid.ByteNetwork(["a", "b"]).fit(np.concatenate([langid.windows_of(b"aaa bbb " * 16, 0, 1)[0], langid.windows_of(b"xyz zzy " * 16, 0, 1)[0]] * 20),
                                                 np.array([0, 1] * 20))
    assert network.predict("aaa bbb " * 100)[0] == "a" and network.predict("aaa bbb " * 100 + "xyz zzy " * 20000)[0] == "b"
    texts = ["aaa bbb " * n for n in (1, 5, 50, 20000)] + [None, "", "123 !"]
    assert [p[0] for p in network.predict_many(texts)] == [network.predict(t)[0] for t in texts] == ["a"] * 4 + ["und"] * 3


def test_gradients_by_differences():
    network = langid.ByteNetwork(["a", "b", "c"])
    rng = np.random.default_rng(1)
    block, target = rng.integers(0, 256, (6, langid.WINDOW)).astype(np.int16), np.array([0, 1, 2, 0, 1, 2])
    grad = network.gradients(block, target)
    loss = lambda: -np.log(network.probabilities(block)[np.arange(6), target]).mean()
    for name, value in network.weights.items():
        at = np.unravel_index(np.abs(grad[name]).argmax(), value.shape)
        keep, step = value[at], 1e-2
        value[at] = keep + step
        up = loss()
        value[at] = keep - step
        down = loss()
        value[at] = keep
        assert abs((up - down) / (2 * step) - grad[name][at]) < 0.05 * abs(grad[name][at]) + 2e-4, name


def test_quality_of_held_out_texts(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = plans.op1_quality(spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    good, bad = ([r.score for r in rows if r.held_out and labels.get(r.doc_id) == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.9 and np.mean([g >= 0.3 for g in good]) > 0.95


def test_prior_and_negative_risk_of_a_known_mixture():
    rng = np.random.default_rng(5)
    draw = lambda n, at: np.concatenate((rng.normal(at, 1, (n, 3)), np.ones((n, 1))), axis=1)
    positive, unlabelled = draw(2000, 2.0), np.concatenate((draw(2100, 2.0), draw(900, -2.0)))
    prior = quality.estimated_prior(positive, unlabelled)
    assert abs(prior - 0.7) < 0.06
    weights = quality.fit(positive, unlabelled, prior)
    assert quality.risk(weights, positive, unlabelled, prior)[1] > -0.05
    assert ((draw(500, 2.0) @ weights) > 0).mean() > 0.97 and ((draw(500, -2.0) @ weights) < 0).mean() > 0.97


def test_pipeline_stage_by_stage(spark):
    """Each stage against a plain Python rendering of its rule, on what the stage before kept."""
    import re

    import corpus_pipeline
    from test_dedup import brute_components, plain_fingerprint

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    network = langid.train(docs.where(langid.split_number("doc_id", 4) != 2))
    kept = {r.doc_id: r for r in docs.collect()}
    low = lambda t: re.findall("[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    grams = set()
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        w = low(r.text)
        grams |= {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9)) if w}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, sf)
        if name.startswith("language"):
            want = {i for i, r in kept.items() if (p := network.predict(r.text))[0] != "und" and p[1] >= 0.4}
        elif name.startswith("exact"):
            first = {}
            for i in sorted(kept):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", kept[i].text or ""), i)
            want = set(first.values())
        elif name.startswith("SimHash"):
            roots = brute_components({i: plain_fingerprint(r.text) for i, r in kept.items()})
            want = {i for i, root in roots.items() if i == root}
        elif name.startswith("benchmark"):
            sizes = {len(g) for g in grams}
            want = {i for i, r in kept.items() if not any(tuple(w[k:k + n]) in grams for w in [low(r.text)] for n in sizes for k in range(len(w) - n + 1))}
        else:
            want = set(kept)
        rows = result.collect()
        assert {r.doc_id for r in rows} == want and len(rows) == len(want), name
        kept = {r.doc_id: r for r in rows}
        docs = result
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, sf).collect()) == sorted(kept)
