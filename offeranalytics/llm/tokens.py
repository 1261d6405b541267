"""Exact token counts of a byte-level BPE vocabulary, merged on ragged numpy arrays.

Texts are cut into pre-tokens by array passes over their code points. Distinct pre-tokens lie one after the other in
one array of symbols; in each round every sequence applies its lowest-ranked pair at all its places at once, left to
right, and sequences without a known pair leave the array. What survives is counted.
"""

import json
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Characters handled together; a longer text is cut where white space follows another character.
CHUNK = 1 << 20
#: Short pre-tokens whose count a worker remembers.
KNOWN = 400_000
NO_RANK = np.int32(2**31 - 1)
LETTER, NUMBER, SPACE, OTHER, STOP = range(5)
SENTINEL = "\ud800"  # not in any valid text, stands between texts
# What the pre-tokenizer counts as white space, and the suffixes it splits off after an apostrophe
WHITE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SUFFIXES = ["s", "t", "re", "ve", "m", "ll", "d"]


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)
    table[WHITE] = SPACE
    table[ord(SENTINEL)] = STOP
    return table


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Merge ranks of a ``tokenizers`` file and the special strings that count as one token each."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        if model["type"] != "BPE" or data["pre_tokenizer"]["type"] != "ByteLevel" or data["normalizer"] or model.get("ignore_merges"):
            raise ValueError("a byte-level BPE file without normalizer is needed")
        self.specials = [t["content"] for t in data["added_tokens"]]
        ids = model["vocab"]
        self.first = np.array([ids[s] for s in byte_symbols()], np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        left, right = (np.array([ids[p[i]] for p in pairs], np.int64) for i in (0, 1))
        self.made = np.array([ids[a + b] for a, b in pairs], np.int64)
        self.levels = self._tables(left << 20 | right)
        self.known: dict[bytes, int] = {}

    @staticmethod
    def _tables(keys: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """Hash tables of one key per slot; keys that find their slot taken go to the next, smaller table."""
        ranks, levels, bits = np.arange(len(keys)), [], 18
        while len(keys):
            slots = Vocabulary._slots(keys, bits)
            _, won = np.unique(slots, return_index=True)
            table, rank = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NO_RANK, np.int32)
            table[slots[won]], rank[slots[won]] = keys[won], ranks[won]
            levels.append((bits, table, rank))
            rest = np.ones(len(keys), bool)
            rest[won] = False
            keys, ranks, bits = keys[rest], ranks[rest], max(8, bits - 3)
        return levels

    @staticmethod
    def _slots(keys: np.ndarray, bits: int) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 2 * bits)) >> np.uint64(64 - bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 20 | right
        found = np.full(len(keys), NO_RANK, np.int32)
        for bits, table, rank in self.levels:
            slots = self._slots(keys, bits)
            hit = table[slots] == keys
            found[hit] = rank[slots[hit]]
        return found


def merged_lengths(vocabulary: Vocabulary, raw: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Number of symbols left of each byte sequence; ``raw`` holds them one after the other, none is empty."""
    result = lengths.copy()
    alive = np.flatnonzero(lengths > 1)
    symbols = vocabulary.first[raw[np.repeat(lengths > 1, lengths)]]
    lengths = lengths[alive]
    ranks = None
    while len(alive):
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        if ranks is None:
            ranks = vocabulary.ranks(symbols, np.append(symbols[1:], 0))
        ranks[starts + lengths - 1] = NO_RANK
        lowest = np.minimum.reduceat(ranks, starts)
        going = lowest < NO_RANK
        if not going.all():
            result[alive[~going]] = lengths[~going]
            keep = np.repeat(going, lengths)
            symbols, ranks, alive, lengths, lowest = symbols[keep], ranks[keep], alive[going], lengths[going], lowest[going]
            if not len(alive):
                break
            starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        merge = ranks == np.repeat(lowest, lengths)
        touching = merge[1:] & merge[:-1]
        if touching.any():  # as in "aaa": of pairs that overlap every second one merges, from the left
            places = np.flatnonzero(merge)
            fresh = np.concatenate(([True], places[1:] != places[:-1] + 1))
            order = np.arange(len(places)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
            merge[places[order % 2 == 1]] = False
        places = np.flatnonzero(merge)
        symbols[places] = vocabulary.made[ranks[places]]
        keep = np.ones(len(symbols), bool)
        keep[places + 1] = False
        lengths = lengths - np.add.reduceat(merge, starts, dtype=np.int64)
        symbols, ranks = symbols[keep], ranks[keep]
        at = places - np.arange(len(places))
        changed = np.zeros(len(symbols), bool)
        changed[at] = changed[at[at > 0] - 1] = True
        stale = np.flatnonzero(changed)
        ranks[stale] = vocabulary.ranks(symbols[stale], symbols[np.minimum(stale + 1, len(symbols) - 1)])
    return result


def boundaries(codes: np.ndarray) -> np.ndarray:
    """True where a pre-token begins, for code points of texts with a sentinel after each."""
    kind = _classes()[codes]
    starts = np.ones(len(codes), bool)
    starts[1:] = kind[1:] != kind[:-1]
    space = kind == SPACE
    # the last of several white-space characters before a word stands alone or, if a blank, leads the word
    last = np.zeros(len(codes), bool)
    last[:-1] = space[:-1] & (kind[1:] != SPACE) & (kind[1:] != STOP)
    starts |= last
    leads = np.flatnonzero(last & (codes == 32))
    starts[leads + 1] = False
    # an apostrophe alone, not led by a blank, takes its suffix from the letters after it
    quote = np.flatnonzero((codes[:-1] == 39) & starts[:-1] & (kind[1:] == LETTER))
    if len(quote):
        tail = np.pad(codes, (0, 2))
        open_quote = np.ones(len(quote), bool)
        for suffix in sorted(SUFFIXES, key=len, reverse=True):
            hit = open_quote & np.all([tail[quote + 1 + k] == ord(c) for k, c in enumerate(suffix)], axis=0)
            starts[quote[hit] + 1] = False
            after = quote[hit] + 1 + len(suffix)
            starts[after[after < len(starts)]] = True
            open_quote &= ~hit
    starts[kind == STOP] = True
    return starts


def _same(raw: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> bool:
    """Are the byte runs that begin at ``a`` and ``b`` equal, pair by pair?"""
    inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return bool((raw[np.repeat(a, lengths) + inside] == raw[np.repeat(b, lengths) + inside]).all())


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    base = 0x5851F42D4C957F2D
    n = 5 * CHUNK
    up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 2**64), np.uint64)
    up[0] = down[0] = 1
    with np.errstate(over="ignore"):
        up, down = np.cumprod(up), np.cumprod(down)
    return up, down


def count_piece(vocabulary: Vocabulary, texts: list[str]) -> np.ndarray:
    """Tokens of each text (no special strings in them); together at most a few times ``CHUNK`` characters."""
    codes = np.frombuffer(SENTINEL.join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.flatnonzero(boundaries(codes))
    stop = codes == ord(SENTINEL)
    width = 1 + (codes > 0x7F) + (codes > 0x7FF).astype(np.int64) + (codes > 0xFFFF)
    width[stop] = 0
    offset = np.concatenate(([0], np.cumsum(width)))
    text_of = np.cumsum(stop)[starts]
    real = ~stop[starts]
    begin, end = offset[starts], offset[np.append(starts[1:], len(codes))]
    begin, end, text_of = begin[real], end[real], text_of[real]
    raw = np.frombuffer("".join(texts).encode("utf-8"), np.uint8)
    if not len(begin):
        return np.zeros(len(texts), np.int64)
    up, down = _powers()
    lengths = end - begin
    if len(raw) < len(up):
        with np.errstate(over="ignore"):
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], dtype=np.uint64)))
            hashes = ((sums[end] - sums[begin]) * down[begin]) ^ (lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        _, first, same = np.unique(hashes, return_index=True, return_inverse=True)
        if not ((lengths == lengths[first][same]).all() and _same(raw, begin, begin[first][same], lengths)):
            first = same = np.arange(len(begin))
    else:  # one very long text without a place to cut
        first = same = np.arange(len(begin))
    counts = _distinct_counts(vocabulary, raw, begin[first], lengths[first])[same]
    return np.bincount(text_of, counts, len(texts)).astype(np.int64)


def _distinct_counts(vocabulary: Vocabulary, raw: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Tokens of each byte run; runs seen in earlier pieces are looked up, the others merged together."""
    whole, known = raw.tobytes(), vocabulary.known
    runs = [whole[a:b] for a, b in zip(begin.tolist(), (begin + size).tolist())]
    counts = np.fromiter((known.get(r, 0) for r in runs), np.int64, len(runs))
    new = np.flatnonzero(counts == 0)
    if len(new):
        begin, size = begin[new], size[new]
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        counts[new] = merged_lengths(vocabulary, raw[np.repeat(begin, size) + inside], size)
        if len(known) + len(new) > KNOWN:
            known.clear()
        known.update((runs[i], int(c)) for i, c in zip(new.tolist(), counts[new]) if len(runs[i]) <= 64)
    return counts


def _parts(text: str) -> Iterator[str]:
    """A long text in parts that end where white space follows another character: no pre-token spans that place."""
    while len(text) > CHUNK:
        at = next((i for i in range(CHUNK, len(text)) if text[i].isspace() and text[i] not in "\x1c\x1d\x1e\x1f"
                   and not text[i - 1].isspace()), len(text))
        yield text[:at]
        text = text[at:]
    yield text


def count_tokens(vocabulary: Vocabulary, texts: list[str | None]) -> np.ndarray:
    """Tokens of each whole text; null counts as empty."""
    totals = np.zeros(len(texts), np.int64)
    pieces: list[tuple[int, str]] = []
    held = 0

    def flush() -> None:
        nonlocal held
        np.add.at(totals, [i for i, _ in pieces], count_piece(vocabulary, [p for _, p in pieces]))
        pieces.clear()
        held = 0

    for i, text in enumerate(texts):
        segments = [text or ""]
        for special in vocabulary.specials:
            if special in segments[0] or len(segments) > 1:
                segments = [s for segment in segments for s in segment.split(special)]
        totals[i] += len(segments) - 1
        for segment in segments:
            for part in _parts(segment):
                pieces.append((i, part))
                held += len(part)
                if held >= CHUNK:
                    flush()
    if pieces:
        flush()
    return totals


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def token_counts(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_bytes (UTF-8), n_tokens, over_limit.

    ``path`` names a byte-level BPE file of the ``tokenizers`` library on every worker. A special string inside a
    text counts as one token, as the library's default has it; none is added. A null text counts as empty: 0 bytes,
    0 tokens. Repeated and null ids give a row each. Other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path)
        for batch in batches:
            texts, counts = batch.column(1), []
            for at in range(0, batch.num_rows, 256):
                counts.append(count_tokens(vocabulary, texts.slice(at, 256).to_pylist()))
            tokens = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(tokens)], names=["id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    counted = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes")).mapInArrow(
        run, f"id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
