"""Language identification by a byte convolutional network trained in numpy.

Bytes are embedded, filters of several widths run over fixed-length windows, each filter keeps its maximum, and a
softmax layer reads the maxima. Training sees a bounded sample of labelled windows; prediction reads every window of
every text and averages their probabilities by length.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
PAD = 256
#: The bound of the training sample: texts a language and windows a text. All languages are learned.
TEXTS_PER_LANGUAGE = 400
WINDOWS_PER_TEXT = 3
BLOCK = 512


def split_number(id_col: str, parts: int) -> Column:
    """crc32 of the id as text modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % parts


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def windows_of(raw: bytes, at: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows ``at`` to ``at + count`` of a text, padded, and the number of bytes in each."""
    part = np.frombuffer(raw, np.uint8, min(count * WINDOW, len(raw) - at * WINDOW), at * WINDOW)
    rows = -(-len(part) // WINDOW)
    block = np.full(rows * WINDOW, PAD, np.int16)
    block[:len(part)] = part
    sizes = np.full(rows, WINDOW)
    sizes[-1] = len(part) - (rows - 1) * WINDOW
    return block.reshape(rows, WINDOW), sizes


class ByteNetwork:
    """Embedding, filters of widths ``WIDTHS`` held in one matrix, max pooling, softmax."""

    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages, self.reach = languages, max(WIDTHS)
        total = FILTERS * len(WIDTHS)
        self.mask = np.concatenate([np.tile((np.arange(self.reach) < w)[:, None, None], (1, EMBED, FILTERS)) for w in WIDTHS], axis=2)
        self.mask = self.mask.reshape(self.reach * EMBED, total).astype(np.float32)
        self.weights = {
            "embed": rng.normal(0, 0.5, (PAD + 1, EMBED)).astype(np.float32),
            "filters": (rng.normal(0, 0.25, (self.reach * EMBED, total)) * self.mask).astype(np.float32),
            "bias": np.zeros(total, np.float32),
            "out": rng.normal(0, 0.1, (total, len(languages))).astype(np.float32),
            "out_bias": np.zeros(len(languages), np.float32),
        }
        self.weights["embed"][PAD] = 0

    def _patches(self, block: np.ndarray) -> np.ndarray:
        padded = np.pad(block, ((0, 0), (0, self.reach - 1)), constant_values=PAD)
        embedded = self.weights["embed"][padded]
        views = np.lib.stride_tricks.sliding_window_view(embedded.reshape(len(block), -1), self.reach * EMBED, axis=1)[:, ::EMBED]
        return np.ascontiguousarray(views)

    def _pooled(self, block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        patches = self._patches(block)
        maps = (patches.reshape(-1, patches.shape[2]) @ self.weights["filters"]).reshape(len(block), WINDOW, -1)
        return patches, maps, maps.max(axis=1) + self.weights["bias"]

    @staticmethod
    def _softmax(logits: np.ndarray) -> np.ndarray:
        grown = np.exp(logits - logits.max(axis=1, keepdims=True))
        return grown / grown.sum(axis=1, keepdims=True)

    def probabilities(self, block: np.ndarray) -> np.ndarray:
        pooled = np.maximum(self._pooled(block)[2], 0)
        return self._softmax(pooled @ self.weights["out"] + self.weights["out_bias"])

    def gradients(self, block: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
        patches, maps, pooled = self._pooled(block)
        at = maps.argmax(axis=1)
        active = np.maximum(pooled, 0)
        error = self._softmax(active @ self.weights["out"] + self.weights["out_bias"])
        error[np.arange(len(target)), target] -= 1
        error /= len(target)
        back = (error @ self.weights["out"].T) * (pooled > 0)
        chosen = np.take_along_axis(patches, at[:, :, None], axis=1)  # windows x filters x patch
        grad = {"out": active.T @ error, "out_bias": error.sum(axis=0), "bias": back.sum(axis=0),
                "filters": np.einsum("nf,nfp->pf", back, chosen) * self.mask, "embed": np.zeros_like(self.weights["embed"])}
        spread = (back[:, :, None] * self.weights["filters"].T[None]).reshape(len(block), back.shape[1], self.reach, EMBED)
        padded = np.pad(block, ((0, 0), (0, self.reach - 1)), constant_values=PAD)
        bytes_at = np.take_along_axis(padded[:, None, :], at[:, :, None] + np.arange(self.reach), axis=2)
        np.add.at(grad["embed"], bytes_at, spread)
        grad["embed"][PAD] = 0
        return grad

    def fit(self, blocks: np.ndarray, targets: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 0.01, seed: int = 7) -> "ByteNetwork":
        """Adam on shuffled batches."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(blocks))
            for i in range(0, len(order), batch):
                step += 1
                pick = order[i:i + batch]
                for k, g in self.gradients(blocks[pick], targets[pick]).items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    change = rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                    self.weights[k] -= change.astype(np.float32)
        return self

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and its mean probability over all windows; ``und`` without a letter or a learned language."""
        if not self.languages or not has_letter(text):
            return "und", 0.0
        raw = text.encode("utf-8", "surrogatepass")
        total = np.zeros(len(self.languages))
        for at in range(0, -(-len(raw) // WINDOW), BLOCK):
            block, sizes = windows_of(raw, at, BLOCK)
            total += sizes @ self.probabilities(block)
        return self._named(total)

    def _named(self, total: np.ndarray) -> tuple[str, float]:
        best = int(total.argmax())
        return self.languages[best], float(min(1.0, total[best] / total.sum()))

    def predict_many(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """As ``predict``, with the windows of short texts run together."""
        result: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
        held: list[tuple[int, np.ndarray, np.ndarray]] = []

        def flush() -> None:
            if not held:
                return
            chances = self.probabilities(np.concatenate([b for _, b, _ in held]))
            at = 0
            for i, block, sizes in held:
                result[i] = self._named(sizes @ chances[at:at + len(block)])
                at += len(block)
            held.clear()

        rows = 0
        for i, text in enumerate(texts):
            if not self.languages or not has_letter(text):
                continue
            raw = text.encode("utf-8", "surrogatepass")
            if len(raw) > BLOCK * WINDOW:
                result[i] = self.predict(text)
                continue
            block, sizes = windows_of(raw, 0, BLOCK)
            if rows + len(block) > BLOCK:
                flush()
                rows = 0
            held.append((i, block, sizes))
            rows += len(block)
        flush()
        return result


def training_windows(docs: DataFrame, lang_col: str, text_col: str, id_col: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """A bounded sample: about ``TEXTS_PER_LANGUAGE`` texts a language by a hash of id and length, windows spread
    over each whole text. Only the windows reach the driver."""
    rows = docs.where(F.col(lang_col).isNotNull() & (F.length(F.coalesce(text_col, F.lit(""))) > 0)).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("string").alias("id"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(counts)
    if not languages:
        return [], np.zeros((0, WINDOW), np.int16), np.zeros(0, np.int64)
    share = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(int((1 << 30) * min(1.0, TEXTS_PER_LANGUAGE / n))))])
    drawn = rows.where(F.pmod(F.xxhash64("id", F.length("text")), F.lit(1 << 30)) < share[F.col("lang")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, parts = [], []
            for lang, text in zip(batch.column(0), batch.column(1)):
                raw = text.as_py()
                if not has_letter(raw):
                    continue
                raw = raw.encode("utf-8", "surrogatepass")
                n = -(-len(raw) // WINDOW)
                for at in sorted({k * (n - 1) // max(1, WINDOWS_PER_TEXT - 1) for k in range(WINDOWS_PER_TEXT)}):
                    names.append(lang.as_py())
                    parts.append(raw[at * WINDOW:(at + 1) * WINDOW])
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(parts, pa.binary())], names=["lang", "part"])

    got = sorted((r["lang"], bytes(r["part"])) for r in drawn.select("lang", "text").mapInArrow(run, "lang string, part binary").collect())
    blocks = np.concatenate([windows_of(p, 0, 1)[0] for _, p in got]) if got else np.zeros((0, WINDOW), np.int16)
    languages = sorted({lang for lang, _ in got})
    place = {lang: i for i, lang in enumerate(languages)}
    return languages, blocks, np.array([place[lang] for lang, _ in got], np.int64)


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id") -> ByteNetwork:
    """A network for the languages of the labelled rows of ``docs``; without any it answers ``und``."""
    languages, blocks, targets = training_windows(docs, lang_col, text_col, id_col)
    network = ByteNetwork(languages)
    return network.fit(blocks, targets) if len(blocks) else network


def predict_languages(docs: DataFrame, network: ByteNetwork, text_col: str = "text", passed: tuple[str, ...] = ()) -> DataFrame:
    """The ``passed`` columns of each row with lang_pred and score (mean probability of the predicted language).

    Null, empty and letterless texts give ``und`` and 0. Whole texts are read, a block of windows at a time.
    """
    kinds = dict(docs.select(*passed).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = batch.column(0), []
            for at in range(0, batch.num_rows, 64):
                found += network.predict_many(texts.slice(at, 64).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[*passed, "lang_pred", "score"])

    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in passed], "lang_pred string", "score double"])
    return docs.select(F.col(text_col).cast("string").alias("__text"), *passed).mapInArrow(run, schema)


def keep_known(docs: DataFrame, network: ByteNetwork, least: float = 0.4, text_col: str = "text") -> DataFrame:
    """``docs`` without rows that are ``und`` or whose language has a mean probability below ``least``; all columns kept."""
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, kept = batch.column(place), []
            for at in range(0, batch.num_rows, 64):
                kept += [lang != "und" and score >= least for lang, score in network.predict_many(texts.slice(at, 64).to_pylist())]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def identify(docs: DataFrame, parts: int = 4, held: int = 2, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: id, held_out, lang_pred, score. Rows of split ``held`` are never learned from."""
    network = train(docs.where(split_number(id_col, parts) != held), lang_col, text_col, id_col)
    rows = docs.select(F.col(id_col), F.col(text_col), (split_number(id_col, parts) == held).alias("held_out"))
    return predict_languages(rows, network, text_col, (id_col, "held_out"))
