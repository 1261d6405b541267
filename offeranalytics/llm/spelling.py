"""Spelling variants grouped over a variable-length gram index.

A dictionary holds all grams of ``SHORTEST`` code points and every longer one whose prefix is so frequent that its list
would be long; it is closed under prefixes. A word is cut greedily: at each place the longest gram of the dictionary
counts, unless an earlier one covers it. Whether a gram counts depends on a window only: its own code points, one more if a longer
gram continues it, and those before it if a longer gram ends with it. So an edit spoils the grams whose window it
falls into and leaves all others, at places moved by one at most; the largest number that one edit can spoil is the
bound of a word. Of two near words the two rarest common grams stand among the bound + 2 rarest of either (in one fixed
order of grams), so merging the lists of these and asking for two hits finds every pair. That takes two grams beyond
the bound in one of the words; words without them also enter an index of shortest grams, where the bound is
``SHORTEST`` and every word of ``LEAST_LENGTH`` or more has them. All pairs that meet are verified.
"""

from collections import defaultdict
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import cut

SHORTEST, LONGEST = 2, 4
#: From this length on every word has two grams of ``SHORTEST`` that one edit leaves.
LEAST_LENGTH = 2 * SHORTEST + 1
#: A gram is continued if it stands in more than this share of the words.
LONG_LIST = 0.05
#: The dictionary goes to all tasks; with more grams than this, the share is raised.
MOST_GRAMS = 200_000
HITS = 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OTHER = r"[^a-zÀ-ÿ]+"
MASK = (1 << 64) - 1


def runs(text: Column) -> Column:
    """Maximal runs of Latin letters, A-Z in lower case; null has none."""
    plain = F.octet_length(text) == F.length(text)  # then the built-in lower changes A-Z only
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.filter(F.split(lowered, OTHER), lambda w: w != "")


def counted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage: int | None = None) -> DataFrame:
    """(word, n) over whole texts. With ``damage`` a run loses a code point where that number divides the checksum of id and run.

    A null id reads as empty. Counts add up before they are shuffled, so a word of a third of all rows is no hot key.
    """
    words = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs(F.col(text_col).cast("string"))).alias("word"))
    if damage is not None:
        h = F.crc32(F.concat("id", F.lit(":"), "word").cast("binary"))
        at = (F.col("h") % F.length("word")).cast("int")
        shorter = F.concat(F.substr("word", F.lit(1), at), F.substr("word", at + 2))
        words = words.withColumn("h", h).select(F.when(F.col("h") % damage == 0, shorter).otherwise(F.col("word")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


class Grams:
    """A dictionary closed under prefixes, with the number of times each gram stands in the words."""

    def __init__(self, counts: dict[str, int]):
        self.counts = counts
        self.continued = {g[:-1] for g in counts if len(g) > SHORTEST}
        #: code points before a gram by which some longer gram that ends with it begins
        self.before: dict[str, int] = defaultdict(int)
        for gram in counts:
            for k in range(1, len(gram) - SHORTEST + 1):
                self.before[gram[k:]] = max(self.before[gram[k:]], k)
        self.codes: dict[tuple[str, int], int] = {}

    def cut(self, word: str, longest: int = LONGEST) -> list[tuple[int, str, int, int, int]]:
        """(count, gram, place, first, end of the window) of the grams of a word."""
        found, covered, size = [], 0, len(word)
        for at in range(size - SHORTEST + 1):
            end = at + SHORTEST
            while end < min(size, at + longest) and word[at:end + 1] in self.counts:
                end += 1
            if end <= covered:
                continue
            covered, gram = end, word[at:end]
            far = longest > SHORTEST
            first = at - self.before.get(gram, 0) if far else at
            found.append((self.counts.get(gram, 0), gram, at, first, end + (far and len(gram) < longest and gram in self.continued)))
        return found

    @staticmethod
    def bound(grams: list[tuple[int, str, int, int, int]], size: int) -> int:
        """The most grams whose window one edit can fall into."""
        change = [0] * (size + 2)
        for _, _, _, first, end in grams:
            change[max(0, first)] += 1
            change[min(size, end)] -= 1
        most = level = 0
        for c in change:
            level += c
            most = max(most, level)
        return most

    def _code(self, gram: str, at: int) -> int:
        code = self.codes.get((gram, at))
        if code is None:
            code = self.codes[gram, at] = xxhash.xxh3_64_intdigest(gram, at)
        return code

    def keys(self, word: str) -> tuple[list[int], list[int]]:
        """Keys under which a word is listed, and those under which it looks for words longer by one."""
        size, listed, sought = len(word), [], []
        for level, longest in enumerate((LONGEST, SHORTEST)):
            grams = self.cut(word, longest)
            bound = self.bound(grams, size)
            rarest = sorted((g[2], g[1]) for g in sorted(grams)[:bound + HITS])
            for (p, a), (q, b) in combinations(rarest, HITS):
                listed.append(self._key(level, size, a, p, b, q))
                sought += [self._key(level, size + 1, a, p + i, b, q + j) for i, j in ((0, 0), (0, 1), (1, 1))]
            if len(grams) - bound >= HITS:
                break
        return listed, sought

    def _key(self, level: int, size: int, a: str, p: int, b: str, q: int) -> int:
        mixed = (self._code(a, p) * 0x9E3779B97F4A7C15 + self._code(b, q) * 0xC2B2AE3D27D4EB4F + (size * 2 + level) * 0x165667B19E3779F9) & MASK
        return mixed - (1 << 64) if mixed >> 63 else mixed


def gram_dictionary(words: DataFrame, long_list: float = LONG_LIST, most: int = MOST_GRAMS) -> Grams:
    """The dictionary of stored ``words`` (word): at most ``most`` grams, or all shortest ones if these are more."""
    total = words.count()
    each = F.flatten(F.transform(F.sequence(F.lit(SHORTEST), F.least(F.lit(LONGEST), F.length("word"))), lambda q: F.transform(
        F.sequence(F.lit(1), F.length("word") - q + 1), lambda i: F.substr("word", i, q))))
    counts = cut(words.where(F.length("word") >= SHORTEST).select(F.explode(each).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n")))
    size = F.length("gram")
    limit = long_list * total
    while True:
        frequent = counts.where((F.col("n") > limit) & (size < LONGEST)).select(F.col("gram").alias("prefix"))
        longer = counts.where(size > SHORTEST).join(frequent, F.expr("left(gram, length(gram) - 1)") == F.col("prefix"), "left_semi")
        chosen = counts.where(size == SHORTEST).unionByName(longer)
        if chosen.count() <= most or longer.isEmpty():
            return Grams({r["gram"]: r["n"] for r in chosen.toLocalIterator()})
        limit *= 2


def near_pairs(words: DataFrame, grams: Grams) -> DataFrame:
    """(a, b, na, nb): every pair of stored ``words`` (word, n) one inserted, deleted or replaced code point apart, once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [grams.keys(w) for w in batch.column(0).to_pylist()]
            lists = [pa.array([k[i] for k in keys], pa.list_(pa.int64())) for i in range(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists], names=["word", "n", "listed", "sought"])

    indexed = cut(words.select("word", "n").mapInArrow(run, "word string, n bigint, listed array<bigint>, sought array<bigint>"))
    lists = indexed.select(F.explode("listed").alias("key"), F.col("word").alias("b"), F.col("n").alias("nb"))
    looking = indexed.select(F.explode(F.concat("listed", "sought")).alias("key"), F.col("word").alias("a"), F.col("n").alias("na"))
    more = F.length("b") - F.length("a")
    met = looking.join(lists, "key").where((more == 1) | ((more == 0) & (F.col("a") < F.col("b"))))
    return met.where(F.levenshtein("a", "b", 1) == 1).select("a", "b", "na", "nb").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of stored ``forms`` (word, form) by pointer jumping; counts at least double along a chain, so it is short."""
    jumps = forms.select("word", F.col("form").alias("root"))
    for _ in range(64):
        ahead = jumps.select(F.col("word").alias("via"), F.col("root").alias("next"))
        moved = cut(jumps.join(ahead, F.col("root") == F.col("via"), "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if not moved.agg(F.max("moved")).first()[0]:
            return moved.select("word", "root")
        jumps = moved.select("word", "root")
    raise RuntimeError("the chains of forms did not end")


def spelling_variants(counts: DataFrame, ratio: int = 2, least_length: int = LEAST_LENGTH, least_count: int = 3,
                      long_list: float = LONG_LIST, most_grams: int = MOST_GRAMS) -> DataFrame:
    """One row per word of ``counts`` (word, n): word, n, form, form_n, n_near, root.

    Words shorter than ``least_length`` code points or rarer than ``least_count`` are left out, and so is a null word. Near words
    differ by one inserted, deleted or replaced code point; ``n_near`` counts all of them. The form is the near word of
    largest n (ties: smallest in code-point order) where that is at least ``ratio`` times the word's, else null; the
    root is where following forms ends, the word itself without a form. Rows that repeat a word add up. An empty table
    gives no rows. Other columns are not read. ``least_length`` must be 5 or more, see the module's text.
    """
    if least_length < LEAST_LENGTH or ratio < 2:
        raise ValueError(f"words of {LEAST_LENGTH} or more code points and a ratio of 2 or more are needed")
    summed = counts.groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    words = cut(summed.where((F.length("word") >= least_length) & (F.col("n") >= least_count)))
    pairs = cut(near_pairs(words, gram_dictionary(words, long_list, most_grams)))
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("na").alias("n"), F.struct((-F.col("nb")).alias("less"), F.col("b").alias("form")).alias("near")),
        F.struct(F.col("b").alias("word"), F.col("nb").alias("n"), F.struct((-F.col("na")).alias("less"), F.col("a").alias("form")).alias("near")))).alias("r")).select("r.*")
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min("near").alias("near"), F.first("n").alias("own"))
    takes = -F.col("near.less") >= ratio * F.col("own")
    best = cut(best.select("word", "n_near", F.when(takes, F.col("near.form")).alias("form"), F.when(takes, -F.col("near.less")).alias("form_n")))
    roots = _roots(best.where("form is not null").select("word", "form"))
    return words.join(best, "word", "left").join(roots, "word", "left").select(
        "word", "n", "form", "form_n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.coalesce("root", "word").alias("root"))
