"""Benchmark decontamination over a distributed positional inverted index, in DataFrame functions only.

Corpus frequencies of the benchmark's terms come first. Every window of a benchmark item then takes its rarest
terms; only those terms get postings (document, position). Postings minus their offset in the item give the
place where the item would begin; documents and places where all rarest terms of a window agree are candidates,
and the words there are compared with the item's.
"""

from pyspark.sql import Column, DataFrame, functions as F

from .common import cut

# What separates words once A-Z are in lower case
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Lists of terms are broadcast up to this many rows, beyond that they meet the tokens in a shuffle.
BROADCAST_TERMS = 500_000


def words(text: Column) -> Column:
    """Lower-cased (A-Z only) words of a text; null has none."""
    plain = F.octet_length(text) == F.length(text)  # then the built-in lower changes A-Z only
    parts = F.split(F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER)), SEPARATORS)
    return F.coalesce(F.filter(parts, lambda w: w != ""), F.array().cast("array<string>"))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_TERMS else df


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id, a hash that tells apart texts of a repeated id, and the text."""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("version"), text.alias("text"))


def positional_index(docs: DataFrame, terms: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings (id, version, term, pos) of whole texts, of all terms or of those in ``terms`` (term)."""
    tokens = keyed(docs, id_col, text_col).select("id", "version", F.posexplode(words(F.col("text"))).alias("pos", "term"))
    return tokens if terms is None else tokens.join(_small(terms), "term").select("id", "version", "term", "pos")


def item_windows(items: DataFrame, frequency: DataFrame, window: int, rarest: int, id_col: str, text_col: str) -> DataFrame:
    """(item, item_id, words, windows): of each window of an item its start and the offsets of its rarest terms.

    Windows with a term that the corpus lacks are left out, they occur nowhere.
    """
    base = items.select(F.col(id_col).cast("string").alias("item_id"), words(F.col(text_col).cast("string")).alias("words")).where(
        F.size("words") > 0).distinct().withColumn("item", F.md5(F.concat_ws(" ", F.coalesce("item_id", F.lit("\n")), F.col("words"))))
    counted = base.select("item", F.posexplode("words").alias("off", "term")).join(frequency, "term", "left").groupBy("item").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "off"))).alias("by_rarity"))
    size = F.size("words")
    starts = F.sequence(F.lit(0), F.greatest(size - window, F.lit(0)))
    rare = lambda s: F.slice(F.filter("by_rarity", lambda x: (x["off"] >= s) & (x["off"] < s + window)), 1, rarest)
    chosen = F.transform(starts, lambda s: F.struct(s.alias("start"), rare(s).alias("rare")))
    present = F.filter(chosen, lambda w: w["rare"][0]["n"] > 0)
    slim = F.transform(present, lambda w: F.struct(w["start"].alias("start"), F.transform(w["rare"], lambda x: x["off"]).alias("offsets")))
    return base.join(counted, "item").select("item", "item_id", "words", slim.alias("windows")).where(F.size("windows") > 0)


def anchors(windows: DataFrame) -> DataFrame:
    """(term, item, off): the rarest terms of all windows and where they stand in their item."""
    offsets = F.array_distinct(F.flatten(F.transform("windows", lambda w: w["offsets"])))
    return windows.select("item", "words", F.explode(offsets).alias("off")).select(F.get("words", F.col("off")).alias("term"), "item", "off")


def candidates(postings: DataFrame, anchor_terms: DataFrame, windows: DataFrame) -> DataFrame:
    """(id, version, found): per document the items and places where all rarest terms of some window line up."""
    aligned = postings.join(_small(anchor_terms), "term").select("id", "version", "item", (F.col("pos") - F.col("off")).alias("at"), "off")
    agreed = aligned.groupBy("id", "version", "item", "at").agg(F.collect_set("off").alias("offs"))
    starts = F.transform(F.filter("windows", lambda w: F.forall(w["offsets"], lambda o: F.array_contains("offs", o)) & (w["start"] + F.col("at") >= 0)),
                         lambda w: w["start"])
    met = agreed.join(_small(windows), "item").select("id", "version", "item_id", "words", "at", starts.alias("starts")).where(F.size("starts") > 0)
    return met.groupBy("id", "version").agg(F.collect_list(F.struct("item_id", "words", "at", "starts")).alias("found"))


def phrase_matches(docs: DataFrame, items: DataFrame, window: int = 10, rarest: int = 2, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, text, n_words and matches - an array of (start, end, item_id), by start.

    A match is an exact occurrence of ``window`` consecutive words of an item; an item of fewer words is one
    window, one without words none. Null texts have no words. Repeated rows and repeated items add nothing; an
    item with a null id is matched, and named null. Empty tables give no rows or no matches.
    """
    tokens = positional_index(docs, None, id_col, text_col)
    terms = items.select(F.explode(F.array_distinct(words(F.col(item_text_col).cast("string")))).alias("term")).distinct()
    frequency = cut(tokens.join(_small(cut(terms)), "term").groupBy("term").agg(F.count(F.lit(1)).alias("n")))
    windows = cut(item_windows(items, frequency, window, rarest, item_col, item_text_col))
    anchored = cut(anchors(windows))
    postings = cut(positional_index(docs, anchored.select("term").distinct(), id_col, text_col))
    found = cut(candidates(postings, anchored, windows)).select(F.col("id").alias("f_id"), F.col("version").alias("f_version"), "found")
    rows = keyed(docs, id_col, text_col)
    joined = rows.join(found, F.col("id").eqNullSafe(F.col("f_id")) & F.col("version").eqNullSafe(F.col("f_version")), "left").select(
        "id", "text", words(F.col("text")).alias("words"), "found")

    def exact(c: Column) -> Column:
        length = F.least(F.size(c["words"]), F.lit(window))
        good = F.filter(c["starts"], lambda s: F.slice("words", c["at"] + s + 1, length) == F.slice(c["words"], s + 1, length))
        return F.transform(good, lambda s: F.struct((c["at"] + s).alias("start"), (c["at"] + s + length).alias("end"), c["item_id"].alias("item_id")))

    none = F.array().cast("array<struct<start:int,end:int,item_id:string>>")
    matches = F.when(F.col("found").isNull(), none).otherwise(F.array_sort(F.array_distinct(F.flatten(F.transform("found", exact)))))
    return joined.select(F.col("id").alias(id_col), "text", F.size("words").cast("long").alias("n_words"), matches.alias("matches"))


def proximity_matches(docs: DataFrame, phrases: DataFrame, span: int = 20, id_col: str = "doc_id", text_col: str = "text",
                      phrase_col: str = "item_id", phrase_text_col: str = "text") -> DataFrame:
    """(id, phrase, pos): occurrences of the rarest term of a phrase with all its other terms within ``span`` words."""
    terms = phrases.select(F.col(phrase_col).alias("phrase"), F.explode(F.array_distinct(words(F.col(phrase_text_col).cast("string")))).alias("term")).distinct()
    postings = cut(positional_index(docs, terms.select("term").distinct(), id_col, text_col))
    frequency = postings.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    ranked = terms.join(frequency, "term", "left").groupBy("phrase").agg(
        F.min_by("term", F.struct(F.coalesce("n", F.lit(0)), "term")).alias("rarest"), F.count(F.lit(1)).alias("wanted"))
    lists = postings.join(_small(terms), "term").groupBy("id", "version", "phrase", "term").agg(F.collect_set("pos").alias("places"))
    documents = lists.join(ranked, "phrase").groupBy("id", "version", "phrase", "wanted").agg(
        F.first(F.when(F.col("term") == F.col("rarest"), F.col("places")), ignorenulls=True).alias("seeds"),
        F.collect_list("places").alias("all")).where((F.size("all") == F.col("wanted")) & F.col("seeds").isNotNull())
    near = F.filter("seeds", lambda p: F.forall("all", lambda other: F.exists(other, lambda q: F.abs(q - p) <= span)))
    return documents.select(F.col("id").alias(id_col), "phrase", F.explode(F.array_sort(near)).alias("pos"))


def digest(matched: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of ``phrase_matches``: words, words inside a match, items, and a hash of the sorted item ids."""
    covered = F.aggregate("matches", F.struct(F.lit(0).alias("until"), F.lit(0).cast("long").alias("total")), lambda a, m: F.struct(
        F.greatest(a["until"], m["end"]).alias("until"),
        (a["total"] + F.greatest(F.lit(0), m["end"] - F.greatest(a["until"], m["start"]))).alias("total")), lambda a: a["total"])
    items = F.array_sort(F.array_distinct(F.filter(F.transform("matches", lambda m: m["item_id"]), lambda i: i.isNotNull())))
    return matched.select(id_col, "n_words", covered.alias("n_hit"), items.alias("items")).select(
        id_col, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a window of a benchmark item, all columns kept."""
    matched = phrase_matches(docs, items, window, id_col=id_col, text_col=text_col)
    dirty = cut(matched.where(F.size("matches") > 0).select(F.col(id_col).alias("__dirty"), F.xxhash64("text").alias("__version")).distinct())
    same = F.col(id_col).eqNullSafe(F.col("__dirty")) & (F.xxhash64(F.col(text_col).cast("string")) == F.col("__version"))
    return docs.join(dirty, same, "left_anti")
