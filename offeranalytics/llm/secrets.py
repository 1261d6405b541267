"""Secret scans with corpus-wide ownership, in DataFrame functions only.

Patterns find candidates and their places. Hashes of the candidates' values are then counted over the whole corpus by
distinct repositories and owners: a value that many owners or many repositories hold is a copied example, one that a
single owner holds in few repositories and that looks random is reported as live, also where no base pattern caught it.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import cut, join_facts

# The base patterns, in the order in which spans at one place are listed
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Any long run of key characters; reported as ``owned`` if it holds letters and digits and one owner has it.
RUN = r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{20,}+"
KINDS = ["assign", "access", "hex", "owned"]
LEAST_VALUE = 6
#: From this many owners on a value is a copied example.
COPIED_OWNERS = 3
#: From this many repositories on, whoever owns them, too.
COPIED_REPOS = 10

FOUND = "array<struct<kind:int,no:int,gap:bigint,size:bigint,value:string>>"


def _matches(text: str, matches: str, pattern: str, kind: int, value: Column | None = None) -> Column:
    """Matches of a pattern with the number of code points between each and the one before it."""
    zipped = F.arrays_zip(F.split(text, pattern).alias("gaps"), F.col(matches).alias("found"))
    shown = F.transform(zipped, lambda z, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("no"), F.length(z["gaps"]).cast("long").alias("gap"), F.length(z["found"]).cast("long").alias("size"),
        z["found"].alias("value")))
    return F.when(F.size(matches) > 0, F.filter(shown, lambda m: m["value"].isNotNull())).otherwise(F.array().cast(FOUND))


def scan(docs: DataFrame, id_col: str, text_col: str, owner_col: str | None, repo_col: str | None) -> DataFrame:
    """One stored row per document: row, id, owner, repo, found (matches of all patterns)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c else F.lit("")
    rows = docs.select(F.col(id_col).alias("id"), named(owner_col).alias("owner"), named(repo_col).alias("repo"), text.alias("text"))
    patterns = {"m0": ASSIGN, "m1": ACCESS, "m2": HEX, "m3": RUN}
    rows = rows.select("*", *[F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(m) for m, p in patterns.items()])
    found = F.concat(*[_matches("text", m, p, k) for k, (m, p) in enumerate(patterns.items())])
    return cut(rows.select(F.monotonically_increasing_id().alias("row"), "id", "owner", "repo", found.alias("found")))


def candidates(scanned: DataFrame) -> DataFrame:
    """Matches with their places: row, kind, start, end, value, owner, repo. Runs that touch a base span are left out."""
    value = F.when(F.col("m.kind") == 0, F.regexp_extract("m.value", ASSIGN, 2)).otherwise(F.col("m.value"))
    each = scanned.select("row", "owner", "repo", F.explode("found").alias("m")).select("row", "owner", "repo", "m.kind", "m.no", "m.gap", "m.size", value.alias("value"))
    before = Window.partitionBy("row", "kind").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("gap") + F.col("size")).over(before), F.lit(0)) + F.col("gap")
    placed = each.withColumn("start", start).withColumn("end", F.col("start") + F.col("size"))
    sound = F.when(F.col("kind") == 0, F.length("value") >= LEAST_VALUE).when(
        F.col("kind") == 3, F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]")).otherwise(F.lit(True))
    kept = placed.where(sound)
    order = Window.partitionBy("row").orderBy("start", "kind")
    base = F.col("kind") < 3
    ended = F.max(F.when(base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    begun = F.min(F.when(base, F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    touched = (F.coalesce(ended, F.lit(0)) > F.col("start")) | (F.coalesce(begun, F.col("end")) < F.col("end"))
    return kept.withColumn("touched", touched).where(base | ~F.col("touched")).select(
        "row", "kind", "start", "end", "owner", "repo", F.sha2("value", 256).alias("hash"),
        ((F.length("value") >= 16) & F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]")).alias("random"))


def ownership(found: DataFrame) -> DataFrame:
    """(hash, n, repos, owners): occurrences, distinct repositories and distinct owners of each value.

    Distinct (hash, owner, repo) first, then owners, then hashes: each step adds up before it shuffles, so a value
    that a third of all rows share is spread over its owners and repositories.
    """
    repos = found.groupBy("hash", "owner", "repo").agg(F.count(F.lit(1)).alias("n"))
    owners = repos.groupBy("hash", "owner").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("repos"))
    return owners.groupBy("hash").agg(F.sum("n").alias("n"), F.sum("repos").alias("repos"), F.count(F.lit(1)).alias("owners"))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str | None = "source", repo_col: str | None = "doc_id",
                 copied_owners: int = COPIED_OWNERS, copied_repos: int | None = COPIED_REPOS) -> DataFrame:
    """One row per row of ``docs``: id and secrets - an array of (start, kind_no, kind, end, state), by start and kind.

    A span is the whole match in code points, end exclusive. ``state`` is copied (``copied_owners`` owners or
    ``copied_repos`` repositories or more hold the value), live (one owner, fewer repositories, at least 16 characters
    with letters and digits) or unsure. Without ``copied_repos`` owners alone decide. A repository is one name of one
    owner. Base spans are always listed; ``owned`` spans, which no base span touches, only while live. Null texts are
    empty; null owners and repositories are one unknown owner or repository. Repeated rows are scanned each. Other columns
    are not read.
    """
    scanned = scan(docs, id_col, text_col, owner_col, repo_col)
    found = cut(candidates(scanned))
    facts = cut(ownership(found))
    total = facts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    copied = F.col("owners") >= copied_owners
    if copied_repos is not None:
        copied = copied | (F.col("repos") >= copied_repos)
    state = F.when(copied, "copied").when((F.col("owners") == 1) & F.col("random"), "live").otherwise("unsure")
    judged = join_facts(found, facts, ["hash"], "n", total).withColumn("state", state).where((F.col("kind") < 3) | (F.col("state") == "live"))
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind") + 1)
    spans = judged.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", F.col("kind").alias("kind_no"), kind.alias("kind"), "end", "state"))).alias("secrets"))
    none = F.array().cast("array<struct<start:bigint,kind_no:int,kind:string,end:bigint,state:string>>")
    return scanned.select("row", "id").join(spans, "row", "left").select(F.col("id").alias(id_col), F.coalesce("secrets", none).alias("secrets"))


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, a hash of the base spans, all spans as text, and counts by state."""
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda test: F.size(F.filter("secrets", test)).cast("long")
    of_kind = lambda k: count(lambda s: s["kind_no"] == k)
    kinds = [of_kind(k).alias(f"n_{KINDS[k]}") for k in range(3)]
    base = F.filter("secrets", lambda s: s["kind_no"] < 3)
    return scanned.select(id_col, *kinds, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("secrets")).alias("spans"),
                          count(lambda s: s["state"] == "live").alias("n_live"), count(lambda s: s["state"] == "copied").alias("n_copied"))
