"""WARC archives: a distributed writer with revisit records, and a reader that verifies the chain of boundaries.

The reader cuts files at every occurrence of the record magic, also inside payloads. Each candidate names its
successor: its offset plus the length its header states. Candidates that lead straight to the next one are joined to
runs; pointer jumping from offset 0 of each file over the runs' exits then finds what a sequential reader would
reach. Only those candidates are records.
"""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import cut, salted_join, shared_folder

# Fixed values of the format
MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEAST_REVISIT = 100
DATE = "2024-01-01T00:00:00Z"
RECORDS_PER_FILE = 50_000


def page_rows(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(id, url, payload, digest, first): ``first`` is the smallest id with the same payload where it is another row's
    and the payload has at least ``LEAST_REVISIT`` bytes. Null payloads are empty; null ids never lead a group."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    long = F.octet_length("payload") >= LEAST_REVISIT
    total = rows.count()
    groups = cut(rows.where(long).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    joined = salted_join(rows, groups, ["digest"], "n", total)
    other = F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    return joined.select("id", "url", "payload", "digest", other.alias("first"))


def _line(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def record(date: str = DATE) -> Column:
    """The bytes of one record without its end mark, from the columns of ``page_rows``."""
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    revisit = F.col("first").isNotNull()
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    return F.concat(
        F.lit(MAGIC), F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit("\r\n"),
        _line("WARC-Record-ID", urn(F.col("id"))), _line("WARC-Target-URI", url), _line("WARC-Date", F.lit(date)),
        _line("WARC-Refers-To", urn(F.col("first"))), _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("X-Payload-Length", F.octet_length("payload").cast("string")), _line("Content-Type", F.lit("text/html; charset=utf-8")),
        F.lit("Content-Length: "), F.octet_length(body).cast("string"), F.lit(END), body)


def write_warc(pages: DataFrame, path: str, compression: str = "gzip", records_per_file: int = RECORDS_PER_FILE, **columns: str) -> None:
    """Write a record for each row to archive files under ``path``; the text writer's line end is the end mark.

    A file is one gzip stream or, with compression "none", plain and read in splits. Control characters and blanks
    of a url become %20, a null url or id leaves its header out.
    """
    (page_rows(pages, **columns).select(record().alias("value")).write.option("lineSep", END).option("compression", compression)
     .option("maxRecordsPerFile", records_per_file).text(path))


def _header(name: str) -> Column:
    return F.regexp_extract("head", rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1)


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """Pieces between magics: file, block, id (in reading order), size in bytes, value."""
    raw = spark.read.option("lineSep", MAGIC).text(path)
    return raw.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                      F.monotonically_increasing_id().alias("id"), F.octet_length("value").cast("long").alias("size"))


def _parsed(chunks: DataFrame) -> DataFrame:
    """Header of each piece; payload and digest where the piece holds the whole record."""
    headed = chunks.withColumn("head", F.substring_index("value", END, 1))
    length = F.expr("try_cast(regexp_extract(head, '(?im)^Content-Length:[ \\t]*([0-9]+)[ \\t]*\\r?$', 1) as bigint)")
    sized = headed.withColumns({"head_size": F.octet_length("head").cast("long"), "length": length})
    return sized.withColumns({"reach": F.col("head_size") + len(END) + F.col("length") + len(END), "kind": _header("WARC-Type")})


def _placed(rows: DataFrame) -> DataFrame:
    """Add ``off``, the place of each piece's magic in its file: sums inside a block, then of the blocks before."""
    step = F.col("size") + len(MAGIC)
    inside = Window.partitionBy("file", "block").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("file", "block").agg(F.sum(step).alias("step")).select(
        "file", "block", F.coalesce(F.sum("step").over(earlier), F.lit(0)).alias("before"))
    placed = rows.withColumn("within", F.coalesce(F.sum(step).over(inside), F.lit(0))).join(blocks, ["file", "block"])
    return placed.withColumn("off", F.col("before") + F.col("within") - len(MAGIC)).drop("before", "within")


def reachable(candidates: DataFrame) -> DataFrame:
    """Rows of ``candidates`` (file, off, next, ...) on the chain from offset 0 of their file, by pointer jumping.

    ``candidates`` should be stored. Runs of candidates that lead straight to the next one are one node. Every
    round doubles the jumps, so a file with r runs takes log2(r) rounds.
    """
    order = Window.partitionBy("file").orderBy("off")
    starts = F.coalesce(F.lag("next").over(order) != F.col("off"), F.lit(True))
    runs = candidates.withColumn("run", F.sum(starts.cast("long")).over(order))
    runs = cut(runs)
    exits = runs.groupBy("file", "run").agg(F.max_by("next", "off").alias("exit"))
    entries = runs.select("file", F.col("off").alias("exit"), F.col("run").alias("to"))
    jumps = cut(exits.join(entries, ["file", "exit"]).select("file", "run", "to", F.col("exit").alias("entry")))
    reached = cut(runs.where("off = 0").select("file", "run", F.lit(0).cast("long").alias("entry")))
    while not jumps.isEmpty():
        new = reached.select("file", "run").join(jumps, ["file", "run"]).select("file", F.col("to").alias("run"), "entry")
        reached = cut(reached.unionByName(new).distinct())
        onward = jumps.select("file", F.col("run").alias("to"), F.col("to").alias("far"), F.col("entry").alias("at"))
        jumps = cut(jumps.join(onward, ["file", "to"]).select("file", "run", F.col("far").alias("to"), F.col("at").alias("entry")))
    return runs.join(reached, ["file", "run"]).where(F.col("off") >= F.col("entry")).drop("run", "entry")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: file, offset, type, record_id, target_uri, refers_to, digest, stated_bytes, payload_sha256.

    ``digest`` and ``stated_bytes`` are what the header says of the full payload, ``payload_sha256`` is computed
    from the payload read (null for revisits). Files without a record at offset 0, and a truncated tail, give no rows.
    Only records with a magic inside are put together again from their pieces; others stay in their task.
    """
    parsed = _parsed(_chunks(spark, path))
    whole = F.col("reach") == F.col("size")
    payload = F.expr(f"substring(cast(value as binary), cast(head_size + {len(END)} + 1 as int), cast(length as int))")
    slim = parsed.select("file", "block", "id", "size", "head", "kind", "reach", F.coalesce(whole, F.lit(False)).alias("whole"),
                         F.when(whole, F.sha2(payload, 256)).alias("payload_sha256"))
    # from the magic to the end mark; a piece without a length leads nowhere
    placed = _placed(slim).where("off >= 0").withColumn("next", F.col("off") + F.col("reach") + len(MAGIC))
    records = cut(reachable(cut(placed.select("file", "off", "next", "head", "kind", "whole", "payload_sha256"))))
    split = records.where(~F.col("whole") & F.col("next").isNotNull())
    if not split.isEmpty():
        records = records.where("whole").unionByName(_rejoined(spark, path, split))
    else:
        records = records.where("whole")
    named = lambda c: F.regexp_extract(c, r"^<urn:page:(.*)>$", 1)
    blank = lambda c: F.when(c != "", c)
    return records.select(
        "file", F.col("off").alias("offset"), F.col("kind").alias("type"), blank(named(_header("WARC-Record-ID"))).alias("record_id"),
        blank(_header("WARC-Target-URI")).alias("target_uri"), blank(named(_header("WARC-Refers-To"))).alias("refers_to"),
        blank(F.regexp_replace(_header("WARC-Payload-Digest"), "^sha256:", "")).alias("digest"),
        F.expr("try_cast(regexp_extract(head, '(?im)^X-Payload-Length:[ \\t]*([0-9]+)', 1) as bigint)").alias("stated_bytes"),
        F.when(F.col("kind") != "revisit", F.col("payload_sha256")).alias("payload_sha256"))


def _rejoined(spark: SparkSession, path: str, split: DataFrame) -> DataFrame:
    """Records whose payload holds the magic: their files are read again and the pieces joined."""
    split = cut(split)
    files = split.select("file").distinct()
    chunks = _placed(_chunks(spark, path).join(files, "file", "left_semi")).where("off >= 0")
    spans = split.select("file", F.col("off").alias("from"), "next")
    order = Window.partitionBy("file").orderBy("off").rowsBetween(Window.unboundedPreceding, 0)
    marked = chunks.join(spans, (chunks["file"] == spans["file"]) & (chunks["off"] == spans["from"]), "left").select(
        chunks["file"], "off", "value", "from", "next")
    owned = marked.withColumns({"owner": F.last("from", ignorenulls=True).over(order), "until": F.last("next", ignorenulls=True).over(order)})
    pieces = owned.where(F.col("off") < F.col("until")).groupBy("file", "owner").agg(
        F.array_sort(F.collect_list(F.struct("off", "value"))).alias("pieces"))
    value = F.array_join(F.transform("pieces", lambda p: p["value"]), MAGIC)
    whole = _parsed(pieces.select("file", F.col("owner").alias("off"), value.alias("value"), F.octet_length(value).cast("long").alias("size")))
    payload = F.expr(f"substring(cast(value as binary), cast(head_size + {len(END)} + 1 as int), cast(length as int))")
    return whole.where(F.col("size") >= F.col("reach")).select(
        "file", "off", (F.col("off") + F.col("reach") + len(MAGIC)).alias("next"), "head", "kind", F.lit(True).alias("whole"),
        F.sha2(payload, 256).alias("payload_sha256"))


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", compression: str = "gzip") -> DataFrame:
    """Write all pages to archives in the shared folder, read them back: id, payload_bytes, payload_digest, record_type,
    refers_to. One row per page; rows repeating id and payload of a group's first are responses too. The archives
    are removed when the result is stored. A response whose payload does not give the stated digest is an error.
    """
    spark = pages.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_warc(pages, path, compression, id_col=id_col, url_col=url_col, payload_col=payload_col)
    kind = pages.schema[id_col].dataType
    sound = F.when((F.col("type") == "revisit") | F.col("payload_sha256").eqNullSafe(F.col("digest")), F.col("digest")).otherwise(
        F.raise_error(F.lit("a payload does not match its digest")))
    result = cut(read_warc(spark, path).select(
        F.col("record_id").cast(kind).alias(id_col), F.col("stated_bytes").alias("payload_bytes"), sound.alias("payload_digest"),
        F.col("type").alias("record_type"), F.col("refers_to").cast(kind).alias("refers_to")))
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return result
