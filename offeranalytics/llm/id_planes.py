"""Token ids in binary files whose blocks are shuffled into planes.

Documents are dealt to files by ascending id. Their ids form one stream a file, cut into blocks of ``BLOCK`` ids. A block
is transposed, so that one byte (or bit) of all its ids lies together, and each such plane is compressed by itself;
upper planes are nearly constant and vanish. The file ends with an index: where each block begins, how long its planes
are, and the id and length of every document, so a reader takes only the blocks it needs.

Layout, numbers little-endian, a line end after each of the parts: header (magic, mode, number of the file); blocks
(compressed planes one after the other); index (compressed document ids as JSON, compressed lengths, block
table) with its footer. Spark's writer and reader move the bytes, so files may lie in any store that Spark reaches.
"""

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import cut, shared_folder

# Fixed values of the format
MAGIC, TAIL = b"IDPLANE1", b"IDPLEND1"
MODES = {"byte": b"Y", "bit": b"I"}
PLANES = {b"Y": 4, b"I": 32}
HEAD, FOOT = "<8s1sI", "<QQQQI8s"
BLOCK = 1 << 16
LEVEL = 3
#: Bytes of text that go to one file.
FILE_BYTES = 32 << 20
#: Pieces whose ids a worker remembers.
KNOWN = 600_000
# The pattern by which the word vocabulary cuts lower-cased texts, and the same for Latin-1 letters
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-z0-9ß-öø-ÿ]+")
#: Where the two may differ: rare white space, other letters and numbers, and what could be a special string.
OTHER = re.compile("[\x1c-\x1f\x85\xa0\xaa\xb2\xb3\xb5\xb9\xba\xbc-\xbe\u0100-\U0010ffff]|<\\|")


class Encoder:
    """Ids of whole texts by the tokenizers library, as little-endian 32-bit numbers.

    Where a vocabulary cuts texts by ``PATTERN``, a text of Latin-1 letters is cut here and the library's model encodes each
    piece once; a worker remembers the first ``KNOWN``. All other texts go to the library whole.
    """

    def __init__(self, path: str, end_id: int | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_piece = cuts_by_pattern(path)
        if self.by_piece:
            self.model = Tokenizer.from_file(path)
            self.model.normalizer = normalizers.Sequence([])
            self.model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.known: dict[str, bytes] = {}
        self.end = b"" if end_id is None else struct.pack("<I", end_id)

    @staticmethod
    def _ids(tokenizer, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text and the end id; null counts as empty."""
        whole = [t or "" for t in texts]
        cut_up = [PIECES.findall(t.lower()) if self.by_piece and not OTHER.search(t) else None for t in whole]
        new = list({p for ps in cut_up if ps for p in ps if p not in self.known})
        fresh = dict(zip(new, self._ids(self.model, new))) if new else {}
        if len(self.known) + len(new) <= KNOWN:
            self.known |= fresh
            fresh = self.known
        else:
            fresh |= {p: self.known[p] for ps in cut_up if ps for p in ps if p in self.known}
        return [(b"".join(map(fresh.__getitem__, ps)) if ps is not None else self._ids(self.tokenizer, [t])[0]) + self.end
                for t, ps in zip(whole, cut_up)]


def cuts_by_pattern(path: str) -> bool:
    """Does the vocabulary normalise as the word vocabulary does and cut by ``PATTERN``, dropping what does not match?"""
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    split, *rest = (data.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    normalizers = (data.get("normalizer") or {}).get("normalizers") or []
    space = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
    return (split.get("type") == "Split" and split["behavior"] == "Removed" and split["invert"] and split["pattern"] == {"Regex": PATTERN}
            and [(r["type"], r["add_prefix_space"], r["use_regex"]) for r in rest] == [("ByteLevel", False, False)]
            and normalizers == [{"type": "NFC"}, space, {"type": "Lowercase"}]
            and all(t["content"].startswith("<|") and not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in data["added_tokens"]))


def _encoder(path: str, end_id: int | None) -> Encoder:
    """Functions of this package travel by value, so what is to outlive a task is kept with the library's own module."""
    import tokenizers

    held = tokenizers.__dict__.setdefault("_encoders_of_id_planes", {})
    if (path, end_id) not in held:
        held[path, end_id] = Encoder(path, end_id)
    return held[path, end_id]


def to_planes(ids: np.ndarray, mode: bytes) -> list[bytes]:
    """The planes of a block, lowest first, each compressed."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    rows = raw.T if mode == MODES["byte"] else np.packbits(np.unpackbits(raw, axis=1, bitorder="little").T, axis=1, bitorder="little")
    packer = zstandard.ZstdCompressor(level=LEVEL)
    return [packer.compress(np.ascontiguousarray(r).tobytes()) for r in rows]


def from_planes(planes: list[bytes], n: int, mode: bytes) -> np.ndarray:
    """The ids of a block of ``n``."""
    opener = zstandard.ZstdDecompressor()
    rows = np.stack([np.frombuffer(opener.decompress(p), np.uint8) for p in planes])
    if mode == MODES["bit"]:
        rows = np.packbits(np.unpackbits(rows, axis=1, count=n, bitorder="little").T, axis=1, bitorder="little").T
    return np.ascontiguousarray(rows.T).view("<u4").reshape(-1)


def _table(mode: bytes) -> np.dtype:
    return np.dtype([("offset", "<u8"), ("n", "<u4"), ("crc", "<u4"), ("sizes", "<u4", (PLANES[mode],))])


def file_parts(number: int, docs: Iterator[tuple[object, bytes]], mode: bytes, block: int = BLOCK) -> Iterator[bytes]:
    """The parts of one file without their line ends; ``docs`` are (id, ids as bytes) in order."""
    head = struct.pack(HEAD, MAGIC, mode, number)
    names, lengths, table, offset = [], [], [], len(head) + 1
    waiting = bytearray()
    yield head

    def blocks(least: int) -> Iterator[bytes]:
        nonlocal offset
        at = 0
        while len(waiting) - at >= least:
            ids = np.frombuffer(bytes(waiting[at:at + 4 * block]), "<u4")
            at += 4 * block
            planes = to_planes(ids, mode)
            part = b"".join(planes)
            table.append((offset, len(ids), zlib.crc32(part), [len(p) for p in planes]))
            offset += len(part) + 1
            yield part
        del waiting[:at]

    for name, ids in docs:
        names.append(name)
        lengths.append(len(ids) // 4)
        waiting += ids
        if len(waiting) >= 4 * block:
            yield from blocks(4 * block)
    yield from blocks(1)
    packer = zstandard.ZstdCompressor(level=LEVEL)
    sections = [packer.compress(json.dumps(names).encode()), packer.compress(np.array(lengths, "<u8").tobytes()), np.array(table, _table(mode)).tobytes()]
    body = b"".join(sections)
    yield body + struct.pack(FOOT, *[len(s) for s in sections], offset, zlib.crc32(body), TAIL)


class IdFile:
    """One file's bytes: its number, the ids of its documents in order, and the places of their first ids."""

    def __init__(self, content: bytes):
        magic, self.mode, self.number = struct.unpack_from(HEAD, content)
        *sizes, offset, crc, tail = struct.unpack_from(FOOT, content, len(content) - 1 - struct.calcsize(FOOT))
        body = content[offset:offset + sum(sizes)]
        if magic != MAGIC or tail != TAIL or zlib.crc32(body) != crc:
            raise ValueError("not a whole file of token ids")
        a, b = sizes[0], sizes[0] + sizes[1]
        opener = zstandard.ZstdDecompressor()
        self.content, self.names = content, json.loads(opener.decompress(body[:a]))
        self.lengths = np.frombuffer(opener.decompress(body[a:b]), "<u8").astype(np.int64)
        self.table = np.frombuffer(body[b:], _table(self.mode))
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)))
        self.firsts = np.concatenate(([0], np.cumsum(self.table["n"].astype(np.int64))))
        self._held: tuple[int, np.ndarray] = (-1, np.zeros(0, "<u4"))

    def _block(self, i: int) -> np.ndarray:
        if self._held[0] != i:
            row, at, planes = self.table[i], int(self.table["offset"][i]), []
            for size in row["sizes"].tolist():
                planes.append(self.content[at:at + size])
                at += size
            if zlib.crc32(b"".join(planes)) != row["crc"]:
                raise ValueError(f"block {i} is damaged")
            self._held = (i, from_planes(planes, int(row["n"]), self.mode))
        return self._held[1]

    def ids(self, doc: int) -> np.ndarray:
        """The ids of the document at a place in the file; only blocks it touches are opened."""
        start, end = int(self.starts[doc]), int(self.starts[doc + 1])
        pieces, i = [], int(np.searchsorted(self.firsts, start, "right")) - 1
        while start < end:
            first = int(self.firsts[i])
            pieces.append(self._block(i)[start - first:end - first])
            start = min(end, int(self.firsts[i + 1]))
            i += 1
        return np.concatenate(pieces) if pieces else np.zeros(0, "<u4")


def write_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int | None, mode: str = "byte", file_bytes: int = FILE_BYTES,
              block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode whole texts and write their ids to files under ``path`` in ascending order of the id, nulls first.

    Rows of one id are ordered by a hash of the text. Texts are dealt to files by ranges of (id, hash, row), so no id is too
    frequent for one file; they are encoded where they are written and ids are never stored otherwise.
    """
    kind = docs.schema[id_col].dataType.typeName()
    if kind not in ("byte", "short", "integer", "long", "string"):
        raise ValueError(f"ids are whole numbers or strings, not {kind}")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    files = max(-(-total // file_bytes), min(least, -(-total // (1 << 20))), 1)
    sign = MODES[mode]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = _encoder(vocabulary, end_id)

        def documents() -> Iterator[tuple[object, bytes]]:
            for batch in batches:
                names = batch.column(0).to_pylist()
                for at in range(0, batch.num_rows, 256):
                    yield from zip(names[at:at + 256], encoder.encode(batch.column(1).slice(at, 256).to_pylist()))

        each = documents()
        first = next(each, None)
        if first is not None:
            def again() -> Iterator[tuple[object, bytes]]:
                yield first
                yield from each

            for part in file_parts(TaskContext.get().partitionId(), again(), sign, block):
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.binary())], names=["part"])

    order = ["id", "hash", "row"]
    dealt = rows.select("id", "text", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("row")).repartitionByRange(
        files, *order).sortWithinPartitions(*order).select("id", "text")
    # the cast keeps the bytes as they are
    dealt.mapInArrow(run, "part binary").select(F.col("part").cast("string").alias("value")).write.option("lineSep", "\n").text(path)


def read_ids(spark: SparkSession, path: str, id_type: str) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document in the files, in no order of rows; start counts over all files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                data = content.as_buffer().to_pybytes()
                if data:
                    file = IdFile(data)
                    crcs = [zlib.crc32(file.ids(i).tobytes()) for i in range(len(file.names))]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(file.names, kind), pa.array([file.number] * len(crcs), pa.int64()), pa.array(file.starts[:-1]), pa.array(file.lengths),
                        pa.array(crcs, pa.int64())], names=["id", "number", "inside", "n_tokens", "ids_crc32"])

    kind = {"tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}[id_type]
    docs = cut(spark.read.format("binaryFile").load(path).select("content").mapInArrow(
        run, f"id {id_type}, number bigint, inside bigint, n_tokens bigint, ids_crc32 bigint"))
    sizes = docs.groupBy("number").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    offsets = sizes.select("number", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return docs.join(offsets, "number").select("id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, vocabulary: str, end_id: int | None = 2, mode: str = "byte", file_bytes: int = FILE_BYTES, block: int = BLOCK,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all documents to files in the shared folder, read them back: id, start, n_tokens, ids_crc32.

    One row per row of ``docs``. A null text is empty and holds the end id only. Null ids come first; rows of one
    id follow in the order of a hash of their texts, repeated rows one after the other. The files are removed when
    the result is stored. An empty table gives no rows. Other columns are not read. Damaged files are an error.
    """
    spark = docs.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/ids-{uuid.uuid4().hex}"
    write_ids(docs, path, vocabulary, end_id, mode, file_bytes, block, id_col, text_col)
    result = cut(read_ids(spark, path, docs.schema[id_col].dataType.simpleString()).withColumnRenamed("id", id_col))
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return result
