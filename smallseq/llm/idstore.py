"""Binary token-id files: one zstandard frame for each document, a shared dictionary, an offset index.

A store is a folder of two Parquet tables written by Spark's committer, so that any file system works and lost tasks leave
nothing behind:

* ``dictionary``: one row (hash, bytes, vocabulary path); the dictionary is trained on serialised id arrays.
* ``blocks``: rows (part, block, first_doc, last_doc, n_docs, n_tokens, before, image). ``image`` is the binary block:
  magic, id width, dictionary hash, count of documents and of those without an id (which stand first), then the index (document ids, token counts, frame offsets), then the
  frames. ``before`` counts the ids that stand before the block in its part; parts and blocks ascend by document id.

A short document is read through the index alone: Parquet's statistics find the block, the offsets its frame.
"""

from __future__ import annotations

import hashlib
import math
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, tokens
from .batches import by_volume, hold, nothing_held

MAGIC = b"IDS2"
_HEAD = struct.Struct("<4sB32sII")
#: A block is closed at so many bytes of frames or documents.
BLOCK_BYTES, BLOCK_DOCS = 1 << 20, 4096
#: The dictionary: its size, and the bounded sample that it is trained on (documents by smallest hash of their id, the
#: leading ids of each). The sample bears on the compression ratio only, never on what is stored.
DICT_BYTES, SAMPLE_DOCS, SAMPLE_IDS, LEVEL = 32 << 10, 500, 2048, 1
#: Chunks and pieces that the encoder's caches keep.
CACHE_ENTRIES = 700_000


class LibraryEncoder:
    """The tokenizers library behind the chunk cache: pieces that are new go through its model."""

    def __init__(self, path: str):
        spec, library = tokens.load_file(path), tokens.load_library(path)
        self.tokenize = library.model.tokenize
        self.chunks = tokens.ChunkEncoder(library, {t["content"]: t["id"] for t in spec["added_tokens"]}, self._pieces, CACHE_ENTRIES)

    def _pieces(self, pieces: list[str]) -> Iterator[bytes]:
        for piece in pieces:
            found = self.tokenize(piece)
            yield struct.pack(f"<{len(found)}I", *[t.id for t in found])

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        return self.chunks.encode_column(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))


@cache
def encoder(path: str) -> LibraryEncoder:
    hold("idstore", encoder.cache_clear)
    return LibraryEncoder(path)


def _packed(ids: bytes, width: int) -> bytes:
    return np.frombuffer(ids, "<u4").astype(f"<u{width}").tobytes()


def train_dictionary(docs: DataFrame, vocab_path: str, width: int) -> bytes:
    """A dictionary from a bounded sample (see SAMPLE_DOCS); empty if there is too little text to train one."""
    usable = docs.where("doc_id is not null").select("doc_id")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31))
    cut = min(1 << 31, (4 * SAMPLE_DOCS << 31) // max(1, docs.where("doc_id is not null").count()))
    found = usable.where(place < cut).select("doc_id", place.alias("place")).distinct().collect()  # about 4 * SAMPLE_DOCS rows
    chosen = [doc for _, doc in sorted((r["place"], r["doc_id"]) for r in found)[:SAMPLE_DOCS]]
    if not chosen:
        return b""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_volume(batches, 0):
            coded = encoder(vocab_path).encode(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array([_packed(c[: 4 * SAMPLE_IDS], width) for c in coded], pa.binary())], ["ids"])

    texts = docs.where(F.col("doc_id").isin(chosen)).groupBy("doc_id").agg(F.min("text").alias("text"))  # one for each id
    rows = texts.select("text").mapInArrow(run, "ids binary").collect()
    samples = sorted(bytes(r[0]) for r in rows if r[0])
    if len(samples) < 16 or sum(map(len, samples)) < 2 * DICT_BYTES:
        return b""
    try:
        return zstandard.train_dictionary(min(DICT_BYTES, sum(map(len, samples)) // 8), samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b""


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def block_image(width: int, dict_hash: bytes, ids: list[int | None], counts: list[int], frames: list[bytes]) -> bytes:
    offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])]).astype("<u8")
    none = sum(i is None for i in ids)
    return b"".join([_HEAD.pack(MAGIC, width, dict_hash, len(ids), none), np.array([0] * none + ids[none:], "<i8").tobytes(), np.array(counts, "<u8").tobytes(), offsets.tobytes(), *frames])


class Block:
    """A parsed block: documents are decompressed one by one, through the offset index."""

    def __init__(self, image: bytes, dictionary: bytes):
        magic, self.width, dict_hash, n, none = _HEAD.unpack_from(image)
        if magic != MAGIC or dict_hash != hashlib.sha256(dictionary).digest():
            raise ValueError("not a block of this store, or written with another dictionary")
        at = _HEAD.size
        self.doc_ids = np.frombuffer(image, "<i8", n, at)
        self.without_id = np.arange(n) < none
        self.counts = np.frombuffer(image, "<u8", n, at + 8 * n)
        self.offsets = np.frombuffer(image, "<u8", n + 1, at + 16 * n)
        self.image, self.data = image, at + 24 * n + 8
        self.decompressor = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def ids(self, i: int) -> np.ndarray:
        a, b = self.data + int(self.offsets[i]), self.data + int(self.offsets[i + 1])
        return np.frombuffer(self.decompressor.decompress(self.image[a:b]), f"<u{self.width}").astype("<u4")


def write(docs: DataFrame, vocab_path: str, folder: str, end_id: int = 1, parts: int | None = None) -> None:
    """Encode every whole text (null: empty), append ``end_id``, and write the store in ascending document order.

    Documents without an id stand first. Rows that share an id are all kept, ordered by their frames' bytes. Columns other
    than doc_id and text are not read. The one shuffle moves compressed frames.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spec = tokens.load_file(vocab_path)
    width = 2 if max(max(spec["model"]["vocab"].values()), end_id, *(t["id"] for t in spec["added_tokens"])) < 1 << 16 else 4
    raw = train_dictionary(docs, vocab_path, width)
    dict_hash = hashlib.sha256(raw).digest()
    spark.createDataFrame([(dict_hash, raw, vocab_path)], "hash binary, bytes binary, vocabulary string").coalesce(1).write.parquet(f"{folder}/dictionary")
    parts = parts or common.partitions_for(docs)
    bounds = sorted({int(b) for b in docs.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.1 / parts) or []}) if parts > 1 else []
    cuts = np.array(bounds, "i8")  # ascending ranges of documents, those without an id first
    tail = struct.pack("<I", end_id)

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(raw), write_content_size=True, write_checksum=False, write_dict_id=False).compress
        for batch in by_volume(batches):
            coded = encoder(vocab_path).encode(batch.column(1))
            count = [len(c) // 4 + 1 for c in coded]
            packed = memoryview(np.frombuffer(tail.join([*coded, b""]), "<u4").astype(f"<u{width}").tobytes())
            ends = np.cumsum(count) * width
            frames = [compress(packed[b - n * width : b]) for b, n in zip(ends.tolist(), count, strict=True)]
            bucket = np.searchsorted(cuts, batch.column(0).fill_null(-(1 << 63)).to_numpy(), "right").astype("i4")
            yield pa.RecordBatch.from_arrays([pa.array(bucket), batch.column(0), pa.array(count, pa.int64()), pa.array(frames, pa.binary())], ["bucket", "doc_id", "n_tokens", "frame"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing_held()  # the encoder's caches: this worker may have encoded before
        part, block, before = TaskContext.get().partitionId(), 0, 0
        ids: list[int | None] = []
        counts: list[int] = []
        frames: list[bytes] = []
        size = 0

        def close() -> pa.RecordBatch:
            row = {"part": part, "block": block, "first_doc": next((i for i in ids if i is not None), None), "last_doc": ids[-1], "n_docs": len(ids), "n_tokens": sum(counts), "before": before, "image": block_image(width, dict_hash, ids, counts, frames)}
            return pa.RecordBatch.from_arrays([pa.array([row["part"]], pa.int32()), pa.array([row["block"]], pa.int32()), *(pa.array([row[k]], pa.int64()) for k in ("first_doc", "last_doc", "n_docs", "n_tokens", "before")), pa.array([row["image"]], pa.binary())], list(row))

        for batch in batches:
            for doc, n, frame in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                ids.append(doc)
                counts.append(n)
                frames.append(frame)
                size += len(frame)
                if size >= BLOCK_BYTES or len(ids) >= BLOCK_DOCS:
                    yield close()
                    before += sum(counts)
                    block += 1
                    ids, counts, frames, size = [], [], [], 0
        if ids:
            yield close()

    (
        docs.mapInArrow(squeeze, "bucket int, doc_id long, n_tokens long, frame binary")
        .repartitionById(len(bounds) + 1, "bucket")
        .sortWithinPartitions(F.asc_nulls_first("doc_id"), "n_tokens", "frame")
        .select("doc_id", "n_tokens", "frame")
        .mapInArrow(blocks, "part int, block int, first_doc long, last_doc long, n_docs long, n_tokens long, before long, image binary")
        .write.option("compression", "uncompressed")
        .parquet(f"{folder}/blocks")
    )


def _open(spark: SparkSession, folder: str) -> tuple[bytes, DataFrame]:
    raw = bytes(spark.read.parquet(f"{folder}/dictionary").first()["bytes"])
    return raw, spark.read.parquet(f"{folder}/blocks")


def _starts(blocks: DataFrame) -> DataFrame:
    """Blocks with ``start``: the ids before them in the whole store. One total per part (file) goes to the driver."""
    totals = sorted((r[0], r[1]) for r in blocks.groupBy("part").agg(F.sum("n_tokens")).collect())
    offsets, at = [], 0
    for part, n in totals:
        offsets.append((part, at))
        at += n
    by_part = blocks.sparkSession.createDataFrame(offsets, "part int, offset long") if offsets else blocks.sparkSession.createDataFrame([], "part int, offset long")
    return blocks.join(F.broadcast(by_part), "part").withColumn("start", F.col("offset") + F.col("before"))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, ids array<int>) of every document of a store."""
    raw, blocks = _open(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing_held()
        for batch in batches:
            for start, image in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                b = Block(image.as_buffer().to_pybytes(), raw)
                found = [b.ids(i) for i in range(len(b.doc_ids))]
                counts = b.counts.astype("i8")
                ends = np.concatenate([[0], np.cumsum(counts)]).astype("i4")
                yield pa.RecordBatch.from_arrays([pa.array(b.doc_ids, pa.int64(), mask=b.without_id), pa.array(start + np.cumsum(counts) - counts, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found).astype("i4")))], ["doc_id", "start", "ids"])

    return _starts(blocks).select("start", "image").mapInArrow(run, "doc_id long, start long, ids array<int>")


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the store's files.

    Rows as they were written: nulls and empty texts have the end id alone, rows that repeat an id come one by one, and
    other columns of the documents are not stored.
    """
    raw, blocks = _open(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing_held()
        for batch in batches:
            for start, image in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                b = Block(image.as_buffer().to_pybytes(), raw)
                found = [b.ids(i) for i in range(len(b.doc_ids))]
                counts = np.array([len(x) for x in found], "i8")
                crc = [zlib.crc32(x.tobytes()) for x in found]
                yield pa.RecordBatch.from_arrays([pa.array(b.doc_ids, pa.int64(), mask=b.without_id), pa.array(start + np.cumsum(counts) - counts), pa.array(counts), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return _starts(blocks).select("start", "image").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(spark: SparkSession, folder: str, doc_id: int) -> list[list[int]]:
    """The ids of one document (a list for each row of that id): only its block is read, only its frame decompressed."""
    raw, blocks = _open(spark, folder)
    found = []
    for r in blocks.where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id)).select("image").collect():
        b = Block(bytes(r[0]), raw)
        found += [b.ids(int(i)).tolist() for i in np.flatnonzero((b.doc_ids == doc_id) & ~b.without_id)]
    return found


def new_folder(spark: SparkSession) -> str:
    """A place for a store that lasts as long as the application."""
    return f"{common.own_folder(spark)}/ids-{uuid.uuid4().hex}"
