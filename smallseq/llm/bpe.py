"""Byte-pair encoding and decoding with a contiguous rank array.

A piece is held as its part boundaries (the symbols) and, beside them in one contiguous array, the rank of each adjacent
pair. The minimum is found by scanning that array, the boundary between its two parts is deleted, and only the two
neighbouring ranks are looked up again. Words are short, so the scan beats a heap; a piece of more than SCANNED parts takes
one, with the same merges in the same order.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .batches import by_volume, hold, only

#: No pair of the file; parts of a piece up to which the rank array is scanned.
_NONE, SCANNED = 1 << 40, 128


class RankArrayBpe:
    """Encoder and decoder of one tokenizer file. The library only splits chunks beyond ASCII; merges are made here."""

    def __init__(self, path: str):
        spec = tokens.load_file(path)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        width = 1 << 20
        self.width = width
        self.pairs: dict[int, int] = {}
        merged: list[int] = []
        for rank, (a, b) in enumerate(model["merges"]):
            self.pairs[self.vocab[a] * width + self.vocab[b]] = rank
            merged.append(self.vocab[a + b])
        self.merged = merged
        spelling = tokens.byte_spelling()
        self.inner = {c: self.vocab[c] for c in spelling}
        self.final = {c: self.vocab[c + tokens.WORD_END] for c in spelling}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*self.vocab.values(), *self.specials.values()]) + 1
        self.names = [""] * size
        for name, i in [*self.vocab.items(), *self.specials.items()]:
            self.names[i] = name
        self.encoder = tokens.ChunkEncoder(tokens.load_library(path, model=False), self.specials, lambda pieces: map(self.encode_piece, pieces))

    def encode_piece(self, piece: str) -> bytes:
        """Token ids of one piece, whose bytes are spelt as printable characters."""
        inner, width, pairs, merged = self.inner, self.width, self.pairs, self.merged
        parts = [inner[c] for c in piece]
        parts[-1] = self.final[piece[-1]]
        if len(parts) > SCANNED:
            return self._by_heap(parts)
        ranks = [pairs.get(a * width + b, _NONE) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks:
            least = min(ranks)
            if least == _NONE:
                break
            i = ranks.index(least)
            parts[i] = merged[least]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = pairs.get(parts[i] * width + parts[i + 1], _NONE)
            if i:
                ranks[i - 1] = pairs.get(parts[i - 1] * width + parts[i], _NONE)
        return struct.pack(f"<{len(parts)}I", *parts)

    def _by_heap(self, parts: list[int]) -> bytes:
        """The same for a long piece: least rank first, then leftmost; entries that no longer hold are passed over."""
        width, rank_of, merged = self.width, self.pairs.get, self.merged
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := rank_of(parts[i] * width + parts[i + 1])) is not None]
        heapify(heap)
        while heap:
            rank, i = heappop(heap)
            j = after[i]
            if parts[i] < 0 or j == n or rank_of(parts[i] * width + parts[j]) != rank:
                continue
            parts[i], parts[j] = merged[rank], -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank_of(parts[i] * width + parts[k])) is not None:
                    heappush(heap, (r, i))
            h = before[i]
            if h >= 0 and (r := rank_of(parts[h] * width + parts[i])) is not None:
                heappush(heap, (r, h))
        kept = [x for x in parts if x >= 0]
        return struct.pack(f"<{len(kept)}I", *kept)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        return self.encoder.encode(texts)

    def decode(self, ids: bytes) -> str:
        """The file names no decoder, so its tokens are joined by spaces; special tokens stay."""
        names = self.names
        return " ".join([names[i] for i in np.frombuffer(ids, "<u4").tolist()])


@cache
def encoder(path: str) -> RankArrayBpe:
    """One encoder (and its cache) for each worker process."""
    hold("bpe", encoder.cache_clear)
    return RankArrayBpe(path)


def encode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of every whole text: (id, ids array<int>). Null and empty texts have no ids. One pass, no shuffle."""
    out_id = next(f for f in docs.schema.fields if f.name == id_col).dataType.simpleString()

    @only("bpe")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocab_path)
        for batch in by_volume(batches, limit=2 << 20):
            coded = bpe.encode(batch.column(1).to_pylist())
            flat = np.frombuffer(b"".join(coded), "<u4").astype("i4")
            ends = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded])]).astype("i4")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["doc_id", "ids"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {out_id}, ids array<int>")


def encode_with_digest(docs: DataFrame, vocab_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids array<int>, decoded_sha256): what ``encode`` gives, with the digest of the decoded text.

    Null and empty texts have no ids; rows stay rows, also those that repeat an id; other columns are not read.
    """
    out_id = docs.schema["doc_id"].dataType.simpleString()

    @only("bpe")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocab_path)
        for batch in by_volume(batches, limit=2 << 20):
            coded = bpe.encode(batch.column(1).to_pylist())
            count = np.array([len(c) // 4 for c in coded], "i8")
            ends = np.concatenate([[0], np.cumsum(count)]).astype("i4")
            flat = np.frombuffer(b"".join(coded), "<u4").astype("i4")
            digest = [hashlib.sha256(bpe.decode(c).encode()).hexdigest() for c in coded]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(digest, pa.string())], ["doc_id", "n_tokens", "ids", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {out_id}, n_tokens long, ids array<int>, decoded_sha256 string")


def decode(coded: DataFrame, vocab_path: str) -> DataFrame:
    """(doc_id, ids) -> (doc_id, text): the decoded text of every id list (null: empty)."""
    out_id = coded.schema["doc_id"].dataType.simpleString()

    @only("bpe")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocab_path)
        for batch in batches:
            texts = [bpe.decode(np.array(ids or [], "<u4").tobytes()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return coded.select("doc_id", "ids").mapInArrow(run, f"doc_id {out_id}, text string")


def round_trip_digests(docs: DataFrame, vocab_path: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Encodes and decodes each whole text in the same task, so neither ids nor decoded texts are moved. Null and empty texts
    give no tokens and the digests of nothing; rows that repeat a doc_id give a row each; other columns are not read.
    """
    out_id = docs.schema["doc_id"].dataType.simpleString()

    @only("bpe")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocab_path)
        for batch in by_volume(batches, limit=2 << 20):
            count, ids_hex, text_hex = [], [], []
            for ids in bpe.encode(batch.column(1).to_pylist()):
                count.append(len(ids) // 4)
                ids_hex.append(hashlib.sha256(ids).hexdigest())
                text_hex.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(text_hex, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {out_id}, n_tokens long, ids_sha256 string, decoded_sha256 string")
