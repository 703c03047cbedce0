"""Suffix-array deduplication: longest-previous-factor arrays over the texts that can hold a repeat.

Shards are groups of byte contexts that share an anchor (see ``repeats``): equal windows always meet in one shard. A task
concatenates its shards, sorts the suffixes by doubling, and reads the longest previous factor of each window's start from
the previous and next smaller positions in suffix order. A group too large for one task is decided by counting window
hashes instead, which no group size can break.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats
from .batches import by_volume, lean
from .repeats import RangeHash, Scheme, mix

_U = np.uint64
#: A group of at most so many distinct contexts is one shard; a suffix array is built over about so many bytes.
SHARD_CONTEXTS, ARRAY_BYTES = 10_000, 1 << 20
_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))


class Bytes(Scheme):
    """UTF-8 bytes; a window's anchor is its k-gram of least hash, the leftmost first."""

    def __init__(self, window: int):
        self.window = window
        self.gram = max(1, window * 8 // 25)
        self.before, self.choice, self.key = 0, window - self.gram + 1, self.gram

    def units(self, raw: bytes) -> np.ndarray:
        return _BYTE[np.frombuffer(raw, "u1")]

    def ranked(self, units: np.ndarray) -> np.ndarray:
        out = np.full(len(units), np.iinfo(_U).max, _U)
        at = np.arange(max(0, len(units) - self.gram + 1))
        out[at] = RangeHash(units, 0)(at, at + self.gram)
        return out


def _dense(key: np.ndarray) -> np.ndarray:
    kind = "i4" if len(key) < 1 << 31 else "i8"
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.zeros(len(key), bool)
    np.not_equal(key[1:], key[:-1], out=new[1:])
    out = np.empty(len(key), kind)
    out[order] = np.cumsum(new, dtype=kind)
    return out


def prefix_ranks(text: np.ndarray, depth: int) -> list[tuple[int, np.ndarray]]:
    """(length, rank of each position's next ``length`` bytes) for doubling lengths, the last being ``depth``."""
    n = len(text)
    size = 8 if depth >= 8 else 1
    key = np.zeros(n, _U)
    for i in range(size):
        key[: max(0, n - i)] |= text[i:].astype(_U) << _U(8 * (size - 1 - i))
    levels = [(size, _dense(key))]
    while size < depth:
        step = min(size, depth - size)
        rank = levels[-1][1]
        key = rank.astype("i8")
        key *= n + 1
        key[: max(0, n - step)] += rank[step:]
        key[: max(0, n - step)] += 1
        levels.append((size + step, _dense(key)))
        size += step
    return levels


def smaller_neighbours(seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each index the nearest index before, and after, with a smaller value (-1: none), by pointer jumping."""

    def before(x: np.ndarray) -> np.ndarray:
        at = np.arange(len(x)) - 1
        open_ = np.flatnonzero(at >= 0)
        while len(open_):
            open_ = open_[x[at[open_]] > x[open_]]
            at[open_] = at[at[open_]]
            open_ = open_[at[open_] >= 0]
        return at

    back = before(seq[::-1])[::-1]
    return before(seq), np.where(back >= 0, len(seq) - 1 - back, -1)


def previous_factors(text: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(lpf, source) of the starts (ascending): length, capped at ``depth``, of the longest match with an earlier start.

    Lengths below ``depth`` are whole steps of the doubling; ``source`` is the index of such a start (-1: none).
    """
    levels = prefix_ranks(text, depth)
    full = levels[-1][1][starts]
    order = np.argsort(full, kind="stable")  # suffix order; equal ones by position
    psv, nsv = smaller_neighbours(order)

    def common(other: np.ndarray) -> np.ndarray:
        has = np.flatnonzero(other >= 0)
        i, j = starts[order[has]], starts[order[other[has]]]
        length = np.where(full[order[has]] == full[order[other[has]]], depth, 0)
        i, j, part = i.copy(), j.copy(), np.zeros(len(has), "i8")
        for size, rank in reversed(levels[:-1]):
            fits = (np.maximum(i, j) + size <= len(text)) & (length < depth)
            same = np.zeros(len(has), bool)
            same[fits] = rank[i[fits]] == rank[j[fits]]
            i, j, part = i + size * same, j + size * same, part + size * same
        out = np.zeros(len(order), "i8")
        out[has] = np.maximum(length, np.minimum(part, depth - 1))
        return out

    a, b = common(psv), common(nsv)
    lpf, source = np.empty(len(starts), "i8"), np.empty(len(starts), "i8")
    lpf[order] = np.maximum(a, b)
    best = np.where(a >= b, psv, nsv)
    source[order] = np.where((np.maximum(a, b) > 0) & (best >= 0), order[best], -1)
    return lpf, source


@lean
def _shard_ranges(batches: Iterator[pa.RecordBatch], window: int, keep_first: bool) -> Iterator[pa.RecordBatch]:
    """(kh, d, t, lo, n, context) of whole, sorted shards -> (d, t, lo, hi) of windows that recur."""

    def work(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        place = np.stack([table.column(i).to_numpy() for i in (0, 1, 2, 3)])
        table = table.filter(pa.array(np.concatenate([[True], (place[:, 1:] != place[:, :-1]).any(axis=0)])))  # rows of one id and text
        d, t, lo, n = (table.column(i).to_numpy() for i in (1, 2, 3, 4))
        contexts = [c.as_buffer() for c in table.column(5)]
        size = np.array([c.size for c in contexts], "i8")
        text = np.frombuffer(b"".join(contexts), "u1")
        owner = np.repeat(np.arange(len(n)), n)
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        starts = (np.cumsum(size) - size)[owner] + within
        lpf, source = previous_factors(text, starts, window)
        gone = lpf >= window
        if not keep_first:  # a window that is not the first names an earlier one, down to the first
            gone[source[gone]] = True
        at = np.flatnonzero(gone)
        new = np.concatenate([[True], (np.diff(at) > 1) | (owner[at[1:]] != owner[at[:-1]])]) if len(at) else np.zeros(0, bool)
        first, last = at[new], at[np.concatenate([new[1:], [True]])] if len(at) else at
        who = owner[first]
        return pa.RecordBatch.from_arrays([pa.array(d[who]), pa.array(t[who]), pa.array(lo[who] + within[first], pa.int32()), pa.array(lo[who] + within[last] + window, pa.int32())], ["d", "t", "lo", "hi"])

    held: list[pa.RecordBatch] = []
    volume = 0
    for batch in by_volume(batches, 5, limit=ARRAY_BYTES // 2):
        kh = batch.column(0).to_numpy()
        if held and volume >= ARRAY_BYTES:
            last = held[-1].column(0)[-1].as_py()
            end = int(np.argmax(kh != last)) if (kh != last).any() else batch.num_rows
            held.append(batch.slice(0, end))
            if end < batch.num_rows:
                yield work(held)
                held, volume, batch = [], 0, batch.slice(end)
            else:
                continue
        held.append(batch)
        volume += batch.column(5).nbytes
    if held:
        yield work(held)


def _contexts(texts: DataFrame, window: int) -> DataFrame:
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_volume(batches, 2, limit=1 << 20):
            rows = []
            for d, t, raw, ranges in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist(), batch.column(3).to_pylist(), strict=True):
                rows += [(r["kh"], d, t, r["lo"], r["n"], raw[r["lo"] : r["lo"] + r["n"] - 1 + window]) for r in ranges]
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["kh", "d", "t", "lo", "n", "context"])

    return texts.select("d", "t", "text", "ranges").mapInArrow(run, "kh long, d long, t long, lo int, n int, context binary")


def by_suffixes(rows: DataFrame, edges: DataFrame, scheme: Scheme, keep_first: bool = False) -> DataFrame:
    """Judge of ``repeats.repeated_ranges``: suffix arrays for shards, counted hashes for groups beyond their size."""
    small = edges.where(F.col("many") <= SHARD_CONTEXTS)
    found = (
        _contexts(repeats.edge_texts(rows, small), scheme.window)
        .repartition("kh")
        .sortWithinPartitions("kh", "d", "t", "lo")
        .select("kh", "d", "t", "lo", "n", "context")
        .mapInArrow(partial(_shard_ranges, window=scheme.window, keep_first=keep_first), "d long, t long, lo int, hi int")
    )
    large = edges.where(F.col("many") > SHARD_CONTEXTS)
    if large.isEmpty():
        return found
    return found.union(repeats.by_count(rows, large, scheme, keep_first))


def _kept(raw: bytes, lo: np.ndarray, hi: np.ndarray) -> tuple[bytes, int, int]:
    if not len(lo):
        return raw, 0, 0
    gone = repeats.covered(len(raw), lo, hi)
    edges = np.diff(gone.astype("i1"), prepend=0)
    return np.frombuffer(raw, "u1")[~gone].tobytes(), int(gone.sum()), int((edges == 1).sum())


def _digest(raw: bytes, lo: np.ndarray, hi: np.ndarray) -> tuple:
    kept, removed, spans = _kept(raw, lo, hi)
    return len(raw), removed, spans, hashlib.sha256(kept).hexdigest()


def _text(raw: bytes, lo: np.ndarray, hi: np.ndarray) -> tuple:
    return (_kept(raw, lo, hi)[0],)


def digests(docs: DataFrame, window: int = 200) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, without every byte that a recurring window covers.

    All copies go, the first too. A window recurs if its bytes start anywhere else, same document included, judged on the
    input. Null and empty texts are empty; shorter texts lose nothing; rows that repeat an id and a text count as copies.
    """
    rows, ranges = repeats.repeated_ranges(docs, Bytes(window), by_suffixes)
    return repeats.finished(rows, ranges, _digest, [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())], "n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def deduplicate(docs: DataFrame, window: int = 200, keep_first: bool = True) -> DataFrame:
    """(doc_id, kept binary): the bytes left when later copies are removed (``keep_first=False``: all copies)."""
    rows, ranges = repeats.repeated_ranges(docs, Bytes(window), partial(by_suffixes, keep_first=keep_first), keep_first)
    return repeats.finished(rows, ranges, _text, [("kept", pa.binary())], "kept binary")
