"""Windows that recur anywhere in a corpus: the machinery behind substring and suffix-array deduplication.

A text is a row of units (words or bytes). Every window of W units has one anchor: a position in it that its own content
alone determines, so equal windows have equal anchors at equal places. An anchor is known by ``kh``, the hash of units that
lie in all its windows, and by ``ch``, the hash of everything its windows cover in this text. Then

* an anchor whose kh is unique has no repeated window and is dropped after one aggregation;
* anchors that share kh and ch (hashes of two families, 128 bits together) have the same windows, all repeated;
* only what is left, the edges of repeats, is compared window by window.

All steps are aggregations (partial before the shuffle) and joins against tables with one row for each key, which Spark can
split on skew; no group of equal anchors is ever gathered. Tables between steps lie in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import by_volume, lean
from .common import BROADCAST_BYTES, likely, materialise, remove, row_key, volume
from .shingles import mix

_U = np.uint64
#: Odd bases of the polynomial range hashes (modulo 2**64).
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


class RangeHash:
    """Hashes of any ranges of a unit array, from one prefix sum."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, units: np.ndarray, which: int):
        n = len(units)
        up, down = self._powers.get(which, (np.zeros(0, _U), np.zeros(0, _U)))
        if len(up) <= n:
            base = _BASES[which]
            size = max(n + 1, 1 << 16)
            make = lambda b: np.concatenate([np.ones(1, _U), np.multiply.accumulate(np.full(size, b, _U))])
            up, down = make(base), make(pow(base, -1, 1 << 64))
            if size <= 1 << 22:
                self._powers[which] = (up, down)
        self.down = down
        self.sums = np.concatenate([np.zeros(1, _U), np.cumsum(units * up[:n], dtype=_U)])

    def __call__(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[first]) * self.down[first] ^ (end - first).astype(_U))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size < width and len(x):
        step = min(size, width - size)
        x = np.minimum(x[:-step], x[step:]) if len(x) > step else x[:0]
        size += step
    return x


def contents(units: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """XXH3 of each range's units, read as a whole: another family of hashes than the ranges' polynomials."""
    raw = memoryview(np.ascontiguousarray(units)).cast("B") if len(units) else b""
    return np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip((8 * first).tolist(), (8 * end).tolist(), strict=True)), "u8", len(first))


class Scheme:
    """How units are read and anchors chosen. Subclasses say which positions may be anchors and how they are ranked."""

    window: int
    #: An anchor p of the window at i lies in [i + before, i + before + choice); its key covers [p - before, p + key).
    before: int
    choice: int
    key: int

    def units(self, raw: bytes) -> np.ndarray:
        raise NotImplementedError

    def ranked(self, units: np.ndarray) -> np.ndarray:
        """A rank for each position, the largest value where no anchor may be."""
        raise NotImplementedError

    def anchors(self, texts: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        """(text, lo, n, kh, ch) of every anchor: it owns the windows that start at lo .. lo + n - 1 of its text."""
        w = self.window
        size = np.array([len(t) for t in texts], "i8")
        units = np.concatenate(texts) if texts else np.zeros(0, _U)
        begin = np.cumsum(size) - size
        starts = np.maximum(size - w + 1, 0)
        total = int(starts.sum())
        if not total:
            return tuple(np.zeros(0, t) for t in ("i8", "i8", "i8", "u8", "u8"))
        at = np.arange(total) + np.repeat(begin - (np.cumsum(starts) - starts), starts)
        bits = _U(max(1, len(units).bit_length()))
        ranked = (self.ranked(units) >> bits << bits) | np.arange(len(units), dtype=_U)
        owner = (sliding_min(ranked, self.choice)[at + self.before] & ((_U(1) << bits) - _U(1))).astype("i8")
        cut = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1])
        p, lo = owner[cut], at[cut]
        n = np.diff(np.concatenate([cut, [total]]))
        text = np.searchsorted(begin, lo, "right") - 1
        kh = RangeHash(units, 0)(p - self.before, p + self.key)
        ch = contents(units, lo, lo + n - 1 + w)
        return text, lo - begin[text], n, kh, ch


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, its key (d, t) and the text; rows that share an id and a text share the key, and so their result."""
    return docs.select("doc_id", *row_key(), "text")


def _raw(column: pa.Array) -> list[bytes]:
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def anchor_table(rows: DataFrame, scheme: Scheme) -> DataFrame:
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_volume(batches, 2, limit=1 << 20):
            text, lo, n, kh, ch = scheme.anchors([scheme.units(b) for b in _raw(batch.column(2))])
            at = pa.array(text)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(lo, pa.int32()), pa.array(n, pa.int32()), pa.array(kh.view("i8")), pa.array(ch.view("i8"))], ["d", "t", "lo", "n", "kh", "ch"])

    return rows.select("d", "t", "text").mapInArrow(run, "d long, t long, lo int, n int, kh long, ch long")


def window_rows(texts: DataFrame, scheme: Scheme) -> DataFrame:
    """(d, t, text, ranges) -> (kh, wh, d, t, s): the hash of every window in the ranges."""
    w = scheme.window

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_volume(batches, 2, limit=1 << 20):
            for d, t, raw, ranges in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _raw(batch.column(2)), batch.column(3).to_pylist(), strict=True):
                n = np.array([r["n"] for r in ranges], "i8")
                lo = np.array([r["lo"] for r in ranges], "i8")
                s = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
                wh = contents(scheme.units(raw), s, s + w).view("i8")
                kh = np.repeat(np.array([r["kh"] for r in ranges], "i8"), n)
                yield pa.RecordBatch.from_arrays([pa.array(kh), pa.array(wh), pa.array(np.full(len(s), d, "i8")), pa.array(np.full(len(s), t, "i8")), pa.array(s, pa.int32())], ["kh", "wh", "d", "t", "s"])

    return texts.select("d", "t", "text", "ranges").mapInArrow(run, "kh long, wh long, d long, t long, s int")


def edge_texts(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """The texts that hold edges, with them: (d, t, text, ranges array<struct<kh, lo, n>>), one row for each key."""
    by_text = materialise(edges.groupBy("d", "t").agg(F.collect_list(F.struct("kh", "lo", "n")).alias("ranges")), "ranges")
    texts = rows.select("d", "t", "text")
    if volume(by_text) <= BROADCAST_BYTES:
        return texts.join(F.broadcast(by_text), ["d", "t"])
    return likely(texts, by_text, ["d", "t"]).join(by_text, ["d", "t"])


def by_count(rows: DataFrame, edges: DataFrame, scheme: Scheme, keep_first: bool = False) -> DataFrame:
    """(d, t, lo, hi) of the edges' windows that recur (``keep_first``: but the first), by counting their hashes."""
    found = materialise(window_rows(edge_texts(rows, edges), scheme), "windows")
    again = found.groupBy("kh", "wh").agg(F.count("*").alias("copies"), F.min(F.struct("d", "t", "s")).alias("first")).where("copies > 1")
    found = found.join(materialise(again, "again"), ["kh", "wh"])
    if keep_first:
        found = found.where(F.struct("d", "t", "s") != F.col("first"))
    return found.select("d", "t", F.col("s").alias("lo"), (F.col("s") + scheme.window).alias("hi"))


def repeated_ranges(docs: DataFrame, scheme: Scheme, judge: Callable[[DataFrame, DataFrame, Scheme], DataFrame] = by_count, keep_first: bool = False) -> tuple[DataFrame, DataFrame]:
    """The keyed rows, and (d, t, lo, hi): unit ranges, overlapping as they may, whose windows recur anywhere.

    ``judge`` decides the edges: (rows, edges (kh, many, d, t, lo, n), scheme) -> ranges; ``many`` counts the distinct
    contexts of an edge's group. With ``keep_first`` the ranges leave out the first copy (smallest id, then position), as
    far as ``judge`` does.
    """
    rows = keyed(docs)
    every = materialise(anchor_table(rows, scheme), "anchors")
    # Aggregates are written before they are joined on their own key: then both sides of the join are plain shuffles, which
    # Spark can split where a key is hot; an aggregate's output would be joined as it lies.
    shared = materialise(every.groupBy("kh").count().where("count > 1").select("kh"), "recurring")
    anchors = materialise(every.join(shared, "kh", "left_semi"), "shared")
    remove(every)
    groups = materialise(anchors.groupBy("kh", "ch").agg(F.count("*").alias("copies"), F.min(F.struct("d", "t", "lo", "n")).alias("first")), "groups")
    whole = anchors.join(groups.where("copies > 1").select("kh", "ch", "first"), ["kh", "ch"])
    if keep_first:
        whole = whole.where(F.struct("d", "t", "lo", "n") != F.col("first"))
    whole = whole.select("d", "t", "lo", (F.col("lo") + F.col("n") - 1 + scheme.window).alias("hi"))
    mixed = groups.groupBy("kh").agg(F.count("*").alias("many"), F.min("copies").alias("least")).where("many > 1" if keep_first else "many > 1 and least = 1")
    edges = groups.join(materialise(mixed.select("kh", "many"), "mixed"), "kh").select("kh", "many", "first.*")
    return rows, whole.union(judge(rows, materialise(edges, "edges"), scheme))


def finished(rows: DataFrame, ranges: DataFrame, finish: Callable[[bytes, np.ndarray, np.ndarray], tuple], fields: list[tuple[str, pa.DataType]], ddl: str) -> DataFrame:
    """``finish(raw text, lo, hi)`` of every row with its ranges (sorted); the one shuffle of the texts themselves."""
    by_text = ranges.groupBy("d", "t").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges")).hint("shuffle_hash")
    out_id = rows.schema["doc_id"].dataType.simpleString()

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_volume(batches, 1, limit=2 << 20):
            cases = batch.column(2)
            out = []
            for raw, case in zip(_raw(batch.column(1)), cases, strict=True):
                if case.is_valid:
                    lo, hi = (case.values.field(i).to_numpy().astype("i8") for i in (0, 1))
                    order = np.argsort(lo, kind="stable")
                    out.append(finish(raw, lo[order], hi[order]))
                else:
                    out.append(finish(raw, np.zeros(0, "i8"), np.zeros(0, "i8")))
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, kind) for c, (_, kind) in zip(columns, fields, strict=True))], ["doc_id", *(name for name, _ in fields)])

    return rows.join(by_text, ["d", "t"], "left").select("doc_id", "text", "ranges").mapInArrow(run, f"doc_id {out_id}, {ddl}")


def covered(n: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """A mask of the n units that the ranges cover."""
    step = np.zeros(n + 1, "i4")
    np.add.at(step, lo, 1)
    np.add.at(step, hi, -1)
    return np.cumsum(step[:n]) > 0
