"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked through BK-trees.

Fingerprints within the radius agree wholly on one of ``radius + 1`` bands of bits, so each band's value names a shard and
links are only sought within shards. A shard's fingerprints form a BK-tree (children keyed by their integer distance to the
parent); a search follows the edges within the radius. All trees of a task are built and searched at once, level by level,
as arrays. A shard that is too large is dealt on by bands of its remaining bits, and again, until so few bits are free that
no shard can exceed LAST_SHARD distinct fingerprints whatever the data. Trees are built where their shard lies rather than
broadcast, as their size grows with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import similar
from .batches import by_volume, lean
from .common import broadcast_if_small, materialise
from .graph import connected_components
from .shingles import hash64, simhash, words_of

#: Distinct fingerprints of a shard that is searched as it is; what a shard of the last round can hold (its free bits).
SHARD_ROWS, LAST_SHARD = 4096, 1 << 14
#: Rows of whole shards that a task holds at once, and frontier pairs searched at once.
HOLD_ROWS, FRONTIER = 200_000, 1 << 20


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash: A-Z lowered, words between ASCII white space, shingles with repeats."""
    words = words_of(text)
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    grams: Iterator[bytes] = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)) if n > 1 else iter([b" ".join(words)])
    return simhash(np.fromiter(map(hash64, grams), "<u8", n))


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): a fingerprint (signed long) for every row; null and empty texts have 0."""
    out_id = docs.schema["doc_id"].dataType.simpleString()

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_volume(batches):
            fps = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], "u8").view("i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {out_id}, fp long")


def build_forest(fps: np.ndarray, shard: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """BK-trees of all shards: for each item its parent (-1: a root), its edge's distance, and its depth.

    ``shard`` ascends. All items start at their shard's first item and descend together: of those at one node with one
    distance, the first becomes the child and the others go on below it.
    """
    n = len(fps)
    parent, edge, depth = np.full(n, -1), np.zeros(n, "i4"), np.zeros(n, "i4")
    first = np.concatenate([[True], shard[1:] != shard[:-1]]) if n else np.zeros(0, bool)
    root = np.flatnonzero(first)[np.cumsum(first) - 1] if n else np.zeros(0, "i8")
    left = np.flatnonzero(~first)
    at = root[left]
    level = 1
    while len(left):
        d = np.bitwise_count(fps[left] ^ fps[at])
        key = at * 65 + d
        _, lead, group = np.unique(key, return_index=True, return_inverse=True)
        child = left[lead]
        parent[child], edge[child], depth[child] = at[lead], d[lead], level
        stay = np.ones(len(left), bool)
        stay[lead] = False
        at = child[group][stay]
        left = left[stay]
        level += 1
    return parent, edge, depth


def search_forest(fps: np.ndarray, shard: np.ndarray, radius: int) -> np.ndarray:
    """A label for each item: the first item of its component under links within the radius, inside its shard."""
    n = len(fps)
    parent, edge, _ = build_forest(fps, shard)
    key = parent * 65 + edge
    order = np.argsort(key, kind="stable")
    order = order[parent[order] >= 0]
    kids_key = key[order]
    first = np.concatenate([[True], shard[1:] != shard[:-1]]) if n else np.zeros(0, bool)
    root = np.flatnonzero(first)[np.cumsum(first) - 1] if n else np.zeros(0, "i8")
    label = np.arange(n)
    step = max(1, FRONTIER // SHARD_ROWS)
    for lo in range(0, n, step):
        q = np.arange(lo, min(n, lo + step))
        node = root[q]
        while len(q):
            d = np.bitwise_count(fps[q] ^ fps[node]).astype("i8")
            hit = (d <= radius) & (q != node)
            if hit.any():
                label = _unite(label, q[hit], node[hit])
            a = np.searchsorted(kids_key, node * 65 + np.maximum(d - radius, 0), "left")
            b = np.searchsorted(kids_key, node * 65 + np.minimum(d + radius, 64), "right")
            many = b - a
            q = np.repeat(q, many)
            node = order[np.arange(len(q)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(a, many)] if len(q) else q
    return label


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hook the larger root of each pair onto the smaller until all pairs agree."""
    while True:
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return label
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def _bands(mask: int, pieces: int) -> list[int]:
    """Split the free bits of ``mask`` into contiguous bands, each joined to the mask."""
    free = [i for i in range(64) if not mask >> i & 1]
    cut = [round(i * len(free) / pieces) for i in range(pieces + 1)]
    return [mask | sum(1 << i for i in free[cut[k] : cut[k + 1]]) for k in range(pieces)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


@lean
def _shard_links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows (mask, val, fp) of whole, sorted shards -> links (a, b) from each fingerprint to its component's first."""
    held: list[pa.RecordBatch] = []
    rows = 0

    def work(t: pa.Table) -> pa.RecordBatch:
        mask, val, fp = (t.column(i).to_numpy() for i in range(3))
        new = np.concatenate([[True], (mask[1:] != mask[:-1]) | (val[1:] != val[:-1])])
        label = search_forest(fp.view("u8"), np.cumsum(new), radius)
        linked = label != np.arange(len(fp))
        return pa.RecordBatch.from_arrays([pa.array(fp[linked]), pa.array(fp[label[linked]])], ["a", "b"])

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= HOLD_ROWS:
            t = pa.Table.from_batches(held).combine_chunks()
            mask, val = t.column(0).to_numpy(), t.column(1).to_numpy()
            other = np.flatnonzero((mask != mask[-1]) | (val != val[-1]))
            if len(other):  # the last shard may go on in the next batch
                end = int(other[-1]) + 1
                yield work(t.slice(0, end))
                held = t.slice(end).to_batches()
                rows = t.num_rows - end
    if rows:
        yield work(pa.Table.from_batches(held).combine_chunks())


def links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """(fp distinct) -> (a, b): a spanning set of the links within the radius, linear in the number of fingerprints."""
    spark = fps.sparkSession
    pieces = radius + 1
    masks = _bands(0, pieces)
    spread = lambda df, kids: df.withColumn("mask", F.explode(F.array(*[F.lit(_signed(m)) for m in kids]))).withColumn("val", F.col("fp").bitwiseAND(F.col("mask")))
    rows = spread(fps, masks)
    found = []
    while True:
        sizes = materialise(rows.groupBy("mask", "val").count().where("count > 1"), "shards")
        large = sizes.where(F.col("count") > SHARD_ROWS)
        free = 64 - max(m.bit_count() for m in masks)
        last = 2**free <= LAST_SHARD
        small = sizes if last else sizes.where(F.col("count") <= SHARD_ROWS)
        found.append(
            rows.join(small.select("mask", "val"), ["mask", "val"])
            .repartition("mask", "val")
            .sortWithinPartitions("mask", "val", "fp")
            .select("mask", "val", "fp")
            .mapInArrow(partial(_shard_links, radius=radius), "a long, b long")
        )
        if last or large.isEmpty():
            break
        rows = rows.join(large.select("mask", "val"), ["mask", "val"])
        parents, masks = masks, [k for m in masks for k in _bands(m, pieces)]
        family = spark.createDataFrame([(_signed(m), _signed(k)) for m in parents for k in _bands(m, pieces)], "mask long, kid long")
        rows = materialise(rows.join(F.broadcast(family), "mask").select("fp", F.col("kid").alias("mask"), F.col("fp").bitwiseAND(F.col("kid")).alias("val")).distinct(), "large-shards")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def components(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, fp, component_id) of every row: fingerprints link at ``radius`` or fewer differing bits.

    component_id is the smallest doc_id reachable (its own, if none is linked; null only if no member has an id). Copies
    share a fingerprint and are never expanded into pairs: links are found between distinct fingerprints. Rows that repeat
    a doc_id stay rows. An empty table gives no rows.
    """
    prints = materialise(fingerprints(docs, shingle), "fingerprints")
    least = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = materialise(connected_components(links(least.select("fp"), radius)), "roots")
    named = least.join(roots, least["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = materialise(named, "named")
    smallest = materialise(named.groupBy("root").agg(F.min("least").alias("component_id")), "smallest")
    by_fp = materialise(named.join(smallest, "root").select("fp", "component_id"), "by-fingerprint")
    return prints.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, words: int = 5, percent: int = 80, radius: int = 2) -> DataFrame:
    """The documents of which one of each group stays: the row whose doc_id is its component's id.

    Groups are those of ``similar.components``: texts whose sets of ``words``-word shingles have a Jaccard similarity of
    ``percent`` or more. Fingerprints of these sets, linked through the BK-trees, give the first candidates; what their
    radius misses comes from a prefix filter, and every candidate is decided on the whole sets. Of rows that share that id, one stays. Rows without an id cannot be told apart and all stay.
    """
    comp = similar.components(docs, words, percent, partial(links, radius=radius)).where("doc_id is not null")
    ids = materialise(comp.groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("stays"), F.count("*").alias("rows")).where("not stays or rows > 1"), "ids")
    n_twice = ids.agg(F.count_if("stays")).first()[0]
    gone = ids.where(~F.col("stays")).select("doc_id")
    kept = docs.join(broadcast_if_small(gone), "doc_id", "left_anti").select(*docs.columns)
    if n_twice:
        kept = kept.where("doc_id is not null").dropDuplicates(["doc_id"]).union(kept.where("doc_id is null"))
    return kept
