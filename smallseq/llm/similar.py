"""Groups of texts whose word-shingle sets have a Jaccard similarity of some percent or more: exact, no pair is missed.

A text that is so similar to another shares at least that percentage of its shingles with other texts; most texts do not and
go no further (every shingle of every text is counted for that, in packed form). Among those that are left, candidates come
from two sides. SimHash: fingerprints of the sets, linked through BK-trees by the caller (``near``), bring
most copies together. Prefix filter, for what a Hamming radius cannot promise: with all shingles in one global order, two
sets of similarity s share one of the first ``n - ceil(s n) + 1`` shingles of each, so only texts that share such a shingle
are compared. Each candidate is decided on the whole sets. Any global order is right; shingles that are frequent in a
bounded sample come last, so that a common passage does not bring its texts together.

Texts that are already in one group are not compared again: each shingle's texts are first linked as a chain by size, then
only pairs of different groups are compared, in blocks where a shingle is hot. A large group of copies stays linear.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import by_volume, lean
from .common import broadcast_if_small, materialise, partitions_for, remove, text_key
from .graph import connected_components
from .shingles import shingle_set, simhash

#: Texts sampled for the order, texts of the sample from which a shingle comes last, and how many such are kept: these bear
#: on the work only, never on the result.
SAMPLE, OFTEN, HOT = 4000, 3, 200_000
#: Shingles that a task gathers; texts of one shingle that are compared in one block; prefix shingles that two texts share.
GATHER, BLOCK, SHARED = 1_000_000, 5000, 3
_COUNT, _COUNTED = np.dtype([("t", "<i8"), ("shared", "<i4")]), ["home", "t", "n", "hot", "counts"]
_ROW = np.dtype([("gram", "<u8"), ("t", "<i8"), ("n", "<i4")])


def least_overlap(n: int, percent: int) -> int:
    """Members that a set of n has in common with any that is similar enough."""
    return -(-percent * n // 100)


def prefix_length(n: int, percent: int) -> int:
    """So many first members of each of two similar sets share SHARED (or, of small sets, ``least_overlap``) of them."""
    o = least_overlap(n, percent)
    return n - o + min(SHARED, o)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts) if parts else [], pa.int64()))


def _member(x: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which of x occur in ``of`` (ascending)."""
    return of[np.minimum(np.searchsorted(of, x), len(of) - 1)] == x if len(of) else np.zeros(len(x), bool)


def sketch(s: np.ndarray) -> bytes | None:
    """Members of a set by ranges of the hash, about two to a range (None if a count does not fit a byte)."""
    bits = max(4, (len(s) // 2).bit_length())
    counts = np.bincount((s >> np.uint64(64 - bits)).astype("i8"), minlength=1 << bits)
    return counts.astype("u1").tobytes() if counts.max() < 256 else None


def most_common(x: bytes, y: bytes) -> int:
    """No more members than this can two sets have in common."""
    a, b = np.frombuffer(x, "u1"), np.frombuffer(y, "u1")
    k = min(len(a), len(b))
    return int(np.minimum(a.reshape(k, -1).sum(axis=1), b.reshape(k, -1).sum(axis=1)).sum())


def similar_enough(n: int, m: int, x: bytes | None, y: bytes | None, percent: int) -> bool:
    """Whether two sets of n and m members can be so similar, by their sketches."""
    common = min(n, m) if x is None or y is None else most_common(x, y)
    return 100 * common >= percent * (n + m - common)


@lean
def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """(t, text) -> (t, grams): the whole set."""
    for batch in by_volume(batches):
        yield pa.RecordBatch.from_arrays([batch.column(0), _lists([shingle_set(x, words).view("i8") for x in batch.column(1).to_pylist()])], ["t", "grams"])


@lean
def _spread(batches: Iterator[pa.RecordBatch], words: int, parts: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(t, text) -> (part, t, n, hot, rows): a row for each text with its set's size and the number of its hot shingles, and
    one for each range of shingles, which packs the texts that have some there, and these shingles. Hot ones are not packed.

    A text that a task has seen is left out.
    """
    seen: set[int] = set()
    for batch in by_volume(batches):
        ids, sizes, common, grams = [], [], [], []
        for t, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if t not in seen:
                seen.add(t)
                s = shingle_set(text, words)
                late = _member(s, hot)
                ids.append(t)
                sizes.append(len(s))
                common.append(int(late.sum()))
                grams.append(s[~late])
        if not ids:
            continue
        t = np.array(ids, "<i8")
        gram, owner = np.concatenate(grams), np.repeat(np.arange(len(ids), dtype="<u4"), [len(g) for g in grams])
        part = ((gram >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype("i4")
        order = np.argsort(part, kind="stable")
        low, owner, part = gram.astype("<u4")[order], owner[order], part[order]
        cut = np.flatnonzero(np.diff(part, prepend=-1))
        packed = []
        for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(part)], strict=True):
            who, at = np.unique(owner[a:b], return_inverse=True)
            packed.append(b"".join([np.array([len(who), b - a], "<u4").tobytes(), t[who].tobytes(), low[a:b].tobytes(), at.astype("<u2" if len(who) < 1 << 16 else "<u4").tobytes()]))
        none = [None] * len(packed)
        columns = [[*(x % parts for x in ids), *part[cut].tolist()], ids + none, sizes + none, common + none, [None] * len(ids) + packed]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)], ["part", "t", "n", "hot", "rows"])


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    docs, rows = np.frombuffer(packed, "<u4", 2).tolist()
    at = 8 + 8 * docs
    return np.frombuffer(packed, "<i8", docs, 8), np.frombuffer(packed, "<u4", rows, at), np.frombuffer(packed, "<u2" if docs < 1 << 16 else "<u4", rows, at + 4 * rows)


@lean
def _counted(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Rows of a range of shingles -> (home, t, n, hot, counts): texts with their size and hot shingles as they came, and,
    packed for each home of texts, how many of a text's shingles in the range another text has too."""
    found = []
    for batch in batches:
        own = batch.filter(batch.column(0).is_valid())
        if own.num_rows:
            home = pa.array((own.column(0).to_numpy() % parts).astype("i4"))
            yield pa.RecordBatch.from_arrays([home, own.column(0), own.column(1), own.column(2), pa.nulls(own.num_rows, pa.binary())], _COUNTED)
        found += [_unpacked(x.as_py()) for x in batch.column(3) if x.is_valid]
    if found:
        begin = np.cumsum([0, *(len(d) for d, _, _ in found)])
        t, own = np.unique(np.concatenate([d for d, _, _ in found]), return_inverse=True)
        key = np.concatenate([x for _, x, _ in found]).astype("u8") << np.uint64(32)
        key |= own[np.concatenate([at.astype("i8") + b for (_, _, at), b in zip(found, begin[:-1], strict=True)])].astype("u8")
        del found, own
        key = np.unique(key)  # a text counts once for a shingle
        same = key[1:] >> np.uint64(32) == key[:-1] >> np.uint64(32)
        shared = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        many = np.bincount((key[shared] & np.uint64(0xFFFFFFFF)).astype("i8"), minlength=len(t))
        some = np.flatnonzero(many)
        t, many = t[some], many[some]
        home = t % parts
        order = np.argsort(home, kind="stable")
        cut = np.flatnonzero(np.diff(home[order], prepend=-1))
        rows = np.empty(len(t), _COUNT)
        rows["t"], rows["shared"] = t[order], many[order]
        packed = [x.tobytes() for x in np.split(rows, cut[1:])] if len(cut) else []
        none = pa.nulls(len(packed), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(home[order][cut], pa.int32()), pa.nulls(len(packed), pa.int64()), none, none, pa.array(packed, pa.binary())], _COUNTED)


@lean
def _summed(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Texts' sizes and hot shingles, and packed counts of their ranges -> (t): texts with enough shared shingles."""
    sizes, counts = [], []
    for batch in batches:
        own = batch.filter(batch.column(0).is_valid())
        sizes.append(np.stack([own.column(i).to_numpy().astype("i8") for i in range(3)], axis=1))
        counts += [np.frombuffer(x.as_py(), _COUNT) for x in batch.column(3) if x.is_valid]
    if sizes:
        size = np.concatenate(sizes)
        t, first = np.unique(size[:, 0], return_index=True)
        n, shared = size[first, 1], size[first, 2].copy()
        if counts and len(t):
            count = np.concatenate(counts)
            np.add.at(shared, np.searchsorted(t, count["t"]), count["shared"])
        yield pa.RecordBatch.from_arrays([pa.array(t[100 * shared >= percent * n])], ["t"])


@lean
def _prints(batches: Iterator[pa.RecordBatch], words: int, percent: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(t, text) -> (t, n, fp, sketch, grams): the set's size, fingerprint, sketch and prefix."""
    for batch in by_volume(batches):
        sizes, fps, counts, out = [], [], [], []
        for text in batch.column(1).to_pylist():
            s = shingle_set(text, words)
            late = _member(s, hot)
            sizes.append(len(s))
            fps.append(simhash(s))
            counts.append(sketch(s))
            out.append(np.concatenate([s[~late], s[late]])[: prefix_length(len(s), percent)].view("i8"))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int32()), pa.array(np.array(fps, "u8").view("i8")), pa.array(counts, pa.binary()), _lists(out)], ["t", "n", "fp", "sketch", "grams"])


@lean
def _dealt(batches: Iterator[pa.RecordBatch], parts: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(t, n, grams) -> (part, rows): the rows of each range of shingles, packed; hot ones are left out."""
    for batch in batches:
        many = np.diff(batch.column(2).offsets.to_numpy())
        rows = np.empty(int(many.sum()), _ROW)
        rows["gram"] = batch.column(2).flatten().to_numpy().view("u8")
        rows["t"], rows["n"] = np.repeat(batch.column(0).to_numpy(), many), np.repeat(batch.column(1).to_numpy(), many)
        rows = rows[~_member(rows["gram"], hot)]
        part = ((rows["gram"] >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype("i4")
        order = np.argsort(part, kind="stable")
        rows, part = rows[order], part[order]
        cut = np.flatnonzero(np.diff(part, prepend=-1))
        yield pa.RecordBatch.from_arrays([pa.array(part[cut], pa.int32()), pa.array([x.tobytes() for x in np.split(rows, cut[1:])] if len(cut) else [], pa.binary())], ["part", "rows"])


@lean
def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a range of shingles -> (gram, n, t) of those that more than one text has."""
    packed = [x.as_py() for batch in batches for x in batch.column(0)]
    if packed:
        rows = np.frombuffer(b"".join(packed), _ROW)
        del packed
        rows = rows[np.argsort(rows["gram"], kind="stable")]
        same = rows["gram"][1:] == rows["gram"][:-1]
        rows = rows[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
        for at in range(0, len(rows), 100_000):
            x = rows[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(x["gram"].view("i8").copy()), pa.array(x["n"].astype("i8")), pa.array(x["t"].copy())], ["gram", "n", "t"])


def _pair_batch(a: np.ndarray, b: np.ndarray, n: np.ndarray, percent: int) -> pa.RecordBatch:
    """(a, b, need): pairs, and how many prefix shingles they have to share, from the smaller size n."""
    need = np.minimum(SHARED, -(-percent * n // 100))
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(need.astype("i4"))], ["a", "b", "need"])


@lean
def _chained(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (gram, n, t), sorted -> pairs of neighbours that share the gram, of sizes near enough."""
    last = None
    for batch in batches:
        rows = np.stack([c.to_numpy() for c in batch.columns], axis=1)
        if last is not None:
            rows = np.concatenate([last, rows])
        gram, n, t = rows.T
        near = np.flatnonzero((gram[:-1] == gram[1:]) & (t[:-1] != t[1:]) & (100 * n[:-1] >= percent * n[1:]))
        yield _pair_batch(t[near], t[near + 1], n[near], percent)
        last = rows[-1:]


@lean
def _compared(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (gram, cell, n, t, root, block, sketch), sorted -> pairs within a cell, of different groups, of sizes near enough,
    that their sketches do not rule out.

    A cell holds one block of a gram's texts, or two, whose pairs across are meant.
    """
    rows, sketches = np.empty((0, 6), "i8"), []
    for batch in batches:
        rows = np.concatenate([rows, np.stack([batch.column(i).to_numpy() for i in range(6)], axis=1)])
        sketches += batch.column(6).to_pylist()
        cut = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1))
        end = int(cut[-1]) + 1 if len(cut) else 0
        yield from _pairs(rows[:end], sketches[:end], percent)
        rows, sketches = rows[end:], sketches[end:]
    yield from _pairs(rows, sketches, percent)


def _pairs(rows: np.ndarray, sketches: list[bytes | None], percent: int) -> Iterator[pa.RecordBatch]:
    gram, cell, n, t, root, block = rows.T
    if not len(rows):
        return
    first = np.flatnonzero(np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)]))
    two = np.repeat(np.minimum.reduceat(block, first) != np.maximum.reduceat(block, first), np.diff(np.append(first, len(rows))))
    step = 1
    alive = np.arange(len(rows))
    while len(alive := alive[alive + step < len(rows)]):
        other = alive + step
        near = (gram[alive] == gram[other]) & (cell[alive] == cell[other]) & (100 * n[alive] >= percent * n[other])  # sorted by size: later ones are larger still
        alive = alive[near]
        other = alive + step
        found = alive[(root[alive] != root[other]) & (~two[alive] | (block[alive] != block[other]))]
        found = found[[similar_enough(int(n[i]), int(n[i + step]), sketches[i], sketches[i + step], percent) for i in found.tolist()]] if len(found) else found
        if len(found):
            yield _pair_batch(t[found], t[found + step], n[found], percent)
        step += 1


@lean
def _alike(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """(a, b, grams of a, grams of b) -> the pairs that are similar enough."""
    for batch in batches:
        x, y = batch.column(2), batch.column(3)
        keep = []
        for i in range(batch.num_rows):
            p, q = x[i].values.to_numpy(), y[i].values.to_numpy()
            common = len(np.intersect1d(p, q, assume_unique=True))
            keep.append(100 * common >= percent * (len(p) + len(q) - common))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


@lean
def _possible(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """(a, b, sizes, sketches) -> the pairs that their sketches do not rule out."""
    for batch in batches:
        keep = [similar_enough(*case, percent) for case in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5)), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _verified(pairs: DataFrame, texts: DataFrame, prints: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose whole sets are as similar as that: first by sketches, which rule out most, then by the sets."""
    pairs = materialise(pairs, "pairs")
    side = lambda k, df, *cols: df.select(F.col("t").alias(k), *[F.col(c).alias(f"{c}_{k}") for c in cols])
    joined = lambda df, *cols: pairs.join(side("a", df, *cols), "a").join(side("b", df, *cols), "b").select("a", "b", *[f"{c}_{k}" for c in cols for k in "ab"])
    pairs = materialise(joined(prints, "n", "sketch").mapInArrow(partial(_possible, percent=percent), "a long, b long"), "possible")
    nodes = materialise(pairs.select(F.col("a").alias("t")).union(pairs.select("b")).distinct(), "nodes")
    few = texts.join(broadcast_if_small(nodes), "t", "left_semi").dropDuplicates(["t"]).select("t", "text")
    sets = materialise(few.mapInArrow(partial(_sets, words=words), "t long, grams array<long>"), "sets")
    found = materialise(joined(sets, "grams").mapInArrow(partial(_alike, percent=percent), "a long, b long"), "verified")
    remove(sets)
    return found


def _frequent(texts: DataFrame, words: int, n: int) -> np.ndarray:
    """Shingles (ascending) that are frequent in a sample of about SAMPLE distinct texts of n, HOT at most."""
    cut = min(1 << 31, (SAMPLE << 31) // max(1, n))
    sample = texts.where(F.pmod(F.xxhash64("t"), F.lit(1 << 31)) < cut).dropDuplicates(["t"])
    grams = sample.mapInArrow(partial(_sets, words=words), "t long, grams array<long>").select(F.explode("grams").alias("gram"))
    often = grams.groupBy("gram").count().where(F.col("count") >= OFTEN).orderBy(F.desc("count"), "gram").limit(HOT)
    return np.sort(np.array([r["gram"] for r in often.select("gram").collect()], "i8").view("u8"))


def _with_partners(texts: DataFrame, words: int, percent: int) -> tuple[DataFrame, np.ndarray]:
    """(t, text) of the distinct texts of which enough shingles occur in other texts; and the frequent shingles."""
    n, chars = texts.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    hot = _frequent(texts, words, n)
    parts = max(partitions_for(texts), (chars or 0) // 5 // GATHER + 1)
    spread = texts.mapInArrow(partial(_spread, words=words, parts=parts, hot=hot), "part int, t long, n int, hot int, rows binary")
    counted = spread.repartitionById(parts, "part").select("t", "n", "hot", "rows").mapInArrow(partial(_counted, parts=parts), "home int, t long, n int, hot int, counts binary")
    some = counted.repartitionById(parts, "home").select("t", "n", "hot", "counts").mapInArrow(partial(_summed, percent=percent), "t long")
    some = materialise(some, "with-partners")
    return materialise(texts.join(broadcast_if_small(some), "t", "left_semi").dropDuplicates(["t"]), "near-texts"), hot


def links(docs: DataFrame, words: int = 5, percent: int = 80, near: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(a, b): links of distinct texts, by ``text_key``, that span the groups.

    ``near``: (fp distinct) -> (a, b) pairs of fingerprints whose texts are worth comparing first.
    """
    spark = docs.sparkSession
    texts, hot = _with_partners(docs.select(text_key(F.col("text")).alias("t"), "text"), words, percent)
    prints = texts.mapInArrow(partial(_prints, words=words, percent=percent, hot=hot), "t long, n int, fp long, sketch binary, grams array<long>")
    prints = materialise(prints, "prints")
    parts = max(partitions_for(docs), (prints.agg(F.sum(F.size("grams"))).first()[0] or 0) // GATHER + 1)
    rare = prints.select("t", "n", "grams").mapInArrow(partial(_dealt, parts=parts, hot=hot), "part int, rows binary")
    rare = rare.repartitionById(parts, "part").select("rows").mapInArrow(_shared, "gram long, n long, t long")
    often = spark.createDataFrame([(int(x),) for x in hot.view("i8")], "gram long")  # HOT rows at most
    common = prints.select(F.explode("grams").alias("gram"), F.col("n").cast("long").alias("n"), "t").join(F.broadcast(often), "gram", "left_semi")
    shared = materialise(rare.union(common.select("gram", "n", "t")), "shared")

    pairs = shared.repartition("gram").sortWithinPartitions("gram", "n", "t").mapInArrow(partial(_chained, percent=percent), "a long, b long, need int")
    pairs = _often_enough(pairs)
    if near is not None:
        least = materialise(prints.groupBy("fp").agg(F.min("t").alias("least")), "least")
        same = prints.select("t", "fp").join(least, "fp").where("t <> least").select(F.least("t", "least").alias("a"), F.greatest("t", "least").alias("b"))
        at = lambda k: least.select(F.col("fp").alias(k), F.col("least").alias(f"t_{k}"))
        close = near(least.select("fp")).join(at("a"), "a").join(at("b"), "b").select(F.least("t_a", "t_b").alias("a"), F.greatest("t_a", "t_b").alias("b"))
        pairs = pairs.union(same).union(close).distinct()
    first = _verified(pairs, texts, prints, words, percent)

    rooted = shared.join(connected_components(first), shared["t"] == F.col("node"), "left").select("gram", "n", "t", F.coalesce("root", "t").alias("root"))
    rooted = materialise(rooted, "rooted")
    open_ = rooted.groupBy("gram").agg(F.count("*").alias("texts"), F.min("root").alias("r"), F.max("root").alias("s")).where("r <> s")
    open_ = materialise(open_.select("gram", F.floor((F.col("texts") + (BLOCK - 1)) / BLOCK).cast("long").alias("blocks")), "open")
    block = F.pmod(F.xxhash64("t"), F.col("blocks"))
    seen = prints.select("t", "sketch")
    rows = rooted.join(open_, "gram").join(seen, "t").withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cell = F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")
    rows = rows.select("gram", cell.alias("cell"), "n", "t", "root", "block", "sketch")
    rest = rows.repartition("gram", "cell").sortWithinPartitions("gram", "cell", "n", "t").mapInArrow(partial(_compared, percent=percent), "a long, b long, need int")
    return first.union(_verified(_often_enough(rest), texts, prints, words, percent))


def _often_enough(pairs: DataFrame) -> DataFrame:
    """The pairs that came up for as many shingles as they need."""
    return pairs.groupBy("a", "b").agg(F.count("*").alias("times"), F.min("need").alias("need")).where("times >= need").select("a", "b")


def components(docs: DataFrame, words: int = 5, percent: int = 80, near: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(doc_id, component_id) of every row: the smallest doc_id of the texts reachable (null only if no member has an id).

    Texts with fewer words than a shingle are one shingle; null, empty and blank texts are alike. Rows that repeat an id or
    a text stay rows. An empty table gives no rows.
    """
    rows = docs.select("doc_id", text_key(F.col("text")).alias("t"))
    roots = materialise(connected_components(links(docs, words, percent, near)), "roots")
    named = materialise(rows.join(roots, rows["t"] == roots["node"], "left").select("doc_id", F.coalesce("root", "t").alias("root")), "named")
    smallest = materialise(named.groupBy("root").agg(F.min("doc_id").alias("component_id")), "smallest")
    return named.join(smallest, "root").select("doc_id", "component_id")
