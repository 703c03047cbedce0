"""Benchmark decontamination by winnowing, in DataFrame functions only.

Of every window of ``window`` words the least hash of its k-grams is its fingerprint. Equal windows have equal
fingerprints, so joining documents' and benchmark's fingerprints misses no shared window; a hit is then extended to the
whole window and compared word for word. A document sends each fingerprint once, and its texts are read again only if one
of them hits; only windows with a fingerprint hit are ever built as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialise, row_key, unpacked, whole_row

#: Words in a window, and in the k-grams that are hashed (a power of two).
WINDOW, GRAM = 13, 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed value of the contract: everything in ASCII but digits and lower-case letters separates words.
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Arrays are exploded with the outer variants below: the plain ones add a filter on the array, which the optimizer pushes
# through the projections by writing the array's whole expression out again, once for each use in each of them.


def words_of(text: Column) -> Column:
    """A-Z lowered, then the words; null has none."""
    return F.coalesce(F.array_remove(F.split(F.translate(text, _UPPER, _LOWER), _GAP), ""), F.array().cast("array<string>"))


def _shifted(name: str, by: int, combine) -> Column:
    """combine(a[i], a[i + by]) over an array column, as far as both exist."""
    n = F.greatest(F.size(name) - by, F.lit(0))
    return F.zip_with(F.slice(name, 1, n), F.slice(name, by + 1, n), combine)


def with_fingerprints(df: DataFrame, lengths: list[int]) -> DataFrame:
    """(.., w) -> also f<m> for each length m: the fingerprint of each window of m words.

    Hashes of 1, 2, 4, .. words are made once and serve all lengths; windows no longer than a k-gram are hashed whole.
    """
    grams = sorted({min(m, GRAM) for m in lengths})
    df = df.withColumn("p1", F.transform("w", lambda x: F.xxhash64(x)))
    size = 1
    while size * 2 <= max(grams, default=0):
        df = df.withColumn(f"p{size * 2}", _shifted(f"p{size}", size, lambda a, b: F.xxhash64(a, b)))
        size *= 2
    for k in grams:
        at = 0
        for size in (1, 2, 4, 8):
            if k & size:
                if at:
                    n = F.greatest(F.size("w") - (at + size) + 1, F.lit(0))
                    df = df.withColumn(f"g{k}", F.zip_with(F.slice(f"g{k}", 1, n), F.slice(f"p{size}", at + 1, n), lambda a, b: F.xxhash64(a, b)))
                else:
                    df = df.withColumn(f"g{k}", F.col(f"p{size}"))
                at += size
    for m in lengths:
        k, size = min(m, GRAM), 1
        df = df.withColumn(f"f{m}", F.col(f"g{k}"))
        while size < m - k + 1:
            step = min(size, m - k + 1 - size)
            df = df.withColumn(f"f{m}", _shifted(f"f{m}", step, lambda a, b: F.least(a, b)))
            size += step
    return df


def _tagged(m: int) -> Column:
    """The distinct fingerprints of windows of m words, as array<struct<m, fp, n>>."""
    return F.transform(F.array_distinct(f"f{m}"), lambda f: F.struct(F.lit(m).alias("m"), f.alias("fp"), F.lit(0).alias("n")))


def _placed(m: int) -> Column:
    """The fingerprints of windows of m words with their places, as array<struct<m, p, fp>>."""
    return F.transform(f"f{m}", lambda f, p: F.struct(F.lit(m).alias("m"), p.alias("p"), f.alias("fp")))


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id string, m, win, fp): every window of every item; an item of fewer words (not none) is one window."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    items = materialise(items.withColumn("m", F.least(F.size("w"), F.lit(window))), "items")
    parts = []
    for (m,) in sorted(items.select("m").distinct().collect()):  # at most ``window`` lengths
        own = with_fingerprints(items.where(F.col("m") == m), [m])
        starts = F.transform(f"f{m}", lambda f, i: F.struct(f.alias("fp"), F.array_join(F.slice("w", i + 1, m), " ").alias("win")))  # noqa: B023
        parts.append(own.select("item_id", "m", F.explode_outer(starts).alias("x")).select("item_id", "m", "x.win", "x.fp"))
    if not parts:
        return benchmark.sparkSession.createDataFrame([], "item_id string, m int, win string, fp long")
    out = parts[0]
    for more in parts[1:]:
        out = out.union(more)
    return out.distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans.

    A document's word is hit if it lies in an occurrence of an item's window. ``spans`` are the maximal hit runs
    (array<struct<first, last>>, words from 0). contaminated: n_hit > 0 and 20 * n_hit >= n_words. Null and empty texts
    have no words; rows that repeat an id and a text get the same values; an empty benchmark hits nothing. Items that
    repeat an id count once. Columns other than doc_id and text are not read; no documents give no rows.
    """
    return _judged(docs, benchmark, window).drop("d", "t")


def _judged(docs: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    """contamination() with the keys d, t of each row."""
    rows = docs.select("doc_id", "text", *row_key())
    windows = materialise(item_windows(benchmark, window), "windows")
    lengths = sorted(r[0] for r in windows.select("m").distinct().collect())
    known = materialise(windows.select("m", "fp").distinct(), "fingerprints")
    known = broadcast_if_small(known.withColumn("known", F.lit(True)))

    # one scan: a row for the document itself (m = 0, fp a key of its own), and one for each of its fingerprints that hits
    prints = with_fingerprints(rows.select("doc_id", "d", "t", words_of(F.col("text")).alias("w")), lengths)
    own = F.array(F.struct(F.lit(0).alias("m"), F.xxhash64("d", "t").alias("fp"), F.size("w").alias("n")))
    each = [_tagged(m) for m in lengths]
    sent = prints.select("doc_id", "d", "t", F.explode_outer(F.concat(own, *each)).alias("x")).select("doc_id", "d", "t", "x.m", "x.fp", "x.n")
    found = materialise(sent.join(known, ["m", "fp"], "left").where("m = 0 or known").select("doc_id", "d", "t", "m", "n"), "found")
    every = found.where("m = 0").select("doc_id", "d", "t", F.col("n").cast("long").alias("n_words"))

    # the texts of documents with a hit, their windows with one, and these compared word for word
    some = broadcast_if_small(materialise(found.where("m > 0").select("d", "t").distinct(), "with-hits"))
    texts = rows.join(some, ["d", "t"], "left_semi").select("d", "t", words_of(F.col("text")).alias("w"))
    texts = materialise(texts, "hit-texts")
    marked = with_fingerprints(texts, lengths)
    none = F.array().cast("array<struct<m:int,p:int,fp:bigint>>")
    places = [_placed(m) for m in lengths]
    at = marked.select("d", "t", F.explode_outer(F.concat(none, *places)).alias("x")).select("d", "t", "x.m", "x.p", "x.fp").where("p is not null")
    starts = at.join(known, ["m", "fp"], "left_semi").groupBy("d", "t").agg(F.collect_set(F.struct("m", "p")).alias("starts"))
    starts = materialise(starts, "starts")
    cases = texts.join(starts.hint("shuffle_hash"), ["d", "t"])
    cases = cases.select("d", "t", F.explode(F.transform("starts", lambda s: F.struct(s["m"].alias("m"), s["p"].alias("p"), F.array_join(F.slice("w", s["p"] + 1, s["m"]), " ").alias("win")))).alias("c"))
    cases = cases.select("d", "t", "c.m", "c.p", "c.win").distinct()
    wins = broadcast_if_small(materialise(windows.select("m", "win").distinct(), "window-texts"))
    true = materialise(cases.join(wins, ["m", "win"], "left_semi"), "hits")
    spans = _islands(true)
    owners = broadcast_if_small(windows.select("win", "item_id"))
    items = true.select("d", "t", "win").distinct().join(owners, "win").groupBy("d", "t").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    judged = materialise(spans.join(items, ["d", "t"], "left"), "judged")
    hit = F.coalesce("n_hit", F.lit(0))
    return (
        every.join(judged, ["d", "t"], "left")
        .select(
            "doc_id", "d", "t", "n_words", hit.cast("long").alias("n_hit"), F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
            F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"), ((hit > 0) & (hit * 20 >= F.col("n_words"))).alias("contaminated"),
            F.coalesce("spans", F.array().cast("array<struct<first:int,last:int>>")).alias("spans"),
        )
    )


def _islands(hits: DataFrame) -> DataFrame:
    """(d, t, p, m) -> (d, t, n_hit, spans): overlapping and touching windows joined to runs (windows over one document)."""
    w = Window.partitionBy("d", "t").orderBy("p", "m")
    before = F.max(F.col("p") + F.col("m")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = hits.select("d", "t", "p", "m").distinct().withColumn("new", F.when(before >= F.col("p"), 0).otherwise(1)).withColumn("island", F.sum("new").over(w))
    runs = marked.groupBy("d", "t", "island").agg(F.min("p").alias("first"), (F.max(F.col("p") + F.col("m")) - 1).alias("last"))
    return runs.groupBy("d", "t").agg(F.sum(F.col("last") - F.col("first") + 1).alias("n_hit"), F.array_sort(F.collect_list(F.struct("first", "last"))).alias("spans"))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows that are not contaminated, as they are, whatever the names of their columns; for the rest see ``contamination``."""
    bad = _judged(docs.select("doc_id", "text"), benchmark, window).where("contaminated").select("d", "t").distinct()
    bad = broadcast_if_small(materialise(bad, "contaminated"))
    return docs.select(whole_row(docs), *row_key()).join(bad, ["d", "t"], "left_anti").select(*unpacked(docs.columns))
