"""Operators on raw reads: quality filter, collapse, decollapse, and alignment of short reads by k-mer joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.seq import reverse_complement, trimmed


def quality_filter(reads: DataFrame, average: int = 30, qualified: int = 20, unqualified_percent: int = 10, n_limit: int = 1, min_length: int = 15, max_length: int = 35, phred: int = 33, adapter: str | None = None, front: int = 0, tail: int = 0, poly_x: int | None = None) -> DataFrame:
    """Reads (seq, qual, ..) that pass, trimmed: adapter, poly-X tail, fixed ends; mean and share of base qualities, Ns, length."""
    df = reads
    cut = lambda df, n: df.withColumns({"qual": F.substring("qual", F.lit(1), n), "seq": F.substring("seq", F.lit(1), n)})
    if front or tail:
        df = df.withColumns({"seq": trimmed(F.col("seq"), front, tail), "qual": trimmed(F.col("qual"), front, tail)})
    if adapter:
        at = F.locate(adapter, F.col("seq"))
        df = cut(df, F.when(at > 0, at - 1).otherwise(F.length("seq")))
    if poly_x:
        run = F.greatest(*[F.length(F.regexp_extract("seq", f"({b}{{{poly_x},}})$", 1)) for b in "ACGT"])
        df = cut(df, F.length("seq") - run)
    scores = F.transform(F.split("qual", ""), lambda c: F.ascii(c) - phred)
    n = F.length("seq")
    total = F.aggregate(scores, F.lit(0), lambda a, b: a + b)
    low = F.size(F.filter(scores, lambda q: q < qualified))
    n_count = n - F.length(F.translate("seq", "Nn", ""))
    return df.where((n >= min_length) & (n <= max_length) & (n_count <= n_limit) & (total >= average * n) & (low * 100 <= unqualified_percent * n))


def filter_report(reads: DataFrame, kept: DataFrame) -> DataFrame:
    """One row (before, after): the counts that the summary takes from a filter's report."""
    return reads.agg(F.count("*").alias("before")).crossJoin(kept.agg(F.count("*").alias("after")))


def collapse(reads: DataFrame, five: int = 0, three: int = 0) -> DataFrame:
    """(library, read_idx, seq) -> (library, seq_id, seq, read_count): distinct sequences, numbered from 0 as first seen.

    The count is aggregated before the shuffle; numbers come from ranges of the first index, so no task sorts a library
    alone: ranks within each range, plus the sizes of the ranges before it.
    """
    rows = reads.withColumn("seq", trimmed(F.col("seq"), five, three)) if five or three else reads
    counts = rows.where("seq <> ''").groupBy("library", "seq").agg(F.count("*").alias("read_count"), F.min("read_idx").alias("first"))
    return numbered(counts, "library", "first", "seq_id").select("library", "seq_id", "seq", "read_count")


def numbered(df: DataFrame, key: str, order: str, out: str, width: int = 1 << 16) -> DataFrame:
    """Adds ``out``: 0-based ranks by ``order`` (a non-negative integer, distinct within ``key``), bucket by bucket."""
    bucketed = df.withColumn("__b", F.floor(F.col(order) / width))
    sizes = bucketed.groupBy(key, "__b").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(key).orderBy("__b")) - F.col("__n")
    sizes = sizes.select(key, "__b", before.alias("__before"))
    rank = F.row_number().over(Window.partitionBy(key, "__b").orderBy(order)) - 1
    return bucketed.withColumn("__r", rank).join(sizes, [key, "__b"]).withColumn(out, F.col("__before") + F.col("__r")).drop("__b", "__r", "__before")


def by_threshold(collapsed: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame]:
    """(above, low): sequences with more than ``threshold`` reads, and the others; ids stay."""
    return collapsed.where(F.col("read_count") > threshold), collapsed.where(F.col("read_count") <= threshold)


def decollapse(alignments: DataFrame, name: str = "name") -> DataFrame:
    """Every alignment as often as its read was seen, the count taken off its name."""
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("read_count").cast("long")))
    return alignments.where("read_count > 0").withColumn(name, F.regexp_replace(name, "(_count=|_x)[0-9]+$", "")).withColumn("copy", times)


def kmers(genome: DataFrame, k: int) -> DataFrame:
    """(chrom, seq) -> (chrom, pos, kmer): all k-mers with their 0-based place; a persisted table of them is an index."""
    n = F.length("seq") - k + 1
    at = F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")))
    return genome.select("chrom", "seq", at.alias("pos")).select("chrom", "pos", F.substring("seq", F.col("pos") + 1, F.lit(k)).alias("kmer"), "seq")


def mismatch_count(a: Column, b: Column) -> Column:
    """Positions that differ between two texts of one length."""
    return F.size(F.filter(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x != y), lambda d: d))


def align(reads: DataFrame, genome: DataFrame, mismatches: int = 0, seed: int | None = None, strands: tuple[bool, ...] = (True, False), max_hits: int | None = None, best: bool = False, limit: int | None = None, tile: int = 1024) -> DataFrame:
    """(seq_id, seq) x (chrom, seq) -> (seq_id, seq, chrom, s, e, fwd, nm): every place with at most so many mismatches.

    A read is cut into mismatches + 1 seeds, one of which must match exactly (pigeonhole); seeds meet the genome's k-mers,
    which carry their position alone, in an equi-join, and only the places found meet the genome's tiles to be compared in
    full. ``seed`` is as long as the shortest read allows unless it is given. ``best`` keeps each read's places of fewest
    mismatches, ``max_hits`` drops reads with more places, ``limit`` reports so many places of a read (by mismatches, then
    position).
    """
    pieces = mismatches + 1
    shortest, longest = reads.agg(F.min(F.length("seq")), F.max(F.length("seq"))).first()
    seed, longest = seed or max(1, (shortest or 1) // pieces), longest or 1
    numbers = F.explode(F.sequence(F.lit(0), F.floor(F.greatest(F.length("seq") - 1, F.lit(0)) / tile).cast("int")))
    tiles = genome.select("chrom", F.col("seq").alias("g"), numbers.alias("b"))
    cut = lambda more: F.substring("g", F.col("b") * tile + 1, F.lit(tile + more))
    index = tiles.select("chrom", "b", cut(seed - 1).alias("g"), F.explode(F.sequence(F.lit(0), F.lit(tile - 1))).alias("o"))
    index = index.select("chrom", (F.col("b").cast("long") * tile + F.col("o")).alias("pos"), F.substring("g", F.col("o") + 1, F.lit(seed)).alias("kmer")).where(F.length("kmer") == seed)
    oriented = F.explode(F.array(*[F.struct(F.lit(f).alias("fwd"), (F.col("seq") if f else reverse_complement(F.col("seq"))).alias("q")) for f in strands]))
    # a sequence is looked up once, however many reads have it
    probe = reads.select("seq").distinct().select("seq", oriented.alias("x")).select("seq", "x.fwd", "x.q")
    starts = F.explode(F.array(*[F.lit(i * seed) for i in range(pieces)]))
    probe = probe.select("*", starts.alias("so")).withColumn("kmer", F.substring("q", F.col("so") + 1, F.lit(seed))).where(F.length("kmer") == seed)
    hit = probe.join(index, "kmer").withColumn("s", F.col("pos") - F.col("so")).where("s >= 0").select("seq", "fwd", "q", "chrom", "s")
    hit = hit.distinct() if pieces > 1 else hit
    hit = hit.withColumn("b", F.floor(F.col("s") / tile).cast("int")).join(tiles.select("chrom", "b", cut(longest).alias("ctx")), ["chrom", "b"])
    hit = hit.withColumn("place", F.substring("ctx", (F.col("s") % tile).cast("int") + 1, F.length("q"))).where(F.length("place") == F.length("q"))
    if mismatches:
        hit = hit.withColumn("nm", mismatch_count(F.col("place"), F.col("q"))).where(F.col("nm") <= mismatches)
    else:
        hit = hit.where(F.col("place") == F.col("q")).withColumn("nm", F.lit(0))
    places = hit.select("seq", "chrom", "s", (F.col("s") + F.length("q")).cast("long").alias("e"), "fwd", "nm")
    named = reads.select("seq_id", "seq").distinct() if pieces > 1 else reads.select("seq_id", "seq")
    found = named.join(places, "seq").select("seq_id", "seq", "chrom", "s", "e", "fwd", "nm")
    each = Window.partitionBy("seq_id")
    if best:
        found = found.withColumn("__least", F.min("nm").over(each)).where("nm = __least").drop("__least")
    if max_hits is not None:
        found = found.withColumn("__n", F.count("*").over(each)).where(F.col("__n") <= max_hits).drop("__n")
    if limit is not None:
        found = found.withColumn("__n", F.row_number().over(each.orderBy("nm", "chrom", "s", "fwd"))).where(F.col("__n") <= limit).drop("__n")
    return found


def as_alignments(found: DataFrame, collapsed: DataFrame) -> DataFrame:
    """``align``'s places of a library's collapsed reads, as the assignment reads alignments."""
    rows = found.join(collapsed.select("library", "seq_id", "read_count"), "seq_id")
    seq = F.when(F.col("fwd"), F.col("seq")).otherwise(reverse_complement(F.col("seq")))
    key = F.xxhash64("chrom", "s", "fwd")
    return rows.select(
        "library", F.concat(F.col("seq_id").cast("string"), F.lit("_count="), "read_count").alias("name"), key.alias("row_key"), "chrom", "s", "e", "fwd",
        F.substring("seq", 1, 1).alias("nt5"), F.length("seq").alias("length"), F.col("nm").cast("int").alias("nm"), F.col("read_count").cast("long").alias("read_count"), seq.alias("seq"),
    )


def unaligned(reads: DataFrame, alignments: DataFrame) -> DataFrame:
    return reads.join(alignments.select("seq_id").distinct(), "seq_id", "left_anti")
