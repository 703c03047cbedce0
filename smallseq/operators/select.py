"""Assignment of alignments to features: overlap, predicates, and the hierarchy of rules.

Alignments: library, name, row_key, chrom, s, e, fwd, nt5, length, nm, read_count, seq.
Matches: feature_id, classifier, chrom, fs, fe (shifted), strand, record_id, and the typed rule's columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..durable import durable
from .intervals import interval_join, merge_intervals, overlap_counts

ROW, PAIR = ["library", "name", "row_key"], ["feature_id", "classifier"]


def overlaps(kind: Column) -> Column:
    """Whether the alignment [s, e) fits the interval [fs, fe) in the way its rule asks (they do overlap)."""
    a, b, f, g = F.col("s"), F.col("e"), F.col("fs"), F.col("fe")
    at_start, at_end = (a == f) & (b <= g), (b == g) & (a >= f)
    ends = at_start | at_end
    five = F.when(F.col("strand").isNull(), ends).when(F.col("fwd"), at_start).otherwise(at_end)
    three = F.when(F.col("strand").isNull(), ends).when(F.col("fwd"), at_end).otherwise(at_start)
    return (
        F.when(kind == "partial", True)
        .when(kind == "nested", (f <= a) & (b <= g))
        .when(kind == "exact", (a == f) & (b == g))
        .when(kind == "anchored", ends)
        .when(kind == "5' anchored", five)
        .when(kind == "3' anchored", three)
        .otherwise(False)
    )


def passes_strand() -> Column:
    return F.col("sense").isNull() | F.col("strand").isNull() | ((F.col("fwd") == F.col("strand")) == F.col("sense"))


def _member(allowed: str, value: str) -> Column:
    return F.col(allowed).isNull() | F.array_contains(allowed, F.col(value))


def passes() -> Column:
    return overlaps(F.col("overlap")) & _member("mismatches", "nm") & passes_strand() & _member("nts", "nt5") & _member("lengths", "length")


def passes_for(kind) -> Column:
    """``passes`` but for the overlap, of the alignments alone: with one rule and strand, given as a row."""
    tests = [F.col(value).isin(allowed) for allowed, value in ((kind["mismatches"], "nm"), (kind["nts"], "nt5"), (kind["lengths"], "length")) if allowed is not None]
    if kind["sense"] is not None and kind["strand"] is not None:
        tests.append((F.col("fwd") == kind["strand"]) == kind["sense"])
    return F.coalesce(reduce(Column.__and__, tests, F.lit(True)), F.lit(False))


def with_loci(alignments: DataFrame, normalize: bool = True) -> DataFrame:
    """Adds loci (alignments of the read) and corr (its count shared among them, or whole)."""
    loci = F.count("*").over(Window.partitionBy("library", "name"))
    share = F.col("read_count").cast("double") / F.col("loci").cast("double") if normalize else F.col("read_count").cast("double")
    return alignments.withColumn("loci", loci).withColumn("corr", share)


def candidate_pairs(alignments: DataFrame, matches: DataFrame, small: bool | None = None) -> DataFrame:
    return interval_join(alignments, matches, small)


def choose(pairs: DataFrame) -> DataFrame:
    """The pairs of each alignment that pass all predicates at the least hierarchy at which any does.

    Every predicate comes before the ranking: a pair that fails uses up no rank.
    """
    w = Window.partitionBy(*ROW).orderBy("hierarchy")
    best = pairs.where(passes()).withColumn("__rank", F.rank().over(w)).where(F.col("__rank") == 1)
    return best.select(*ROW, *PAIR, "rule_idx", "corr", "loci").distinct()


def with_hits(chosen: DataFrame, normalize: bool = True) -> DataFrame:
    """Adds hits (features with classifier of the alignment), n_rules (rules of the pair) and fcorr (the pair's share)."""
    # one sort by row and pair serves all three windows
    pair = F.dense_rank().over(Window.partitionBy(*ROW).orderBy(*PAIR))
    n_rules = F.count("*").over(Window.partitionBy(*ROW, *PAIR))
    share = F.col("corr") / F.col("hits").cast("double") if normalize else F.col("corr")
    ranked = chosen.withColumns({"__pair": pair, "n_rules": n_rules})
    return ranked.withColumn("hits", F.max("__pair").over(Window.partitionBy(*ROW))).drop("__pair").withColumn("fcorr", share)


def assign(alignments: DataFrame, matches: DataFrame, norm_loci: bool = True, norm_hits: bool = True, small: bool | None = None) -> DataFrame:
    """One row for each alignment, feature, classifier and rule that is assigned, with its shares.

    All windows partition by the read or finer, so one shuffle of the alignments serves loci, ranks and hits.
    """
    return with_hits(choose(candidate_pairs(with_loci(alignments, norm_loci), matches, small)), norm_hits)


def candidate_counts(alignments: DataFrame, matches: DataFrame, small: bool | None = None) -> DataFrame:
    """(library, name, row_key, candidates): distinct feature records that overlap; alignments without one have no row.

    Records of one interval on a chromosome are counted by their ends, without pairs; those of several by their pairs, and
    so are keys that several places share.
    """
    pieces = durable(merge_intervals(matches.where("fs < fe").select("record_id", "chrom", "fs", "fe").distinct(), ["record_id", "chrom"]))
    each = pieces.withColumn("__n", F.count("*").over(Window.partitionBy("record_id", "chrom")))
    several = each.where("__n > 1").drop("__n")
    rows = alignments.where("s < e").groupBy(*ROW).agg(F.collect_set(F.struct("chrom", "s", "e")).alias("__places"))
    rows = durable(rows)
    single = rows.where(F.size("__places") == 1).select(*ROW, F.inline("__places"))
    shared = rows.where(F.size("__places") > 1).select(*ROW, F.inline("__places"))
    counts = [overlap_counts(single, each.where("__n = 1"), "candidates").where("candidates > 0").select(*ROW, "candidates")]
    for some, records in ((single, several), (shared, pieces)):
        if not some.isEmpty() and not records.isEmpty():
            counts.append(interval_join(some, records, small).groupBy(*ROW).agg(F.count_distinct("record_id").alias("candidates")))
    if len(counts) == 1:
        return counts[0]
    return reduce(DataFrame.unionByName, counts).groupBy(*ROW).agg(F.sum("candidates").alias("candidates"))
