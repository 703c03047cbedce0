"""The data behind the plots; drawing them is left to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.seq import group_of

GENE = ["feature_id", "classifier"]


def class_counts(counts: DataFrame) -> DataFrame:
    return counts.groupBy("library", "classifier").agg(F.sum("count").alias("count"))


def proportions(counts: DataFrame, mapped: DataFrame, label: str, scale: int = 2, unassigned: str = "_UNASSIGNED_") -> DataFrame:
    """(library, label, proportion) of the mapped reads, rounded half to even, with the unassigned rest where it shows."""
    share = counts.join(F.broadcast(mapped.select("library", "mapped_reads")), "library").select("library", F.col(label).cast("string").alias(label), F.bround(F.col("count") / F.col("mapped_reads"), scale + 2).alias("proportion"))
    rest = share.groupBy("library").agg((1 - F.sum("proportion")).alias("proportion")).where(F.col("proportion") >= 10.0**-(scale + 2)).select("library", F.lit(unassigned).alias(label), "proportion")
    return share.unionByName(rest)


def sample_averages(counts: DataFrame) -> DataFrame:
    return counts.groupBy(*GENE, group_of(F.col("library")).alias("grp")).agg(F.avg("count").alias("count"))


def length_proportions(matrix: DataFrame, bases: tuple[str, ...] = ("A", "C", "G", "T"), shortest: int | None = None, longest: int | None = None) -> DataFrame:
    """nt-by-length counts as shares of the library's total, lengths without reads filled with zeros."""
    total = sum((F.sum(b) for b in bases), F.lit(0.0))
    libraries = matrix.groupBy("library").agg(total.alias("total"), F.min("length").alias("lo"), F.max("length").alias("hi"))
    lo, hi = (F.lit(shortest) if shortest is not None else F.col("lo")), (F.lit(longest) if longest is not None else F.col("hi"))
    axis = libraries.select("library", "total", F.explode(F.sequence(lo, hi)).alias("length"))
    return axis.join(matrix, ["library", "length"], "left").select("library", "length", *[(F.coalesce(b, F.lit(0.0)) / F.col("total")).alias(b) for b in bases])


def class_filter(rows: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None) -> DataFrame:
    """Rows of some classifiers, or of all but some, without case; not both."""
    if include and exclude:
        raise ValueError("include and exclude cannot be given together")
    name = F.lower("classifier")
    if include:
        return rows.where(name.isin([c.lower() for c in include]))
    return rows.where(~name.isin([c.lower() for c in exclude])) if exclude else rows


def significant(results: DataFrame, cutoff: float = 0.05) -> DataFrame:
    """Genes with an adjusted p below the cutoff; a null one never passes."""
    return results.where(F.col("padj") < cutoff)


def outgroup(averages: DataFrame, results: DataFrame, cutoff: float = 0.05) -> DataFrame:
    return averages.join(significant(results, cutoff).select(*GENE).distinct(), GENE, "left_anti")


def ingroup(averages: DataFrame, results: DataFrame, cutoff: float = 0.05) -> DataFrame:
    return averages.join(significant(results, cutoff).select(*GENE).distinct(), GENE, "left_semi")


def padj_table(results: DataFrame, comparisons: list[str]) -> DataFrame:
    return results.withColumn("comparison", F.concat_ws("_vs_", "cond1", "cond2")).groupBy(*GENE).pivot("comparison", comparisons).agg(F.first("padj"))


def scatter_points(averages: DataFrame, x: str, y: str) -> DataFrame:
    """(feature_id, classifier, x, y) of two groups; genes that are zero in both are left out."""
    wide = averages.groupBy(*GENE).pivot("grp", [x, y]).agg(F.first("count")).fillna(0.0)
    return wide.select(*GENE, F.col(f"`{x}`").alias("x"), F.col(f"`{y}`").alias("y")).where("x > 0 or y > 0")


def scatter_groups(points: DataFrame, results: DataFrame, cutoff: float = 0.05, by_class: bool = True, rest: str = "p >= cutoff") -> DataFrame:
    """Points with their group: the classifier (or one group) of those below the cutoff, ``rest`` for the others.

    ``place`` is the order of drawing: groups by size, the largest first, so that small ones lie on top.
    """
    hits = significant(results, cutoff).select(*GENE).distinct().withColumn("hit", F.lit(True))
    name = F.col("classifier") if by_class else F.lit("p < cutoff")
    grouped = points.join(hits, GENE, "left").withColumn("grp", F.when(F.col("hit"), name).otherwise(rest)).drop("hit")
    sizes = grouped.groupBy("grp").agg(F.count("*").alias("n"))
    order = sizes.agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "grp"))).alias("x"))  # one row a group
    places = order.select(F.posexplode("x").alias("place", "x")).select("place", "x.grp")
    return grouped.join(F.broadcast(places), "grp").select(*GENE, "x", "y", "grp", "place")


def class_colours(classes: list[str], palette: list[str]) -> dict[str, str]:
    """A colour for each class, in order; an error if the palette has too few."""
    if len(classes) > len(palette):
        raise ValueError(f"{len(classes)} classes, but {len(palette)} colours")
    return dict(zip(sorted(classes), palette, strict=False))


def replicate_points(counts: DataFrame, pairs: DataFrame) -> DataFrame:
    """(feature_id, classifier, grp, rep1, rep2, x, y): counts of each pair of replicates; genes without any are left out."""
    side = lambda k: counts.select(*GENE, F.col("library").alias(f"library{k}"), F.col("count").alias("xy"[k - 1]))
    named = pairs.select("grp", "rep1", "rep2", *[F.concat("grp", F.lit("_rep_"), f"rep{k}").alias(f"library{k}") for k in (1, 2)])
    both = side(1).join(F.broadcast(named), "library1").join(side(2), ["library2", *GENE])
    return both.where("x > 0 or y > 0").select(*GENE, "grp", "rep1", "rep2", "x", "y")


def view_limits(averages: DataFrame) -> DataFrame:
    """(lo, hi): log2 of the least count above zero and of the greatest; zeros are drawn at lo."""
    return averages.agg(F.log2(F.min(F.when(F.col("count") > 0, F.col("count")))).alias("lo"), F.log2(F.max("count")).alias("hi"))


def by_padj(results: DataFrame) -> DataFrame:
    return results.withColumn("n", F.row_number().over(Window.partitionBy("cond1", "cond2").orderBy(F.asc_nulls_last("padj"), *GENE)))
