"""Differential expression: size factors, normalised counts, comparisons, adjusted p-values, an approximate Wald test."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

GENE = ["feature_id", "classifier"]


def integer_counts(counts: DataFrame) -> DataFrame:
    """Counts truncated towards zero."""
    return counts.withColumn("count", F.when(F.col("count") < 0, F.ceil("count")).otherwise(F.floor("count")).cast("long"))


def without_zero_genes(counts: DataFrame) -> DataFrame:
    some = counts.groupBy(*GENE).agg(F.sum("count").alias("__all")).where("__all > 0").select(*GENE)
    return counts.join(some, GENE, "left_semi")


def size_factors(counts: DataFrame) -> DataFrame:
    """(library, size_factor): median over genes of count / geometric mean, of genes counted in every library."""
    n_libraries = counts.select("library").distinct().count()
    means = counts.where("count > 0").groupBy(*GENE).agg(F.count("*").alias("n"), F.avg(F.ln(F.col("count").cast("double"))).alias("log_mean")).where(F.col("n") == n_libraries)
    ratios = counts.join(means, GENE).select("library", (F.col("count").cast("double") / F.exp("log_mean")).alias("ratio"))
    return ratios.groupBy("library").agg(F.median("ratio").alias("size_factor"))


def normalized_counts(counts: DataFrame, factors: DataFrame) -> DataFrame:
    return counts.join(F.broadcast(factors), "library").withColumn("count", F.col("count").cast("double") / F.col("size_factor")).drop("size_factor")


def bh_adjusted(results: DataFrame, by: list[str], p: str = "pvalue", out: str = "padj") -> DataFrame:
    """Benjamini-Hochberg: min over larger p of p * n / rank, at most 1; null p stays null. ``by`` names a comparison."""
    known = F.col(p).isNotNull()
    w = Window.partitionBy(*by, known)
    rank = F.rank().over(w.orderBy(p)) + F.count("*").over(w.orderBy(p).rangeBetween(0, 0)) - 1
    raw = F.col(p) * F.count(p).over(w) / rank
    ranked = results.withColumn("__raw", raw)
    return ranked.withColumn(out, F.when(known, F.least(F.lit(1.0), F.min("__raw").over(w.orderBy(F.desc(p)).rangeBetween(Window.unboundedPreceding, 0))))).drop("__raw")


def control_comparisons(groups: DataFrame) -> DataFrame:
    """(cond1, cond2): the control against each other group. groups: grp, ord, is_control."""
    c = groups.where("is_control").select(F.col("grp").alias("cond1"))
    return c.crossJoin(F.broadcast(groups.where("not is_control").select(F.col("grp").alias("cond2"))))


def all_comparisons(groups: DataFrame, flipped: bool = True) -> DataFrame:
    """(cond1, cond2, flip): every unordered pair in sheet order, and its reverse."""
    a, b = groups.select(F.col("grp").alias("cond1"), F.col("ord").alias("o1")), groups.select(F.col("grp").alias("cond2"), F.col("ord").alias("o2"))
    pairs = a.join(F.broadcast(b), F.col("o1") < F.col("o2")).select("cond1", "cond2", F.lit(False).alias("flip"))
    return pairs.unionByName(pairs.select(F.col("cond2").alias("cond1"), F.col("cond1").alias("cond2"), F.lit(True).alias("flip"))) if flipped else pairs


def replicate_pairs(libraries: DataFrame) -> DataFrame:
    """(grp, rep1, rep2): pairs of a group's replicates."""
    a = libraries.select("grp", F.col("replicate").alias("rep1"))
    b = libraries.select(F.col("grp").alias("g2"), F.col("replicate").alias("rep2"))
    return a.join(b, (F.col("grp") == F.col("g2")) & (F.col("rep1") < F.col("rep2"))).drop("g2")


def replicate_counts(libraries: DataFrame) -> DataFrame:
    """(grp, n, replicated): libraries of each group, and whether there are several."""
    return libraries.groupBy("grp").agg(F.count("*").alias("n")).withColumn("replicated", F.col("n") > 1)


def flipped(results: DataFrame) -> DataFrame:
    """The reverse comparison: fold change and statistic change sign."""
    swapped = results.withColumnsRenamed({"cond1": "__c"}).withColumnRenamed("cond2", "cond1").withColumnRenamed("__c", "cond2")
    return swapped.withColumns({c: -F.col(c) for c in ("log2FoldChange", "stat") if c in results.columns}).select(*results.columns)


def wald_tests(normalized: DataFrame, groups: DataFrame, comparisons: DataFrame) -> DataFrame:
    """Per comparison and gene: baseMean, log2FoldChange, lfcSE, stat, pvalue, padj.

    A negative binomial Wald test on normalised counts with moment dispersions that are shrunk half-way to their trend
    (dispersion ~ a + b / mean, fitted over all genes). An approximation of the usual model-based test: no Cook's cut-off, no
    independent filtering. All of it is aggregates and column functions; groups: library, grp.
    """
    rows = normalized.join(F.broadcast(groups.select("library", "grp")), "library")
    stats = rows.groupBy(*GENE, "grp").agg(F.avg("count").alias("mean"), F.var_samp("count").alias("var"), F.count("*").alias("n"))
    per_gene = rows.groupBy(*GENE).agg(F.avg("count").alias("baseMean"))
    pooled = stats.groupBy(*GENE).agg((F.sum(F.coalesce("var", F.lit(0.0)) * (F.col("n") - 1)) / F.greatest(F.sum(F.col("n") - 1), F.lit(1))).alias("var"))
    gene = per_gene.join(pooled, GENE).withColumn("raw", F.greatest((F.col("var") - F.col("baseMean")) / (F.col("baseMean") * F.col("baseMean") + 1e-12), F.lit(1e-8)))
    fit = gene.where("baseMean > 0").agg(F.regr_slope("raw", 1 / F.col("baseMean")).alias("slope"), F.regr_intercept("raw", 1 / F.col("baseMean")).alias("at"))
    gene = gene.crossJoin(F.broadcast(fit)).withColumn("trend", F.greatest(F.coalesce("at", F.lit(0.1)) + F.coalesce("slope", F.lit(0.0)) / F.greatest("baseMean", F.lit(1e-12)), F.lit(1e-8)))
    gene = gene.select(*GENE, "baseMean", F.exp((F.ln("raw") + F.ln("trend")) / 2).alias("dispersion"))
    side = lambda c, i: stats.select(*GENE, F.col("grp").alias(c), F.col("mean").alias(f"m{i}"), F.col("n").alias(f"n{i}"))
    wide = F.broadcast(comparisons.select("cond1", "cond2")).join(side("cond1", 1), "cond1").join(side("cond2", 2), ["cond2", *GENE]).join(gene, GENE)
    change = (F.ln(F.col("m2") + 0.5) - F.ln(F.col("m1") + 0.5)) / F.ln(F.lit(2.0))
    spread = lambda i: (1 / (F.col(f"m{i}") + 0.5) + F.col("dispersion")) / F.col(f"n{i}")
    wide = wide.withColumns({"log2FoldChange": change, "lfcSE": F.sqrt(spread(1) + spread(2)) / F.ln(F.lit(2.0))}).withColumn("stat", F.col("log2FoldChange") / F.col("lfcSE"))
    p = F.when(F.col("baseMean") > 0, two_sided(F.col("stat")))
    return bh_adjusted(wide.withColumn("pvalue", p).select("cond1", "cond2", *GENE, "baseMean", "log2FoldChange", "lfcSE", "stat", "pvalue"), ["cond1", "cond2"])


def with_metadata(results: DataFrame, features: DataFrame) -> DataFrame:
    """Comparison rows with the names of their features (feature_id, classifier, feature_name); others are left out."""
    return results.join(features.select(*GENE, "feature_name").distinct(), GENE)


def two_sided(z):
    """2 * (1 - Phi(|z|)), by the rational approximation 26.2.17 of Abramowitz and Stegun (error below 1e-7)."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    # fixed values of the approximation
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.least(F.lit(1.0), 2 * F.exp(-x * x / 2) / F.sqrt(2 * F.pi()) * poly)


def principal_components(normalized: DataFrame, top: int = 500) -> DataFrame:
    """(library, pc1, pc2) of log2(count + 1) over the most variable genes.

    The library x library Gram matrix is summed over genes in SQL; only that matrix (one row for each pair of libraries)
    reaches the driver.
    """
    import numpy as np

    logs = normalized.withColumn("x", F.log2(F.col("count") + 1))
    w = Window.partitionBy(*GENE)
    logs = logs.withColumns({"x": F.col("x") - F.avg("x").over(w), "v": F.var_samp("x").over(w)})
    chosen = logs.groupBy(*GENE).agg(F.first("v").alias("v")).orderBy(F.desc("v"), *GENE).limit(top).select(*GENE)
    logs = logs.join(chosen, GENE, "left_semi").select(*GENE, "library", "x")
    other = logs.select(*GENE, F.col("library").alias("library2"), F.col("x").alias("y"))
    gram = logs.join(other, GENE).groupBy("library", "library2").agg(F.sum(F.col("x") * F.col("y")).alias("g")).collect()
    names = sorted({r[0] for r in gram})
    m = np.zeros((len(names), len(names)))
    for a, b, g in gram:
        m[names.index(a), names.index(b)] = g
    values, vectors = np.linalg.eigh((m + m.T) / 2)
    order = np.argsort(-values)[:2]
    rows = []
    for i, name in enumerate(names):
        pcs = [float(vectors[i, j] * np.sqrt(max(values[j], 0.0)) * (1 if vectors[np.argmax(np.abs(vectors[:, j])), j] > 0 else -1)) for j in order]
        rows.append((name, *pcs, *[0.0] * (2 - len(pcs))))
    return normalized.sparkSession.createDataFrame(rows, "library string, pc1 double, pc2 double")

