"""Aggregations over assigned alignments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..durable import durable
from .intervals import running_sums
from .select import PAIR, ROW, assign, candidate_pairs, choose, passes_for, with_hits, with_loci

#: Kinds of matches (rule and strand) up to which counts go by the ends of intervals; each is a column of that plan.
KINDS = 64
#: So many numbers of a table of places are broadcast; beyond, alignments are shuffled by their places.
PLACE_NUMBERS = 4_000_000
#: What an alignment gives to a feature, summed exactly: sums are taken from each other.
SHARE = "decimal(38, 18)"


def rounded(x: Column) -> Column:
    return F.round(x.cast("double"), 6)


def feature_counts(assigned: DataFrame) -> DataFrame:
    """(library, feature_id, classifier, count): a pair counts once for an alignment, whatever rules led to it."""
    return assigned.groupBy("library", *PAIR).agg(F.sum(F.col("fcorr") / F.col("n_rules")).alias("count"))


def _overlapping(alignments: DataFrame, matches: DataFrame, n: int) -> DataFrame:
    """Adds ``__n``: array of the matches of each of n kinds that overlap the alignment, and, at last, of those marked several.

    They are those that begin before its end, less those that end at its begin or before, looked up by place.
    """
    ends = matches.select("chrom", "kind", "several", F.explode(F.array(F.struct(F.col("fs").alias("pos"), F.lit(True).alias("begin")), F.struct(F.col("fe").alias("pos"), F.lit(False).alias("begin")))).alias("x")).select("*", "x.*")
    tests = [F.col("kind") == i for i in range(n)] + [F.col("several")]
    sums = [f"{side}{i}" for side in "be" for i in range(n + 1)]
    marks = ends.select("chrom", "pos", *[F.when(test & begin, 1).otherwise(0).cast("long").alias(f"{side}{i}") for side, begin in (("b", F.col("begin")), ("e", ~F.col("begin"))) for i, test in enumerate(tests)], F.lit(False).alias("asked"))
    asked = alignments.select("chrom", F.explode(F.array(F.col("s"), F.col("e") - 1)).alias("pos")).where("chrom is not null and pos is not null").distinct()
    asked = asked.select("*", *[F.lit(0).cast("long").alias(c) for c in sums], F.lit(True).alias("asked"))
    places = durable(marks.union(asked).groupBy("chrom", "pos").agg(*[F.sum(c).alias(c) for c in sums], F.max("asked").alias("asked")))
    places = durable(running_sums(places, ["chrom"], sums).where("asked"))
    small = places.count() * (n + 3) <= PLACE_NUMBERS
    rows = alignments
    for side, at in (("b", F.col("e") - 1), ("e", F.col("s"))):
        found = places.select(F.col("chrom").alias("__c"), F.col("pos").alias("__p"), *[f"{side}{i}" for i in range(n + 1)])
        rows = rows.join(F.broadcast(found) if small else found, (F.col("chrom") == F.col("__c")) & (at == F.col("__p"))).drop("__c", "__p")
    return rows.withColumn("__n", F.array(*[F.col(f"b{i}") - F.col(f"e{i}") for i in range(n + 1)])).drop(*sums)


def selected_counts(alignments: DataFrame, matches: DataFrame, norm_loci: bool = True, norm_hits: bool = True) -> DataFrame:
    """``feature_counts`` of ``assign``; without pairs where every rule asks for a partial overlap.

    An alignment's hits are then counted by the ends of intervals for each kind of match, and a feature's count is what
    alignments that begin before its end give, less what those give that end at its begin or before. Alignments whose key
    recurs, or that meet one of several matches of a pair, are assigned by their pairs; so are all with other overlaps.
    """
    matches = durable(matches.where("fs < fe"))
    kinds = matches.select("rule_idx", "strand", "overlap", "hierarchy", "sense", "nts", "lengths", "mismatches").distinct().collect()  # rules x strands
    if not kinds or len(kinds) > KINDS or any(k["overlap"] != "partial" for k in kinds):
        return feature_counts(assign(alignments, matches, norm_loci, norm_hits))
    n = len(kinds)
    kind = F.coalesce(*[F.when((F.col("rule_idx") == k["rule_idx"]) & F.col("strand").eqNullSafe(F.lit(k["strand"]).cast("boolean")), i) for i, k in enumerate(kinds)])
    marked = matches.select(*PAIR, "chrom", "fs", "fe", kind.alias("kind"), (F.count("*").over(Window.partitionBy(*PAIR)) > 1).alias("several"))
    marked = durable(marked.where("chrom is not null"))
    rows = with_loci(alignments, norm_loci).withColumn("__same", F.count("*").over(Window.partitionBy(*ROW)))
    rows = _overlapping(rows, marked, n)
    # arrays, not a column for each kind: the optimiser's constraints grow with the columns' combinations
    level = F.array(*[F.lit(k["hierarchy"]) for k in kinds])
    by_pairs = (F.col("__same") > 1) | (F.element_at("__n", -1) > 0) | (F.col("s") > F.col("e"))
    rows = rows.withColumn("__by_pairs", by_pairs).withColumn("__n", F.array(*[F.when(passes_for(k), F.get("__n", F.lit(i))).otherwise(0) for i, k in enumerate(kinds)]))
    rows = rows.withColumn("__best", F.array_min(F.transform("__n", lambda x, i: F.when(x > 0, F.get(level, i)))))
    rows = rows.withColumn("__n", F.transform("__n", lambda x, i: F.when(F.get(level, i) == F.col("__best"), x).otherwise(0)))
    rows = rows.withColumn("__hits", F.aggregate("__n", F.lit(0).cast("long"), lambda a, x: a + x))
    share = (F.col("corr") / F.col("__hits").cast("double") if norm_hits else F.col("corr")).cast(SHARE)

    own = F.when(F.col("__by_pairs"), F.array(F.lit(-1))).otherwise(F.filter(F.transform("__n", lambda x, i: F.when(x > 0, i)), lambda x: x.isNotNull()))
    given = rows.where("__by_pairs or __best is not null").select("library", "chrom", "s", "e", F.when(~F.col("__by_pairs"), share).alias("share"), F.explode(own).alias("kind"))
    sides = F.explode(F.array(F.struct(F.lit(True).alias("begin"), F.col("s").alias("pos")), F.struct(F.lit(False).alias("begin"), F.col("e").alias("pos")))).alias("x")
    given = given.select("library", "chrom", "kind", "share", sides).select("library", "chrom", "kind", "x.begin", F.when(F.col("kind") >= 0, F.col("x.pos")).alias("pos"), "share")
    given = durable(given.groupBy("library", "chrom", "kind", "begin", "pos").agg(F.sum("share").cast(SHARE).alias("count"), F.count("*").alias("n")))

    by = ["library", "chrom", "kind", "begin"]
    features = marked.where("not several").crossJoin(F.broadcast(given.select("library").distinct()))
    ends = F.explode(F.array(F.struct(F.lit(True).alias("begin"), (F.col("fe") - 1).alias("pos"), F.lit(1).alias("sign")), F.struct(F.lit(False).alias("begin"), F.col("fs").alias("pos"), F.lit(-1).alias("sign")))).alias("x")
    asked = features.select("library", "chrom", "kind", *PAIR, ends).select("library", "chrom", "kind", "x.begin", "x.pos", F.lit(0).cast(SHARE).alias("count"), F.lit(0).cast("long").alias("n"), *PAIR, "x.sign")
    given_rows = given.where("kind >= 0").select(*asked.columns[:7], *[F.lit(None).cast(asked.schema[c].dataType).alias(c) for c in (*PAIR, "sign")])
    sums = running_sums(given_rows.union(asked).withColumns({"count": F.col("count").cast(SHARE)}), by, ["count", "n"]).where("sign is not null")
    signed = lambda c: F.sum(F.when(F.col("sign") > 0, F.col(c)).otherwise(-F.col(c)))
    # what 18 decimal places cut off an exact share is rounded away
    found = sums.groupBy("library", *PAIR).agg(signed("count").alias("count"), signed("n").alias("n")).where("n > 0").select("library", *PAIR, F.round("count", 12).cast("double").alias("count"))
    if given.where("kind < 0").isEmpty():
        return found
    paired = with_hits(choose(candidate_pairs(rows.where("__by_pairs").select(*alignments.columns, "loci", "corr"), matches)), norm_hits)
    return found.union(feature_counts(paired)).groupBy("library", *PAIR).agg(F.sum("count").alias("count"))


def rule_counts(assigned: DataFrame, rules: DataFrame, libraries: DataFrame) -> DataFrame:
    """(library, rule_idx, count): a pair's share is split among its rules; all rules of all libraries have a row."""
    counts = assigned.groupBy("library", "rule_idx").agg(F.sum(F.col("fcorr") / F.col("n_rules")).alias("count"))
    every = libraries.select("library").distinct().crossJoin(F.broadcast(rules.select("rule_idx")))
    return every.join(counts, ["library", "rule_idx"], "left").select("library", "rule_idx", F.coalesce("count", F.lit(0.0)).alias("count"))


def zero_filled(counts: DataFrame, features: DataFrame, libraries: DataFrame) -> DataFrame:
    """All (feature, classifier) pairs in all libraries."""
    every = features.select(*PAIR).distinct().crossJoin(F.broadcast(libraries.select("library").distinct()))
    return every.join(counts, ["library", *PAIR], "left").select("library", *PAIR, F.coalesce("count", F.lit(0.0)).alias("count"))


def with_aliases(counts: DataFrame, aliases: DataFrame) -> DataFrame:
    return counts.join(aliases, "feature_id", "left").withColumn("feature_name", F.coalesce("feature_name", F.lit("")))


def by_alignment(alignments: DataFrame, assigned: DataFrame) -> DataFrame:
    """Every alignment (with loci, corr) with its assigned share, hits and set of feature ids."""
    per = assigned.groupBy(*ROW).agg(F.sum(F.col("fcorr") / F.col("n_rules")).alias("assigned"), F.max("hits").alias("hits"), F.collect_set("feature_id").alias("feature_ids"))
    joined = alignments.join(per, ROW, "left")
    return joined.withColumns({"assigned": F.coalesce("assigned", F.lit(0.0)), "hits": F.coalesce("hits", F.lit(0)), "unassigned": F.when(F.col("hits").isNull(), F.col("corr")).otherwise(0.0)})


def by_read(per_alignment: DataFrame) -> DataFrame:
    """(library, name): loci, reads, assigned, unassigned, n_features (ids, whatever classifier), first alignment's nt5, length."""
    first = F.min_by(F.struct("nt5", "length"), F.col("row_key"))
    return per_alignment.groupBy("library", "name").agg(
        F.first("loci").alias("loci"), F.first("read_count").alias("read_count"), F.sum("assigned").alias("assigned"), F.sum("unassigned").alias("unassigned"),
        F.size(F.array_distinct(F.flatten(F.collect_list(F.coalesce("feature_ids", F.array().cast("array<string>")))))).alias("n_features"), first.alias("f"),
    ).select("*", "f.nt5", "f.length").drop("f")


def alignment_stats(reads: DataFrame) -> DataFrame:
    """Long form (library, stat, value) of the ten totals."""
    one = lambda cond, value: F.sum(F.when(cond, value).otherwise(F.lit(0.0)))
    some, single = F.col("n_features") > 0, F.col("n_features") == 1
    # fixed values: the report's labels
    stats = {
        "Total Assigned Reads": F.sum("assigned"),
        "Total Unassigned Reads": F.sum("unassigned"),
        "Total Assigned Sequences": one(some, 1.0),
        "Total Unassigned Sequences": one(~some, 1.0),
        "Assigned Single-Mapping Reads": one(some & (F.col("loci") == 1), F.col("assigned")),
        "Assigned Multi-Mapping Reads": one(some & (F.col("loci") > 1), F.col("assigned")),
        "Reads Assigned to Single Feature": one(single, F.col("assigned")),
        "Sequences Assigned to Single Feature": one(single, 1.0),
        "Reads Assigned to Multiple Features": one(some & ~single, F.col("assigned")),
        "Sequences Assigned to Multiple Features": one(some & ~single, 1.0),
    }
    wide = reads.groupBy("library").agg(*[v.alias(k) for k, v in stats.items()])
    return wide.unpivot("library", list(stats), "stat", "value")


def summary_stats(reads: DataFrame) -> DataFrame:
    """(library, mapped_sequences, mapped_reads, assigned_reads, raw_reads)."""
    return reads.groupBy("library").agg(F.count("*").alias("mapped_sequences"), F.sum(F.col("assigned") + F.col("unassigned")).alias("mapped_reads"), F.sum("assigned").alias("assigned_reads"), F.sum("read_count").alias("raw_reads"))


def summary_report(summary: DataFrame, filtered: DataFrame | None = None, unique: DataFrame | None = None) -> DataFrame:
    """Long form (stat, library, value) of the summary, with the filter's and the collapser's rows where they are known.

    filtered: library, total_reads, retained_reads; unique: library, unique. A row that no library has is left out.
    """
    # fixed values: the report's labels
    labels = {"Total Reads": "total_reads", "Retained Reads": "retained_reads", "Unique Sequences": "unique", "Mapped Sequences": "mapped_sequences", "Mapped Reads": "mapped_reads", "Assigned Reads": "assigned_reads"}
    df = summary
    for more in (filtered, unique):
        if more is not None:
            df = df.join(more, "library", "left")
    shown = {label: c for label, c in labels.items() if c in df.columns}
    wide = df.select("library", *[F.col(c).cast("double").alias(label) for label, c in shown.items()])
    return wide.unpivot("library", list(shown), "stat", "value").where("value is not null").select("stat", "library", "value")


def with_mapped_row(rule_counts: DataFrame, summary: DataFrame) -> DataFrame:
    """(rule, library, count): counts by rule with each library's mapped reads as a last row."""
    rows = rule_counts.select(F.col("rule_idx").cast("string").alias("rule"), "library", "count")
    return rows.unionByName(summary.select(F.lit("Mapped Reads").alias("rule"), "library", F.col("mapped_reads").alias("count")))


def nt_length(reads: DataFrame, assigned_only: bool, bases: tuple[str, ...] = ("A", "C", "G", "T")) -> DataFrame:
    """(library, length, A, C, G, T): reads by length and 5' base of their first alignment."""
    value = F.col("assigned") if assigned_only else F.col("assigned") + F.col("unassigned")
    rows = reads.where("n_features > 0") if assigned_only else reads
    return rows.groupBy("library", "length").pivot("nt5", list(bases)).agg(F.sum(value)).fillna(0.0, list(bases))


def diagnostics(per_alignment: DataFrame, candidates: DataFrame) -> DataFrame:
    """(library, ..): uncounted alignments by strand; shares without a candidate, and with candidates but no assignment."""
    rows = per_alignment.join(candidates, ROW, "left").where("hits = 0")
    none = F.col("candidates").isNull()
    return rows.groupBy("library").agg(
        F.sum(F.when(F.col("fwd"), 1).otherwise(0)).alias("uncounted_plus"), F.sum(F.when(F.col("fwd"), 0).otherwise(1)).alias("uncounted_minus"),
        F.sum(F.when(none, F.col("corr")).otherwise(0.0)).alias("no_feature"), F.sum(F.when(none, 0.0).otherwise(F.col("corr"))).alias("eliminated"),
    )


def chrom_misses(alignments: DataFrame, known: DataFrame) -> DataFrame:
    """(library, chrom, n): alignments on chromosomes that no annotation row has."""
    return alignments.join(F.broadcast(known.select("chrom").distinct()), "chrom", "left_anti").groupBy("library", "chrom").agg(F.count("*").alias("n"))


def alignment_table(per_alignment: DataFrame, assigned: DataFrame) -> DataFrame:
    """The per-alignment report: 1-based closed coordinates, sequences as read, features as text."""
    from ..functions.seq import reverse_complement

    pairs = assigned.groupBy(*ROW).agg(F.array_join(F.transform(F.array_sort(F.collect_set(F.struct(*PAIR))), lambda p: F.concat(F.lit("("), p["feature_id"], F.lit(", "), p["classifier"], F.lit(")"))), "; ").alias("feature_hits"))
    return per_alignment.join(pairs, ROW, "left").select(
        *ROW, F.when(F.col("fwd"), F.col("seq")).otherwise(reverse_complement(F.col("seq"))).alias("sequence"), "read_count", "corr", "loci", "chrom",
        (F.col("s") + 1).alias("start"), F.col("e").alias("end"), F.when(F.col("fwd"), "+").otherwise("-").alias("strand"), "nm", "hits", F.coalesce("feature_hits", F.lit("")).alias("feature_hits"),
    )


def stats_check(counts: DataFrame, rules: DataFrame, summary: DataFrame) -> DataFrame:
    """(library, feature_sum, rule_sum, assigned_reads, agree): the three totals, within a tolerance of 1."""
    f = counts.groupBy("library").agg(F.sum("count").alias("feature_sum"))
    r = rules.groupBy("library").agg(F.sum("count").alias("rule_sum"))
    joined = summary.select("library", "assigned_reads").join(f, "library", "left").join(r, "library", "left").fillna(0.0)
    agree = (F.abs(F.col("feature_sum") - F.col("assigned_reads")) < 1) & (F.abs(F.col("rule_sum") - F.col("assigned_reads")) < 1)
    return joined.withColumn("agree", agree)


def class_check(counts: DataFrame, rule_counts: DataFrame, rules: DataFrame) -> DataFrame:
    """(library, classifier, feature_sum, rule_sum, agree): the totals of each classifier by features and by its rules."""
    f = counts.groupBy("library", "classifier").agg(F.sum("count").alias("feature_sum"))
    r = rule_counts.join(F.broadcast(rules.select("rule_idx", "classifier")), "rule_idx").groupBy("library", "classifier").agg(F.sum("count").alias("rule_sum"))
    joined = r.join(f, ["library", "classifier"], "full").fillna(0.0, ["feature_sum", "rule_sum"])
    return joined.withColumn("agree", F.abs(F.col("feature_sum") - F.col("rule_sum")) < 1)


def normalized(counts: DataFrame, libraries: DataFrame, mapped: DataFrame) -> DataFrame:
    """Counts by each library's ``norm``: null, blank or 1 unchanged; a number divides; ``rpm`` divides by million mapped reads."""
    text = F.lower(F.trim(F.coalesce("norm", F.lit(""))))
    number = text.try_cast("double")
    factor = F.when(text.isin("", "1"), 1.0).when(text == "rpm", F.col("mapped_reads") / 1e6).when(number.isNotNull(), number).otherwise(F.raise_error(F.concat(F.lit("not a normalization: "), "norm")).cast("double"))
    factors = libraries.select("library", "norm").distinct().join(mapped.select("library", "mapped_reads"), "library", "left").select("library", factor.alias("factor"))
    return counts.join(F.broadcast(factors), "library").withColumn("count", F.col("count") / F.col("factor")).drop("factor")


