"""Building the interval side: identity and column filters, lineage, sub-interval unions, feature matches.

Annotation rows: file, line_no, chrom, source, type, fs, fe, strand, feature_id, parent, attrs
(array<struct<key, key_lc, vals, vals_lc>>).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..durable import durable
from .intervals import merge_intervals, with_shift


def has_identity(attrs: Column, key: Column, val: Column) -> Column:
    """Whether the attributes hold the (key, value) pair, without case; a null key or value matches any."""
    return F.when(key.isNull() & val.isNull(), True).otherwise(
        F.exists(attrs, lambda a: (key.isNull() | (a["key_lc"] == key)) & (val.isNull() | F.array_contains(a["vals_lc"], val)))
    )


def passes_columns(source: Column, type_: Column) -> Column:
    """Both column filters pass, without case; a null filter passes all."""
    return (F.col("sources").isNull() | F.array_contains("sources", F.lower(source))) & (F.col("types").isNull() | F.array_contains("types", F.lower(type_)))


def stage_one(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Annotation rows with the rules that select them. The rules (a sheet) are broadcast."""
    rules = rules.withColumnsRenamed({"key": "rule_key", "val": "rule_val"})
    on = has_identity(F.col("attrs"), F.col("rule_key"), F.col("rule_val")) & passes_columns(F.col("source"), F.col("type"))
    return rows.join(F.broadcast(rules), on).drop("rule_key", "rule_val")


def without_chromosomes(rows: DataFrame) -> DataFrame:
    return rows.where(F.lower("type") != "chromosome")


def roots(parents: DataFrame, matched: DataFrame) -> DataFrame:
    """(child, parent) links and matched ids -> (feature_id, root): each id's highest matched ancestor, or itself.

    Pointer jumping: each round doubles the generations that an id has climbed and keeps the highest match seen, so depth d
    takes log2(d) joins, none with a collected side. A cycle never settles and raises.
    """
    hit = matched.select(F.col("feature_id").alias("m")).distinct()
    links = parents.where("parent is not null and parent <> child").select("child", "parent").distinct()
    nodes = links.select(F.col("child").alias("id")).union(links.select("parent")).union(hit).distinct()
    state = nodes.join(links, nodes["id"] == links["child"], "left").select("id", F.col("parent").alias("up"))
    state = state.join(hit, state["up"] == hit["m"], "left").select("id", "up", F.col("m").alias("best"))
    # up: the ancestor reached; best: the highest match among those passed, up included
    for _ in range(nodes.count().bit_length() + 1):  # enough for one chain of all ids
        above = state.select(F.col("id").alias("a"), F.col("up").alias("a_up"), F.col("best").alias("a_best"))
        state = state.join(above, state["up"] == above["a"], "left").select("id", F.col("a_up").alias("up"), F.coalesce("a_best", "best").alias("best"), F.col("up").isNotNull().alias("moving"))
        state = durable(state)
        if state.where("moving").isEmpty():
            return state.select(F.col("id").alias("feature_id"), F.coalesce("best", "id").alias("root"))
        state = state.drop("moving")
    raise ValueError("the parent links hold a cycle")


def feature_matches(selected: DataFrame, root_of: DataFrame | None = None) -> DataFrame:
    """Rows of ``stage_one`` -> the interval side of the assignment, shifted, one row for each sub-interval and rule.

    Sub-intervals of a root are merged where they overlap. record_id identifies equal records: feature, classifier, strand
    and the rules with their intervals, of which a rule with a wildcard overlap has none.
    """
    if root_of is not None:
        selected = selected.join(root_of, "feature_id", "left").withColumn("feature_id", F.coalesce("root", "feature_id")).drop("root")
    keys = ["feature_id", "chrom", "strand"]
    merged = merge_intervals(selected.select(*keys, "fs", "fe").distinct(), keys)
    rule = [c for c in ("classifier", "rule_idx", "hierarchy", "overlap", "wild_overlap", "shift5", "shift3", "sense", "nts", "lengths", "mismatches")]
    picked = selected.select("feature_id", *rule).distinct()
    return with_records(with_shift(merged.join(picked, "feature_id")))


def with_records(matches: DataFrame) -> DataFrame:
    """Adds record_id to shifted matches."""
    part = F.concat_ws(":", "rule_idx", F.when(F.col("wild_overlap"), F.lit("*")).otherwise(F.concat_ws("-", "fs", "fe")))
    by = ["feature_id", "classifier", "chrom", "strand", "fs", "fe"]
    rules = F.array_join(F.array_sort(F.collect_set(part).over(Window.partitionBy(*by))), ";")
    return matches.withColumn("record_id", F.xxhash64("feature_id", "classifier", F.coalesce(F.col("strand").cast("string"), F.lit(".")), rules))


def aliases(rows: DataFrame, keys: list[str], root_of: DataFrame | None = None) -> DataFrame:
    """(feature_id, feature_name): values of the alias attributes, merged to the root."""
    from ..functions.seq import joined_aliases

    wanted = [k.lower() for k in keys]
    found = rows.select("feature_id", F.explode("attrs").alias("a")).where(F.col("a.key_lc").isin(wanted)).select("feature_id", F.explode("a.vals").alias("alias"))
    if root_of is not None:
        found = found.join(root_of, "feature_id", "left").withColumn("feature_id", F.coalesce("root", "feature_id")).drop("root")
    return found.groupBy("feature_id").agg(joined_aliases(F.collect_set("alias")).alias("feature_name"))


def sequence_features(ref_seqs: DataFrame, rules: DataFrame) -> DataFrame:
    """(seq_id, seq_len) as features of both strands under every rule: the mode without annotations."""
    strands = F.explode(F.array(F.lit(True), F.lit(False)))
    rows = ref_seqs.select(F.col("seq_id").alias("feature_id"), F.col("seq_id").alias("chrom"), F.lit(0).cast("long").alias("fs"), F.col("seq_len").cast("long").alias("fe"), strands.alias("strand"))
    return with_records(with_shift(rows.crossJoin(F.broadcast(rules.drop("key", "val", "sources", "types")))))


def ambiguous_sequences(ref_seqs: DataFrame) -> DataFrame:
    """(seq_id, issue): repeated in a file, or of more than one length over all."""
    twice = ref_seqs.groupBy("file", "seq_id").count().where("count > 1").select("seq_id", F.lit("duplicate").alias("issue"))
    lengths = ref_seqs.groupBy("seq_id").agg(F.count_distinct("seq_len").alias("n")).where("n > 1").select("seq_id", F.lit("inconsistent length").alias("issue"))
    return twice.union(lengths).distinct()


def annotation_issues(rows: DataFrame) -> DataFrame:
    """(file, no_strand, no_id): annotation rows that lack a strand or an id."""
    count = lambda cond: F.sum(F.when(cond, 1).otherwise(0))
    return without_chromosomes(rows).groupBy("file").agg(count(F.col("strand").isNull()).alias("no_strand"), count(F.col("feature_id").isNull()).alias("no_id"))


def shared_chroms(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.select("chrom").intersect(right.select("chrom"))


def strandedness(pairs: DataFrame, sample: int | None = 20_000) -> DataFrame:
    """(same_strand, share) over a bounded sample of overlapping pairs: whether a library keeps its strand.

    A probe of a library's kind, not a count: ``sample`` bounds it on purpose; None takes all pairs.
    """
    rows = pairs.where("strand is not null").select((F.col("fwd") == F.col("strand")).alias("same_strand"))
    counted = (rows if sample is None else rows.limit(sample)).groupBy("same_strand").agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n").alias("total"))
    return counted.crossJoin(F.broadcast(total)).select("same_strand", (F.col("n") / F.col("total")).alias("share"))
