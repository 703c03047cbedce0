"""Checks of inputs, as reports; what must stop a run raises."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import reference

#: Aligners whose output keeps a read's alignments together.
ORDERED_BY = {"bowtie", "bowtie2", "star"}


def check_annotation(rows: DataFrame) -> DataFrame:
    """(file, no_strand, no_id) where something is missing; rows without an id raise."""
    issues = reference.annotation_issues(rows).where("no_strand > 0 or no_id > 0")
    bad = issues.where("no_id > 0").head()
    if bad is not None:
        raise ValueError(f"{bad['file']}: {bad['no_id']} rows without an id")
    return issues


def check_chroms(annotation: DataFrame, alignments: DataFrame, genome: DataFrame | None = None, sample: int = 50_000) -> str | None:
    """None if chromosomes are shared; with genome sequences none shared raises, by alignments it is a warning's text.

    Alignments are probed with a bounded number of rows, as the question is only whether names can match at all.
    """
    if genome is not None:
        if reference.shared_chroms(annotation, genome).isEmpty():
            raise ValueError("annotation and genome share no chromosome")
        return None
    if reference.shared_chroms(annotation, alignments.limit(sample)).isEmpty():
        return "annotation and alignments may share no chromosome"
    return None


def check_sequences(ref_seqs: DataFrame) -> None:
    """Raises for missing or incomplete reference headers, then for repeated or inconsistent ones."""
    if ref_seqs.isEmpty():
        raise ValueError("no reference sequences in the headers")
    if not ref_seqs.where("seq_id is null or seq_len is null").isEmpty():
        raise ValueError("incomplete reference headers")
    issues = reference.ambiguous_sequences(ref_seqs).orderBy("seq_id").limit(20).collect()
    if issues:
        raise ValueError("; ".join(f"{r['seq_id']}: {r['issue']}" for r in issues))


def order_by_file(header: DataFrame) -> DataFrame:
    """(file, together): whether a header tells that a read's alignments are adjacent; null if it does not say.

    Sorted or grouped by name: yes; by coordinate: no; otherwise by the last program's aligner.
    """
    tag = lambda record, key: F.max_by(F.when(F.col("record") == record, F.col("tags")[key]), F.when(F.col("record") == record, F.col("line_no") if "line_no" in header.columns else F.lit(0)))
    rows = header.groupBy("file").agg(tag("HD", "SO").alias("so"), tag("HD", "GO").alias("go"), tag("PG", "ID").alias("program"))
    known = F.when((F.col("so") == "queryname") | (F.col("go") == "query"), True).when((F.col("so") == "coordinate") | (F.col("go") == "reference"), False)
    return rows.select("file", known.when(F.lower("program").isin(*sorted(ORDERED_BY)), True).alias("together"))


def check_order(header: DataFrame) -> None:
    """Raises if a header says that a read's alignments are not adjacent. Grouping by name does not need them to be."""
    bad = order_by_file(header).where("not coalesce(together, false)").orderBy(F.asc_nulls_last("together")).head()
    if bad is not None:
        raise ValueError("the order of alignments cannot be told" if bad["together"] is None else "alignments are sorted by coordinate")


def check_features(matches: DataFrame) -> None:
    if matches.isEmpty():
        raise ValueError("no feature is selected by the rules")


def check_totals(check: DataFrame) -> list[str]:
    """Libraries whose totals disagree (see ``counts.stats_check``); never stops a run."""
    return [r["library"] for r in check.where(~F.col("agree")).select("library").collect()]
