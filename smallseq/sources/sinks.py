"""Writers. Results go out through Spark's committer as folders; ``single`` brings a report into one file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fasta(collapsed: DataFrame, path: str, threshold: int = 0, compress: bool = False) -> None:
    """Collapsed sequences as FASTA, ``_lowcounts`` beside it if there is a threshold; refuses to overwrite.

    Ranges of ids keep the order without gathering a library in one task.
    """
    from ..operators.reads import by_threshold

    above, low = by_threshold(collapsed, threshold)
    for rows, out in [(above, path)] + ([(low, path + "_lowcounts")] if threshold > 0 else []):
        text = rows.repartitionByRange("seq_id").sortWithinPartitions("seq_id").select(F.concat(F.lit(">"), "seq_id", F.lit("_count="), "read_count", F.lit("\n"), "seq").alias("value"))
        text.write.mode("errorifexists").text(out, compression="gzip" if compress else None)


def decollapsed_alignments(raw: DataFrame, header: list[str], path: str) -> None:
    """Alignment text with each line as often as its read was seen (``fields`` of raw alignments), header first."""
    from ..operators.reads import decollapse

    body = decollapse(raw).select("row_key", "copy", F.array_join(F.concat(F.array("name"), F.slice("fields", F.lit(2), F.size("fields"))), "\t").alias("value"))
    head = raw.sparkSession.createDataFrame([(-1, i, h) for i, h in enumerate(header)], "row_key long, copy long, value string")
    head.unionByName(body).repartitionByRange("row_key", "copy").sortWithinPartitions("row_key", "copy").select("value").write.mode("errorifexists").text(path)


def report(df: DataFrame, path: str, order: list[str], single: bool = True, digits: int | None = 2, hidden: list[str] | None = None) -> None:
    """A CSV report: doubles rounded half to even, rows in order; ``hidden`` columns serve the order alone."""
    if digits is not None:
        df = df.withColumns({c: F.bround(c, digits) for c, kind in df.dtypes if kind == "double"})
    df = df.orderBy(*order) if order else df
    df = df.drop(*(hidden or []))
    (df.coalesce(1) if single else df).write.mode("errorifexists").csv(path, header=True)


def wide(df: DataFrame, keys: list[str], libraries: list[str], value: str = "count") -> DataFrame:
    """One column for each library, as the reports have them."""
    value = value if value in df.columns else "value"
    return df.groupBy(*keys).pivot("library", sorted(libraries)).agg(F.first(value)).fillna(0.0, sorted(libraries))


def alignment_tables(table: DataFrame, path: str) -> None:
    table.write.mode("errorifexists").partitionBy("library").csv(path, header=True)


def unaligned_fasta(reads: DataFrame, path: str) -> None:
    reads.select(F.concat(F.lit(">"), "seq_id", F.lit("\n"), "seq").alias("value")).write.mode("errorifexists").text(path)
