"""Column functions on sequences, flags, tags and names. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trimmed(seq: Column, five: int, three: int) -> Column:
    """``five`` bases off the front, ``three`` off the end; trimming too much leaves ''."""
    return F.substring(seq, F.lit(five + 1), F.greatest(F.length(seq) - (five + three), F.lit(0)))


def five_prime_base(seq: Column, forward: Column) -> Column:
    """First base of a forward read; of a reverse one the complement of the last. Only upper-case ACGT is complemented."""
    return F.when(forward, F.substring(seq, 1, 1)).otherwise(F.translate(F.substring(seq, -1, 1), "ACGT", "TGCA"))


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def on_forward_strand(flag: Column) -> Column:
    return flag.bitwiseAND(16) == 0


def is_mapped(flag: Column) -> Column:
    return flag.bitwiseAND(4) == 0


def strand_of(symbol: Column) -> Column:
    """'+' true, '-' false, anything else null (unstranded)."""
    return F.when(symbol == "+", True).when(symbol == "-", False)


def cigar_edits(cigar: Column) -> Column:
    """Inserted, deleted and substituted bases (I, D, X)."""
    lengths = F.transform(F.regexp_extract_all(cigar, F.lit(r"(\d+)[IDX]"), F.lit(1)), lambda x: x.cast("int"))
    return F.coalesce(F.aggregate(lengths, F.lit(0), lambda a, b: a + b), F.lit(0))


def tag_edits(tags: Column) -> Column:
    """The NM tag's value of an array of tags; 0 where it is missing."""
    return F.coalesce(F.regexp_extract(F.array_join(tags, "\t"), r"(?:^|\t)NM:i:(\d+)", 1).try_cast("int"), F.lit(0))


def collapsed_count(name: Column, kind: str | None) -> Column:
    """Reads behind a collapsed read's name: the integer after its last '=' or '_x'; 1 for names that are not collapsed."""
    if kind is None:
        return F.lit(1).cast("long")
    return F.regexp_extract(name, "=([0-9]+)$" if kind == "=" else "_x([0-9]+)$", 1).try_cast("long")


def group_of(library: Column) -> Column:
    return F.split(library, "_rep_")[0]


def library_name(group: Column, replicate: Column) -> Column:
    return F.concat(group, F.lit("_rep_"), replicate.cast("string"))


def base_name(path: Column) -> Column:
    """A library file's name without folder, extension and the aligner's suffix."""
    stem = F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")
    return F.regexp_replace(stem, "_aligned_seqs$", "")


def r_safe(name: Column) -> Column:
    """A name as R would make it: a letter or a dot first, other characters than letters, digits, '.' and '_' to dots."""
    clean = F.regexp_replace(name, r"[^A-Za-z0-9._]", ".")
    return F.when(clean.rlike(r"^(?:[0-9_]|\.[0-9])|^$"), F.concat(F.lit("X"), clean)).otherwise(clean)


def natural_key(name: Column) -> Column:
    """Sorts like the name with its numbers read as numbers, letters without case."""
    return F.regexp_replace(F.regexp_replace(F.lower(name), r"(\d+)", r"000000000000000000$1"), r"0*(\d{18})(?!\d)", "$1")


def comparison_name(file_name: Column) -> Column:
    """``a_vs_b`` of a comparison table's file name."""
    pattern = r"_cond1_(.*?)_cond2_(.*?)_deseq_table\.csv"
    return F.concat(F.regexp_extract(file_name, pattern, 1), F.lit("_vs_"), F.regexp_extract(file_name, pattern, 2))


def joined_aliases(aliases: Column) -> Column:
    """Distinct aliases sorted without case, joined by ', '."""
    order = lambda a, b: F.when(F.lower(a) < F.lower(b), -1).when(F.lower(a) > F.lower(b), 1).when(a < b, -1).when(a > b, 1).otherwise(0)
    return F.array_join(F.array_sort(F.array_distinct(aliases), order), ", ")
