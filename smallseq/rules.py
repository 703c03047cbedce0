"""Selection rules: parsing a sheet's text into typed rules, on the driver (a sheet has tens of rows)."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Words that match everything; overlap kinds and the name that is another's alias.
WILDCARDS = {"any", "all", "both", "*", ""}
OVERLAPS = {"partial", "nested", "exact", "anchored", "5' anchored", "3' anchored"}
OVERLAP_ALIASES = {"full": "nested"}
NUCLEOTIDES = {"A", "T", "G", "C", "N"}

SCHEMA = T.StructType([
    T.StructField("rule_idx", T.IntegerType(), False),
    T.StructField("key", T.StringType()),
    T.StructField("val", T.StringType()),
    T.StructField("classifier", T.StringType()),
    T.StructField("sources", T.ArrayType(T.StringType())),
    T.StructField("types", T.ArrayType(T.StringType())),
    T.StructField("hierarchy", T.IntegerType(), False),
    T.StructField("overlap", T.StringType(), False),
    T.StructField("wild_overlap", T.BooleanType(), False),
    T.StructField("shift5", T.IntegerType(), False),
    T.StructField("shift3", T.IntegerType(), False),
    T.StructField("sense", T.BooleanType()),
    T.StructField("nts", T.ArrayType(T.StringType())),
    T.StructField("lengths", T.ArrayType(T.IntegerType())),
    T.StructField("mismatches", T.ArrayType(T.IntegerType())),
])


def is_wild(text: str | None) -> bool:
    return text is None or str(text).lower().strip() in WILDCARDS


def parse_numbers(text: str | None) -> list[int] | None:
    """'19, 21-23' -> [19, 21, 22, 23]; a wildcard -> None."""
    if is_wild(text):
        return None
    if not re.fullmatch(r"\s*\d+(\s*-\s*\d+)?(\s*,\s*\d+(\s*-\s*\d+)?)*\s*", text):
        raise ValueError(f"not a list of numbers and ranges: {text!r}")
    out: set[int] = set()
    for part in text.split(","):
        first, _, last = (x.strip() for x in part.partition("-"))
        out.update(range(int(first), int(last or first) + 1))
    return sorted(out)


def parse_nts(text: str | None) -> list[str] | None:
    if is_wild(text):
        return None
    found = [x.strip().upper().replace("U", "T") for x in text.split(",")]
    if not all(x in NUCLEOTIDES for x in found):
        raise ValueError(f"not a list of nucleotides: {text!r}")
    return sorted(set(found))


def parse_strand(text: str | None) -> bool | None:
    if is_wild(text):
        return None
    if (word := text.lower().strip()) not in ("sense", "antisense"):
        raise ValueError(f"not a strand: {text!r}")
    return word == "sense"


def parse_filter(text: str | None) -> list[str] | None:
    """Lower-case list of a column filter; empty parts are dropped, a wildcard is None."""
    if is_wild(text):
        return None
    return [x for x in (part.strip().lower() for part in text.split(",")) if x] or None


def parse_overlap(text: str | None) -> tuple[str, bool, int, int]:
    """(kind, wildcard, shift5, shift3); a wildcard ignores whatever shift follows it."""
    kind, _, shift = (text or "").lower().strip().partition(",")
    if is_wild(kind):
        return "partial", True, 0, 0
    kind = OVERLAP_ALIASES.get(kind.strip(), kind.strip())
    if kind not in OVERLAPS:
        raise ValueError(f"not an overlap selector: {text!r}")
    if not shift.strip():
        return kind, False, 0, 0
    parts = shift.replace(" ", "").split(",")
    if len(parts) != 2 or not all(re.fullmatch(r"-?\d+", p) for p in parts):
        raise ValueError(f"not a pair of shifts: {text!r}")
    return kind, False, int(parts[0]), int(parts[1])


@dataclass(frozen=True)
class Rule:
    """One row of a rule sheet, as text; '' matches everything."""

    key: str = ""
    val: str = ""
    classifier: str = ""
    source: str = ""
    type: str = ""
    hierarchy: int = 0
    overlap: str = "partial"
    mismatch: str = ""
    strand: str = ""
    nt5: str = ""
    length: str = ""

    def typed(self, index: int) -> tuple:
        kind, wild, five, three = parse_overlap(self.overlap)
        part = lambda x: None if is_wild(x) else x.lower()
        return (index, part(self.key), part(self.val), self.classifier, parse_filter(self.source), parse_filter(self.type), int(self.hierarchy),
                kind, wild, five, three, parse_strand(self.strand), parse_nts(self.nt5), parse_numbers(self.length), parse_numbers(self.mismatch))

    def describe(self) -> str:
        shown = {"Select for": self.key, "with value": self.val, "Classify as": self.classifier, "Source Filter": self.source, "Type Filter": self.type,
                 "Hierarchy": self.hierarchy, "Strand": self.strand, "5' End Nucleotide": self.nt5, "Length": self.length, "Overlap": self.overlap, "Mismatches": self.mismatch}
        return "; ".join(f"{k}: {v}" for k, v in shown.items())


def unique_rules(rules: list[Rule]) -> list[tuple[int, Rule]]:
    """Rules that differ in more than their hierarchy, the first of each, with their row in the sheet."""
    seen: set[tuple] = set()
    out = []
    for i, rule in enumerate(rules):
        selectors = rule.typed(0)
        same = repr(selectors[:6] + selectors[7:])
        if same not in seen:
            seen.add(same)
            out.append((i, rule))
    return out


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    return spark.createDataFrame([r.typed(i) for i, r in unique_rules(rules)], SCHEMA)
