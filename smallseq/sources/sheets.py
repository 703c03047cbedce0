"""Rule and sample sheets, configuration files, filter reports and earlier results. Sheets are read on the driver."""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..rules import Rule

#: The sheets' headers and the names of their fields here.
FEATURES = {
    "select for...": "key", "with value...": "val", "classify as...": "classifier", "source filter": "source", "type filter": "type", "hierarchy": "hierarchy",
    "strand": "strand", "5' end nucleotide": "nt5", "length": "length", "overlap": "overlap", "mismatches": "mismatch",
}
SAMPLES = {"input files": "file", "sample/group name": "group", "replicate number": "replicate", "control": "control", "normalization": "norm"}
EXTENSIONS = {".fastq", ".fq", ".gz", ".sam", ".bam", ".fa", ".fasta"}


def read_sheet(path: str | Path, headers: dict[str, str]) -> list[dict[str, str]]:
    """Rows of a sheet with just these headers, in any order and case; blank rows are left out.

    The delimiter is told from the header; a byte-order mark and a spreadsheet's one-character ellipsis are put right.
    """
    text = Path(path).read_text(encoding="utf-8-sig").replace("…", "...")
    lines = text.splitlines()
    if not lines:
        raise ValueError(f"{path}: empty sheet")
    delimiter = max(",\t;|", key=lambda d: len(next(csv.reader([lines[0]], delimiter=d))))
    rows = [r for r in csv.reader(lines, delimiter=delimiter, skipinitialspace=True) if any(x.strip() for x in r)]
    names = [x.strip().lower() for x in rows[0]]
    if missing := [h for h in headers if h not in names]:
        raise ValueError(f"{path}: missing columns: {', '.join(missing)}")
    if unknown := [h for h in names if h not in headers]:
        raise ValueError(f"{path}: unknown columns: {', '.join(unknown)}")
    out = []
    for i, row in enumerate(rows[1:], 2):
        if len(row) != len(names):
            raise ValueError(f"{path}: row {i} has {len(row)} fields, not {len(names)}")
        out.append({headers[n]: v.strip() for n, v in zip(names, row, strict=True)})
    return out


def read_rules(path: str | Path) -> list[Rule]:
    return [Rule(**row | {"hierarchy": int(row["hierarchy"]), "nt5": row["nt5"].upper().replace("U", "T") if row["nt5"] else "", "overlap": row["overlap"].lower()}) for row in read_sheet(path, FEATURES)]


@dataclass(frozen=True)
class Sample:
    file: str
    group: str
    replicate: str
    control: bool = False
    norm: str = ""

    @property
    def library(self) -> str:
        return f"{self.group}_rep_{self.replicate}"


def read_samples(path: str | Path) -> list[Sample]:
    """Samples of a sheet, files relative to it; rows that repeat one whole are read once."""
    base = Path(path).resolve().parent
    found = [Sample(str(base / r["file"]), r["group"], r["replicate"], r["control"].lower() in ("t", "true", "1", "yes"), r["norm"]) for r in read_sheet(path, SAMPLES)]
    return unique_samples(found)


def unique_samples(samples: list[Sample]) -> list[Sample]:
    """The first of samples that agree in everything."""
    return list(dict.fromkeys(samples))


def check_samples(samples: list[Sample], files: bool = True) -> None:
    """Raises for what would spoil a run: files, repeated samples, several controls, normalisations, names that clash."""
    if not samples:
        raise ValueError("the sample sheet has no samples")
    for s in samples:
        if not s.file or not s.group or not s.replicate:
            raise ValueError(f"incomplete sample: {s}")
        if files and not Path(s.file).is_file():
            raise ValueError(f"no such file: {s.file}")
        if Path(s.file).suffix.lower() not in EXTENSIONS:
            raise ValueError(f"unknown file type: {s.file}")
        if not re.fullmatch(r"\s*(rpm|\d+|\d+\.\d+|)\s*", s.norm, re.I):
            raise ValueError(f"not a normalization: {s.norm!r}")
    for what, keys in (("file", [s.file for s in samples]), ("sample", [s.library for s in samples])):
        if len(set(keys)) < len(keys):
            raise ValueError(f"a {what} occurs twice")
    if len({s.group for s in samples if s.control}) > 1:
        raise ValueError("there can be one control group at most")
    safe = {re.sub(r"[^A-Za-z0-9._]", ".", g) for g in {s.group for s in samples}}
    if len(safe) < len({s.group for s in samples}):
        raise ValueError("group names differ only in characters that result names cannot hold")


def enough_replicates(samples: list[Sample]) -> bool:
    """Whether the model has a degree of freedom: more samples than groups, and two groups."""
    groups = {s.group for s in samples}
    return len(groups) > 1 and len(samples) - len(groups) >= 1


def library_table(spark: SparkSession, samples: list[Sample]) -> DataFrame:
    return spark.createDataFrame([(s.library, s.group, s.replicate, s.file, s.control, s.norm) for s in samples], "library string, grp string, replicate string, file string, is_control boolean, norm string")


def read_config(path: str | Path) -> dict:
    """A YAML configuration. Without a YAML library: keys, scalars, lists of scalars and of one-level maps."""
    text = Path(path).read_text(encoding="utf-8")
    try:
        import yaml
    except ImportError:
        return _plain_yaml(text)
    return yaml.safe_load(text) or {}


def _scalar(text: str):
    text = re.sub(r"(^|\s)#.*$", "", text).strip()
    if text[:1] in "\"'" and text[-1:] == text[:1] and len(text) > 1:
        return text[1:-1]
    if text in ("", "~", "null"):
        return None
    if text.lower() in ("true", "false", "yes", "no"):
        return text.lower() in ("true", "yes")
    if text.startswith("[") and text.endswith("]"):
        return [_scalar(x) for x in text[1:-1].split(",") if x.strip()]
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    return text


def _plain_yaml(text: str) -> dict:
    out: dict = {}
    key, item = None, None
    for line in text.splitlines():
        bare = re.sub(r"(^|\s)#.*$", "", line).rstrip()
        if not bare.strip():
            continue
        body, indent = bare.strip(), len(bare) - len(bare.lstrip())
        if body.startswith("- ") or body == "-":
            rest = body[1:].strip()
            if not isinstance(out.get(key), list):
                out[key] = []
            if m := re.match(r"([\w.\- ]+):(?:\s+(.*)|$)", rest):
                item = {m[1].strip(): _scalar(m[2] or "")}
                out[key].append(item)
            else:
                item = None
                out[key].append(_scalar(rest))
        elif m := re.match(r"([^:]+):(?:\s+(.*)|$)", body):
            if indent and item is not None:
                item[m[1].strip()] = _scalar(m[2] or "")
            elif indent and key is not None and not isinstance(out.get(key), list):
                out[key] = (out[key] or {}) | {m[1].strip(): _scalar(m[2] or "")}
            else:
                key, item = m[1].strip(), None
                out[key] = _scalar(m[2] or "")
    return out


def resolved(path: str, config_file: str | Path) -> str:
    """A path of a configuration, relative to the file that names it."""
    p = Path(path)
    return str(p if p.is_absolute() else (Path(config_file).resolve().parent / p))


def check_paths(config: dict, config_file: str | Path, required: tuple[str, ...] = ("samples_csv", "features_csv", "run_directory"), lists: tuple[str, ...] = ("gff_files", "genome_files")) -> None:
    """Raises for keys that a configuration lacks, and for files that it names and that are not there."""
    if missing := [k for k in required if not config.get(k)]:
        raise ValueError(f"{config_file}: missing: {', '.join(missing)}")
    named = [config[k] for k in required if k.endswith("_csv")]
    for key in lists:
        entries = config.get(key) or []
        if not isinstance(entries, list):
            raise ValueError(f"{config_file}: {key} has to be a list")
        named += [x["path"] if isinstance(x, dict) else x for x in entries]
    if gone := [x for x in named if x and not Path(resolved(x, config_file)).is_file()]:
        raise ValueError(f"{config_file}: no such file: {', '.join(gone)}")


@dataclass(frozen=True)
class Upgrade:
    """What a version changed in configurations: keys renamed, keys added with a value; ``blocked``: by hand only."""

    version: str
    rename: tuple[tuple[str, str], ...] = ()
    add: tuple[tuple[str, object], ...] = ()
    blocked: bool = False


def version_key(text: str | None) -> tuple[int, ...]:
    return tuple(int(x) for x in re.findall(r"\d+", text or "0"))


def upgraded(config: dict, upgrades: list[Upgrade]) -> dict:
    """A configuration brought to the newest version, keys in their place; raises if a step on the way is blocked."""
    steps = sorted((u for u in upgrades if version_key(u.version) > version_key(config.get("version"))), key=lambda u: version_key(u.version))
    if blocked := [u.version for u in steps if u.blocked]:
        raise ValueError(f"the configuration is too old to be upgraded: version {blocked[0]} has to be followed by hand")
    for u in steps:
        names = dict(u.rename)
        config = {names.get(k, k): v for k, v in config.items()}
        config = config | {k: v for k, v in u.add if k not in config} | {"version": u.version}
    return config


def filter_reports(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, total_reads, retained_reads) of read filters' JSON reports; a malformed one gives nulls."""
    schema = "summary struct<before_filtering struct<total_reads bigint>, after_filtering struct<total_reads bigint>>"
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.from_json("value", schema).alias("j"))
    return rows.select("file", F.col("j.summary.before_filtering.total_reads").alias("total_reads"), F.col("j.summary.after_filtering.total_reads").alias("retained_reads"))


def wide_to_long(df: DataFrame, keys: list[str], value: str = "count", name: str = "library") -> DataFrame:
    return df.unpivot(keys, [c for c in df.columns if c not in keys], name, value)


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """A feature-count report read again: (library, feature_id, classifier, count)."""
    df = spark.read.csv(path, header=True, inferSchema=False).drop("Feature Name")
    long = wide_to_long(df.withColumnsRenamed({"Feature ID": "feature_id", "Classifier": "classifier"}), ["feature_id", "classifier"])
    return long.withColumn("count", F.col("count").cast("double"))


def read_comparisons(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Comparison tables read again, each named by its file."""
    from ..functions.seq import comparison_name

    df = spark.read.csv(path, header=True)
    return df.select("*", comparison_name(F.col("_metadata.file_name")).alias("comparison"))
