"""From sheets and files to reports: count, collapse, compare, plot data; and the command line."""

from __future__ import annotations

import argparse
import shutil
import time
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .durable import durable
from .operators import counts as C
from .operators import dge, plotdata, reads, reference, select, validate
from .report import Report
from .rules import Rule, rule_table
from .sources import bam, sheets, sinks, textual


@dataclass(frozen=True)
class CountOptions:
    normalize_by_genomic_hits: bool = True
    normalize_by_feature_hits: bool = True
    all_features: bool = False
    verify_stats: bool = True
    report_diags: bool = False
    decollapse: bool = False
    aliases: tuple[str, ...] = ("Alias",)


@dataclass
class Counted:
    """Results of a count run: tables in long form, with a library column."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    warnings: list[str] = field(default_factory=list)


def load_alignments(spark: SparkSession, samples: list[sheets.Sample]) -> DataFrame:
    """All libraries in one table; rows are keyed by library and position in the file."""
    out = None
    for s in samples:
        one = bam.alignments(spark, s.file, s.library) if s.file.endswith(".bam") else textual.alignments(spark, s.file, s.library)
        out = one if out is None else out.unionByName(one)
    return out


def annotated_matches(spark: SparkSession, paths: list[str], rules: list[Rule], options: CountOptions) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(matches, aliases, known chromosomes) of annotation files under the rules."""
    rows = textual.annotation(spark, paths)
    known = rows.select("chrom").distinct()
    used = reference.without_chromosomes(rows)
    selected = reference.stage_one(used, rule_table(spark, rules))
    root_of = reference.roots(used.select(F.col("feature_id").alias("child"), "parent"), selected.select("feature_id"))
    return reference.feature_matches(selected, root_of), reference.aliases(used, list(options.aliases), root_of), known


def count_tables(alignments: DataFrame, matches: DataFrame, rules: DataFrame, libraries: DataFrame, options: CountOptions = CountOptions(), aliases: DataFrame | None = None, known: DataFrame | None = None) -> Counted:
    """Every report of the count step. libraries: library, norm."""
    assigned = durable(select.assign(alignments, matches, options.normalize_by_genomic_hits, options.normalize_by_feature_hits))
    per_alignment = C.by_alignment(select.with_loci(alignments, options.normalize_by_genomic_hits), assigned)
    by_read = durable(C.by_read(per_alignment))
    summary = C.summary_stats(by_read)
    counts = C.zero_filled(C.feature_counts(assigned), matches, libraries)
    out = Counted()
    out.tables = {
        "feature_counts": C.with_aliases(counts, aliases) if aliases is not None else counts,
        "counts_by_rule": C.rule_counts(assigned, rules, libraries),
        "alignment_stats": C.alignment_stats(by_read),
        "summary_stats": summary,
        "mapped_nt_len_dist": C.nt_length(by_read, False),
        "assigned_nt_len_dist": C.nt_length(by_read, True),
    }
    if not libraries.where("trim(coalesce(norm, '')) not in ('', '1')").isEmpty():
        out.tables["norm_counts"] = C.normalized(counts, libraries, summary)
    if options.verify_stats:
        check = C.stats_check(C.feature_counts(assigned), out.tables["counts_by_rule"], summary)
        if options.normalize_by_feature_hits and (bad := validate.check_totals(check)):
            out.tables["stats_check"] = check
            out.warnings.append(f"totals disagree: {', '.join(bad)}")
    if options.report_diags:
        out.tables["alignment_table"] = C.alignment_table(per_alignment, assigned)
        out.tables["assignment_diags"] = C.diagnostics(per_alignment, select.candidate_counts(alignments, matches))
        if known is not None:
            out.tables["chrom_misses"] = C.chrom_misses(alignments, known)
    return out


def count(spark: SparkSession, samples: list[sheets.Sample], rules: list[Rule], annotation: list[str], options: CountOptions = CountOptions(), alignments: DataFrame | None = None, genome: list[str] | None = None) -> Counted:
    """Counts alignments by annotation, or by the reference sequences of their headers if there is none.

    ``alignments``: those of reads aligned here; otherwise the samples' files are read, and their headers' order is checked.
    """
    from_files = alignments is None
    alignments = load_alignments(spark, samples) if from_files else alignments
    libraries = sheets.library_table(spark, samples)
    warnings: list[str] = []
    text = [s.file for s in samples if not s.file.endswith(".bam")]
    if from_files and text:
        order = validate.order_by_file(textual.alignment_header(spark, text)).where("not coalesce(together, false)")
        warnings += [f"{r['file']}: " + ("the order of alignments cannot be told" if r["together"] is None else "sorted by coordinate") + "; reads are grouped by name" for r in order.orderBy("file").collect()]  # one row a file
    names = known = None
    if annotation:
        rows = textual.annotation(spark, annotation)
        validate.check_annotation(rows)
        chroms = textual.genome_chroms(spark, genome) if genome else None
        if note := validate.check_chroms(rows, alignments, chroms):
            warnings.append(note)
        matches, names, known = annotated_matches(spark, annotation, rules, options)
        matches = durable(matches)
    else:
        seqs = textual.reference_sequences(textual.alignment_header(spark, [s.file for s in samples]))
        validate.check_sequences(seqs)
        matches = reference.sequence_features(seqs.select("seq_id", "seq_len").distinct(), rule_table(spark, rules))
    if not options.all_features:
        validate.check_features(matches)
    out = count_tables(alignments, matches, rule_table(spark, rules), libraries, options, names, known)
    out.warnings = warnings + out.warnings
    return out


def timestamp() -> str:
    # fixed value: the format of run names
    return time.strftime("%Y-%m-%d_%H-%M-%S")


def wide_reports(tables: dict[str, DataFrame], rules: list[Rule] | None = None) -> dict[str, tuple[DataFrame, list[str]]]:
    """The reports with a column for each library, and what they are ordered by. Labels are fixed values of the reports."""
    out: dict[str, tuple[DataFrame, list[str]]] = {}
    libraries = sorted(r[0] for r in tables["feature_counts"].select("library").distinct().collect())
    names = {"feature_id": "Feature ID", "classifier": "Classifier", "feature_name": "Feature Name"}
    for table in ("feature_counts", "norm_counts"):
        if table in tables:
            keys = [k for k in names if k in tables[table].columns]
            out[table] = (sinks.wide(tables[table], keys, libraries).withColumnsRenamed(names), [names[k] for k in keys])
    if "counts_by_rule" in tables:
        report = sinks.wide(C.with_mapped_row(tables["counts_by_rule"], tables["summary_stats"]), ["rule"], libraries)
        if rules is not None:
            text = tables["counts_by_rule"].sparkSession.createDataFrame([(str(i), r.describe()) for i, r in enumerate(rules)], "rule string, text string")
            report = report.join(F.broadcast(text), "rule", "left").select(F.col("rule").alias("Rule Index"), F.coalesce("text", F.lit("")).alias("Rule String"), *[F.col(f"`{x}`") for x in libraries])
        else:
            report = report.withColumnRenamed("rule", "Rule Index")
        out["counts_by_rule"] = (report.withColumn("o", F.coalesce(F.col("Rule Index").try_cast("int"), F.lit(1 << 30))), ["o"])
    if "summary_stats" in tables:
        out["summary_stats"] = (sinks.wide(tables["summary_report"] if "summary_report" in tables else C.summary_report(tables["summary_stats"]), ["stat"], libraries).withColumnRenamed("stat", "Summary Statistics"), ["Summary Statistics"])
    if "alignment_stats" in tables:
        out["alignment_stats"] = (sinks.wide(tables["alignment_stats"], ["stat"], libraries, "value").withColumnRenamed("stat", "Alignment Statistics"), ["Alignment Statistics"])
    return out


def write_tables(result: Counted, folder: str, rules: list[Rule] | None = None) -> None:
    """Long tables as Parquet (for later steps), and CSV reports beside them."""
    again = {}
    for name, df in result.tables.items():
        df.write.mode("errorifexists").parquet(f"{folder}/tables/{name}")
        again[name] = df.sparkSession.read.schema(df.schema).parquet(f"{folder}/tables/{name}")
    wide = wide_reports(again, rules) if "summary_stats" in again and "feature_counts" in again else {}
    for name, df in again.items():
        if name == "alignment_table":
            sinks.alignment_tables(df, f"{folder}/{name}")
        elif name in wide:
            report, order = wide[name]
            sinks.report(report, f"{folder}/{name}", order, hidden=[c for c in order if c == "o"])
        elif name != "summary_report":
            sinks.report(df, f"{folder}/{name}", df.columns[:2])


def step_folder(folder: str, step: str, fresh: bool) -> str:
    """Where a step writes: the run's own folder, or a stamped one beside it when a run is taken up again."""
    return f"{folder}/{step}_{timestamp()}" if fresh else f"{folder}/{step}"


def latest(folder: str, step: str) -> str:
    """The newest folder of a step that has tables."""
    found = sorted((p for p in Path(folder).glob(f"{step}*") if (p / "tables").is_dir()), key=lambda p: (p.name != step, p.name))
    if not found:
        raise ValueError(f"{folder} has no results of the step {step}")
    return str(found[-1])


def aligned_reads(spark: SparkSession, samples: list[sheets.Sample], genome: list[str], config: dict, folder: str) -> tuple[DataFrame, DataFrame]:
    """Raw reads filtered, collapsed (written as FASTA) and aligned: (alignments, the summary's rows for each library).

    Keys of the configuration are the operators' parameters, with the prefixes ``filter_`` and ``align_``.
    """
    given = lambda prefix: {k.removeprefix(prefix): v for k, v in config.items() if k.startswith(prefix)}
    chroms = durable(textual.fasta(spark, genome).select(F.col("name").alias("chrom"), F.upper("seq").alias("seq")))
    out = stats = None
    for s in samples:
        raw = textual.fastq(spark, s.file)
        kept = durable(reads.quality_filter(raw, **given("filter_")))
        collapsed = durable(reads.collapse(kept.withColumn("library", F.lit(s.library))))
        sinks.fasta(collapsed, f"{folder}/collapse/{s.library}", int(config.get("threshold") or 0))
        found = reads.as_alignments(reads.align(collapsed, chroms, **given("align_")), collapsed)
        counted = reads.filter_report(raw, kept).crossJoin(collapsed.agg(F.count("*").alias("unique")))
        counted = counted.select(F.lit(s.library).alias("library"), F.col("before").alias("total_reads"), F.col("after").alias("retained_reads"), "unique")
        out, stats = (found, counted) if out is None else (out.unionByName(found), stats.unionByName(counted))
    return durable(out), durable(stats)


def compare(counts: DataFrame, samples: list[sheets.Sample], control: str | None = None, drop_zero: bool = False) -> dict[str, DataFrame]:
    """Normalised counts and comparison tables of integer counts."""
    spark = counts.sparkSession
    counts = dge.integer_counts(counts.select("library", "feature_id", "classifier", "count"))
    if drop_zero:
        counts = dge.without_zero_genes(counts)
    normalized = durable(dge.normalized_counts(counts, dge.size_factors(counts)))
    order = list(dict.fromkeys(s.group for s in samples))
    if control is not None and control not in order:
        raise ValueError(f"no such control group: {control}")
    groups = spark.createDataFrame([(g, i, g == control) for i, g in enumerate(order)], "grp string, ord int, is_control boolean")
    comparisons = dge.control_comparisons(groups) if control else dge.all_comparisons(groups, flipped=False)
    results = dge.wald_tests(normalized, sheets.library_table(spark, samples), comparisons)
    if control is None:
        results = results.unionByName(dge.flipped(results))
    return {"norm_counts": normalized, "comparisons": results, "pca": dge.principal_components(normalized)}


@dataclass(frozen=True)
class PlotOptions:
    """What is drawn: significance, the lengths' axis, classes with or without, and what the unassigned rest is called."""

    p_value: float = 0.05
    len_dist_min: int | None = None
    len_dist_max: int | None = None
    classes_include: tuple[str, ...] = ()
    classes_exclude: tuple[str, ...] = ()
    unassigned_class: str = "_UNASSIGNED_"
    unknown_class: str = "_UNKNOWN_"
    plots: tuple[str, ...] = ("len_dist", "class_charts", "rule_charts", "replicate_scatter", "sample_avg_scatter_by_dge")


def plot_tables(tables: dict[str, DataFrame], options: PlotOptions = PlotOptions()) -> dict[str, DataFrame]:
    """The data of every wanted plot that the given tables allow."""
    out = {}
    mapped, want = tables.get("summary_stats"), set(options.plots)
    axis = {"shortest": options.len_dist_min, "longest": options.len_dist_max}
    for kind in ("mapped", "assigned"):
        if "len_dist" in want and f"{kind}_nt_len_dist" in tables:
            out[f"len_dist_{kind}"] = plotdata.length_proportions(tables[f"{kind}_nt_len_dist"], **axis)
    if "class_charts" in want and mapped is not None and "feature_counts" in tables:
        named = tables["feature_counts"].withColumn("classifier", F.when(F.trim("classifier") == "", options.unknown_class).otherwise(F.col("classifier")))
        out["class_charts"] = plotdata.proportions(plotdata.class_counts(named), mapped, "classifier", unassigned=options.unassigned_class)
    if "rule_charts" in want and mapped is not None and "counts_by_rule" in tables:
        out["rule_charts"] = plotdata.proportions(tables["counts_by_rule"], mapped, "rule_idx", unassigned="N")
    if "norm_counts" not in tables:
        return out
    chosen = plotdata.class_filter(tables["norm_counts"], list(options.classes_include), list(options.classes_exclude))
    averages = out["sample_averages"] = plotdata.sample_averages(chosen)
    libraries = chosen.select("library").distinct()
    if "replicate_scatter" in want:
        pairs = dge.replicate_pairs(libraries.select(F.split("library", "_rep_")[0].alias("grp"), F.split("library", "_rep_")[1].alias("replicate")))
        out["replicate_scatter"] = plotdata.replicate_points(chosen, pairs)
    if "sample_avg_scatter_by_dge" in want and "comparisons" in tables:
        results = tables["comparisons"]
        for a, b in sorted(results.select("cond1", "cond2").distinct().collect()):  # one row a comparison
            points = plotdata.scatter_points(averages, a, b)
            out[f"scatter_{a}_vs_{b}"] = plotdata.scatter_groups(points, results.where((F.col("cond1") == a) & (F.col("cond2") == b)), options.p_value)
    return out


def collapse(spark: SparkSession, path: str, out: str, threshold: int = 0, compress: bool = False, five: int = 0, three: int = 0) -> None:
    rows = textual.fastq_sequences(spark, path).withColumn("library", F.lit("library"))
    sinks.fasta(reads.collapse(rows, five, three), out, threshold, compress)


def _session() -> SparkSession:
    return SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()


def run(spark: SparkSession, config_file: str, steps: tuple[str, ...] = ("align", "count", "dge", "plot"), again: bool = False, options: dict | None = None) -> None:
    """Steps of a run named in a configuration: samples_csv, features_csv, gff_files, genome_files, run_directory.

    Samples that are FASTQ files are filtered, collapsed and aligned to the genome first; alignment files go straight to
    the counts. Every step reads what the one before has written. ``again`` takes a run up: its steps write to folders of
    their own, stamped with the time, and later steps read the newest.
    """
    config = sheets.read_config(config_file)
    sheets.check_paths(config, config_file)
    listed = lambda key: [sheets.resolved(g["path"] if isinstance(g, dict) else g, config_file) for g in config.get(key) or []]
    at = lambda key: sheets.resolved(config[key], config_file)
    folder = at("run_directory")
    samples = sheets.read_samples(at("samples_csv"))
    sheets.check_samples(samples, files="count" in steps)
    place = lambda step: step_folder(folder, step, again)
    profile(config_file, config, folder)
    if "count" in steps:
        rules, genome = sheets.read_rules(at("features_csv")), listed("genome_files")
        options = CountOptions(**{k: config[k] for k in CountOptions.__dataclass_fields__ if k in config and k != "aliases"} | (options or {}))
        raw = all(Path(s.file).suffix.lower() in (".fastq", ".fq", ".gz") for s in samples)
        out = place("count")
        alignments, stats = aligned_reads(spark, samples, genome, config, out) if raw else (None, None)
        result = count(spark, samples, rules, listed("gff_files"), options, alignments, genome)
        if stats is not None:
            parts = stats.select("library", "total_reads", "retained_reads"), stats.select("library", "unique")
            result.tables["summary_report"] = C.summary_report(result.tables["summary_stats"], *parts)
        write_tables(result, out, rules)
        if options.decollapse and not raw:
            for s in samples:
                if not s.file.endswith(".bam"):
                    head = [r[0] for r in textual.lines(spark, s.file).where(F.col("value").startswith("@")).orderBy("line_no").select("value").collect()]  # the header alone
                    sinks.decollapsed_alignments(textual.alignments(spark, s.file, s.library, raw=True), head, f"{out}/{s.library}_decollapsed")
        if result.warnings:
            told = Report()
            for w in result.warnings:
                told.warning(w)
            print(told.text())
    read = lambda name: spark.read.parquet(f"{latest(folder, 'count')}/tables/{name}")
    if "dge" in steps and sheets.enough_replicates(samples):
        control = next((s.group for s in samples if s.control), None)
        write_tables(Counted(compare(read("feature_counts"), samples, control, bool(config.get("drop_zero")))), place("dge"))
    if "plot" in steps:
        tables = {name: read(name) for name in ("feature_counts", "counts_by_rule", "summary_stats", "mapped_nt_len_dist", "assigned_nt_len_dist")}
        if sheets.enough_replicates(samples):
            compared = latest(folder, "dge")
            tables |= {name: spark.read.parquet(f"{compared}/tables/{name}") for name in ("norm_counts", "comparisons")}
        given = {k.removeprefix("plot_"): tuple(v) if isinstance(v, list) else v for k, v in config.items() if k.startswith("plot_") and k.removeprefix("plot_") in PlotOptions.__dataclass_fields__}
        out = place("plots")
        write_tables(Counted(plot_tables(tables, PlotOptions(**given))), out)
        draw(spark, out, [s.library for s in samples])


def profile(config_file: str, config: dict, folder: str) -> None:
    """Copies of a run's configuration and sheets beside its results, so that they say how they were made."""
    target = Path(folder) / "config"
    target.mkdir(parents=True, exist_ok=True)
    for source in [config_file, *(sheets.resolved(config[k], config_file) for k in ("samples_csv", "features_csv") if k in config)]:
        shutil.copyfile(source, target / Path(source).name)


def draw(spark: SparkSession, folder: str, libraries: list[str]) -> list[str]:
    """Plots of the data in ``folder``, where matplotlib is at hand: names of the files."""
    from . import plots

    made: list[str] = []
    if not plots.available():
        return made
    kinds = {"len_dist_mapped": None, "len_dist_assigned": None, "class_charts": "classifier", "rule_charts": "rule_idx"}
    for table, label in kinds.items():
        if (Path(folder) / "tables" / table).is_dir():
            data = spark.read.parquet(f"{folder}/tables/{table}")
            for library in libraries:
                made.append(f"{folder}/{table}_{library}.pdf")
                if label is None:
                    plots.stacked_lengths(data, library, made[-1])
                else:
                    plots.proportion_bars(data, library, label, made[-1])
    return made


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="smallseq")
    sub = parser.add_subparsers(dest="command", required=True)
    for name, steps in (("run", "align count dge plot"), ("recount", "count dge plot"), ("replot", "plot")):
        p = sub.add_parser(name, help=f"steps: {steps}")
        p.add_argument("--config", required=True)
        p.set_defaults(steps=tuple(steps.split()), again=name != "run")
    p = sub.add_parser("collapse")
    p.add_argument("-i", "--input", required=True)
    p.add_argument("-o", "--output", required=True)
    p.add_argument("-t", "--threshold", type=int, default=0)
    p.add_argument("-c", "--compress", action="store_true")
    p.add_argument("--5p-trim", dest="five", type=int, default=0)
    p.add_argument("--3p-trim", dest="three", type=int, default=0)
    p = sub.add_parser("count", help="counts alone, with their options")
    p.add_argument("--config", required=True)
    p.add_argument("-ng", "--no-genomic-normalization", dest="normalize_by_genomic_hits", action="store_false")
    p.add_argument("-nf", "--no-feature-normalization", dest="normalize_by_feature_hits", action="store_false")
    p.add_argument("-vs", "--no-verify-stats", dest="verify_stats", action="store_false")
    p.add_argument("-dc", "--decollapse", action="store_true")
    p.add_argument("-d", "--report-diags", action="store_true")
    p.add_argument("-a", "--all-features", action="store_true")
    p = sub.add_parser("templates")
    p.add_argument("-o", "--output", default=".")
    args = parser.parse_args(argv)
    if args.command == "templates":
        return write_templates(args.output)
    spark = _session()
    if args.command == "collapse":
        return collapse(spark, args.input, args.output, args.threshold, args.compress, args.five, args.three)
    if args.command == "count":
        return run(spark, args.config, ("count",), again=True, options={k: getattr(args, k) for k in CountOptions.__dataclass_fields__ if hasattr(args, k)})
    run(spark, args.config, args.steps, args.again)


def write_templates(folder: str) -> None:
    """Empty sheets and a configuration to fill in; existing files stay."""
    texts = {
        "features.csv": ",".join(h.capitalize() if h != "5' end nucleotide" else "5' End Nucleotide" for h in sheets.FEATURES) + "\n",
        "samples.csv": "Input Files,Sample/Group Name,Replicate Number,Control,Normalization\n",
        "config.yml": "samples_csv: samples.csv\nfeatures_csv: features.csv\ngff_files:\n  - path: annotation.gff3\nrun_directory: run\n",
    }
    for name, text in texts.items():
        target = Path(folder) / name
        if not target.exists():
            target.write_text(text)


if __name__ == "__main__":
    main()
