import gzip
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from smallseq import pipeline
from smallseq.functions import seq as S
from smallseq.operators import validate
from smallseq.sources import bam, sheets, sinks, textual

GFF = """##gff-version 3
I\tsrc\tchromosome\t1\t1000\t.\t.\t.\tID=I
I\tWB\tgene\t100\t200\t.\t+\t.\tID=g1;Class=CSR,piRNA;Name=alpha%2Cbeta;note="a;b"
I\tWB\tmRNA\t100\t150\t.\t+\t.\tID=t1;Parent=g1;Class=CSR;Alias=zeta
I\tWB\tgene\t300\t350\t.\t-\t.\tgene_id "g2"; Class "unknown"; Alias "Beta"
"""
SAM = """@HD\tSO:unsorted
@SQ\tSN:I\tLN:1000
@PG\tID:bowtie\tCL:a:b
0_count=5\t16\tI\t100\t255\t21M\t*\t0\t0\tCAAGACAGAGCTTCACCGTTC\tIIIIIIIIIIIIIIIIIIIII\tXA:i:0\tNM:i:0
0_count=5\t0\tI\t300\t255\t21M\t*\t0\t0\tCAAGACAGAGCTTCACCGTTC\tIIIIIIIIIIIIIIIIIIIII\tNM:i:1
1_count=2\t4\t*\t0\t0\t*\t*\t0\t0\tGGGGGGGGGGGGGGGG\tIIIIIIIIIIIIIIII
"""


@pytest.fixture
def files(tmp_path):
    (tmp_path / "a.gff3").write_text(GFF)
    (tmp_path / "a.sam").write_text(SAM)
    return tmp_path


def test_annotation(spark, files):
    rows = {r["feature_id"]: r for r in textual.annotation(spark, str(files / "a.gff3")).collect()}
    g1 = rows["g1"]
    assert (g1["fs"], g1["fe"], g1["strand"]) == (99, 200, True)
    attrs = {a["key"]: a["vals"] for a in g1["attrs"]}
    assert attrs == {"ID": ["g1"], "Class": ["CSR", "piRNA"], "Name": ["alpha,beta"], "note": ["a;b"]}
    assert rows["t1"]["parent"] == "g1" and rows["g2"]["strand"] is False
    assert {a["key"]: a["vals"] for a in rows["g2"]["attrs"]} == {"gene_id": ["g2"], "Class": ["unknown"], "Alias": ["Beta"]}


def test_attribute_edges(spark):
    df = spark.createDataFrame([("a=1+1;A=2%zz;;b",)], "t string").select(textual.attributes(F.col("t")).alias("a"))
    assert [(x["key"], x["vals"]) for x in df.first()["a"]] == [("A", ["2%zz"])]
    with pytest.raises(Exception, match="mismatched quotes"):
        spark.createDataFrame([('a="1',)], "t string").select(textual.attributes(F.col("t"))).collect()


def test_alignments(spark, files):
    rows = textual.alignments(spark, str(files / "a.sam"), "l").orderBy("row_key").collect()
    assert [(r["s"], r["e"], r["fwd"], r["nt5"], r["nm"], r["read_count"], r["length"]) for r in rows] == [(99, 120, False, "G", 0, 5, 21), (299, 320, True, "C", 1, 5, 21)]


def test_edits_from_cigar_without_tags(spark, tmp_path):
    (tmp_path / "c.sam").write_text("r\t0\tI\t1\t0\t5M1I3X2D\t*\t0\t0\tACGTACGTA\tIIIIIIIII\n")
    row = textual.alignments(spark, str(tmp_path / "c.sam"), "l").first()
    assert (row["nm"], row["read_count"]) == (6, 1)


def test_empty_alignments_raise(spark, tmp_path):
    (tmp_path / "e.sam").write_text("@HD\tSO:unsorted\n")
    with pytest.raises(ValueError, match="empty"):
        textual.alignments(spark, str(tmp_path / "e.sam"), "l")


def test_header(spark, files):
    header = textual.alignment_header(spark, str(files / "a.sam"))
    assert header.where("record = 'PG'").first()["tags"] == {"ID": "bowtie", "CL": "a:b"}
    assert [(r["seq_id"], r["seq_len"]) for r in textual.reference_sequences(header).collect()] == [("I", 1000)]
    validate.check_order(header)


@pytest.mark.parametrize(("lines", "ok"), [("@HD\tSO:queryname\n", True), ("@HD\tSO:coordinate\n", False), ("@PG\tID:STAR\n", True), ("@PG\tID:other\n", False)])
def test_order_check(spark, tmp_path, lines, ok):
    (tmp_path / "h.sam").write_text(lines)
    header = textual.alignment_header(spark, str(tmp_path / "h.sam"))
    if ok:
        validate.check_order(header)
    else:
        with pytest.raises(ValueError):
            validate.check_order(header)


def test_reference_checks(spark):
    seqs = lambda rows: spark.createDataFrame(rows, "file string, seq_id string, seq_len long")
    validate.check_sequences(seqs([("a", "I", 5), ("b", "I", 5)]))
    for rows, text in (([], "no reference"), ([("a", "I", None)], "incomplete"), ([("a", "I", 5), ("a", "I", 5)], "duplicate"), ([("a", "I", 5), ("b", "I", 6)], "inconsistent")):
        with pytest.raises(ValueError, match=text):
            validate.check_sequences(seqs(rows))


def bgzf(raw):
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(raw) + c.flush()


def test_bam_equals_sam(spark, files):
    def record(name, flag, pos, seq, nm):
        packed = bytes(bam.BASES.index(a) << 4 | bam.BASES.index(b) for a, b in zip(seq[::2], seq[1::2] + "=" * (len(seq) % 2), strict=True))
        body = struct.pack("<iiBBHHHiiii", 0, pos, len(name) + 1, 255, 0, 1, flag, len(seq), -1, -1, 0) + name.encode() + b"\0" + struct.pack("<I", len(seq) << 4) + packed + b"\xff" * len(seq) + b"NMC" + bytes([nm])
        return struct.pack("<i", len(body)) + body

    text = b"@HD\tSO:unsorted\n"
    head = b"BAM\1" + struct.pack("<i", len(text)) + text + struct.pack("<i", 1) + struct.pack("<i", 2) + b"I\0" + struct.pack("<i", 1000)
    seq = "CAAGACAGAGCTTCACCGTTC"
    raw = bgzf(head) + bgzf(record("0_count=5", 16, 99, seq, 0) + record("0_count=5", 0, 299, seq, 1)) + bgzf(b"")
    (files / "a.bam").write_bytes(raw)
    cols = ["name", "chrom", "s", "e", "fwd", "nt5", "length", "nm", "read_count", "seq"]
    one = bam.alignments(spark, str(files / "a.bam"), "l").select(cols).collect()
    two = textual.alignments(spark, str(files / "a.sam"), "l").select(cols).collect()
    assert sorted(one) == sorted(two)


def test_fastq_collapse_and_fasta(spark, tmp_path):
    reads = ["ACGT", "TTTT", "ACGT", "GG", "ACGT", "TTTT"]
    text = "".join(f"@r{i}\n{r}\n+\n{'I' * len(r)}\n" for i, r in enumerate(reads))
    with gzip.open(tmp_path / "a.fastq.gz", "wt") as f:
        f.write(text)
    rows = textual.fastq(spark, str(tmp_path / "a.fastq.gz")).orderBy("read_idx").collect()
    assert [(r["qname"], r["seq"]) for r in rows] == [(f"r{i}", r) for i, r in enumerate(reads)]
    pipeline.collapse(spark, str(tmp_path / "a.fastq.gz"), str(tmp_path / "out.fa"), threshold=1)
    got = {(r["seq_id"], r["read_count"], r["seq"]) for r in textual.collapsed_fasta(spark, str(tmp_path / "out.fa")).collect()}
    low = {(r["seq_id"], r["read_count"], r["seq"]) for r in textual.collapsed_fasta(spark, str(tmp_path / "out.fa_lowcounts")).collect()}
    assert got == {(0, 3, "ACGT"), (1, 2, "TTTT")} and low == {(2, 1, "GG")}
    with pytest.raises(Exception, match="(?i)exists"):
        pipeline.collapse(spark, str(tmp_path / "a.fastq.gz"), str(tmp_path / "out.fa"))


def test_genome_headers(spark, tmp_path):
    (tmp_path / "g.fa").write_text(">chr1 x\nATGC\nAA\n>chr2\nCGTA\n")
    assert {r[0] for r in textual.genome_chroms(spark, str(tmp_path / "g.fa")).collect()} == {"chr1", "chr2"}
    assert {(r["name"], r["seq"]) for r in textual.fasta(spark, str(tmp_path / "g.fa")).collect()} == {("chr1", "ATGCAA"), ("chr2", "CGTA")}


FEATURES = "Select for...,with value...,Classify as...,Source Filter,Type Filter,Hierarchy,Strand,5' End Nucleotide,Length,Overlap,Mismatches\n"


def test_sheets(spark, files):
    (files / "features.csv").write_text("﻿" + FEATURES + "Class,CSR,c1,,,1,sense,\"a,u\",20-22,Full,\n\n,,all,,,2,both,all,all,partial,\n")
    rules = sheets.read_rules(files / "features.csv")
    assert [(r.val, r.hierarchy, r.overlap, r.nt5) for r in rules] == [("CSR", 1, "full", "A,T"), ("", 2, "partial", "ALL")]
    (files / "bad.csv").write_text(FEATURES.replace("Length", "Lenght") + "\n")
    with pytest.raises(ValueError, match="missing columns: length"):
        sheets.read_rules(files / "bad.csv")
    (files / "samples.csv").write_text("Replicate Number,Input Files,Sample/Group Name,Control,Normalization\n1,a.sam,cond,true,rpm\n1,a.sam,cond,true,rpm\n")
    samples = sheets.read_samples(files / "samples.csv")
    assert [s.library for s in samples] == ["cond_rep_1"] and samples[0].control
    sheets.check_samples(samples)
    assert not sheets.enough_replicates(samples)
    with pytest.raises(ValueError, match="normalization"):
        sheets.check_samples([sheets.Sample(str(files / "a.sam"), "g", "1", norm="123.rpm")])


def test_plain_yaml():
    text = "a: 1\nb: 'x y' # c\nc:\n  - path: p\n    alias: [q, r]\n  - path: s\nd:\n  - 1\n  - z\ne: true\n"
    assert sheets._plain_yaml(text) == {"a": 1, "b": "x y", "c": [{"path": "p", "alias": ["q", "r"]}, {"path": "s"}], "d": [1, "z"], "e": True}


def test_filter_report(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"summary": {"before_filtering": {"total_reads": 9},\n "after_filtering": {"total_reads": 7}}}')
    row = sheets.filter_reports(spark, str(tmp_path / "r.json")).first()
    assert (row["total_reads"], row["retained_reads"]) == (9, 7)


def test_names(spark):
    df = spark.createDataFrame([("/x/lib1_aligned_seqs.sam", "1a b", "x_cond1_a_cond2_b_deseq_table.csv")], "p string, n string, f string")
    assert tuple(df.select(S.base_name(F.col("p")), S.r_safe(F.col("n")), S.comparison_name(F.col("f"))).first()) == ("lib1", "X1a.b", "a_vs_b")
    names = spark.createDataFrame([("g10",), ("G2",), ("g1",)], "n string").orderBy(S.natural_key(F.col("n"))).collect()
    assert [r[0] for r in names] == ["g1", "G2", "g10"]


def test_run_from_files(spark, files):
    (files / "features.csv").write_text(FEATURES + "Class,CSR,c1,,,1,both,all,all,partial,\n,,rest,,,2,both,all,all,partial,\n")
    (files / "samples.csv").write_text("Input Files,Sample/Group Name,Replicate Number,Control,Normalization\na.sam,cond,1,,rpm\n")
    (files / "run.yml").write_text("samples_csv: samples.csv\nfeatures_csv: features.csv\ngff_files:\n  - path: a.gff3\nrun_directory: out\nreport_diags: true\n")
    pipeline.main(["run", "--config", str(files / "run.yml")])
    read = lambda name: spark.read.parquet(str(files / f"out/count/tables/{name}")).collect()
    counts = {(r["feature_id"], r["classifier"]): (r["count"], r["feature_name"]) for r in read("feature_counts")}
    assert counts[("g1", "c1")] == (2.5, "zeta") and counts[("g2", "rest")][0] == 2.5
    assert {r["mapped_reads"] for r in read("summary_stats")} == {5.0}
    norm = {r["feature_id"]: r["count"] for r in read("norm_counts") if r["count"]}
    assert norm["g1"] == 2.5 / (5.0 / 1e6)
    assert len(read("alignment_table")) == 2
    assert (files / "out/plots/tables/class_charts").exists()


    # taken up again: new folders beside the run's, the newest of which the plots read
    pipeline.main(["recount", "--config", str(files / "run.yml")])
    pipeline.main(["replot", "--config", str(files / "run.yml")])
    again = [p for p in (files / "out").glob("count_*")]
    assert len(again) == 1 and pipeline.latest(str(files / "out"), "count") == str(again[0])
    assert len(list((files / "out").glob("plots_*"))) >= 1 and (files / "out/config/run.yml").exists()
    report = spark.read.csv(f"{again[0]}/counts_by_rule", header=True).collect()
    assert report[0]["Rule String"].startswith("Select for: Class; with value: CSR") and report[-1]["Rule Index"] == "Mapped Reads" and report[-1]["cond_rep_1"] == "5.0"
    assert set(spark.read.csv(f"{again[0]}/feature_counts", header=True).columns) == {"Feature ID", "Classifier", "Feature Name", "cond_rep_1"}


def test_run_from_raw_reads(spark, files):
    genome = "".join("ACGT"[(i * i * 7 + i // 3) % 4] for i in range(1000))
    (files / "g.fa").write_text(">I one\n" + "\n".join(genome[i : i + 60] for i in range(0, 1000, 60)) + "\n")
    rc = genome[310:332].translate(str.maketrans("ACGT", "TGCA"))[::-1]
    seqs = [genome[105:127]] * 3 + [rc] * 2 + ["A" * 50]
    (files / "r.fastq").write_text("".join(f"@r{i}\n{x}\n+\n{'I' * len(x)}\n" for i, x in enumerate(seqs)))
    (files / "features.csv").write_text(FEATURES + ",,all,,,1,both,all,all,partial,\n")
    (files / "samples.csv").write_text("Input Files,Sample/Group Name,Replicate Number,Control,Normalization\nr.fastq,raw,1,,\n")
    (files / "run.yml").write_text("samples_csv: samples.csv\nfeatures_csv: features.csv\ngff_files:\n  - path: a.gff3\ngenome_files:\n  - path: g.fa\nrun_directory: raw\nfilter_max_length: 35\nalign_mismatches: 0\n")
    pipeline.run(spark, str(files / "run.yml"))
    summary = {r["Summary Statistics"]: float(r["raw_rep_1"]) for r in spark.read.csv(str(files / "raw/count/summary_stats"), header=True).collect()}
    assert summary["Total Reads"] == 6 and summary["Retained Reads"] == 5 and summary["Unique Sequences"] == 2 and summary["Mapped Reads"] == 5
    counts = {r["feature_id"]: r["count"] for r in spark.read.parquet(str(files / "raw/count/tables/feature_counts")).collect()}
    assert counts["g2"] > 0 and sum(counts.values()) <= 5
    assert spark.read.text(str(files / "raw/count/collapse/raw_rep_1")).count() == 4


def test_decollapsed_alignments(spark, files):
    raw = textual.alignments(spark, str(files / "a.sam"), "l", raw=True)
    sinks.decollapsed_alignments(raw, ["@HD\tSO:unsorted"], str(files / "d"))
    lines = [r[0] for r in spark.read.text(str(files / "d")).collect()]
    assert len(lines) == 11 and sum(line.startswith("0\t16\t") for line in lines) == 5


def test_templates(tmp_path):
    pipeline.main(["templates", "-o", str(tmp_path)])
    assert sheets.read_rules(tmp_path / "features.csv") == []


def test_report_text():
    from smallseq.report import Report

    r = Report({"x": "The x"})
    r.warning("careful", {"x": {"a": 1, "b": []}, "y": ["p", "q"], "z": {}})
    r.error("bad", "why")
    lines = r.text().split("\n")
    assert lines[0].startswith("========[ ERROR ]==") and lines[1:3] == ["bad", "why"]
    assert "\tThe x: " in lines and "\t\ta: 1" in lines and "\t\t\t[ NONE ]" in lines and "\t\tp" in lines and "\t\t{ NONE }" in lines


def test_configurations_are_upgraded():
    steps = [sheets.Upgrade("1.10", add=(("k", 3),)), sheets.Upgrade("1.2", rename=(("old", "new"),)), sheets.Upgrade("0.9", blocked=True)]
    got = sheets.upgraded({"old": 1, "other": 2, "version": "v1.1"}, steps)
    assert got == {"new": 1, "other": 2, "version": "1.10", "k": 3} and list(got)[0] == "new"
    assert sheets.upgraded(got, steps) == got
    with pytest.raises(ValueError, match="by hand"):
        sheets.upgraded({"old": 1}, steps)


def test_paths_are_checked(files):
    with pytest.raises(ValueError, match="missing: features_csv"):
        sheets.check_paths({"samples_csv": "a", "run_directory": "r"}, files / "c.yml")
    with pytest.raises(ValueError, match="no such file: gone.gff"):
        sheets.check_paths({"samples_csv": "a.sam", "features_csv": "a.sam", "run_directory": "r", "gff_files": ["a.gff3", {"path": "gone.gff"}]}, files / "c.yml")


def test_colours():
    from smallseq.operators import plotdata

    assert plotdata.class_colours(["b", "a"], ["red", "blue", "green"]) == {"a": "red", "b": "blue"}
    with pytest.raises(ValueError):
        plotdata.class_colours(["b", "a"], ["red"])
