import random

import pytest
from pyspark.sql import functions as F

from smallseq.operators import dge, plotdata, reads
from smallseq.streaming import counts as stream


def test_numbering_spans_buckets(spark):
    rows = [("l", i * 7919 % 300_000) for i in range(50)]
    df = reads.numbered(spark.createDataFrame(rows, "library string, first long"), "library", "first", "n", width=1000)
    assert [r["first"] for r in df.orderBy("n").collect()] == sorted(x for _, x in rows)
    assert {r["n"] for r in df.collect()} == set(range(50))


def test_trim_can_empty_a_read(spark):
    df = spark.createDataFrame([("l", 0, "ACGT"), ("l", 1, "AC"), ("l", 2, "")], "library string, read_idx long, seq string")
    assert [(r["seq"], r["read_count"]) for r in reads.collapse(df, 1, 1).collect()] == [("CG", 1)]


@pytest.mark.parametrize("mismatches", [0, 2])
def test_alignment_finds_every_place(spark, mismatches):
    rng = random.Random(5)
    genome = {f"c{i}": "".join(rng.choice("ACGT") for _ in range(n)) for i, n in enumerate((2500, 90, 12))}
    probes = []
    for i in range(25):
        c = rng.choice(["c0", "c1"])
        at = rng.randrange(len(genome[c]) - 24)
        q = list(genome[c][at : at + rng.randint(18, 24)])
        for _ in range(rng.randint(0, 3)):
            q[rng.randrange(len(q))] = rng.choice("ACGT")
        q = "".join(q)
        probes.append((i, q if rng.random() < 0.5 else q[::-1].translate(str.maketrans("ACGT", "TGCA"))))
    want = set()
    for i, q in probes:
        for fwd, p in ((True, q), (False, q[::-1].translate(str.maketrans("ACGT", "TGCA")))):
            for c, g in genome.items():
                for s in range(len(g) - len(p) + 1):
                    nm = sum(a != b for a, b in zip(p, g[s:], strict=False))
                    if nm <= mismatches:
                        want.add((i, c, s, fwd, nm))
    got = reads.align(spark.createDataFrame(probes, "seq_id long, seq string"), spark.createDataFrame(list(genome.items()), "chrom string, seq string"), mismatches, tile=512)
    assert {(r["seq_id"], r["chrom"], r["s"], r["fwd"], r["nm"]) for r in got.collect()} == want


def test_quality_filter(spark):
    rows = [("a", "A" * 20, "I" * 20), ("low", "A" * 20, "#" * 3 + "I" * 17), ("n", "NN" + "A" * 18, "I" * 20), ("short", "A" * 10, "I" * 10), ("adapter", "ACGT" * 4 + "TTAGG", "I" * 21), ("poly", "ACGT" * 4 + "G" * 12, "I" * 28)]
    df = spark.createDataFrame(rows, "name string, seq string, qual string")
    got = {r["name"]: r["seq"] for r in reads.quality_filter(df, adapter="TTAGG", poly_x=8).collect()}
    assert set(got) == {"adapter", "poly"}  # the plain read is a poly-A and trimmed away
    assert got["adapter"] == "ACGT" * 4 and got["poly"] == "ACGT" * 4
    assert {r["name"] for r in reads.quality_filter(df).collect()} == {"a", "adapter", "poly"}


def test_bh(spark):
    p = [0.01, 0.04, 0.03, 0.005, None, 0.04]
    df = spark.createDataFrame([("c", i, x) for i, x in enumerate(p)], "c string, i int, pvalue double")
    got = {r["i"]: r["padj"] for r in dge.bh_adjusted(df, ["c"]).collect()}
    known = sorted((x, i) for i, x in enumerate(p) if x is not None)
    best = 1.0
    for rank in range(len(known), 0, -1):
        best = min(best, known[rank - 1][0] * len(known) / rank)
        assert got[known[rank - 1][1]] == pytest.approx(best)
    assert got[4] is None


def test_size_factors_undo_depth(spark):
    base = {"a": 10, "b": 200, "c": 35}
    rows = [(f"g{g}_rep_{r}", f, "x", n * k) for g, r, k in ((0, 1, 1), (0, 2, 2), (1, 1, 4)) for f, n in base.items()] + [("g0_rep_1", "z", "x", 0), ("g0_rep_2", "z", "x", 5), ("g1_rep_1", "z", "x", 0)]
    counts = spark.createDataFrame(rows, "library string, feature_id string, classifier string, count long")
    f = {r["library"]: r["size_factor"] for r in dge.size_factors(counts).collect()}
    assert f["g0_rep_1"] == pytest.approx(0.5) and f["g0_rep_2"] == pytest.approx(1.0) and f["g1_rep_1"] == pytest.approx(2.0)
    normalized = {(r["library"], r["feature_id"]): r["count"] for r in dge.normalized_counts(counts, dge.size_factors(counts)).collect()}
    assert normalized[("g0_rep_1", "a")] == pytest.approx(normalized[("g1_rep_1", "a")])


def test_wald_finds_the_changed_gene(spark):
    rng = random.Random(1)
    rows = [(f"g{g}_rep_{r}", f"f{i}", "x", (100 + rng.randint(-9, 9)) * (8 if g and i == 3 else 1)) for g in (0, 1) for r in (1, 2, 3) for i in range(40)]
    counts = spark.createDataFrame(rows, "library string, feature_id string, classifier string, count long")
    groups = spark.createDataFrame([(f"g{g}_rep_{r}", f"g{g}") for g in (0, 1) for r in (1, 2, 3)], "library string, grp string")
    normalized = dge.normalized_counts(counts, dge.size_factors(counts))
    found = dge.wald_tests(normalized, groups, spark.createDataFrame([("g0", "g1")], "cond1 string, cond2 string"))
    sig = plotdata.significant(found).collect()
    assert [r["feature_id"] for r in sig] == ["f3"] and sig[0]["log2FoldChange"] == pytest.approx(3, abs=0.2)
    back = {r["feature_id"]: r for r in dge.flipped(found).collect()}["f3"]
    assert (back["cond1"], back["cond2"]) == ("g1", "g0") and back["log2FoldChange"] == pytest.approx(-sig[0]["log2FoldChange"])


def test_two_sided_p(spark):
    got = spark.range(1).select(dge.two_sided(F.lit(1.959964)), dge.two_sided(F.lit(-3.0)), dge.two_sided(F.lit(0.0))).first()
    assert got[0] == pytest.approx(0.05, abs=1e-6) and got[1] == pytest.approx(0.0026998, abs=1e-6) and got[2] == pytest.approx(1, abs=1e-6)


def test_proportions_and_the_unassigned_rest(spark):
    counts = spark.createDataFrame([("l", "a", 1.0)], "library string, classifier string, count double")
    for mapped, rest in ((3.0, True), (1.00004, False)):
        m = spark.createDataFrame([("l", mapped)], "library string, mapped_reads double")
        got = {r["classifier"]: round(r["proportion"], 6) for r in plotdata.proportions(counts, m, "classifier").collect()}
        assert got == ({"a": 0.3333, "_UNASSIGNED_": 0.6667} if rest else {"a": 1.0})


def test_stream_collapse(spark, tmp_path):
    df = spark.createDataFrame([("l", "AC"), ("l", "AC"), ("l", "G"), ("l", "")], "library string, seq string")
    df.write.parquet(str(tmp_path / "in"))
    query = stream.to_table(stream.collapsed(stream.reads(spark, str(tmp_path / "in"))), "collapsed_now", str(tmp_path / "cp"))
    query.awaitTermination(60)
    assert {(r["seq"], r["read_count"]) for r in spark.table("collapsed_now").collect()} == {("AC", 2), ("G", 1)}


def test_mismatch_alignment_takes_every_probe(spark):
    import os

    import duckdb
    import pytest

    from smallseq.plans import registry

    sf = "/root/testdata/sf0.01"
    if not os.path.isdir(sf):
        pytest.skip("needs the test tables")
    con = duckdb.connect()
    for t in ("part", "supplier"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.execute(registry._PLACES + " SELECT DISTINCT q.seq_id, chrom, s, fwd, hamming(q, w) AS nm FROM q, k WHERE hamming(q, w) <= 2").fetchall()
    got = [tuple(r) for r in registry.QUERIES["kmer_align_mismatch"](spark, sf).collect()]
    assert sorted(got) == sorted(want) and max(r[0] for r in got) > 40


def test_every_alignment_is_decollapsed(spark):
    import os

    import pytest
    from pyspark.sql import functions as F

    from smallseq.plans import bridge, registry

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("needs the test tables")
    want = bridge.alignments(spark, sf).where("read_count > 0").agg(F.sum("read_count"), F.count("*")).first()
    got = registry.QUERIES["decollapse"](spark, sf).agg(F.count("*"), F.count_if(F.col("copy") == 1)).first()
    assert tuple(got) == tuple(want)
