"""Registered queries on tables with large keys and many rows."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")

from smallseq.plans import registry  # noqa: E402

#: A multiple of every modulus that the projection takes of an order's key; the keys of its rows pass 64 bits.
SHIFT = 2_100_000


@pytest.fixture(scope="module")
def shifted(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("shifted"))
    spark.read.parquet(f"{SF}/lineitem.parquet").withColumn("l_orderkey", F.col("l_orderkey") + SHIFT).write.parquet(f"{d}/lineitem.parquet")
    shutil.copy(f"{SF}/part.parquet", f"{d}/part.parquet")
    return d


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("name", ["feature_counts", "alignment_stats", "candidates", "collapse", "collapse_threshold", "summary_report"])
def test_keys_beyond_64_bits(spark, shifted, name):
    assert _rows(registry.QUERIES[name](spark, shifted)) == _rows(registry.QUERIES[name](spark, SF))


@pytest.mark.parametrize("name", ["strand_select", "column_filter", "rule_counts", "class_check", "summary_stats", "counts_report", "counts_wide", "sample_avg", "scatter_points", "dge_outgroup", "class_filter", "class_include", "deseq_norm", "wald_dge"])
def test_queries_on_wide_keys(spark, shifted, name):
    assert _rows(registry.QUERIES[name](spark, shifted)) == _rows(registry.QUERIES[name](spark, SF))


def test_components_on_wide_keys(spark, shifted):
    big, small = (registry.QUERIES["pca"](spark, d).orderBy("library").collect() for d in (shifted, SF))
    assert [r["library"] for r in big] == [r["library"] for r in small] and len(big) == 6


def test_keys_beyond_64_bits_are_whole(spark, shifted):
    big, small = (registry.QUERIES["alignment_table"](spark, d) for d in (shifted, SF))
    assert (dict(big.dtypes)["row_key"], dict(small.dtypes)["row_key"]) == ("decimal(38,0)", "bigint")
    step = SHIFT * 8 * 4000037 * 400009
    assert step > 1 << 64
    rest = lambda r, key, name: tuple(r.asDict().values())[3:] + (key, name)
    got = {rest(r, int(r["row_key"]), r["name"]) for r in big.collect()}
    assert got == {rest(r, r["row_key"] + step, r["name"] + SHIFT) for r in small.collect()}


def test_candidates_are_counted_without_pairs(spark):
    """Alignments and features at one place: the pairs would be the product of both."""
    from smallseq.operators import select

    n = 40_000
    places = spark.range(n).selectExpr("'l' as library", "id as name", "id as row_key", "if(id % 4 = 3, 'empty', 'c') as chrom", "id % 3000 as s", "id % 3000 + 20 as e")
    places = places.unionByName(places.where("name in (1, 2)"))  # a repeated row counts once
    features = spark.range(n).selectExpr("'c' as chrom", "id % 40 as fs", "2000 + id % 40 as fe", "id as record_id")
    # one record of two intervals, and one whose intervals overlap
    more = spark.createDataFrame([("c", 5000, 5010, -1), ("c", 2990, 2995, -1), ("c", 3000, 3001, -1), ("c", 100, 200, -2), ("c", 150, 300, -2)], "chrom string, fs long, fe long, record_id long")
    got = {r["name"]: r["candidates"] for r in select.candidate_counts(places, features.unionByName(more)).collect()}
    want = {}
    for s in range(3000):
        e = s + 20
        if e - 1 >= 39 and s < 2000:
            hit = n
        else:
            hit = sum(n // 40 for k in range(40) if k < e and s < 2000 + k)
        want[s] = hit + (s < 2995 and e > 2990 or s < 3001 and e > 3000) + (s < 300 and e > 100)
    assert got == {i: want[i % 3000] for i in range(n) if i % 4 < 3 and want[i % 3000]}


def test_a_repeated_sequence_is_aligned_once(spark):
    """Many reads of one sequence, of which a piece lies in many places: once for each read these were 120 million pairs."""
    import time

    from smallseq.operators import reads

    seq, began = "AAAAAACGTACGTTGACC", time.time()
    genome = spark.createDataFrame([("c", "AAAAAAGGCCTTGGCCTTGGCC" * 2000 + seq), ("d", "AAAAAAGGTACGTTGACC")], "chrom string, seq string")
    probes = spark.range(60_000).selectExpr("id as seq_id", f"'{seq}' as seq")
    found = reads.align(probes, genome, mismatches=2, seed=6).groupBy("chrom", "s", "fwd", "nm").count().collect()
    assert sorted(map(tuple, found)) == [("c", 44_000, True, 0, 60_000), ("d", 0, True, 1, 60_000)]
    assert time.time() - began < 40


def test_a_task_leaves_its_worker_without_its_memory(monkeypatch):
    """Every task of the near-duplicate stage gives back what it took, also if it is not read to its end."""
    from smallseq.llm import batches, similar, simhash

    given = []
    monkeypatch.setattr(batches, "give_back", lambda: given.append(1))
    for name in ("_spread", "_counted", "_summed", "_prints", "_dealt", "_shared", "_chained", "_compared", "_alike", "_possible", "_sets"):
        assert hasattr(getattr(similar, name), "__wrapped__"), name
    assert hasattr(simhash._shard_links, "__wrapped__")
    before = len(given)
    assert list(similar._possible(iter([]), 80)) == [] and len(given) == before + 1


def test_selected_counts_without_pairs(spark, tmp_path):
    """Alignments and features at one place: the pairs would be the product of both."""
    n = 30_000
    spark.range(n).selectExpr("id * 150000 as l_orderkey", "1 as l_linenumber", "0L as l_partkey", "0L as l_suppkey", "'O' as l_linestatus", "5.0D as l_quantity").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(n).selectExpr("id * 50000 as p_partkey", "30 as p_size", "'b' as p_brand", "'t' as p_type", "'cold x' as p_name").write.parquet(f"{tmp_path}/part.parquet")
    got = registry.QUERIES["strand_select"](spark, str(tmp_path))
    chosen = [i * 50000 for i in range(n) if i * 50000 % 3 != 2]  # unstranded, or on the reads' strand
    count = round(sum(1 + i * 150000 % 7 for i in range(n)) / len(chosen), 6)
    assert _rows(got.select("library", "feature_id", "classifier")) == sorted((("g0_rep_1", str(p), "s") for p in chosen), key=repr)
    assert [r[0] for r in got.select("count").distinct().collect()] == [count]


def test_selected_counts_are_those_of_the_assignment(spark):
    """Keys that recur, pairs with several matches, hierarchies, no strand, nulls and empty alignments."""
    from smallseq.operators import counts, reference, select
    from smallseq.rules import Rule, rule_table

    places = spark.range(3000).selectExpr("concat('l', id % 2) as library", "id div 3 as name", "if(id % 50 < 2, 0, id) as row_key", "if(id % 41 = 0, null, concat('c', id % 3)) as chrom", "(id * 37) % 9000 as s", "id % 25 as length",
        "if(id % 31 = 0, null, id % 2 = 0) as fwd", "substring('ACGT', cast(id % 4 + 1 as int), 1) as nt5", "cast(id % 3 as int) as nm", "id % 5 as read_count", "'' as seq")
    alignments = places.selectExpr("library", "name", "row_key", "chrom", "s", "s + length as e", "fwd", "nt5", "cast(length as int) as length", "nm", "read_count", "seq")
    rows = spark.range(400).selectExpr("cast(if(id % 20 = 0, 0, id) as string) as feature_id", "concat('c', id % 3) as chrom", "(id * 53) % 9000 as fs", "(id * 53) % 9000 + 20 + if(id % 40 = 1, 5000, 0) as fe",
        "if(id % 3 = 0, null, id % 3 = 1) as strand", "'b' as source", "concat('t', id % 4) as type", "array(named_struct('key', 'Class', 'key_lc', 'class', 'vals', array('x'), 'vals_lc', array('x'))) as attrs")
    sheet = [Rule(classifier="s", strand="sense", hierarchy=2, nt5="A,C"), Rule(classifier="s", type="t1", strand="antisense", hierarchy=1, overlap="partial, 3, -2"), Rule(classifier="m", mismatch="1", length="10-20", hierarchy=1, type="t2, t3")]
    for rules in (sheet, [Rule(classifier="n", overlap="nested")], [Rule(type="none")]):
        matches = reference.feature_matches(reference.stage_one(rows, rule_table(spark, rules)))
        for shares in ((True, True), (False, False))[: 2 if rules == sheet else 1]:
            want, got = ({tuple(r)[:3]: r["count"] for r in df.collect()} for df in (counts.feature_counts(select.assign(alignments, matches, *shares)), counts.selected_counts(alignments, matches, *shares)))
            assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
            assert bool(want) == (rules[0].type != "none")


def _dense(spark, folder, n):
    """Tables of n alignments and n features at few places: the pairs would be the product of both."""
    spark.range(n).selectExpr("id * 150000 + id % 2 as l_orderkey", "cast(1 + id % 2 as int) as l_linenumber", "id % 7 as l_partkey", "0L as l_suppkey", "if(id % 3 = 0, 'F', 'O') as l_linestatus", "cast(id % 18 as double) as l_quantity").write.parquet(f"{folder}/lineitem.parquet")
    spark.range(n).selectExpr("id * 50000 as p_partkey", "30 + cast(id % 9 as int) as p_size", "concat('Brand#', 3 + id % 6) as p_brand", "'PROMO' as p_type", "element_at(array('small x', 'hot x', 'red x', 'blue x'), cast(id % 4 + 1 as int)) as p_name").write.parquet(f"{folder}/part.parquet")
    return str(folder)


def test_feature_counts_without_pairs(spark, tmp_path):
    import time

    began = time.time()
    got = {tuple(r)[:3]: r["count"] for r in registry.QUERIES["feature_counts"](spark, _dense(spark, tmp_path / "big", 40_000)).collect()}
    assert time.time() - began < 120 and {k[2] for k in got} == {"little"}
    total = sum(1 + (i * 150000 + i % 2) % 7 for i in range(40_000))
    assert 0 < sum(got.values()) <= total


_SHEET = """exact anchored 5'_anchored 3'_anchored nested partial""".split()


@pytest.mark.parametrize("several", [False, True])
def test_tiles_give_the_shares_of_the_assignment(spark, several, monkeypatch):
    """Every overlap, hierarchies that tie, keys that recur, pairs with several matches, no strand, nulls, empty alignments; shared tiles."""
    from smallseq.operators import counts, reference, select, tiles
    from smallseq.rules import Rule, rule_table

    monkeypatch.setattr(tiles, "SLICE", 150)
    odd = "if(id % 50 < 2, 0, id)" if several else "id"
    places = spark.range(4000).selectExpr("concat('l', id % 2) as library", "id div 3 as name", f"{odd} as row_key", "if(id % 41 = 0, null, concat('c', id % 3)) as chrom", "(id * 37) % 5000 as s", f"id % 25 + {0 if several else 1} as length",
        "if(id % 31 = 0, null, id % 2 = 0) as fwd", "substring('ACGT', cast(id % 4 + 1 as int), 1) as nt5", "cast(id % 3 as int) as nm", "id % 5 as read_count", "'' as seq")
    alignments = places.selectExpr("library", "name", "row_key", "chrom", "s", "s + length as e", "fwd", "nt5", "cast(length as int) as length", "nm", "read_count", "seq")
    rows = spark.range(900).selectExpr(f"cast({'if(id % 20 = 0, 0, id)' if several else 'id'} as string) as feature_id", "concat('c', id % 3) as chrom", "(id * 74) % 5000 as fs", "(id * 74) % 5000 + if(id % 7 < 3, id * 2 % 25 + 1, 3 + id % 31) + if(id % 40 = 1, 3000, 0) as fe",
        "if(id % 5 = 0, null, id % 5 < 3) as strand", "'b' as source", "concat('t', id % 4) as type", "array(named_struct('key', 'Class', 'key_lc', 'class', 'vals', array('x'), 'vals_lc', array('x'))) as attrs")
    rules = [Rule(classifier=k, overlap=k.replace("_", " "), hierarchy=i // 3, strand=("", "sense", "antisense")[i % 3], nt5="A,C" if i == 5 else "", mismatch="0, 2" if i == 1 else "", type="t1, t2" if k == "partial" else "") for i, k in enumerate(_SHEET)]
    table = rule_table(spark, rules)
    matches = reference.feature_matches(reference.stage_one(rows, table))
    for norm in ((True, True), (False, False)):
        assigned = select.assign(alignments, matches, *norm)
        by = lambda df: {tuple(r)[:4]: r["n"] for r in df.groupBy("library", *select.PAIR, "rule_idx").agg(F.sum(F.col("fcorr") / F.col("n_rules")).alias("n")).collect()}
        want, got = by(assigned), by(tiles.shares(alignments, matches, *norm, rules=table if norm[0] else None))
        assert len(want) > 1000 and {k[3] for k in want} == set(range(6))
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    shown = ["library", "name", "loci", F.round("assigned", 9), F.round("unassigned", 9), F.least("n_features", F.lit(2)), "length"]
    want = counts.by_read(counts.by_alignment(select.with_loci(alignments), select.assign(alignments, matches)))
    # of rows with one key the first is not told
    shown = shown[: 6 if several else 7]
    assert _rows(tiles.reads(alignments, matches).select(*shown)) == _rows(want.select(*shown))
