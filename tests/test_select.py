import pytest
from pyspark.sql import functions as F

from smallseq.operators import counts as C
from smallseq.operators import intervals, select
from smallseq.operators import reference
from smallseq.rules import Rule, rule_table

ALN = "library string, name string, row_key long, chrom string, s long, e long, fwd boolean, nt5 string, length int, nm int, read_count long, seq string"


def aln(spark, *places):
    rows = [("l", f"r{i}", i, "I", s, e, fwd, "A", e - s, 0, 1, "A" * (e - s)) for i, (s, e, fwd) in enumerate(places)]
    return spark.createDataFrame(rows, ALN)


def feature(spark, s, e, strand, overlap):
    rows = spark.createDataFrame([("f", "I", s, e, strand)], "feature_id string, chrom string, fs long, fe long, strand boolean")
    return reference.with_records(intervals.with_shift(rows.crossJoin(rule_table(spark, [Rule(overlap=overlap)]).drop("key", "val", "sources", "types"))))


# feature, kind, places that fit, places that do not
TABLE = [
    ((5, 10, True), "nested", [(7, 8, True), (5, 9, True), (6, 10, True)], [(4, 8, True), (7, 11, True)]),
    ((5, 10, True), "partial", [(4, 8, True), (7, 11, True), (5, 9, True), (6, 10, True)], [(10, 12, True), (3, 5, True)]),
    ((5, 9, True), "exact", [(5, 9, True)], [(5, 8, True), (6, 9, True), (4, 8, True), (6, 10, True)]),
    ((5, 10, True), "5' anchored", [(5, 10, True), (5, 9, True), (6, 10, False), (5, 10, False)], [(6, 10, True), (5, 11, True), (4, 10, False), (5, 9, False)]),
    ((5, 10, True), "3' anchored", [(5, 10, True), (6, 10, True), (5, 9, False), (5, 10, False)], [(5, 9, True), (4, 10, True), (5, 11, False), (6, 10, False)]),
    ((5, 10, None), "5' anchored", [(5, 9, True), (6, 10, True), (5, 10, False)], [(6, 9, True), (4, 10, True)]),
    ((5, 10, True), "anchored", [(5, 9, True), (6, 10, True), (5, 10, True)], [(6, 9, True), (5, 11, True)]),
]


@pytest.mark.parametrize(("f", "kind", "good", "bad"), TABLE)
def test_overlap_kinds(spark, f, kind, good, bad):
    pairs = select.candidate_pairs(aln(spark, *good, *bad), feature(spark, *f, kind), small=True)
    assert {r["row_key"] for r in pairs.where(select.passes()).collect()} == set(range(len(good)))


@pytest.mark.parametrize("small", [True, False])
def test_interval_join_is_a_range_join(spark, small):
    import random

    rng = random.Random(3)
    left = [(rng.randrange(20000), rng.randint(1, 40), rng.choice("xy")) for _ in range(200)]
    right = [(rng.randrange(20000), rng.choice([1, 30, 200, 9000]), rng.choice("xy")) for _ in range(80)]
    a = spark.createDataFrame([(i, c, s, s + n) for i, (s, n, c) in enumerate(left)], "i int, chrom string, s long, e long")
    f = spark.createDataFrame([(i, c, s, s + n) for i, (s, n, c) in enumerate(right)], "j int, chrom string, fs long, fe long")
    got = sorted((r["i"], r["j"]) for r in intervals.interval_join(a, f, small).collect())
    want = sorted((i, j) for i, (s, n, c) in enumerate(left) for j, (t, m, d) in enumerate(right) if c == d and s < t + m and t < s + n)
    assert got == want


@pytest.mark.parametrize(("shift", "want"), [("-5,5", (5, 25)), ("-10,10", (0, 30)), ("-1,-1", (9, 19))])
def test_shifts(spark, shift, want):
    row = feature(spark, 10, 20, True, f"partial, {shift}").first()
    assert (row["fs"], row["fe"]) == want


@pytest.mark.parametrize(("strand", "want"), [(True, (5, 10)), (False, (0, 5))])
def test_asymmetric_shift_follows_the_strand(spark, strand, want):
    row = feature(spark, 0, 10, strand, "5' anchored, 5, 0").first()
    assert (row["fs"], row["fe"]) == want


@pytest.mark.parametrize(("shift", "reason"), [("0,-5", "null"), ("10,0", "inverted"), ("-1,0", "negative start")])
def test_illegal_shifts(spark, shift, reason):
    rows = spark.createDataFrame([("f", "I", 0, 5, True)], "feature_id string, chrom string, fs long, fe long, strand boolean").crossJoin(rule_table(spark, [Rule(overlap=f"exact, {shift}")]))
    assert [r["reason"] for r in intervals.illegal_shifts(rows).collect()] == [reason]
    assert intervals.with_shift(rows).isEmpty()


def test_touching_intervals_stay_apart(spark):
    rows = spark.createDataFrame([("g", 0, 10), ("g", 9, 20), ("g", 29, 40), ("s", 99, 110), ("s", 110, 120)], "k string, fs long, fe long")
    got = {(r["k"], r["fs"], r["fe"]) for r in intervals.merge_intervals(rows, ["k"]).collect()}
    assert got == {("g", 0, 20), ("g", 29, 40), ("s", 99, 110), ("s", 110, 120)}


# alignments 1..4 and features of two hand-derived runs
GOLD_ALN = [("1", "I", 0, 21, False, 1, 1), ("2", "V", 49, 71, True, 22, 2), ("2", "V", 69, 91, True, 22, 3), ("2", "V", 124, 146, True, 22, 4), ("3", "I", 20, 42, False, 13, 5), ("4", "MtDNA", 0, 18, True, 5, 6)]
GOLD_FEATURES = [("1", "I", 0, 22, False, []), ("2a", "V", 49, 72, True, ["piRNA", "CSR"]), ("2b", "V", 69, 92, False, ["miRNA", "piRNA"]), ("2c", "V", 124, 147, True, ["ALG", "CSR"]), ("3", "I", 19, 42, False, ["unknown"]), ("4", "MtDNA", 0, 18, True, ["CSR"])]


def gold(spark, sheet):
    a = spark.createDataFrame([("l", n, k, c, s, e, f, "G", e - s, 0, r, "G" * (e - s)) for n, c, s, e, f, r, k in GOLD_ALN], ALN)
    rows = spark.createDataFrame([(i, c, s, e, f, "x", "gene", [("Class", "class", v, [x.lower() for x in v])]) for i, c, s, e, f, v in GOLD_FEATURES],
                                 "feature_id string, chrom string, fs long, fe long, strand boolean, source string, type string, attrs array<struct<key:string,key_lc:string,vals:array<string>,vals_lc:array<string>>>")
    rules = rule_table(spark, sheet)
    matches = reference.feature_matches(reference.stage_one(rows, rules))
    assigned = select.assign(a, matches)
    per = C.by_alignment(select.with_loci(a), assigned)
    return a, matches, assigned, per, C.by_read(per), rules


def test_gold_run_with_one_rule(spark):
    _, _, assigned, _, reads, _ = gold(spark, [Rule()])
    counts = {r["feature_id"]: round(r["count"], 2) for r in C.feature_counts(assigned).collect()}
    assert counts == {"1": 7.0, "2a": 7.33, "2b": 7.33, "2c": 7.33, "3": 7.0, "4": 5.0}
    stats = {r["stat"]: round(r["value"], 6) for r in C.alignment_stats(reads).collect()}
    assert stats["Total Assigned Reads"] == 41 and stats["Total Unassigned Reads"] == 0 and stats["Total Assigned Sequences"] == 4
    assert stats["Assigned Single-Mapping Reads"] == 19 and stats["Assigned Multi-Mapping Reads"] == 22
    assert (stats["Reads Assigned to Single Feature"], stats["Sequences Assigned to Single Feature"]) == (5, 1)
    assert (stats["Reads Assigned to Multiple Features"], stats["Sequences Assigned to Multiple Features"]) == (36, 3)
    assert {r["length"]: round(r["G"], 6) for r in C.nt_length(reads, False).collect()} == {18: 5, 21: 1, 22: 35}


def test_gold_run_with_a_hierarchy(spark):
    sheet = [Rule("Class", "CSR", hierarchy=1, overlap="nested", strand="sense"), Rule("Class", "piRNA", hierarchy=2, strand="antisense")]
    a, matches, assigned, per, reads, rules = gold(spark, sheet)
    libraries = a.select("library").distinct()
    counts = {r["feature_id"]: round(r["count"], 2) for r in C.feature_counts(assigned).collect()}
    assert counts == {"2a": 7.33, "2b": 7.33, "2c": 7.33, "4": 5.0}
    assert {r["rule_idx"]: round(r["count"], 2) for r in C.rule_counts(assigned, rules, libraries).collect()} == {0: 19.67, 1: 7.33}
    stats = {r["stat"]: round(r["value"], 6) for r in C.alignment_stats(reads).collect()}
    assert (stats["Total Assigned Reads"], stats["Total Unassigned Reads"]) == (27, 14)
    assert (stats["Assigned Single-Mapping Reads"], stats["Assigned Multi-Mapping Reads"]) == (5, 22)
    assert {r["length"]: round(r["G"], 6) for r in C.nt_length(reads, True).collect()} == {18: 5, 22: 22}
    d = C.diagnostics(per, select.candidate_counts(a, matches)).first()
    assert (d["uncounted_plus"], d["uncounted_minus"], round(d["no_feature"], 6), d["eliminated"]) == (0, 2, 14, 0)
    check = C.stats_check(C.feature_counts(assigned), C.rule_counts(assigned, rules, libraries), C.summary_stats(reads)).first()
    assert check["agree"]


def test_a_failed_pair_uses_no_rank(spark):
    sheet = [Rule(classifier="a", hierarchy=1, nt5="C"), Rule(classifier="b", hierarchy=2)]
    assert {r["classifier"] for r in gold(spark, sheet)[2].collect()} == {"b"}


def test_unnormalized_share(spark):
    a, matches, *_ = gold(spark, [Rule()])
    counts = {r["feature_id"]: r["count"] for r in C.feature_counts(select.assign(a, matches, False, False)).collect()}
    assert counts["2a"] == 44 and counts["1"] == 14  # two alignments of 22 reads touch 2a


def test_roots_climb_to_the_highest_match(spark):
    links = spark.createDataFrame([("p", "g"), ("c", "p"), ("x", "y")], "child string, parent string")
    found = lambda ids: {r["feature_id"]: r["root"] for r in reference.roots(links, spark.createDataFrame([(i,) for i in ids], "feature_id string")).collect()}
    assert found(["c", "p"]) == {"g": "g", "p": "p", "c": "p", "x": "x", "y": "y"}
    assert found(["c", "g"])["c"] == "g" and found(["g"])["p"] == "g"


def test_a_cycle_raises(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "a")], "child string, parent string")
    with pytest.raises(ValueError):
        reference.roots(links, spark.createDataFrame([("a",)], "feature_id string"))


def test_normalization(spark):
    counts = spark.createDataFrame([("a", "f", 10.0), ("b", "f", 10.0), ("c", "f", 10.0)], "library string, feature_id string, count double")
    libraries = spark.createDataFrame([("a", " RPM "), ("b", "2.5"), ("c", "  1")], "library string, norm string")
    mapped = spark.createDataFrame([("a", 1e6), ("b", 1.0), ("c", 1.0)], "library string, mapped_reads double")
    assert {r["library"]: r["count"] for r in C.normalized(counts, libraries, mapped).collect()} == {"a": 10.0, "b": 4.0, "c": 10.0}
    with pytest.raises(Exception, match="not a normalization"):
        C.normalized(counts, libraries.withColumn("norm", F.lit("123.rpm")), mapped).collect()
