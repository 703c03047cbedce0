"""All registered queries and their oracles. Each query applies operators to the bridge tables (see ``bridge``)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..durable import durable
from ..functions import seq as S
from ..operators import counts as C
from ..operators import dge, intervals, plotdata, reads, reference, select, tiles
from ..rules import Rule, rule_table
from . import bridge as B

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CTES = B.assignment_sql()
R = C.rounded


def query(oracle: str | None = None):
    """Registers a query under its function's name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f

    return add


def _assigned(spark: SparkSession, sf: str, sheet=B.RULES) -> DataFrame:
    return select.assign(B.alignments(spark, sf), B.matches(spark, sf, sheet))


def _shares(spark, sf) -> DataFrame:
    return tiles.shares(B.alignments(spark, sf), B.matches(spark, sf), rules=B.rules(spark))


def _counts(spark, sf) -> DataFrame:
    return C.feature_counts(_shares(spark, sf))


def _per_alignment(spark, sf) -> DataFrame:
    return C.by_alignment(select.with_loci(B.alignments(spark, sf)), _assigned(spark, sf))


def _reads(spark, sf) -> DataFrame:
    return tiles.reads(B.alignments(spark, sf), B.matches(spark, sf), B.rules(spark))


def _both(spark, sf) -> tuple[DataFrame, DataFrame]:
    """(counts, reads) of one assignment, which is written once."""
    assigned = durable(_assigned(spark, sf))
    return C.feature_counts(assigned), C.by_read(C.by_alignment(select.with_loci(B.alignments(spark, sf)), assigned))


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: R(F.col(c)) for c in cols})


# ---- assignment and counts -------------------------------------------------------------------------------------------
@query(f"WITH {CTES} SELECT library, feature_id, classifier, round(count, 6) AS count FROM counts")
def feature_counts(spark, sf):
    return _rounded(_counts(spark, sf), "count")


def _overlap_query(name: str, kind: str) -> None:
    sheet = [Rule(overlap=kind)]

    def run(spark, sf):
        pairs = select.candidate_pairs(B.alignments(spark, sf), B.matches(spark, sf, sheet)).where(select.passes())
        return pairs.groupBy("feature_id").agg(F.count("*").alias("n"))

    QUERIES[name] = run
    ORACLES[name] = f"WITH {B.assignment_sql(sheet)} SELECT feature_id, count(*) AS n FROM pass GROUP BY feature_id"


for _name, _kind in [("overlap_partial", "partial"), ("overlap_nested", "nested"), ("overlap_exact", "exact"), ("overlap_anchored", "anchored"), ("overlap_anchored5", "5' anchored"), ("overlap_anchored3", "3' anchored"), ("overlap_wildcard", "any, 5, 5")]:
    _overlap_query(_name, _kind)

_SHIFTS = [Rule(overlap="nested, -10, 4"), Rule(classifier="in", overlap="partial, 30, -30"), Rule(classifier="out", overlap="exact, -2, 2")]


@query(f"WITH {B.assignment_sql(_SHIFTS)} SELECT rule_idx, feature_id, fs, fe FROM fm")
def overlap_shift(spark, sf):
    return B.matches(spark, sf, _SHIFTS).select("rule_idx", "feature_id", "fs", "fe")


@query(f"WITH {B.assignment_sql(_SHIFTS)} SELECT rule_idx, feature_id, CASE WHEN fs = fe THEN 'null' WHEN fs > fe THEN 'inverted' ELSE 'negative start' END AS reason FROM fm0 WHERE fs >= fe OR fs < 0")
def illegal_shifts(spark, sf):
    rows = reference.stage_one(B.annotation(spark, sf), B.rules(spark, _SHIFTS))
    return intervals.illegal_shifts(rows).select("rule_idx", "feature_id", "reason")


def _selected_query(name: str, sheet: list[Rule]) -> None:
    def run(spark, sf):
        return _rounded(C.selected_counts(B.alignments(spark, sf), B.matches(spark, sf, sheet)), "count")

    QUERIES[name] = run
    ORACLES[name] = f"WITH {B.assignment_sql(sheet)} SELECT library, feature_id, classifier, round(count, 6) AS count FROM counts"


_selected_query("strand_select", [Rule(classifier="s", strand="sense"), Rule("class", "hot", "a", strand="antisense")])
_selected_query("nt_length_mismatch_select", [Rule(classifier="x", nt5="A,T", length="15-20, 30", mismatch="1")])
_selected_query("hierarchy_select", [Rule("class", "hot", "h", hierarchy=2), Rule(type="PROMO", classifier="p", hierarchy=1, nt5="A"), Rule(classifier="z", hierarchy=9)])
_selected_query("column_filter", [Rule(classifier="f", source="Brand#4,brand#7", type="promo, SMALL")])


@query(f"WITH {CTES}, x AS (SELECT library, rule_idx, sum(fcorr / n_rules) AS count FROM sel GROUP BY ALL) SELECT library, rule_idx, round(coalesce(count, 0), 6) AS count FROM (SELECT DISTINCT library FROM aln) CROSS JOIN (SELECT rule_idx FROM rules) LEFT JOIN x USING (library, rule_idx)")
def rule_counts(spark, sf):
    return _rounded(C.rule_counts(_shares(spark, sf), B.rules(spark), B.libraries(spark, sf)), "count")


@query(f"WITH {CTES} SELECT library, name, loci, round(max(corr), 6) AS corr FROM al GROUP BY ALL")
def genomic_hits(spark, sf):
    return select.with_loci(B.alignments(spark, sf)).groupBy("library", "name", "loci").agg(R(F.max("corr")).alias("corr"))


@query(f"WITH {CTES} SELECT hits, count(*) AS n, round(sum(fcorr), 6) AS share FROM sel GROUP BY hits")
def feature_hits(spark, sf):
    return _assigned(spark, sf).groupBy("hits").agg(F.count("*").alias("n"), R(F.sum("fcorr")).alias("share"))


@query(f"WITH {CTES}, x AS (SELECT library, feature_id, classifier, sum(read_count) AS count FROM (SELECT DISTINCT c.library, c.name, c.row_key, feature_id, classifier, read_count FROM chosen c JOIN aln USING (library, name, row_key)) GROUP BY ALL) SELECT library, feature_id, classifier, round(CAST(count AS DOUBLE), 6) AS count FROM x")
def unnormalized_counts(spark, sf):
    assigned = select.assign(B.alignments(spark, sf), B.matches(spark, sf), norm_loci=False, norm_hits=False)
    return _rounded(C.feature_counts(assigned), "count")


_STATS = """
SELECT library, unnest(['Total Assigned Reads', 'Total Unassigned Reads', 'Total Assigned Sequences', 'Total Unassigned Sequences', 'Assigned Single-Mapping Reads', 'Assigned Multi-Mapping Reads', 'Reads Assigned to Single Feature', 'Sequences Assigned to Single Feature', 'Reads Assigned to Multiple Features', 'Sequences Assigned to Multiple Features']) AS stat,
  unnest([round(CAST(x AS DOUBLE), 6) FOR x IN [sum(assigned), sum(unassigned), sum(CASE WHEN n_features > 0 THEN 1.0::DOUBLE ELSE 0 END), sum(CASE WHEN n_features > 0 THEN 0.0::DOUBLE ELSE 1 END),
    sum(CASE WHEN n_features > 0 AND loci = 1 THEN assigned ELSE 0 END), sum(CASE WHEN n_features > 0 AND loci > 1 THEN assigned ELSE 0 END),
    sum(CASE WHEN n_features = 1 THEN assigned ELSE 0 END), sum(CASE WHEN n_features = 1 THEN 1.0::DOUBLE ELSE 0 END),
    sum(CASE WHEN n_features > 1 THEN assigned ELSE 0 END), sum(CASE WHEN n_features > 1 THEN 1.0::DOUBLE ELSE 0 END)]]) AS value
FROM reads GROUP BY library
"""


@query(f"WITH {CTES} {_STATS}")
def alignment_stats(spark, sf):
    return _rounded(C.alignment_stats(_reads(spark, sf)), "value")


@query(f"WITH {CTES} SELECT library, count(*) AS mapped_sequences, round(sum(assigned + unassigned), 6) AS mapped_reads, round(sum(assigned), 6) AS assigned_reads, CAST(sum(read_count) AS BIGINT) AS raw_reads FROM reads GROUP BY library")
def summary_stats(spark, sf):
    return _rounded(C.summary_stats(_reads(spark, sf)), "mapped_reads", "assigned_reads")


_PIVOT = ", ".join(f"round(coalesce(sum(v) FILTER (nt5 = '{b}'), 0), 6) AS {b}" for b in "ACGT")


@query(f"WITH {CTES} SELECT library, length, {_PIVOT} FROM (SELECT *, assigned + unassigned AS v FROM reads) GROUP BY ALL")
def nt_len_mapped(spark, sf):
    return _rounded(C.nt_length(_reads(spark, sf), False), *"ACGT")


@query(f"WITH {CTES} SELECT library, length, {_PIVOT} FROM (SELECT *, assigned AS v FROM reads WHERE n_features > 0) GROUP BY ALL")
def nt_len_assigned(spark, sf):
    return _rounded(C.nt_length(_reads(spark, sf), True), *"ACGT")


_CAND = "cd AS (SELECT library, name, row_key, count(DISTINCT (feature_id, classifier, strand, fs, fe)) AS candidates FROM cand GROUP BY ALL)"


@query(f"WITH {CTES}, cc AS (SELECT DISTINCT library, name, row_key FROM cand) SELECT library, CAST(sum(CASE WHEN fwd THEN 1 ELSE 0 END) AS BIGINT) AS uncounted_plus, CAST(sum(CASE WHEN fwd THEN 0 ELSE 1 END) AS BIGINT) AS uncounted_minus, round(sum(CASE WHEN cc.library IS NULL THEN corr ELSE 0 END), 6) AS no_feature, round(sum(CASE WHEN cc.library IS NULL THEN 0 ELSE corr END), 6) AS eliminated FROM per_aln LEFT JOIN cc USING (library, name, row_key) WHERE hits = 0 GROUP BY library")
def assignment_diags(spark, sf):
    cand = select.candidate_counts(B.alignments(spark, sf), B.matches(spark, sf))
    return _rounded(C.diagnostics(_per_alignment(spark, sf), cand), "no_feature", "eliminated")


@query(f"WITH {CTES}, {_CAND} SELECT candidates, count(*) AS n FROM cd GROUP BY candidates")
def candidates(spark, sf):
    return select.candidate_counts(B.alignments(spark, sf), B.matches(spark, sf)).groupBy("candidates").agg(F.count("*").alias("n"))


@query(f"WITH {CTES} SELECT library, chrom, count(*) AS n FROM aln WHERE chrom NOT IN (SELECT chrom FROM features WHERE type <> 'PROMO' AND CAST(feature_id AS BIGINT) % 5 < 3) GROUP BY ALL")
def chrom_misses(spark, sf):
    known = B.annotation(spark, sf).where("type <> 'PROMO' and cast(feature_id as bigint) % 5 < 3")
    return C.chrom_misses(B.alignments(spark, sf), known)


@query(f"""WITH {CTES}, x AS (SELECT library, name, row_key, string_agg('(' || feature_id || ', ' || classifier || ')', '; ' ORDER BY feature_id, classifier) AS feature_hits
  FROM (SELECT DISTINCT library, name, row_key, feature_id, classifier FROM sel) GROUP BY ALL)
SELECT library, name, row_key, CASE WHEN fwd THEN seq ELSE reverse(translate(seq, 'ACGTacgt', 'TGCAtgca')) END AS sequence, read_count, round(corr, 6) AS corr, loci, chrom, s + 1 AS start, e AS "end",
  CASE WHEN fwd THEN '+' ELSE '-' END AS strand, nm, hits, coalesce(feature_hits, '') AS feature_hits FROM per_aln LEFT JOIN x USING (library, name, row_key)""")
def alignment_table(spark, sf):
    assigned = _assigned(spark, sf)
    return _rounded(C.alignment_table(C.by_alignment(select.with_loci(B.alignments(spark, sf)), assigned), assigned), "corr").withColumn("hits", F.col("hits").cast("long"))


@query(f"WITH {CTES} SELECT library, feature_id, classifier, round(coalesce(count, 0), 6) AS count FROM (SELECT DISTINCT feature_id, classifier FROM fm) CROSS JOIN (SELECT DISTINCT library FROM aln) LEFT JOIN counts USING (library, feature_id, classifier)")
def zero_filled_counts(spark, sf):
    return _rounded(C.zero_filled(_counts(spark, sf), B.matches(spark, sf), B.libraries(spark, sf)), "count")


@query(f"""WITH {CTES}, f AS (SELECT library, sum(count) AS feature_sum FROM counts GROUP BY library), r AS (SELECT library, sum(fcorr / n_rules) AS rule_sum FROM sel GROUP BY library), a AS (SELECT library, sum(assigned) AS assigned_reads FROM reads GROUP BY library)
SELECT library, round(assigned_reads, 6) AS assigned_reads, round(feature_sum, 6) AS feature_sum, round(rule_sum, 6) AS rule_sum, abs(feature_sum - assigned_reads) < 1 AND abs(rule_sum - assigned_reads) < 1 AS agree FROM a JOIN f USING (library) JOIN r USING (library)""")
def stats_check(spark, sf):
    assigned = durable(_assigned(spark, sf))
    rules = C.rule_counts(assigned, B.rules(spark), B.libraries(spark, sf))
    by_read = C.by_read(C.by_alignment(select.with_loci(B.alignments(spark, sf)), assigned))
    return _rounded(C.stats_check(C.feature_counts(assigned), rules, C.summary_stats(by_read)), "assigned_reads", "feature_sum", "rule_sum")


# ---- the interval side ----------------------------------------------------------------------------------------------
@query(f"WITH {CTES} SELECT feature_id, rule_idx, hierarchy, classifier FROM fm0")
def stage1_match(spark, sf):
    return reference.stage_one(B.annotation(spark, sf), B.rules(spark)).select("feature_id", "rule_idx", "hierarchy", "classifier")


_LINEAGE = "SELECT CAST(p_partkey AS STRING) AS child, CAST(CAST(floor(p_partkey / CAST(4 AS DOUBLE)) AS BIGINT) AS STRING) AS parent, p_size % 3 = 0 AS matched FROM {part} WHERE p_partkey >= 4"


@query(f"""WITH RECURSIVE l AS ({_LINEAGE.format(part="part")}), hit AS (SELECT child AS id FROM l WHERE matched),
up AS (SELECT child AS id, parent AS anc, 1 AS depth FROM l UNION ALL SELECT up.id, l.parent, depth + 1 FROM up JOIN l ON up.anc = l.child),
best AS (SELECT id, arg_max(anc, depth) AS root FROM up WHERE anc IN (SELECT id FROM hit) GROUP BY id)
SELECT n.id AS feature_id, coalesce(root, n.id) AS root FROM (SELECT child AS id FROM l UNION SELECT parent FROM l UNION SELECT id FROM hit) n LEFT JOIN best USING (id)""")
def root_feature(spark, sf):
    rows = spark.sql(_LINEAGE, part=spark.read.parquet(f"{sf}/part.parquet"))
    return reference.roots(rows, rows.where("matched").select(F.col("child").alias("feature_id")))


_SUBS = "SELECT CAST(p_partkey % 97 AS BIGINT) AS root, concat('chr', CAST(p_partkey % 5 AS STRING)) AS chrom, CAST((p_partkey * 53) % 3000 AS BIGINT) AS fs, CAST((p_partkey * 53) % 3000 + 15 + p_size AS BIGINT) AS fe FROM {part}"


@query(f"""WITH x AS ({_SUBS.format(part="part")}), m AS (SELECT *, max(fe) OVER (PARTITION BY root, chrom ORDER BY fs, fe ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM x),
g AS (SELECT *, sum(CASE WHEN fs < b THEN 0 ELSE 1 END) OVER (PARTITION BY root, chrom ORDER BY fs, fe ROWS UNBOUNDED PRECEDING) AS i FROM m)
SELECT root, chrom, min(fs) AS fs, max(fe) AS fe FROM g GROUP BY root, chrom, i""")
def merge_subintervals(spark, sf):
    return intervals.merge_intervals(spark.sql(_SUBS, part=spark.read.parquet(f"{sf}/part.parquet")), ["root", "chrom"])


_SEQ_RULES = [Rule(classifier="full", overlap="nested", strand="sense"), Rule(classifier="start", overlap="5' anchored, 5, 0", hierarchy=1)]


@query(f"""WITH rules AS ({B.rules_sql(_SEQ_RULES)}), q AS (SELECT concat('s', CAST(s_suppkey AS STRING)) AS feature_id, CAST(20 + s_suppkey % 40 AS BIGINT) AS n FROM supplier)
SELECT feature_id, rule_idx, strand, CASE WHEN strand THEN shift5 ELSE 0 - shift3 END AS fs, CASE WHEN strand THEN n + shift3 ELSE n - shift5 END AS fe FROM q, rules, (VALUES (TRUE), (FALSE)) v(strand)""")
def sequence_mode(spark, sf):
    seqs = spark.read.parquet(f"{sf}/supplier.parquet").selectExpr("concat('s', cast(s_suppkey as string)) as seq_id", "cast(20 + s_suppkey % 40 as bigint) as seq_len")
    return reference.sequence_features(seqs, B.rules(spark, _SEQ_RULES)).select("feature_id", "rule_idx", "strand", "fs", "fe")


@query("""WITH q AS (SELECT concat('f', CAST(p_partkey % 3 AS STRING)) AS file, concat('s', CAST(p_partkey % 701 AS STRING)) AS seq_id, p_size % 4 AS seq_len FROM part)
SELECT seq_id, 'duplicate' AS issue FROM (SELECT file, seq_id FROM q GROUP BY ALL HAVING count(*) > 1) UNION SELECT seq_id, 'inconsistent length' FROM q GROUP BY seq_id HAVING count(DISTINCT seq_len) > 1""")
def sq_checks(spark, sf):
    return reference.ambiguous_sequences(spark.read.parquet(f"{sf}/part.parquet").selectExpr("concat('f', cast(p_partkey % 3 as string)) as file", "concat('s', cast(p_partkey % 701 as string)) as seq_id", "p_size % 4 as seq_len"))


@query("""SELECT CAST(p_partkey % 101 AS STRING) AS feature_id, string_agg(DISTINCT p_name, ', ' ORDER BY p_name) AS feature_name FROM part GROUP BY 1""")
def aliases(spark, sf):
    rows = spark.read.parquet(f"{sf}/part.parquet").select((F.col("p_partkey") % 101).cast("string").alias("feature_id"), F.array(F.struct(F.lit("Name").alias("key"), F.lit("name").alias("key_lc"), F.array("p_name").alias("vals"), F.array(F.lower("p_name")).alias("vals_lc"))).alias("attrs"))
    return reference.aliases(rows, ["NAME"])


@query("SELECT source AS file, CAST(sum(CASE WHEN strand IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS no_strand, CAST(0 AS BIGINT) AS no_id FROM (" + B.FEATURES.format(part="part") + ") x GROUP BY source")
def annotation_issues(spark, sf):
    return reference.annotation_issues(B.annotation(spark, sf).withColumn("file", F.col("source")))


@query("SELECT DISTINCT concat('chr', CAST(s_suppkey % 9 AS STRING)) AS chrom FROM supplier WHERE s_suppkey % 9 IN (SELECT p_partkey % 5 FROM part)")
def chrom_overlap(spark, sf):
    genome = spark.read.parquet(f"{sf}/supplier.parquet").selectExpr("concat('chr', cast(s_suppkey % 9 as string)) as chrom")
    return reference.shared_chroms(genome, B.annotation(spark, sf))


# ---- reads ----------------------------------------------------------------------------------------------------------
_READS = "SELECT concat('lib', CAST(name % 3 AS STRING)) AS library, row_key AS read_idx, seq FROM ({}) r"
_OREADS = _READS.format(B.ALN.format(lineitem="lineitem"))


def _read_rows(spark, sf) -> DataFrame:
    rows = B.lineitem(spark, sf)
    return spark.sql(_READS.format(B.alignment_sql(rows)), lineitem=rows)


def _collapse_sql(seq: str) -> str:
    return f"""WITH r AS ({_OREADS}), t AS (SELECT library, read_idx, {seq} AS seq FROM r)
SELECT library, row_number() OVER (PARTITION BY library ORDER BY first) - 1 AS seq_id, seq, read_count FROM (SELECT library, seq, count(*) AS read_count, min(read_idx) AS first FROM t WHERE seq <> '' GROUP BY ALL)"""


@query(_collapse_sql("seq"))
def collapse(spark, sf):
    return reads.collapse(_read_rows(spark, sf))


@query(_collapse_sql("substring(seq, 5, greatest(length(seq) - 16, 0))"))
def collapse_trim(spark, sf):
    return reads.collapse(_read_rows(spark, sf), 4, 12)


@query(f"SELECT library, read_count > 4 AS above, count(*) AS n, CAST(sum(read_count) AS BIGINT) AS reads FROM ({_collapse_sql('seq')}) c GROUP BY ALL")
def collapse_threshold(spark, sf):
    above, low = reads.by_threshold(reads.collapse(_read_rows(spark, sf)), 4)
    both = above.withColumn("above", F.lit(True)).unionByName(low.withColumn("above", F.lit(False)))
    return both.groupBy("library", "above").agg(F.count("*").alias("n"), F.sum("read_count").alias("reads"))


@query(f"SELECT library, CAST(name AS STRING) AS name, row_key, unnest(range(1, read_count + 1)) AS copy FROM ({B.ALN.format(lineitem='lineitem')}) a")
def decollapse(spark, sf):
    aln = B.alignments(spark, sf).withColumn("name", F.concat(F.col("name").cast("string"), F.lit("_count="), F.col("read_count")))
    return reads.decollapse(aln).select("library", "name", "row_key", "copy")


@query(f"SELECT row_key, nt5, reverse(translate(seq, 'ACGTacgt', 'TGCAtgca')) AS rc FROM ({B.ALN.format(lineitem='lineitem')}) a")
def revcomp_nt5(spark, sf):
    aln = B.alignments(spark, sf)
    return aln.select("row_key", S.five_prime_base(F.col("seq"), F.col("fwd")).alias("nt5"), S.reverse_complement(F.col("seq")).alias("rc"))


_CIGAR = "concat(CAST(l_linenumber AS STRING), 'M', CAST(l_partkey % 3 AS STRING), 'I4=', CAST(l_suppkey % 4 AS STRING), 'D2X', CAST(l_linenumber % 2 AS STRING), 'X')"


@query("SELECT l_linenumber, l_partkey % 3 AS i, l_suppkey % 4 AS d, CAST(l_partkey % 3 + l_suppkey % 4 + 2 + l_linenumber % 2 AS INT) AS nm, count(*) AS n FROM lineitem GROUP BY ALL")
def cigar_nm(spark, sf):
    rows = B.lineitem(spark, sf).select("l_linenumber", F.expr("l_partkey % 3").alias("i"), F.expr("l_suppkey % 4").alias("d"), S.cigar_edits(F.expr(_CIGAR)).alias("nm"))
    return rows.groupBy("l_linenumber", "i", "d", "nm").agg(F.count("*").alias("n"))


_QUAL = "translate(substring(md5(CAST(l_orderkey % 5003 AS STRING)), 1, 20), '0123456789abcdef', 'IIIIIIIIIIIIIH5#')"


@query(f"""WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, seq, q FROM (SELECT l_orderkey, l_linenumber, l_partkey, translate(substring(md5(CAST(l_partkey % 997 AS STRING)), 1, 20), '0123456789abcdef', 'ACGTACGTACGTACGN') AS seq, {_QUAL} AS q FROM lineitem)),
s AS (SELECT *, list_sum([ascii(c) - 33 FOR c IN string_split(q, '')]) AS total, len([c FOR c IN string_split(q, '') IF ascii(c) - 33 < 20]) AS low FROM r)
SELECT l_linenumber, count(*) AS n, CAST(sum(l_partkey) AS BIGINT) AS parts FROM s WHERE length(replace(seq, 'N', '')) >= 19 AND total >= 30 * 20 AND low * 100 <= 10 * 20 GROUP BY l_linenumber""")
def read_filter(spark, sf):
    rows = B.lineitem(spark, sf).selectExpr("l_linenumber", "l_partkey", "translate(substring(md5(cast(l_partkey % 997 as string)), 1, 20), '0123456789abcdef', 'ACGTACGTACGTACGN') as seq", f"{_QUAL} as qual")
    return reads.quality_filter(rows).groupBy("l_linenumber").agg(F.count("*").alias("n"), F.sum("l_partkey").alias("parts"))


_GENOME = "SELECT concat('c', CAST(s_suppkey AS STRING)) AS chrom, translate(concat(md5(CAST(s_suppkey AS STRING)), md5(CAST(s_suppkey + 7 AS STRING)), md5(CAST(s_suppkey * 3 AS STRING))), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq FROM {supplier}"
_PROBES = "SELECT p_partkey AS seq_id, translate(substring(md5(CAST(p_partkey % 211 AS STRING)), CAST(1 + p_partkey % 9 AS INT), 18), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq FROM {part}"


def _probe_rows(spark, sf):
    genome = spark.sql(_GENOME, supplier=spark.read.parquet(f"{sf}/supplier.parquet"))
    return spark.sql(_PROBES, part=spark.read.parquet(f"{sf}/part.parquet")), genome


_PLACES = f"""WITH g AS ({_GENOME.format(supplier="supplier")}), p AS ({_PROBES.format(part="part")}),
q AS (SELECT seq_id, TRUE AS fwd, seq AS q FROM p UNION ALL SELECT seq_id, FALSE, reverse(translate(seq, 'ACGT', 'TGCA')) FROM p),
k AS (SELECT chrom, i - 1 AS s, substring(seq, i, 18) AS w FROM (SELECT chrom, seq, unnest(range(1, length(seq) - 16)) AS i FROM g))"""


@query(_PLACES + " SELECT seq_id, chrom, s, s + 18 AS e, fwd FROM q JOIN k ON q = w")
def kmer_align(spark, sf):
    probes, genome = _probe_rows(spark, sf)
    return reads.align(probes, genome, seed=18).select("seq_id", "chrom", "s", "e", "fwd")


# at two mismatches one of three pieces is equal: three equi-joins
_CLOSE = " UNION ".join(f"SELECT q.seq_id, chrom, s, fwd, hamming(q, w) AS nm FROM q JOIN k ON substring(q, {i}, 6) = substring(w, {i}, 6) WHERE hamming(q, w) <= 2" for i in (1, 7, 13))


@query(f"{_PLACES} {_CLOSE}")
def kmer_align_mismatch(spark, sf):
    probes, genome = _probe_rows(spark, sf)
    return reads.align(probes, genome, mismatches=2, seed=6).select("seq_id", "chrom", "s", "fwd", F.col("nm").cast("long").alias("nm"))


@query(_PLACES + " SELECT seq_id, seq FROM p WHERE seq_id NOT IN (SELECT seq_id FROM q JOIN k ON q = w)")
def unaligned_reads(spark, sf):
    probes, genome = _probe_rows(spark, sf)
    return reads.unaligned(probes, reads.align(probes, genome, seed=18))


# ---- normalisation, differential expression -------------------------------------------------------------------------
_NORM = "CASE WHEN library LIKE 'g0%' THEN 'RPM' WHEN library LIKE 'g1%' THEN '2.5' ELSE ' 1' END"


@query(f"WITH {CTES}, m AS (SELECT library, sum(assigned + unassigned) AS mapped FROM reads GROUP BY library) SELECT library, feature_id, classifier, round(count / CASE WHEN library LIKE 'g0%' THEN mapped / 1e6 WHEN library LIKE 'g1%' THEN 2.5 ELSE 1 END, 6) AS count FROM counts JOIN m USING (library)")
def norm_counts(spark, sf):
    libraries = B.libraries(spark, sf).withColumn("norm", F.expr(_NORM))
    counts, by_read = _both(spark, sf)
    return _rounded(C.normalized(counts, libraries, C.summary_stats(by_read)), "count")


_INT = "ic AS (SELECT library, feature_id, classifier, CAST(trunc(coalesce(count, 0) + 1e-9) AS BIGINT) AS count FROM (SELECT DISTINCT feature_id, classifier FROM fm) CROSS JOIN (SELECT DISTINCT library FROM aln) LEFT JOIN counts USING (library, feature_id, classifier))"
_SF = """lm AS (SELECT feature_id, classifier, avg(ln(CAST(count AS DOUBLE))) AS m FROM ic WHERE count > 0 GROUP BY ALL HAVING count(*) = (SELECT count(DISTINCT library) FROM ic)),
sf AS (SELECT library, median(count / exp(m)) AS size_factor FROM ic JOIN lm USING (feature_id, classifier) GROUP BY library)"""


def _integer(spark, sf):
    full = C.zero_filled(_counts(spark, sf), B.matches(spark, sf), B.libraries(spark, sf))
    return durable(dge.integer_counts(full.withColumn("count", F.col("count") + 1e-9)))


@query(f"WITH {CTES}, {_INT} SELECT * FROM ic WHERE (feature_id, classifier) IN (SELECT (feature_id, classifier) FROM ic GROUP BY feature_id, classifier HAVING sum(count) > 0)")
def drop_zero(spark, sf):
    return dge.without_zero_genes(_integer(spark, sf))


@query(f"WITH {CTES}, {_INT}, {_SF} SELECT library, round(size_factor, 6) AS size_factor FROM sf")
def size_factors(spark, sf):
    return _rounded(dge.size_factors(_integer(spark, sf)), "size_factor")


@query(f"WITH {CTES}, {_INT}, {_SF} SELECT library, feature_id, classifier, round(count / size_factor, 6) AS count FROM ic JOIN sf USING (library)")
def deseq_norm(spark, sf):
    counts = _integer(spark, sf)
    return _rounded(dge.normalized_counts(counts, dge.size_factors(counts)), "count")


@query("""WITH x AS (SELECT c_mktsegment AS grp, c_custkey AS id, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST((c_custkey * 7919) % 1009 AS DOUBLE) / 1009 END AS pvalue FROM customer),
r AS (SELECT *, rank() OVER (PARTITION BY grp ORDER BY pvalue) + count(*) OVER (PARTITION BY grp, pvalue) - 1 AS k, count(*) OVER (PARTITION BY grp) AS n FROM x WHERE pvalue IS NOT NULL)
SELECT grp, id, round(pvalue, 6) AS pvalue, round(least(1.0, min(pvalue * n / k) OVER (PARTITION BY grp ORDER BY pvalue DESC RANGE UNBOUNDED PRECEDING)), 6) AS padj FROM r UNION ALL SELECT grp, id, NULL, NULL FROM x WHERE pvalue IS NULL""")
def bh_adjust(spark, sf):
    rows = spark.read.parquet(f"{sf}/customer.parquet").selectExpr("c_mktsegment as grp", "c_custkey as id", "case when c_custkey % 11 = 0 then null else cast((c_custkey * 7919) % 1009 as double) / 1009 end as pvalue")
    return _rounded(dge.bh_adjusted(rows, ["grp"]), "pvalue", "padj")


_GROUPS = "SELECT n_name AS grp, n_nationkey AS ord, n_nationkey = 3 AS is_control FROM {nation}"


def _groups(spark, sf):
    return spark.sql(_GROUPS, nation=spark.read.parquet(f"{sf}/nation.parquet"))


@query(f"WITH g AS ({_GROUPS.format(nation='nation')}) SELECT a.grp AS cond1, b.grp AS cond2 FROM g a, g b WHERE a.is_control AND NOT b.is_control")
def comparisons_control(spark, sf):
    return dge.control_comparisons(_groups(spark, sf))


@query(f"WITH g AS ({_GROUPS.format(nation='nation')}) SELECT a.grp AS cond1, b.grp AS cond2, a.ord > b.ord AS flip FROM g a, g b WHERE a.ord <> b.ord")
def comparisons_all(spark, sf):
    return dge.all_comparisons(_groups(spark, sf))


@query(f"WITH {CTES}, l AS (SELECT DISTINCT split_part(library, '_rep_', 1) AS grp, split_part(library, '_rep_', 2) AS replicate FROM aln) SELECT a.grp, a.replicate AS rep1, b.replicate AS rep2 FROM l a JOIN l b ON a.grp = b.grp AND a.replicate < b.replicate")
def replicate_pairs(spark, sf):
    libs = B.libraries(spark, sf)
    return dge.replicate_pairs(libs.select(S.group_of(F.col("library")).alias("grp"), F.split("library", "_rep_")[1].alias("replicate")))


def _wald(spark, sf):
    counts = _integer(spark, sf)
    normalized = durable(dge.normalized_counts(counts, dge.size_factors(counts)))
    groups = B.libraries(spark, sf).select("library", S.group_of(F.col("library")).alias("grp"))
    comparisons = spark.createDataFrame([("g0", "g1"), ("g0", "g2")], "cond1 string, cond2 string")
    return normalized, dge.wald_tests(normalized, groups, comparisons)


_WALD = f"""WITH {CTES}, {_INT}, {_SF}, nc AS (SELECT split_part(library, '_rep_', 1) AS grp, feature_id, classifier, count / size_factor AS x FROM ic JOIN sf USING (library)),
st AS (SELECT feature_id, classifier, grp, avg(x) AS mean, coalesce(var_samp(x), 0) AS var, count(*) AS n FROM nc GROUP BY ALL),
ge AS (SELECT feature_id, classifier, avg(x) AS baseMean FROM nc GROUP BY ALL),
po AS (SELECT feature_id, classifier, sum(var * (n - 1)) / greatest(sum(n - 1), 1) AS var FROM st GROUP BY ALL),
ra AS (SELECT feature_id, classifier, baseMean, greatest((var - baseMean) / (baseMean * baseMean + 1e-12::DOUBLE), 1e-8::DOUBLE) AS raw FROM ge JOIN po USING (feature_id, classifier)),
fi AS (SELECT regr_slope(raw, 1 / baseMean) AS slope, regr_intercept(raw, 1 / baseMean) AS icept FROM ra WHERE baseMean > 0),
di AS (SELECT feature_id, classifier, baseMean, exp((ln(raw) + ln(greatest(coalesce(icept, 0.1) + coalesce(slope, 0) / greatest(baseMean, 1e-12::DOUBLE), 1e-8::DOUBLE))) / 2) AS d FROM ra, fi),
wi AS (SELECT cond1, cond2, a.feature_id, a.classifier, baseMean, (ln(b.mean + 0.5) - ln(a.mean + 0.5)) / ln(2.0::DOUBLE) AS lfc, sqrt((1 / (a.mean + 0.5) + d) / a.n + (1 / (b.mean + 0.5) + d) / b.n) / ln(2.0::DOUBLE) AS se
  FROM (VALUES ('g0', 'g1'), ('g0', 'g2')) c(cond1, cond2) JOIN st a ON a.grp = cond1 JOIN st b ON b.grp = cond2 AND b.feature_id = a.feature_id AND b.classifier = a.classifier
  JOIN di ON di.feature_id = a.feature_id AND di.classifier = a.classifier),
tt AS (SELECT *, lfc / se AS stat, 1 / (1 + 0.2316419::DOUBLE * abs(lfc / se)) AS t FROM wi),
pv AS (SELECT *, CASE WHEN baseMean > 0 THEN least(1.0, 2 * exp(-stat * stat / 2) / sqrt(2 * pi()) * t * (0.319381530::DOUBLE + t * (-0.356563782::DOUBLE + t * (1.781477937::DOUBLE + t * (-1.821255978::DOUBLE + t * 1.330274429::DOUBLE))))) END AS p FROM tt),
bh AS (SELECT *, p * count(p) OVER (PARTITION BY cond2) / (rank() OVER (PARTITION BY cond2, p IS NULL ORDER BY p) + count(*) OVER (PARTITION BY cond2, p) - 1) AS q FROM pv),
res AS (SELECT cond1, cond2, feature_id, classifier, baseMean, lfc, se, stat, p, CASE WHEN p IS NOT NULL THEN least(1.0, min(q) OVER (PARTITION BY cond2, p IS NULL ORDER BY p DESC RANGE UNBOUNDED PRECEDING)) END AS padj FROM bh)"""
_SHOWN = "feature_id, classifier, round(baseMean, 3) AS baseMean, round({0}lfc + 0.0, 3) + 0.0 AS log2FoldChange, round(se, 3) AS lfcSE, round({0}stat + 0.0, 3) + 0.0 AS stat, round(p, 3) AS pvalue, round(padj, 3) AS padj FROM res"


def _shown(df: DataFrame) -> DataFrame:
    names = ("baseMean", "log2FoldChange", "lfcSE", "stat", "pvalue", "padj")
    return df.withColumns({c: F.round(F.col(c), 3) + 0.0 for c in names})


@query(f"{_WALD} SELECT cond1, cond2, {_SHOWN.format('')}")
def wald_dge(spark, sf):
    return _shown(_wald(spark, sf)[1])


@query(f"{_WALD} SELECT cond2 AS cond1, cond1 AS cond2, {_SHOWN.format('-')}")
def dge_flipped(spark, sf):
    return _shown(dge.flipped(_wald(spark, sf)[1]))


@query()
def pca(spark, sf):
    return dge.principal_components(_wald(spark, sf)[0])


# ---- plot data ------------------------------------------------------------------------------------------------------
@query(f"WITH {CTES} SELECT library, classifier, round(sum(count), 6) AS count FROM counts GROUP BY ALL")
def class_counts(spark, sf):
    return _rounded(plotdata.class_counts(_counts(spark, sf)), "count")


_MAPPED = "mp AS (SELECT library, sum(assigned + unassigned) AS mapped FROM reads GROUP BY library)"


def _share_sql(label: str, source: str, un: str) -> str:
    return f"""WITH {CTES}, {_MAPPED}, p AS (SELECT library, CAST({label} AS STRING) AS {label}, round_even(count / mapped, 4) AS proportion FROM ({source}) JOIN mp USING (library))
SELECT library, {label}, round(proportion, 6) AS proportion FROM p UNION ALL SELECT library, '{un}', round(1 - sum(proportion), 6) FROM p GROUP BY library HAVING 1 - sum(proportion) >= 0.0001"""


@query(_share_sql("classifier", "SELECT library, classifier, sum(count) AS count FROM counts GROUP BY ALL", "_UNASSIGNED_"))
def class_props(spark, sf):
    counts, by_read = _both(spark, sf)
    return _rounded(plotdata.proportions(plotdata.class_counts(counts), C.summary_stats(by_read), "classifier"), "proportion")


@query(_share_sql("rule_idx", "SELECT library, rule_idx, coalesce(sum(fcorr / n_rules), 0) AS count FROM (SELECT DISTINCT library FROM aln) CROSS JOIN (SELECT rule_idx FROM rules) LEFT JOIN sel USING (library, rule_idx) GROUP BY ALL", "N"))
def rule_props(spark, sf):
    assigned = durable(_assigned(spark, sf))
    counts = C.rule_counts(assigned, B.rules(spark), B.libraries(spark, sf))
    by_read = C.by_read(C.by_alignment(select.with_loci(B.alignments(spark, sf)), assigned))
    return _rounded(plotdata.proportions(counts, C.summary_stats(by_read), "rule_idx", unassigned="N"), "proportion")


_AVG = f"WITH {CTES}, z AS (SELECT library, feature_id, classifier, coalesce(count, 0) AS count FROM (SELECT DISTINCT feature_id, classifier FROM fm) CROSS JOIN (SELECT DISTINCT library FROM aln) LEFT JOIN counts USING (library, feature_id, classifier)), av AS (SELECT feature_id, classifier, split_part(library, '_rep_', 1) AS grp, avg(count) AS count FROM z GROUP BY ALL)"


def _averages(spark, sf):
    return plotdata.sample_averages(C.zero_filled(_counts(spark, sf), B.matches(spark, sf), B.libraries(spark, sf)))


@query(_AVG + " SELECT feature_id, classifier, grp, round(count, 6) AS count FROM av")
def sample_avg(spark, sf):
    return _rounded(_averages(spark, sf), "count")


@query(_AVG + ", w AS (SELECT feature_id, classifier, sum(count) FILTER (grp = 'g0') AS x, sum(count) FILTER (grp = 'g1') AS y FROM av GROUP BY ALL) SELECT feature_id, classifier, round(x, 6) AS x, round(y, 6) AS y FROM w WHERE x > 0 OR y > 0")
def scatter_points(spark, sf):
    return _rounded(plotdata.scatter_points(_averages(spark, sf), "g0", "g1"), "x", "y")


@query(_AVG + " SELECT round(log2(min(count) FILTER (count > 0)), 6) AS lo, round(log2(max(count)), 6) AS hi FROM av")
def scatter_limits(spark, sf):
    return _rounded(plotdata.view_limits(_averages(spark, sf)), "lo", "hi")


@query(f"""WITH {CTES}, mt AS (SELECT library, length, {', '.join(f"coalesce(sum(assigned + unassigned) FILTER (nt5 = '{b}'), 0) AS {b}" for b in 'ACGT')} FROM reads GROUP BY ALL),
t AS (SELECT library, sum(A) + sum(C) + sum(G) + sum(T) AS total FROM mt GROUP BY library), ax AS (SELECT library, total, CAST(unnest(range(14, 37)) AS INT) AS length FROM t)
SELECT library, length, {', '.join(f'round(coalesce({b}, 0) / total, 6) AS {b}' for b in 'ACGT')} FROM ax LEFT JOIN mt USING (library, length)""")
def len_dist_props(spark, sf):
    return _rounded(plotdata.length_proportions(C.nt_length(_reads(spark, sf), False), shortest=14, longest=36), *"ACGT")


@query(_AVG + " SELECT feature_id, classifier, grp, round(count, 6) AS count FROM av WHERE NOT EXISTS (SELECT 1 FROM part WHERE CAST(p_partkey AS STRING) = av.feature_id AND p_size < 5)")
def dge_outgroup(spark, sf):
    results = spark.read.parquet(f"{sf}/part.parquet").selectExpr("cast(p_partkey as string) as feature_id", "p_size / 100 as padj").join(B.matches(spark, sf).select("feature_id", "classifier").distinct(), "feature_id")
    return _rounded(plotdata.outgroup(_averages(spark, sf), results), "count")


@query(f"WITH {CTES} SELECT library, feature_id, classifier, round(count, 6) AS count FROM counts WHERE lower(classifier) NOT IN ('hot', 'rest')")
def class_filter(spark, sf):
    return _rounded(plotdata.class_filter(_counts(spark, sf), exclude=["HOT", "Rest"]), "count")


# ---- text and sheets ------------------------------------------------------------------------------------------------
@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_field(spark, sf):
    return spark.read.parquet(f"{sf}/events.parquet").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("SELECT DISTINCT p_brand AS name, CASE WHEN regexp_matches(x, '^([0-9_]|\\.[0-9])|^$') THEN 'X' || x ELSE x END AS safe FROM (SELECT p_brand, regexp_replace(p_brand, '[^A-Za-z0-9._]', '.', 'g') AS x FROM part)")
def r_safe_names(spark, sf):
    return spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_brand").alias("name")).distinct().withColumn("safe", S.r_safe(F.col("name")))


@query("SELECT p_brand AS name, row_number() OVER (ORDER BY split_part(p_brand, '#', 1), CAST(split_part(p_brand, '#', 2) AS INT)) AS n FROM (SELECT DISTINCT p_brand FROM part)")
def natural_sort(spark, sf):
    """Class names in their order (one row for each distinct name, sorted within one array)."""
    names = spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_brand").alias("name")).distinct()
    order = names.agg(F.array_sort(F.collect_set(F.struct(S.natural_key(F.col("name")).alias("key"), "name"))).alias("x"))
    return order.select(F.posexplode("x").alias("n", "x")).select("x.name", (F.col("n") + 1).cast("long").alias("n"))


@query("SELECT min(n_nationkey) AS rule_idx, CAST(n_regionkey AS VARCHAR) AS val, CAST(arg_min(n_nationkey % 7, n_nationkey) AS INT) AS hierarchy FROM nation GROUP BY n_regionkey")
def dup_rules(spark, sf):
    """A sheet of one rule for each nation; of those that differ in their hierarchy alone the first stays."""
    nations = spark.read.parquet(f"{sf}/nation.parquet").select("n_nationkey", "n_regionkey").orderBy("n_nationkey").collect()
    return rule_table(spark, [Rule("region", str(r[1]), "c", hierarchy=r[0] % 7) for r in nations]).select(F.col("rule_idx").cast("long").alias("rule_idx"), "val", "hierarchy")


#: What the sheet of the bridge means, written out by hand: the check of the parser.
_PARSED = """SELECT * FROM (VALUES
 (0, 'class', 'small', 'little', 1, 'nested', 0, 0, TRUE, NULL, NULL),
 (1, 'class', 'hot', 'hot', 2, 'partial', 0, 0, FALSE, NULL, NULL),
 (2, 'class', 'red', 'red', 2, 'anchored', 0, 0, NULL, NULL, NULL),
 (3, 'brand', 'brand#4', 'b4', 1, '5'' anchored', -3, 2, NULL, NULL, NULL),
 (4, 'brand', NULL, 'any brand', 3, '3'' anchored', 0, 0, NULL, 'A,T', NULL),
 (5, 'class', 'blue', 'blue', 3, 'partial', -2, 5, NULL, NULL, '15,16,17,18,19,20,25'),
 (6, NULL, NULL, 'rest', 5, 'nested', 0, 0, NULL, 'C,G', '18,19,20,21,22,23,24,25,26,27,28,29,30,31,32'),
 (7, 'class', 'blue', 'blue too', 3, 'partial', 0, 0, NULL, NULL, '15,16,17,18,19,20,21,22,23,24')
) v(rule_idx, key, val, classifier, hierarchy, overlap, shift5, shift3, sense, nts, lengths)"""


@query(_PARSED)
def parsed_rules(spark, sf):
    return B.rules(spark).select("rule_idx", "key", "val", "classifier", "hierarchy", "overlap", "shift5", "shift3", "sense", F.array_join(F.array_sort("nts"), ",").alias("nts"), F.array_join(F.col("lengths").cast("array<string>"), ",").alias("lengths"))


from . import files  # noqa: E402, F401  (registers the queries that go through files)
