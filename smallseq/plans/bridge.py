"""Small-RNA tables projected from the star-schema test tables, by expressions that Spark SQL and DuckDB share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import reference
from ..rules import Rule, rule_table

#: Alignments from lineitem: a read (order) has a library, a count and several places.
ALN = """
SELECT library, name, row_key, chrom, s, s + length AS e, fwd,
       CASE WHEN fwd THEN substring(seq, 1, 1) ELSE translate(substring(seq, length(seq), 1), 'ACGT', 'TGCA') END AS nt5, length, nm, read_count, seq
FROM (
  SELECT concat('g', CAST(l_orderkey % 3 AS STRING), '_rep_', CAST(CAST(floor(l_orderkey / CAST(3 AS DOUBLE)) AS BIGINT) % 2 + 1 AS STRING)) AS library,
         l_orderkey AS name, ((l_orderkey * 8 + l_linenumber) * 4000037 + l_partkey) * 400009 + l_suppkey AS row_key,
         concat('chr', CAST(l_suppkey % 5 AS STRING)) AS chrom, CAST((l_orderkey * 37 + l_linenumber * 11) % 50000 AS BIGINT) AS s,
         l_linestatus = 'O' AS fwd, CAST(15 + CAST(l_quantity AS INT) % 18 AS INT) AS length, CAST(l_linenumber % 3 AS INT) AS nm, CAST(1 + l_orderkey % 7 AS BIGINT) AS read_count,
         substring(translate(md5(CAST(l_partkey % 997 AS STRING)), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, CAST(15 + CAST(l_quantity AS INT) % 18 AS INT)) AS seq
  FROM {lineitem}
) x
"""
#: The wide form of a row's key, for tables whose keys pass 64 bits.
_KEY, _WIDE_KEY = "((l_orderkey * 8 ", "((CAST(l_orderkey AS DECIMAL(20, 0)) * 8 "
#: Annotation rows from part; every third is unstranded, the first 50 of each 2000 are long.
FEATURES = """
SELECT CAST(p_partkey AS STRING) AS feature_id, concat('chr', CAST(p_partkey % 5 AS STRING)) AS chrom, CAST((p_partkey * 53) % 50000 AS BIGINT) AS fs,
       CAST((p_partkey * 53) % 50000 + 15 + p_size + CASE WHEN p_partkey % 2000 < 50 THEN 6000 ELSE 0 END AS BIGINT) AS fe,
       CASE WHEN p_partkey % 3 = 0 THEN CAST(NULL AS BOOLEAN) ELSE p_partkey % 3 = 1 END AS strand,
       p_brand AS source, p_type AS type, split_part(p_name, ' ', 1) AS cls
FROM {part}
"""
#: Rules that use every selector; the classifier is the rule's, hierarchies tie and nest.
RULES = [
    Rule("class", "small", "little", hierarchy=1, overlap="nested", strand="sense"),
    Rule("class", "hot", "hot", type="ECONOMY, PROMO, LARGE", hierarchy=2, overlap="partial", strand="antisense"),
    Rule("class", "red", "red", hierarchy=2, overlap="anchored", mismatch="0, 2"),
    Rule("brand", "Brand#4", "b4", hierarchy=1, overlap="5' anchored, -3, 2"),
    Rule("brand", "", "any brand", source="Brand#7, Brand#8, Brand#9", hierarchy=3, overlap="3' anchored", nt5="A, U"),
    Rule("class", "blue", "blue", hierarchy=3, overlap="partial, -2, 5", length="15-20, 25"),
    Rule("", "", "rest", hierarchy=5, overlap="nested", nt5="G,C", length="18-32"),
    Rule("class", "blue", "blue too", hierarchy=3, overlap="partial", length="15-24"),
]


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def _keys_fit(rows: DataFrame) -> bool:
    """Whether every key of these rows is a long, by the largest value of each column that it is made of."""
    parts = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    found = rows.agg(*[f(c) for c in parts for f in (F.min, F.max)]).first()
    order, line, part, supp = (max(abs(found[i] or 0), abs(found[i + 1] or 0)) for i in range(0, len(found), 2))
    return ((order * 8 + line) * 4000037 + part) * 400009 + supp < 1 << 63


def alignment_sql(rows: DataFrame) -> str:
    """ALN for these rows of lineitem: its row_key is a long where that holds every key, else the same number as decimal(38, 0)."""
    return ALN if _keys_fit(rows) else ALN.replace(_KEY, _WIDE_KEY)


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lineitem(spark, sf_dir)
    return spark.sql(alignment_sql(rows), lineitem=rows)


def annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.sql(FEATURES, part=spark.read.parquet(f"{sf_dir}/part.parquet"))
    attr = lambda key, col: F.struct(F.lit(key).alias("key"), F.lit(key.lower()).alias("key_lc"), F.array(col).alias("vals"), F.array(F.lower(col)).alias("vals_lc"))
    return rows.withColumn("attrs", F.array(attr("Class", F.col("cls")), attr("Brand", F.col("source"))))


def rules(spark: SparkSession, sheet: list[Rule] = RULES) -> DataFrame:
    return rule_table(spark, sheet)


def matches(spark: SparkSession, sf_dir: str, sheet: list[Rule] = RULES) -> DataFrame:
    return reference.feature_matches(reference.stage_one(annotation(spark, sf_dir), rules(spark, sheet)))


def libraries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ALN, lineitem=lineitem(spark, sf_dir)).select("library").distinct()


def _text(x) -> str:
    if x is None:
        return "NULL"
    if isinstance(x, bool):
        return str(x).upper()
    if isinstance(x, list):
        return "[" + ", ".join(map(_text, x)) + "]"
    return "'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x)


def rules_sql(sheet: list[Rule] = RULES) -> str:
    from ..rules import SCHEMA, unique_rules

    names = ", ".join(f.name for f in SCHEMA.fields)
    rows = ",\n    ".join("(" + ", ".join(map(_text, r.typed(i))) + ")" for i, r in unique_rules(sheet))
    return f"SELECT * FROM (VALUES\n    {rows}) v({names})"


def assignment_sql(sheet: list[Rule] = RULES) -> str:
    """CTEs for DuckDB: aln, features, rules, fm (matches), cand (overlaps), sel (assigned), per_aln, reads."""
    return f"""
aln AS ({ALN.format(lineitem="lineitem")}),
loci AS (SELECT library, name, count(*) AS loci FROM aln GROUP BY ALL),
al AS (SELECT aln.*, loci, CAST(read_count AS DOUBLE) / loci AS corr FROM aln JOIN loci USING (library, name)),
features AS ({FEATURES.format(part="part")}),
rules AS ({rules_sql(sheet)}),
fm0 AS (
  SELECT f.feature_id, f.chrom, f.strand, r.*,
         CASE WHEN f.strand THEN fs + shift5 WHEN NOT f.strand THEN fs - shift3 ELSE fs - greatest(shift5, shift3) END AS fs,
         CASE WHEN f.strand THEN fe + shift3 WHEN NOT f.strand THEN fe - shift5 ELSE fe + greatest(shift5, shift3) END AS fe
  FROM features f JOIN rules r ON (r.key IS NULL OR r.key IN ('class', 'brand'))
   AND (r.val IS NULL OR (r.key = 'class' AND lower(f.cls) = r.val) OR (r.key = 'brand' AND lower(f.source) = r.val) OR (r.key IS NULL AND r.val IN (lower(f.cls), lower(f.source))))
   AND (r.sources IS NULL OR list_contains(r.sources, lower(f.source))) AND (r.types IS NULL OR list_contains(r.types, lower(f.type)))
),
fm AS (SELECT * FROM fm0 WHERE fs < fe AND fs >= 0),
cand AS (SELECT a.*, m.* EXCLUDE (chrom) FROM al a JOIN fm m ON a.chrom = m.chrom AND a.s < m.fe AND m.fs < a.e),
pass AS (
  SELECT *, min(hierarchy) OVER (PARTITION BY library, name, row_key) AS best FROM cand
  WHERE CASE overlap WHEN 'partial' THEN TRUE WHEN 'nested' THEN fs <= s AND e <= fe WHEN 'exact' THEN fs = s AND e = fe
        WHEN 'anchored' THEN (s = fs AND e <= fe) OR (e = fe AND s >= fs)
        WHEN '5'' anchored' THEN CASE WHEN strand IS NULL THEN (s = fs AND e <= fe) OR (e = fe AND s >= fs) WHEN fwd THEN s = fs AND e <= fe ELSE e = fe AND s >= fs END
        ELSE CASE WHEN strand IS NULL THEN (s = fs AND e <= fe) OR (e = fe AND s >= fs) WHEN fwd THEN e = fe AND s >= fs ELSE s = fs AND e <= fe END END
    AND (mismatches IS NULL OR list_contains(mismatches, nm)) AND (sense IS NULL OR strand IS NULL OR (fwd = strand) = sense)
    AND (nts IS NULL OR list_contains(nts, nt5)) AND (lengths IS NULL OR list_contains(lengths, length))
),
chosen AS (SELECT DISTINCT library, name, row_key, feature_id, classifier, rule_idx, corr, loci FROM pass WHERE hierarchy = best),
hits AS (SELECT library, name, row_key, count(*) AS hits FROM (SELECT DISTINCT library, name, row_key, feature_id, classifier FROM chosen) GROUP BY ALL),
sel AS (
  SELECT c.*, hits, count(*) OVER (PARTITION BY c.library, c.name, c.row_key, feature_id, classifier) AS n_rules, corr / hits AS fcorr
  FROM chosen c JOIN hits USING (library, name, row_key)
),
per_aln AS (
  SELECT al.*, coalesce(x.assigned, 0) AS assigned, coalesce(x.hits, 0) AS hits, CASE WHEN x.hits IS NULL THEN corr ELSE 0 END AS unassigned
  FROM al LEFT JOIN (SELECT library, name, row_key, sum(fcorr / n_rules) AS assigned, max(hits) AS hits FROM sel GROUP BY ALL) x USING (library, name, row_key)
),
nf AS (SELECT library, name, count(DISTINCT feature_id) AS n_features FROM sel GROUP BY ALL),
reads AS (
  SELECT p.*, coalesce(n_features, 0) AS n_features FROM (
    SELECT library, name, any_value(loci) AS loci, any_value(read_count) AS read_count, sum(assigned) AS assigned, sum(unassigned) AS unassigned,
           arg_min(nt5, row_key) AS nt5, arg_min(length, row_key) AS length FROM per_aln GROUP BY library, name) p LEFT JOIN nf USING (library, name)
),
counts AS (SELECT library, feature_id, classifier, sum(fcorr / n_rules) AS count FROM sel GROUP BY ALL)
"""
