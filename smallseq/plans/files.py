"""Queries that write the test tables in a file format and read them back through the sources, and those of reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..durable import new_folder
from ..functions import seq as S
from ..operators import counts as C
from ..operators import dge, plotdata, reads, reference, validate
from ..sources import sheets, sinks, textual
from . import bridge as B
from .registry import _AVG, _GENOME, _MAPPED, _PROBES, CTES, R, _averages, _both, _collapse_sql, _counts, _probe_rows, _read_rows, _rounded, query


def _written(df: DataFrame, value: str, name: str) -> str:
    """The expression ``value`` of each row, as lines of text files (whole records in one file each)."""
    path = new_folder(df.sparkSession, name)
    df.selectExpr(f"{value} AS value").write.text(path)
    return path


def _part(spark, sf) -> DataFrame:
    return spark.read.parquet(f"{sf}/part.parquet")


# ---- reads and alignments -------------------------------------------------------------------------------------------
_FASTQ = "SELECT concat('r', CAST(p_partkey AS STRING), ' x') AS qname, translate(substring(md5(CAST(p_partkey AS STRING)), 1, 20), '0123456789abcdef', 'ACGTACGTACGTACGN') AS seq, substring(md5(CAST(p_partkey + 1 AS STRING)), 1, 20) AS qual FROM {part}"


@query(_FASTQ.format(part="part"))
def fastq_scan(spark, sf):
    path = _written(spark.sql(_FASTQ, part=_part(spark, sf)), r"concat('@', qname, '\n', seq, '\n+\n', qual)", "fastq")
    return textual.fastq(spark, path).select("qname", "seq", "qual")


@query(f"SELECT seq, count(*) AS n FROM ({_FASTQ.format(part='part')}) f GROUP BY seq")
def fastq_sequences(spark, sf):
    path = _written(spark.sql(_FASTQ, part=_part(spark, sf)), r"concat('@', qname, '\n', seq, '\n+\n', qual)", "fastq")
    return textual.fastq_sequences(spark, path).groupBy("seq").agg(F.count("*").alias("n"))


_ALL = _collapse_sql("seq").replace("concat('lib', CAST(name % 3 AS STRING)) AS library", "'all' AS library")


@query(f"SELECT seq_id, read_count, seq, read_count <= 100 AS low FROM ({_ALL}) c")
def fasta_sink(spark, sf):
    """Collapsed reads written as FASTA, the rare ones beside it, and both read back."""
    path = f"{new_folder(spark, 'fasta')}/reads"
    sinks.fasta(reads.collapse(_read_rows(spark, sf).withColumn("library", F.lit("all"))), path, threshold=100)
    both = [textual.collapsed_fasta(spark, p).withColumn("low", F.lit(low)) for p, low in ((path, False), (path + "_lowcounts", True))]
    return both[0].unionByName(both[1]).select("seq_id", "read_count", "seq", "low")


@query(f"SELECT max(seq_id) + 1 AS unique_sequences FROM ({_ALL}) c")
def unique_sequences(spark, sf):
    path = f"{new_folder(spark, 'fasta')}/reads"
    sinks.fasta(reads.collapse(_read_rows(spark, sf).withColumn("library", F.lit("all"))), path)
    found = textual.unique_count(textual.collapsed_fasta(spark, path))
    return found.agg(F.max("unique").alias("unique_sequences"))


_SAM = """SELECT p_partkey AS id, concat(CAST(p_partkey AS STRING), '_count=', CAST(1 + p_size % 9 AS STRING)) AS name, CAST(CASE WHEN p_partkey % 7 = 0 THEN 4 WHEN p_partkey % 3 = 0 THEN 16 ELSE 0 END AS INT) AS flag,
 concat('chr', CAST(p_partkey % 5 AS STRING)) AS chrom, CAST(p_partkey * 31 AS BIGINT) AS s, translate(substring(md5(CAST(p_partkey AS STRING)), 1, CAST(15 + p_size % 15 AS INT)), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq, CAST(p_partkey % 4 AS INT) AS edits FROM {part}"""
_SAM_LINE = r"concat_ws('\t', name, flag, chrom, s + 1, 255, concat(length(seq) - 2, 'M2I'), '*', 0, 0, seq, repeat('I', length(seq)), 'XA:i:0'{})"
_SAM_OUT = "SELECT name, chrom, s, s + length(seq) AS e, flag = 0 AS fwd, CASE WHEN flag = 0 THEN substring(seq, 1, 1) ELSE translate(substring(seq, length(seq), 1), 'ACGT', 'TGCA') END AS nt5, CAST(length(seq) AS INT) AS length, {} AS nm, CAST(split_part(name, '=', 2) AS BIGINT) AS read_count, seq FROM ({}) a WHERE flag <> 4"
_SAM_COLS = ("name", "chrom", "s", "e", "fwd", "nt5", "length", "nm", "read_count", "seq")


@query(_SAM_OUT.format("CASE WHEN id % 2 = 0 OR id <= 1 THEN edits ELSE 0 END", _SAM.format(part="part")))
def sam_scan(spark, sf):
    """Alignments with edit tags (the first record has one, others may lack theirs)."""
    rows = spark.sql(_SAM, part=_part(spark, sf)).orderBy("id").coalesce(1)
    path = _written(rows, _SAM_LINE.format(r", case when id % 2 = 0 or id <= 1 then concat('NM:i:', edits) else 'MD:Z:9' end"), "sam")
    return textual.alignments(spark, path, "lib").select(*_SAM_COLS)


@query(_SAM_OUT.format("2", _SAM.format(part="part")))
def sam_cigar_scan(spark, sf):
    """Alignments without tags: edits come from the CIGAR."""
    path = _written(spark.sql(_SAM, part=_part(spark, sf)), _SAM_LINE.format(""), "sam")
    return textual.alignments(spark, path, "lib").select(*_SAM_COLS)


@query(f"SELECT split_part(name, '_', 1) AS name, chrom, count(*) AS n FROM (SELECT name, chrom, unnest(range(0, 1 + CAST(split_part(name, '=', 2) AS BIGINT) - 1)) FROM ({_SAM.format(part='part')}) a WHERE flag <> 4) GROUP BY ALL")
def decollapsed_sam(spark, sf):
    """Alignment text with each line as often as its read was seen, read back."""
    path = _written(spark.sql(_SAM, part=_part(spark, sf)), _SAM_LINE.format(""), "sam")
    out = new_folder(spark, "decollapsed")
    sinks.decollapsed_alignments(textual.alignments(spark, path, "lib", raw=True), ["@HD\tVN:1.0", "@SQ\tSN:chr0\tLN:9"], out)
    back = textual.alignments(spark, out, "lib")
    return back.groupBy("name", "chrom").agg(F.count("*").alias("n"))


_SQ = "SELECT concat('chr', CAST(s_suppkey AS STRING)) AS seq_id, CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE CAST(s_suppkey * 1000 AS BIGINT) END AS seq_len FROM {supplier}"


@query(_SQ.format(supplier="supplier"))
def sam_header(spark, sf):
    rows = spark.sql(_SQ, supplier=spark.read.parquet(f"{sf}/supplier.parquet"))
    path = _written(rows, r"concat('@SQ\tSN:', seq_id, coalesce(concat('\tLN:', seq_len), ''), '\tUR:file://a:b')", "header")
    return textual.reference_sequences(textual.alignment_header(spark, path)).select("seq_id", "seq_len")


# ---- annotation and genome ------------------------------------------------------------------------------------------
_GFF = """SELECT p_partkey AS id, concat('chr', CAST(p_partkey % 5 AS STRING)) AS chrom, p_brand AS source, p_type AS type, CAST(p_partkey * 10 AS BIGINT) AS s, CAST(p_partkey * 10 + p_size AS BIGINT) AS e,
 CASE WHEN p_partkey % 3 = 0 THEN '.' WHEN p_partkey % 3 = 1 THEN '+' ELSE '-' END AS mark, split_part(p_name, ' ', 1) AS word FROM {part}"""
_GFF_LINE = r"""concat_ws('\t', chrom, source, type, s + 1, e, '.', mark, '.', case when id % 4 = 0 then concat('ID=p', id, ';Class=', word, ',b%2Cc;Note=a+b') when id % 4 = 1 then concat('gene_id "g', id, '"; Class "', word, '"; class "', word, '"')
 when id % 4 = 2 then concat('Parent=x', id, ',y;CLASS=', word) else concat('Class=', word, ' ; ID=p', id) end)"""


@query(f"""SELECT CASE WHEN id % 4 IN (0, 3) THEN 'p' || id WHEN id % 4 = 1 THEN 'g' || id ELSE 'x' || id || ',y' END AS feature_id, CASE WHEN id % 4 = 2 THEN 'x' || id || ',y' END AS parent, chrom, source, type, s AS fs, e AS fe,
CASE mark WHEN '+' THEN TRUE WHEN '-' THEN FALSE END AS strand, CASE WHEN id % 4 = 0 THEN word || ',b,c' ELSE word END AS cls FROM ({_GFF.format(part='part')}) g""")
def gff_scan(spark, sf):
    path = _written(spark.sql(_GFF, part=_part(spark, sf)), _GFF_LINE, "gff")
    rows = textual.annotation(spark, path)
    return rows.select("feature_id", "parent", "chrom", "source", "type", "fs", "fe", "strand", textual.attribute_text(F.col("attrs"), "class").alias("cls"))


@query(f"SELECT id, CASE WHEN id % 4 IN (0, 2, 3) THEN 2 + CASE WHEN id % 4 = 0 THEN 1 ELSE 0 END ELSE 2 END AS n_keys, CASE WHEN id % 4 = 0 THEN 2 WHEN id % 4 = 2 THEN 1 ELSE 1 END AS n_values FROM ({_GFF.format(part='part')}) g")
def gff_attr_parse(spark, sf):
    """Attributes of each style: the number of keys (a repeated one counts once) and of values of ``class``."""
    rows = spark.sql(_GFF, part=_part(spark, sf)).selectExpr("id", f"split({_GFF_LINE}, '\\t')[8] as text").withColumn("attrs", textual.attributes(F.col("text")))
    values = F.size(F.element_at(F.filter("attrs", lambda a: a["key_lc"] == "class"), 1)["vals"])
    return rows.select("id", F.size("attrs").alias("n_keys"), values.alias("n_values"))


@query(f"SELECT chrom, count(*) AS n FROM ({_GFF.format(part='part')}) g WHERE lower(type) <> 'economy anodized steel' GROUP BY chrom")
def gff_without_type(spark, sf):
    """Rows of the type ``chromosome`` are dropped; here one type of the test table plays it."""
    rows = spark.sql(_GFF, part=_part(spark, sf)).withColumn("type", F.expr("case when lower(type) = 'economy anodized steel' then 'Chromosome' else type end"))
    path = _written(rows, _GFF_LINE, "gff")
    return reference.without_chromosomes(textual.annotation(spark, path)).groupBy("chrom").agg(F.count("*").alias("n"))


@query(f"SELECT chrom FROM ({_GENOME.format(supplier='supplier')}) g")
def genome_chroms(spark, sf):
    path = _written(_probe_rows(spark, sf)[1], r"concat('> ', chrom, ' x\n', seq)", "genome")
    return textual.genome_chroms(spark, path)


@query(f"SELECT chrom AS name, seq FROM ({_GENOME.format(supplier='supplier')}) g")
def fasta_scan(spark, sf):
    """Records of several lines are joined again."""
    path = _written(_probe_rows(spark, sf)[1], r"concat('>', chrom, ' x\n', substring(seq, 1, 40), '\n', substring(seq, 41, 40), '\n', substring(seq, 81, 1000))", "genome")
    return textual.fasta(spark, path).select("name", "seq")


@query(f"SELECT kmer, count(*) AS n FROM (SELECT substring(seq, i, 6) AS kmer FROM (SELECT seq, unnest(range(1, length(seq) - 4)) AS i FROM ({_GENOME.format(supplier='supplier')}) g)) GROUP BY kmer")
def kmer_index(spark, sf):
    return reads.kmers(_probe_rows(spark, sf)[1], 6).groupBy("kmer").agg(F.count("*").alias("n"))


@query(f"SELECT CAST(seq_id AS VARCHAR) AS name, seq FROM ({_PROBES.format(part='part')}) p WHERE seq NOT IN (SELECT substring(seq, i, 18) FROM (SELECT seq, unnest(range(1, length(seq) - 16)) AS i FROM ({_GENOME.format(supplier='supplier')}) g)) AND reverse(translate(seq, 'ACGT', 'TGCA')) NOT IN (SELECT substring(seq, i, 18) FROM (SELECT seq, unnest(range(1, length(seq) - 16)) AS i FROM ({_GENOME.format(supplier='supplier')}) g))")
def unaligned_sink(spark, sf):
    probes, genome = _probe_rows(spark, sf)
    path = new_folder(spark, "unaligned")
    sinks.unaligned_fasta(reads.unaligned(probes, reads.align(probes, genome, seed=18)), path)
    return textual.fasta(spark, path).select("name", "seq")


#: Two decimals, half to even, in whole millionths (a double just below a half would go the other way).
_MILLIONTHS = "CAST(round(count * 1000000) AS BIGINT)"
_CENTS = f"({_MILLIONTHS} // 10000 + CASE WHEN {_MILLIONTHS} % 10000 > 5000 OR ({_MILLIONTHS} % 10000 = 5000 AND {_MILLIONTHS} // 10000 % 2 = 1) THEN 1 ELSE 0 END) / 100.0::DOUBLE"


# ---- reports --------------------------------------------------------------------------------------------------------
@query(f"WITH {CTES} SELECT feature_id, classifier, library, {_CENTS} AS count FROM counts")
def counts_report(spark, sf):
    """The long report as CSV, two decimals half to even, read back."""
    path = new_folder(spark, "report")
    sinks.report(_rounded(_counts(spark, sf), "count").select("feature_id", "classifier", "library", "count"), path, ["feature_id", "classifier", "library"])
    return spark.read.csv(path, header=True, schema="feature_id string, classifier string, library string, count double")


_LIBRARIES = [f"g{i}_rep_{k}" for i in range(3) for k in (1, 2)]


@query(f"WITH {CTES} SELECT feature_id, classifier, {', '.join(f'round(coalesce(sum(count) FILTER (library = {x!r}), 0), 6) AS {x}' for x in _LIBRARIES)} FROM counts GROUP BY ALL")
def counts_wide(spark, sf):
    """A column for each library, zeros where a library has no count."""
    return _rounded(sinks.wide(_counts(spark, sf), ["feature_id", "classifier"], _LIBRARIES), *_LIBRARIES)


@query(f"WITH {CTES} SELECT library, feature_id, classifier, {_CENTS} AS count FROM counts")
def counts_reread(spark, sf):
    """The wide report written and read again in long form; zeros that were filled in are left out."""
    path = new_folder(spark, "report")
    wide = sinks.wide(_rounded(_counts(spark, sf), "count"), ["feature_id", "classifier"], _LIBRARIES)
    sinks.report(wide.withColumnsRenamed({"feature_id": "Feature ID", "classifier": "Classifier"}), path, ["Feature ID", "Classifier"], digits=12)
    return sheets.read_counts(spark, path).where("count > 0").select("library", "feature_id", "classifier", F.bround("count", 2).alias("count"))


@query(f"""WITH {CTES}, {_MAPPED}, rc AS (SELECT library, rule_idx, coalesce(sum(fcorr / n_rules), 0) AS count FROM (SELECT DISTINCT library FROM aln) CROSS JOIN (SELECT rule_idx FROM rules) LEFT JOIN sel USING (library, rule_idx) GROUP BY ALL)
SELECT CAST(rule_idx AS VARCHAR) AS rule, library, round(count, 6) AS count FROM rc UNION ALL SELECT 'Mapped Reads', library, round(mapped, 6) FROM mp""")
def rule_report(spark, sf):
    """Counts by rule with the row of mapped reads below."""
    from .registry import _assigned
    from ..durable import durable
    from ..operators import select

    assigned = durable(_assigned(spark, sf))
    by_read = C.by_read(C.by_alignment(select.with_loci(B.alignments(spark, sf)), assigned))
    counts = C.rule_counts(assigned, B.rules(spark), B.libraries(spark, sf))
    return _rounded(C.with_mapped_row(counts, C.summary_stats(by_read)), "count")


@query(f"""WITH {CTES}, {_MAPPED}, u AS ({_collapse_sql('seq').replace("concat('lib', CAST(name % 3 AS STRING))", 'library')}), n AS (SELECT library, CAST(max(seq_id) + 1 AS DOUBLE) AS unique_sequences, CAST(sum(read_count) AS DOUBLE) AS retained FROM u GROUP BY library),
x AS (SELECT library, count(*)::DOUBLE AS seqs, sum(assigned) AS assigned, any_value(mapped) AS mapped FROM reads JOIN mp USING (library) GROUP BY library)
SELECT stat, library, round(value, 6) AS value FROM (
 SELECT 'Total Reads' AS stat, library, retained * 2 AS value FROM n UNION ALL SELECT 'Retained Reads', library, retained FROM n UNION ALL SELECT 'Unique Sequences', library, unique_sequences FROM n
 UNION ALL SELECT 'Mapped Sequences', library, seqs FROM x UNION ALL SELECT 'Mapped Reads', library, mapped FROM x UNION ALL SELECT 'Assigned Reads', library, assigned FROM x)""")
def summary_report(spark, sf):
    """Every row of the summary: the filter's (here: twice what it retained), the collapser's, the counts'."""
    rows = B.alignments(spark, sf).select("library", F.col("row_key").alias("read_idx"), "seq")
    collapsed = reads.collapse(rows)
    unique = collapsed.groupBy("library").agg((F.max("seq_id") + 1).alias("unique"))
    filtered = collapsed.groupBy("library").agg((2 * F.sum("read_count")).alias("total_reads"), F.sum("read_count").alias("retained_reads"))
    summary = C.summary_stats(_both(spark, sf)[1])
    return _rounded(C.summary_report(summary, filtered, unique), "value")


@query("SELECT n_name AS file, CAST(n_nationkey * 1000 AS BIGINT) AS total_reads, CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE CAST(n_nationkey * 900 AS BIGINT) END AS retained_reads FROM nation")
def filter_reports(spark, sf):
    """One JSON report for each library; what a report lacks is null."""
    rows = spark.read.parquet(f"{sf}/nation.parquet").withColumn("after", F.expr("case when n_nationkey % 5 = 0 then '' else concat(', \"after_filtering\": {\"total_reads\": ', n_nationkey * 900, '}') end"))
    path = new_folder(spark, "json")
    text = F.expr("concat('{\"summary\": {\"before_filtering\": {\"total_reads\": ', n_nationkey * 1000, ', \"x\": 1}', after, '}}')")
    rows.select("n_name", text.alias("value")).repartition("n_name").write.partitionBy("n_name").text(path)
    found = sheets.filter_reports(spark, f"{path}/*/*.txt")
    name = F.replace(F.regexp_extract("file", "n_name=([^/]*)/", 1), F.lit("%20"), F.lit(" "))
    return found.select(name.alias("file"), "total_reads", "retained_reads")


@query(_AVG + ", m AS (SELECT DISTINCT feature_id, classifier FROM av) SELECT feature_id, classifier, round(avg(count), 6) AS count, CASE WHEN CAST(feature_id AS INT) % 2 = 0 THEN 'a' || feature_id || ', B' || feature_id ELSE '' END AS feature_name FROM av GROUP BY ALL")
def counts_with_aliases(spark, sf):
    """Features with their alternative names; those without one have ''."""
    names = _part(spark, sf).where("p_partkey % 2 = 0").selectExpr("cast(p_partkey as string) as feature_id", "array(concat('B', p_partkey), concat('a', p_partkey), concat('B', p_partkey)) as x")
    aliases = names.select("feature_id", S.joined_aliases(F.col("x")).alias("feature_name"))
    means = _averages(spark, sf).groupBy("feature_id", "classifier").agg(F.avg("count").alias("count"))
    return _rounded(C.with_aliases(means, aliases), "count").select("feature_id", "classifier", "count", "feature_name")


@query("SELECT p_partkey AS id, p_brand || '_x' AS base, p_brand || '_rep_' || p_size AS library, p_brand AS grp, p_brand || '_vs_' || p_type AS comparison FROM part")
def library_names(spark, sf):
    rows = _part(spark, sf).withColumn("library", S.library_name(F.col("p_brand"), F.col("p_size")))
    path, table = F.concat(F.lit("/a.b/c/"), "p_brand", F.lit("_x_aligned_seqs.sam")), F.concat(F.lit("run_cond1_"), "p_brand", F.lit("_cond2_"), "p_type", F.lit("_deseq_table.csv"))
    return rows.select(F.col("p_partkey").alias("id"), S.base_name(path).alias("base"), "library", S.group_of(F.col("library")).alias("grp"), S.comparison_name(table).alias("comparison"))


_RESULTS = "SELECT CASE WHEN p_partkey % 2 = 0 THEN 'a' ELSE 'b' END AS cond1, 'c' AS cond2, p_name AS feature_id, p_brand AS classifier, CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST((p_partkey * 7919) % 1009 AS DOUBLE) / 1009 END AS padj FROM {part}"


@query(f"SELECT feature_id, classifier, min(padj) FILTER (cond1 = 'a') AS a_vs_c, min(padj) FILTER (cond1 = 'b') AS b_vs_c FROM (SELECT cond1, feature_id, classifier, min(padj) AS padj FROM ({_RESULTS.format(part='part')}) r GROUP BY ALL) GROUP BY ALL")
def padj_table(spark, sf):
    rows = spark.sql(_RESULTS, part=_part(spark, sf)).groupBy("cond1", "cond2", "feature_id", "classifier").agg(F.min("padj").alias("padj"))
    return plotdata.padj_table(rows, ["a_vs_c", "b_vs_c"])


@query(f"SELECT cond1, feature_id, classifier, padj, row_number() OVER (PARTITION BY cond1 ORDER BY padj NULLS LAST, feature_id, classifier) AS n FROM (SELECT cond1, feature_id, classifier, min(padj) AS padj FROM ({_RESULTS.format(part='part')}) r GROUP BY ALL)")
def order_by_padj(spark, sf):
    rows = spark.sql(_RESULTS, part=_part(spark, sf)).groupBy("cond1", "cond2", "feature_id", "classifier").agg(F.min("padj").alias("padj"))
    return plotdata.by_padj(rows).select("cond1", "feature_id", "classifier", "padj", F.col("n").cast("long").alias("n"))


@query(f"SELECT cond1, feature_id, classifier FROM ({_RESULTS.format(part='part')}) r WHERE padj < 0.05")
def significant_genes(spark, sf):
    return plotdata.significant(spark.sql(_RESULTS, part=_part(spark, sf))).select("cond1", "feature_id", "classifier")


@query(f"WITH {CTES} SELECT library, feature_id, classifier, round(count, 6) AS count FROM counts WHERE lower(classifier) IN ('hot', 'rest')")
def class_include(spark, sf):
    return _rounded(plotdata.class_filter(_counts(spark, sf), include=["HOT", "Rest"]), "count")


@query(_AVG + " SELECT feature_id, classifier, grp, round(count, 6) AS count FROM av WHERE EXISTS (SELECT 1 FROM part WHERE CAST(p_partkey AS STRING) = av.feature_id AND p_size < 5)")
def dge_group(spark, sf):
    """Averages of the genes that some comparison calls significant."""
    results = _part(spark, sf).selectExpr("cast(p_partkey as string) as feature_id", "p_size / 100 as padj").join(B.matches(spark, sf).select("feature_id", "classifier").distinct(), "feature_id")
    return _rounded(plotdata.ingroup(_averages(spark, sf), results), "count")


@query("SELECT DISTINCT p_brand AS grp, p_size AS replicate FROM part")
def unique_libraries(spark, sf):
    """Samples that repeat one whole are read once."""
    rows = _part(spark, sf).select("p_brand", "p_size").collect()
    found = sheets.unique_samples([sheets.Sample(f"{m}_{n}.sam", m, str(n)) for m, n in rows])
    return sheets.library_table(spark, found).select("grp", F.col("replicate").cast("int").alias("replicate"))


@query("SELECT s_suppkey % 3 = 0 AS so, count(*) AS n FROM supplier GROUP BY ALL")
def order_check(spark, sf):
    """Headers whose sort order tells that a read's alignments lie together, and others."""
    rows = spark.read.parquet(f"{sf}/supplier.parquet").selectExpr("s_suppkey", "case when s_suppkey % 3 = 0 then 'queryname' else 'coordinate' end as so")
    header = rows.select(F.col("s_suppkey").cast("string").alias("file"), F.lit("HD").alias("record"), F.create_map(F.lit("SO"), F.col("so")).alias("tags"))
    return validate.order_by_file(header).groupBy(F.col("together").alias("so")).agg(F.count("*").alias("n"))


@query(f"WITH {CTES}, p AS (SELECT fwd = strand AS same_strand FROM al a JOIN features f ON a.chrom = f.chrom AND a.s < f.fe AND f.fs < a.e WHERE strand IS NOT NULL) SELECT same_strand, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM p GROUP BY same_strand")
def strandedness(spark, sf):
    """The share of overlapping pairs on one strand (over all of them here; the probe may bound its sample)."""
    from ..operators import intervals

    pairs = intervals.interval_join(B.alignments(spark, sf), B.annotation(spark, sf).select("chrom", "fs", "fe", "strand"))
    return reference.strandedness(pairs, sample=None).select("same_strand", R(F.col("share")).alias("share"))


@query("SELECT grp, count(*) AS n, count(*) > 1 AS replicated FROM (SELECT DISTINCT p_brand AS grp, p_size FROM part) GROUP BY grp")
def replicate_counts(spark, sf):
    libraries = _part(spark, sf).select(F.col("p_brand").alias("grp"), F.col("p_size").alias("replicate")).distinct()
    return dge.replicate_counts(libraries)


@query(f"""WITH {CTES}, f AS (SELECT library, classifier, sum(count) AS feature_sum FROM counts GROUP BY ALL), n AS (SELECT DISTINCT library FROM aln),
r AS (SELECT library, rules.classifier, coalesce(sum(fcorr / n_rules), 0) AS rule_sum FROM n CROSS JOIN rules LEFT JOIN sel USING (library, rule_idx) GROUP BY ALL)
SELECT library, classifier, round(coalesce(feature_sum, 0), 6) AS feature_sum, round(coalesce(rule_sum, 0), 6) AS rule_sum, abs(coalesce(feature_sum, 0) - coalesce(rule_sum, 0)) < 1 AS agree FROM r FULL JOIN f USING (library, classifier)""")
def class_check(spark, sf):
    """Totals of each classifier by features against those by rules."""
    from ..durable import durable
    from .registry import _shares

    assigned = durable(_shares(spark, sf))
    rules = B.rules(spark)
    found = C.class_check(C.feature_counts(assigned), C.rule_counts(assigned, rules, B.libraries(spark, sf)), rules)
    return _rounded(found, "feature_sum", "rule_sum")


_POINTS = _AVG + """, w AS (SELECT feature_id, classifier, sum(count) FILTER (grp = 'g0') AS x, sum(count) FILTER (grp = 'g1') AS y FROM av GROUP BY ALL),
p AS (SELECT feature_id, classifier, x, y, CASE WHEN EXISTS (SELECT 1 FROM part WHERE CAST(p_partkey AS STRING) = w.feature_id AND p_size < 5) THEN classifier ELSE 'p >= cutoff' END AS grp FROM w WHERE x > 0 OR y > 0),
o AS (SELECT grp, row_number() OVER (ORDER BY count(*) DESC, grp) - 1 AS place FROM p GROUP BY grp)"""


@query(_POINTS + " SELECT feature_id, classifier, round(x, 6) AS x, round(y, 6) AS y, grp, CAST(place AS INTEGER) AS place FROM p JOIN o USING (grp)")
def scatter_groups(spark, sf):
    """Points of a scatter with their group and its place in the order of drawing."""
    results = _part(spark, sf).selectExpr("cast(p_partkey as string) as feature_id", "p_size / 100 as padj").join(B.matches(spark, sf).select("feature_id", "classifier").distinct(), "feature_id")
    return _rounded(plotdata.scatter_groups(plotdata.scatter_points(_averages(spark, sf), "g0", "g1"), results), "x", "y")


@query(f"WITH {CTES}, z AS (SELECT * FROM counts) SELECT a.feature_id, a.classifier, split_part(a.library, '_rep_', 1) AS grp, split_part(a.library, '_rep_', 2) AS rep1, split_part(b.library, '_rep_', 2) AS rep2, round(a.count, 6) AS x, round(b.count, 6) AS y FROM z a JOIN z b ON a.feature_id = b.feature_id AND a.classifier = b.classifier AND split_part(a.library, '_rep_', 1) = split_part(b.library, '_rep_', 1) AND a.library < b.library")
def replicate_points(spark, sf):
    """Counts of genes in each pair of replicates (here of genes that both have)."""
    libs = B.libraries(spark, sf)
    pairs = dge.replicate_pairs(libs.select(S.group_of(F.col("library")).alias("grp"), F.split("library", "_rep_")[1].alias("replicate")))
    return _rounded(plotdata.replicate_points(_counts(spark, sf), pairs), "x", "y")


@query(f"SELECT cond1, feature_id, classifier, padj, 'name of ' || feature_id AS feature_name FROM ({_RESULTS.format(part='part')}) r WHERE feature_id < 'm'")
def dge_with_metadata(spark, sf):
    """Comparison rows with their features' names."""
    rows = spark.sql(_RESULTS, part=_part(spark, sf))
    names = rows.where("feature_id < 'm'").select("feature_id", "classifier", F.concat(F.lit("name of "), "feature_id").alias("feature_name"))
    return dge.with_metadata(rows, names).select("cond1", "feature_id", "classifier", "padj", "feature_name")
