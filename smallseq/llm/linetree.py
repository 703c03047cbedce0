"""Line deduplication with a log-template tree, in DataFrame functions only.

A line's tokens with digits are wildcards. Lines are parsed down a tree of fixed depth: token count, then the leading
tokens. Within a leaf, tokens that too few documents share at their position are variable fields and become wildcards, at
several levels of support so that a template of any size is found, if enough of the line stays constant; otherwise the
masked line itself is the template. Templates that recur across documents are dropped. Every statistic is a count over all
lines, so the result depends on no order; only hashes and lines that share a leaf are moved, and texts once, to be put
together again. Lines and templates are known by 64-bit hashes: among L distinct lines and R recurring templates about
L * R / 2**64 lines go by chance (at 10**12 and 10**9: 54).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialise, row_key, unpacked, whole_row

#: Documents in which a template recurs; tokens from which a line is long, and documents in which a long line's template
#: recurs; leading tokens in the tree; the share of constant tokens that a generalised template needs; levels of support,
#: each a factor of 2 ** STEP_BITS above the one before.
MIN_DOCS, LONG, LONG_DOCS, LEADING, CONSTANT, LEVELS, STEP_BITS = 5, 50, 2, 2, 0.6, 28, 2
WILD = "<*>"


def masked(line: Column) -> Column:
    """White space to single blanks, tokens with digits to wildcards. A carriage return is white space."""
    flat = F.trim(F.regexp_replace(line, r"[ \t\r\x0b\f]+", " "))
    return F.when(line.rlike("[0-9]"), F.regexp_replace(flat, r"(?<![^ ])[^ 0-9]*[0-9][^ ]*", WILD)).otherwise(flat)


def line_table(docs: DataFrame) -> DataFrame:
    """(d, t, i, leaf, line, size, m): every line that is not blank, by hashes, with its tokens' number and its masked text."""
    rows = docs.select(*row_key(), F.posexplode_outer(F.split("text", "\n")).alias("i", "raw"))
    rows = rows.select("d", "t", "i", masked(F.col("raw")).alias("m")).where("m <> ''")
    rows = rows.select("d", "t", "i", "m", F.split("m", " ").alias("tokens"))
    leaf = F.xxhash64(F.size("tokens"), *[F.coalesce(F.get("tokens", F.lit(i)), F.lit("")) for i in range(LEADING)])
    return rows.select("d", "t", "i", leaf.alias("leaf"), F.xxhash64("m").alias("line"), F.size("tokens").alias("size"), "m")


def templates(lines: DataFrame, min_docs: int) -> DataFrame:
    """(line, level, template): the generalised templates of each distinct line that has any.

    At level k a token is constant if ``min_docs << (STEP_BITS * k)`` documents have it at its position in the leaf, for
    all k up to the leaf's documents: a template's fields are told from its constants by their share of its documents,
    however many those are. A document counts once for a token, whatever number of its lines have it. Only hashes of tokens
    are moved, those of leaves that can recur; a leaf's own leading tokens need no count.
    """
    # Aggregates are written before they are joined on their own key: then both sides are plain shuffles, which Spark can
    # split where a leaf or line is hot; a small one is broadcast by its counted size.
    per_doc = materialise(lines.groupBy("leaf", "d", "t").agg(F.count("*").alias("times"), F.min("line").alias("low"), F.max("line").alias("high")), "leaves")
    wide = per_doc.groupBy("leaf").agg(F.count("*").alias("docs"), F.min("low").alias("low"), F.max("high").alias("high")).where((F.col("docs") >= min_docs) & (F.col("low") != F.col("high")))
    wide = broadcast_if_small(materialise(wide.select("leaf"), "wide"))
    several = materialise(per_doc.where("times > 1").join(wide, "leaf", "left_semi").select("leaf", "d", "t", F.lit(True).alias("several")), "several")
    found = lines.select("leaf", "line", "d", "t", "m").join(wide, "leaf", "left_semi").join(broadcast_if_small(several), ["leaf", "d", "t"], "left")
    tokens = found.select("leaf", "line", "d", "t", "several", F.size(F.split("m", " ")).alias("size"), F.posexplode(F.split("m", " ")).alias("p", "token")).where("p > 0")
    tokens = tokens.select("leaf", "line", "d", "t", "several", "size", "p", F.xxhash64("leaf", "p", "token").alias("key"))
    alone = tokens.where("several is null").groupBy("key").agg(F.count("*").alias("docs"))
    beside = tokens.where("several").select("key", "d", "t").distinct().groupBy("key").agg(F.count("*").alias("docs"))
    common = alone.union(beside).groupBy("key").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
    reached = F.filter(F.sequence(F.lit(0), F.lit(LEVELS)), lambda k: F.col("docs") >= F.lit(min_docs).cast("long") * F.pow(F.lit(float(1 << STEP_BITS)), k))
    common = broadcast_if_small(materialise(common.select("key", (F.size(reached) - 1).alias("top")), "common"))
    constant = tokens.select("leaf", "line", "size", "p", "key").join(common, "key")
    constant = constant.groupBy("leaf", "line", "size").agg(F.collect_set(F.struct("p", "key", "top")).alias("found"), F.max("top").alias("top"))
    constant = constant.select("leaf", "line", "size", "found", F.explode(F.sequence(F.lit(0), F.col("top"))).alias("level"))
    kept = F.array_sort(F.transform(F.filter("found", lambda x: x["top"] >= F.col("level")), lambda x: F.struct(x["p"].alias("p"), x["key"].alias("key"))))
    named = constant.select("leaf", "line", "size", "level", kept.alias("kept")).where(F.size("kept") + 1 >= F.lit(CONSTANT) * F.col("size"))  # and the first token
    named = named.select("line", "level", F.xxhash64("leaf", "kept").alias("template"))
    return named.groupBy("line", "template").agg(F.max("level").alias("level"))


def dropped_lines(docs: DataFrame, min_docs: int = MIN_DOCS, keep_first: bool = False) -> DataFrame:
    """(d, t, i) of the lines of which some template recurs: in ``min_docs`` documents, or LONG_DOCS if the line is long.

    ``keep_first`` spares the first line (smallest document, then position) of each line's most general such template.
    """
    lines = materialise(line_table(docs), "lines", compression="zstd")
    plain = lines.select("d", "t", "i", "line", (F.col("size") >= LONG).alias("long"))
    named = plain.join(broadcast_if_small(materialise(templates(lines, min_docs), "templates")), "line", "left")
    named = materialise(named.select("d", "t", "i", "long", F.coalesce("template", "line").alias("template"), F.coalesce("level", F.lit(0)).alias("level")), "named")
    per_doc = named.groupBy("template", "long", "d", "t").agg(F.min("i").alias("i"))
    needed = F.when(F.col("long"), F.least(F.lit(LONG_DOCS), F.lit(min_docs))).otherwise(min_docs)
    often = per_doc.groupBy("template", "long").agg(F.count("*").alias("docs"), F.min(F.struct("d", "t", "i")).alias("first")).where(F.col("docs") >= needed)
    found = named.join(broadcast_if_small(materialise(often.select("template", "first"), "often")), "template")
    found = found.groupBy("d", "t", "i").agg(F.max_by("first", "level").alias("first"))
    if keep_first:
        found = found.where(F.struct("d", "t", "i") != F.col("first"))
    return found.select("d", "t", "i")


def _with_kept(docs: DataFrame, min_docs: int, keep_first: bool) -> DataFrame:
    """(row, text, gone, lines, kept): kept are the numbers of the lines that stay, from 0."""
    gone = dropped_lines(docs, min_docs, keep_first).groupBy("d", "t").agg(F.collect_list("i").alias("gone"))
    gone = broadcast_if_small(materialise(gone, "gone"), otherwise="shuffle_hash")
    joined = docs.select(whole_row(docs), *row_key()).join(gone, ["d", "t"], "left")
    joined = joined.select("row", F.col("row.text").alias("text"), "gone", F.split("row.text", "\n").alias("lines"))
    numbers = F.sequence(F.lit(0), F.size("lines") - 1)
    return joined.withColumn("kept", F.when(F.col("gone").isNull(), numbers).otherwise(F.array_except(numbers, F.col("gone"))))


def _kept_text() -> Column:
    return F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform("kept", lambda i: F.get("lines", i)), "\n"))


def deduplicate(docs: DataFrame, min_docs: int = MIN_DOCS, keep_first: bool = False) -> DataFrame:
    """The rows with the dropped lines taken out of ``text``; other columns as they are, whatever their names.

    A null text stays null, an empty one empty; a document may become empty but stays a row. Blank lines are kept and
    have no template. Rows that repeat an id and a text count as one document and lose the same lines. No rows give none.
    """
    return _with_kept(docs, min_docs, keep_first).select(*unpacked(docs.columns, text=_kept_text()))


def digests(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Per row: doc_id, n_lines, n_dropped, kept_sha256 (null text: no lines); for the rest see ``deduplicate``."""
    df = _with_kept(docs, min_docs, False)
    n = F.when(F.col("text").isNull(), 0).otherwise(F.size("lines"))
    kept = F.when(F.col("text").isNull(), 0).otherwise(F.size("kept"))
    return df.select(F.col("row.doc_id").alias("doc_id"), n.cast("long").alias("n_lines"), (n - kept).cast("long").alias("n_dropped"), F.sha2(F.coalesce(_kept_text(), F.lit("")), 256).alias("kept_sha256"))


def oracle() -> str:
    """DuckDB SQL for digests()."""
    return f"""
WITH l AS (
  SELECT doc_id, i, raw, CASE WHEN regexp_matches(raw, '[0-9]') THEN array_to_string([CASE WHEN regexp_matches(x, '[0-9]') THEN '{WILD}' ELSE x END FOR x IN string_split(flat, ' ')], ' ') ELSE flat END AS m
  FROM (SELECT doc_id, i, raw, trim(regexp_replace(raw, '[ \\t\\r\\x0b\\f]+', ' ', 'g')) AS flat
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL))
), k AS (SELECT *, string_split(m, ' ') AS tokens FROM l WHERE m <> ''
), f AS (SELECT doc_id, i, m, tokens, len(tokens) AS n, tokens[1] AS a, coalesce(tokens[2], '') AS b FROM k
), short AS (SELECT n, a, b, m, any_value(tokens) AS tokens, count(DISTINCT doc_id) AS docs FROM f GROUP BY n, a, b, m
), wide AS (SELECT n, a, b FROM short GROUP BY n, a, b HAVING sum(docs) >= {MIN_DOCS} AND count(*) > 1
), s AS (SELECT short.* FROM short JOIN wide USING (n, a, b)
), tok AS (SELECT n, a, b, m, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS p FROM s
), common AS (
  SELECT n, a, b, p, token, count(DISTINCT doc_id) AS support FROM tok JOIN (SELECT DISTINCT doc_id, m FROM f) USING (m) GROUP BY ALL HAVING support >= {MIN_DOCS}
), leveled AS (SELECT n, a, b, p, token, unnest([k FOR k IN range(0, {LEVELS + 1}) IF support >= {MIN_DOCS} * power({1 << STEP_BITS}, k)]) AS level FROM common
), named AS (SELECT DISTINCT n, a, b, m, template FROM (
  SELECT n, a, b, m, level, string_agg(p || ':' || token, ' ' ORDER BY p) AS template FROM tok JOIN leveled USING (n, a, b, p, token) GROUP BY n, a, b, m, level HAVING count(*) >= {CONSTANT}::DOUBLE * n)
), every AS (SELECT f.doc_id, f.i, f.n, f.a, f.b, coalesce('T ' || template, 'L ' || f.m) AS template FROM f LEFT JOIN named ON f.n = named.n AND f.a = named.a AND f.b = named.b AND f.m = named.m
), often AS (SELECT n, a, b, template FROM every GROUP BY ALL HAVING count(DISTINCT doc_id) >= CASE WHEN n >= {LONG} THEN {LONG_DOCS} ELSE {MIN_DOCS} END
), gone AS (SELECT DISTINCT doc_id, i FROM every JOIN often USING (n, a, b, template)
), kept AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (g.i IS NOT NULL) AS n_dropped, string_agg(raw, chr(10) ORDER BY i) FILTER (g.i IS NULL) AS kept
  FROM l LEFT JOIN gone g USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dropped, 0) AS BIGINT) AS n_dropped, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id)
"""
