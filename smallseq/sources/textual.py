"""Line formats: FASTQ, FASTA, alignment text, annotation, references' headers. Gzip is recognised by Spark's codec."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import seq as S


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, line_no, value): lines numbered from 0 within their file, whatever blocks it was read in."""
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    sizes = raw.groupBy("file", "block").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n")
    sizes = sizes.select("file", "block", "first", before.alias("before"))
    return raw.join(F.broadcast(sizes), ["file", "block"]).select("file", (F.col("before") + F.col("id") - F.col("first")).alias("line_no"), "value")


def fastq(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, read_idx, qname, seq, qual) of every 4-line record."""
    rows = lines(spark, path).withColumns({"read_idx": F.floor(F.col("line_no") / 4), "part": F.col("line_no") % 4})
    pick = lambda i, name: F.max(F.when(F.col("part") == i, F.col("value"))).alias(name)
    found = rows.groupBy("file", "read_idx").agg(pick(0, "qname"), pick(1, "seq"), pick(3, "qual"))
    return found.withColumn("qname", F.substring("qname", F.lit(2), F.length("qname")))


def fastq_sequences(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, read_idx, seq): the second line of every record, without assembling records."""
    return lines(spark, path).where("line_no % 4 = 1").select("file", F.floor(F.col("line_no") / 4).alias("read_idx"), F.col("value").alias("seq"))


def fasta(spark: SparkSession, path: str | list[str], piece: int = 1 << 16) -> DataFrame:
    """(file, name, seq): records; a name is its header's first word. Lines of a sequence are joined.

    A line's record is the last header at or before it: a running maximum within ranges of ``piece`` lines, over what the
    ranges before hold, so that no task reads a file alone and nothing is compared with every header.
    """
    rows = lines(spark, path).withColumn("b", F.floor(F.col("line_no") / piece)).withColumn("head", F.col("value").startswith(">"))
    own = F.max(F.when(F.col("head"), F.col("line_no"))).over(Window.partitionBy("file", "b").orderBy("line_no"))
    last = rows.where("head").groupBy("file", "b").agg(F.max("line_no").alias("last"))
    ranges = rows.select("file", "b").distinct().join(last, ["file", "b"], "left")
    before = F.max("last").over(Window.partitionBy("file").orderBy("b").rowsBetween(Window.unboundedPreceding, -1))
    placed = rows.withColumn("own", own).join(ranges.select("file", "b", before.alias("before")), ["file", "b"])
    placed = placed.select("file", F.coalesce("own", "before").alias("start"), "line_no", "head", "value").where("start is not null")
    parts = F.array_sort(F.collect_list(F.when(~F.col("head"), F.struct("line_no", F.trim("value").alias("v")))))
    found = placed.groupBy("file", "start").agg(F.max(F.when(F.col("head"), F.regexp_extract("value", r"^>\s*(\S*)", 1))).alias("name"), parts.alias("parts"))
    return found.select("file", "name", F.array_join(F.transform("parts", lambda x: x["v"]), "").alias("seq"))


def collapsed_fasta(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, seq_id, read_count, seq) of a collapsed FASTA's records."""
    rows = fasta(spark, path)
    part = lambda i: F.regexp_extract("name", r"^(\d+)_count=(\d+)$", i).try_cast("long")
    return rows.select("file", part(1).alias("seq_id"), part(2).alias("read_count"), "seq")


def unique_count(collapsed: DataFrame) -> DataFrame:
    """(file, unique): the last id and one; ids count from 0."""
    return collapsed.groupBy("file").agg((F.max("seq_id") + 1).alias("unique"))


def genome_chroms(spark: SparkSession, path: str | list[str]) -> DataFrame:
    rows = spark.read.text(path).where(F.col("value").startswith(">"))
    return rows.select(F.regexp_extract("value", r"^>\s*(\S*)", 1).alias("chrom")).distinct()


def alignment_header(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, line_no, record, tags map): header lines; a value may hold colons."""
    rows = lines(spark, path).where(F.col("value").startswith("@"))
    parts = F.split("value", "\t")
    tags = F.transform(F.filter(F.slice(parts, F.lit(2), F.size(parts)), lambda x: x.contains(":")), lambda x: F.struct(F.substring(x, 1, 2).alias("key"), F.substring(x, F.lit(4), F.length(x)).alias("value")))
    last = F.filter(tags, lambda x, i: ~F.exists(F.slice(tags, i + 2, F.size(tags)), lambda y: y["key"] == x["key"]))
    return rows.select("file", "line_no", F.substring(parts[0], 2, 2).alias("record"), F.map_from_entries(last).alias("tags"))


def reference_sequences(header: DataFrame) -> DataFrame:
    """(file, seq_id, seq_len) of @SQ lines; what is missing is null."""
    return header.where("record = 'SQ'").select("file", F.col("tags")["SN"].alias("seq_id"), F.col("tags")["LN"].try_cast("long").alias("seq_len"))


def collapser_kind(name: str | None) -> str | None:
    """Which collapser named a library's reads, told from its first alignment: '=', '_x' or None."""
    import re

    if name is None:
        return None
    # fixed values: how the two collapsers name a read
    if re.fullmatch(r"\d+_count=\d+", name):
        return "="
    return "_x" if re.fullmatch(r"seq\d+_x(\d+)", name) else None


def alignments(spark: SparkSession, path: str, library: str, raw: bool = False) -> DataFrame:
    """Mapped alignments of a SAM file, as the assignment reads them.

    The end is start plus the read's length; edits come from NM tags if the first record has one, else from the CIGAR.
    Files without records and records without a sequence are errors. ``raw`` adds the line's fields.
    """
    rows = lines(spark, path).where(~F.col("value").startswith("@") & (F.trim("value") != ""))
    parts = F.split("value", "\t")
    first = rows.orderBy("line_no").select(parts.alias("p")).head()
    if first is None:
        raise ValueError(f"alignment file is empty: {path}")
    if len(first["p"]) < 10 or first["p"][9] == "*":
        raise ValueError(f"alignments without sequences: {path}")
    kind = collapser_kind(first["p"][0])
    has_tag = any(t.startswith("NM:") for t in first["p"][11:])
    tags = F.slice(F.col("p"), F.lit(12), F.size("p"))
    edits = S.tag_edits(tags) if has_tag else S.cigar_edits(F.col("p")[5])
    df = rows.select("line_no", parts.alias("p")).withColumn("flag", F.col("p")[1].cast("int")).where(S.is_mapped(F.col("flag")))
    start = F.col("p")[3].cast("long") - 1
    length = F.length(F.col("p")[9])
    fwd = S.on_forward_strand(F.col("flag"))
    out = df.select(
        F.lit(library).alias("library"), F.col("p")[0].alias("name"), F.col("line_no").alias("row_key"), F.col("p")[2].alias("chrom"), start.alias("s"), (start + length).alias("e"), fwd.alias("fwd"),
        S.five_prime_base(F.col("p")[9], fwd).alias("nt5"), length.alias("length"), edits.alias("nm"), S.collapsed_count(F.col("p")[0], kind).alias("read_count"), F.col("p")[9].alias("seq"), *([F.col("p").alias("fields")] if raw else []),
    )
    return out


def attributes(text: Column) -> Column:
    """An annotation's ninth column -> array<struct<key, key_lc, vals, vals_lc>>; of a repeated key the last counts.

    Parts end at ';' outside quotes; key and values stand apart by '=' or blanks; commas part values; percent escapes are
    read after that, a '+' is itself, and a malformed escape stays as it is. Unbalanced quotes are an error.
    """
    quotes = F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))
    safe = F.when(quotes % 2 == 1, F.raise_error(F.concat(F.lit("mismatched quotes in attributes: "), text)).cast("string")).otherwise(text)
    decode = lambda x: F.coalesce(F.try_url_decode(F.replace(x, F.lit("+"), F.lit("%2B"))), x)
    parts = F.filter(F.transform(F.regexp_extract_all(safe, F.lit(r'((?:[^;"]|"[^"]*")+)'), F.lit(1)), lambda x: F.trim(x)), lambda x: x != "")

    def entry(x: Column) -> Column:
        key = decode(F.regexp_extract(x, r"^([^\s=]+)[\s=]+(.*)$", 1))
        value = F.regexp_replace(F.trim(F.regexp_extract(x, r"^([^\s=]+)[\s=]+(.*)$", 2)), r'^"(.*)"$', "$1")
        vals = F.transform(F.filter(F.split(value, ","), lambda v: v != ""), decode)
        return F.struct(key.alias("key"), F.lower(key).alias("key_lc"), vals.alias("vals"), F.transform(vals, lambda v: F.lower(v)).alias("vals_lc"))

    found = F.filter(F.transform(parts, entry), lambda a: a["key"] != "")
    return F.filter(found, lambda a, i: ~F.exists(F.slice(found, i + 2, F.size(found)), lambda b: b["key_lc"] == a["key_lc"]))


def attribute_text(attrs: Column, key: str) -> Column:
    hit = F.filter(attrs, lambda a: a["key_lc"] == key.lower())
    return F.when(F.size(hit) > 0, F.array_join(F.element_at(hit, 1)["vals"], ","))


def annotation(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """GFF3, GFF2 and GTF rows as the reference operators read them; 0-based, half-open. Stops at a FASTA section."""
    rows = lines(spark, path)
    fasta_at = rows.where(F.trim("value") == "##FASTA").groupBy("file").agg(F.min("line_no").alias("__stop"))
    rows = rows.join(F.broadcast(fasta_at), "file", "left").where("__stop is null or line_no < __stop")
    rows = rows.where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    p = F.split("value", "\t")
    at = lambda i: F.get(p, F.lit(i))
    df = rows.select("file", "line_no", at(0).alias("chrom"), at(1).alias("source"), at(2).alias("type"), (at(3).try_cast("long") - 1).alias("fs"), at(4).try_cast("long").alias("fe"), S.strand_of(at(6)).alias("strand"), attributes(at(8)).alias("attrs"))
    text = lambda k: attribute_text(F.col("attrs"), k)
    return df.withColumns({"feature_id": F.coalesce(text("ID"), text("gene_id"), text("Parent")), "parent": text("Parent")})
