"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, idstore, langid, linetree, recompress, simhash, suffixes, topk, urltree
from .common import read_table
from .oracles import ORACLES  # noqa: F401


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), (F.col("quality") == 0).alias("bad"))
    return urltree.judge(read_table(spark, sf_dir, "pages").select("page_id", "url"), labels).drop("template", "purity")


def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = idstore.new_folder(spark)
    idstore.write(read_table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary(), folder)
    return idstore.digests(spark, folder)


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linetree.digests(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.contamination(docs, read_table(spark, sf_dir, "benchmark")).drop("spans")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompress.digests(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(read_table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary())


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = langid.identify(docs.select("doc_id", "text"), langid.train(docs.select("doc_id", "text", "lang")))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_token_ids": op2_token_ids,
    "op3_topk": op3_topk,
    "op4_line_dedup": op4_line_dedup,
    "op5_decontaminate": op5_decontaminate,
    "op6_simhash": op6_simhash,
    "op7_recompression": op7_recompression,
    "op8_suffix_array": op8_suffix_array,
    "op9_bpe": op9_bpe,
    "op10_language_id": op10_language_id,
}
