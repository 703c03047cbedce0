"""A corpus pipeline over ``documents``: language, lines, near-duplicates, benchmark contamination, tokens.

Each stage is a function (spark, docs, sf_dir) -> DataFrame; its result is written as Parquet and reread as the next
stage's docs. All but the last return the columns of documents, whatever their names. A stage sees only what the one before
has kept. No documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smallseq.llm import bpe, decontaminate, langid, linetree, simhash
from smallseq.llm.common import materialise, read_table, ship
from smallseq.llm.queries import vocabulary

#: A document goes if no language has so large a share of its letters (or if it has no letters).
LEAST_LANGUAGE_SHARE = 0.4


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents without a determinable language go, null, empty and letterless texts among them; repeated rows are judged alike."""
    ship(spark)
    return langid.keep_identified(docs, langid.train(docs.select("doc_id", "text", "lang")), LEAST_LANGUAGE_SHARE)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: lines whose template recurs go, but for the first, so that copies lose no line everywhere.

    A null text stays null; rows that repeat an id and a text lose the same lines.
    """
    ship(spark)
    out = linetree.deduplicate(docs, keep_first=True)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: one document of each group of texts with a 5-word similarity of 0.8 or more stays.

    Texts without words, null ones too, are one group; of rows that repeat the id that stays one does; rows without an id stay.
    """
    ship(spark)
    return simhash.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that the contract's rule calls contaminated go; null and empty texts stay, repeated rows go or stay alike."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: doc_id, n_tokens, ids, and the digest of the text decoded from them; a row for each row, null and empty texts without ids."""
    ship(spark)
    return bpe.encode_with_digest(docs, vocabulary())


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("simhash_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("bpe", encode_tokens),
]

#: The trained language model and BPE cannot be said in SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
