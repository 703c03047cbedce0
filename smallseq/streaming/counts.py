"""Incremental counts with Structured Streaming: collapse and feature counts as files arrive.

An extension beyond the batch engine: the same operators over a stream of reads or of assigned alignments. State grows
with distinct keys (sequences, features), not with rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

READS = "library string, seq string"
ASSIGNED = "library string, feature_id string, classifier string, fcorr double, n_rules bigint"


def reads(spark: SparkSession, folder: str, files_per_trigger: int = 16) -> DataFrame:
    return spark.readStream.schema(READS).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def collapsed(stream: DataFrame) -> DataFrame:
    """Running read counts of distinct sequences (ids need the whole input, so they are a batch matter)."""
    return stream.where("seq <> ''").groupBy("library", "seq").agg(F.count("*").alias("read_count"))


def feature_counts(stream: DataFrame) -> DataFrame:
    return stream.groupBy("library", "feature_id", "classifier").agg(F.sum(F.col("fcorr") / F.col("n_rules")).alias("count"))


def to_table(counts: DataFrame, name: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """The running counts in an in-memory table; ``once`` works off what is there and stops."""
    writer = counts.writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="5 seconds")).start()
