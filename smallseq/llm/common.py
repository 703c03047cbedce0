"""Shared helpers: table access, durable intermediate tables, and document keys."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import durable

_own_root: list[str] = []


#: Bytes of a batch that a worker gets at once (Spark's default counts rows alone, whatever their texts' length).
BATCH_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Make ready for workers: the package's source on the executors, and batches bounded by bytes, not by rows alone."""
    durable.ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, through Spark's reader (the path may be remote)."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``; a temporary one only in local mode where that is unset (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("on a cluster, spark.checkpoint.dir has to name a folder that all machines share")
    if not _own_root:
        _own_root.append(tempfile.mkdtemp(prefix="llm-shared-"))
    return f"file://{_own_root[0]}"


def own_folder(spark: SparkSession) -> str:
    """This application's folder for intermediate tables; it goes when the driver's process ends."""
    context = spark.sparkContext
    folder = f"{shared_root(spark)}/llm/{context.applicationId}"
    if getattr(context, "_own_folder", None) is None:
        context._own_folder = folder
        jvm, conf = context._jvm, context._jsc.hadoopConfiguration()

        def clear() -> None:
            try:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(conf).delete(path, True)
            except Exception:  # noqa: BLE001 - the JVM may have ended before
                pass

        atexit.register(clear)
    return folder


def materialise(df: DataFrame, tag: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as a table in the shared folder and return a scan of it.

    This cuts the lineage durably: a lost executor costs the re-read of a file, never a recomputation.
    """
    spark = df.sparkSession
    path = f"{own_folder(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(df: DataFrame) -> None:
    """Delete the files of a materialised table that no later step reads."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_key(text: Column) -> Column:
    """64-bit digest of a text; beside the document id it separates rows that share an id."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def row_key(doc_id: str = "doc_id", text: str = "text") -> tuple[Column, Column]:
    """(d, t): two longs that tell rows apart by id and text. Rows without an id differ from any with one by ``t``."""
    d = F.coalesce(F.col(doc_id).cast("long"), F.lit(0).cast("long")).alias("d")
    return d, F.xxhash64(F.coalesce(text, F.lit("")), F.col(text).isNull(), F.col(doc_id).isNull()).alias("t")


def whole_row(df: DataFrame) -> Column:
    """The caller's columns in one struct ``row``, so that none can clash with a name that an operator adds."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def unpacked(columns: list[str], **replaced: Column) -> list[Column]:
    """The columns of ``row`` again; some replaced."""
    return [replaced.get(c, F.col("row").getField(c)).alias(c) for c in columns]


def partitions_for(df: DataFrame, at_least: int = 1) -> int:
    """The session's shuffle parallelism, for an explicit repartition."""
    return max(at_least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


#: A table of at most so many bytes, as ``volume`` counts them, is broadcast; a larger one is joined by a shuffle.
BROADCAST_BYTES = 32 << 20


def volume(df: DataFrame) -> int:
    """About how many bytes the rows of a written table hold: variable parts as they are, 8 for each field, 16 for a row."""
    parts = [F.lit(16 + 8 * len(df.columns))]
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        if kind in ("string", "binary"):
            parts.append(F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)))
        elif kind in ("array", "map", "struct"):
            parts.append(F.coalesce(F.octet_length(F.to_json(F.col(f"`{f.name}`"))), F.lit(0)))
    return df.agg(F.sum(sum(parts[1:], parts[0]).cast("long"))).first()[0] or 0


def broadcast_if_small(df: DataFrame, otherwise: str | None = None) -> DataFrame:
    """A written table with a broadcast hint if its counted size allows it, else with the hint ``otherwise``."""
    if volume(df) <= BROADCAST_BYTES:
        return F.broadcast(df)
    return df.hint(otherwise) if otherwise else df


#: Bits of the map that ``likely`` broadcasts (4 MB), in rows of so many.
MAP_BITS, ROW_BITS = 1 << 25, 1 << 15


def likely(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """The rows whose key is in ``keys``, and few others: a map of bits rules rows out before a join moves them.

    The map has a fixed size. None of the keys is missed; of other rows one in MAP_BITS / (keys) stays.
    """
    place = F.pmod(F.xxhash64(*on), F.lit(MAP_BITS))
    part, bit = (place / ROW_BITS).cast("long"), F.pmod(place, F.lit(ROW_BITS))
    found = keys.select(part.alias("__part"), bit.alias("__bit")).repartition("__part").groupBy("__part").agg(F.bitmap_construct_agg("__bit").alias("__map"))
    marked = rows.withColumns({"__at": part, "__bit": bit.cast("int")})
    byte = F.conv(F.hex(F.substring("__map", F.floor(F.col("__bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = byte.bitwiseAND(F.expr("shiftleft(1, __bit % 8)")) != 0
    return marked.join(F.broadcast(found), F.col("__at") == F.col("__part")).where(is_set).select(*rows.columns)
