"""Exact top-k search by inner product: tiled matrix products, a partial selection per tile, a merging tree.

Queries and candidates are dealt onto a grid of (query block, shard) tiles of bounded size. Each tile is one matrix
product with a partial selection of every query's best k; lists are then merged in a tree of bounded fan-in, so no task
ever sees more than ``FAN_IN * k`` rows of one query.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, ship

#: Rows of a tile's two sides, and lists merged at once. A tile's products are made in strips of STRIP queries.
TILE_QUERIES, TILE_VECTORS, STRIP, FAN_IN = 2048, 4096, 256, 16
_LONG = 2**63 - 1


def _floored(flat: np.ndarray, scale: float) -> np.ndarray:
    return np.floor(flat.astype("f8") * scale)


def _matrix(table: pa.Table, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, id, whether there is an id, floored matrix) of a tile's side, its last three columns; by id, then row, those
    without an id last, so that a lower index wins a tie."""
    row, named = table.column(table.num_columns - 3).to_numpy(), table.column(table.num_columns - 2)
    has = named.is_valid().to_numpy()
    ids = named.fill_null(0).to_numpy()
    flat = table.column(table.num_columns - 1).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    m = _floored(flat, scale).reshape(len(ids), len(flat) // max(1, len(ids)))
    order = np.lexsort((row, ids, ~has))
    return row[order], ids[order], has[order], m[order]


def _strip_scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products, as int64 (clamped to 64 bits where they would not fit)."""
    bound = np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * q.shape[1]
    if bound < 2**53:
        return (q @ c.T).astype("i8")
    exact = np.array([[int(x) for x in row] for row in q], object) @ np.array([[int(x) for x in row] for row in c], object).T
    return np.clip(exact, -_LONG - 1, _LONG).astype("i8")


def tile_best(queries: pa.Table, vectors: pa.Table, k: int, scale: float) -> pa.Table:
    """Each query row's best k of one tile, ties to the smaller id."""
    found: list[tuple[np.ndarray, ...]] = []
    if queries.num_rows and vectors.num_rows:
        q_row, q_id, _, q = _matrix(queries, scale)
        c_row, c_id, c_has, c = _matrix(vectors, scale)
        for at in range(0, len(q_row), STRIP):
            for i, score in enumerate(_strip_scores(q[at : at + STRIP], c), at):
                pool = np.arange(len(c_row))
                if len(pool) > k + 1:  # the query itself may be among them
                    least = np.partition(score, len(score) - k - 1)[len(score) - k - 1]
                    above = np.flatnonzero(score > least)
                    level = np.flatnonzero(score == least)[: k + 1]
                    pool = np.concatenate([above, level])
                pool = pool[c_row[pool] != q_row[i]]
                pool = pool[np.lexsort((pool, ~score[pool]))][:k]  # ~ turns the order without overflow
                found.append((np.full(len(pool), q_row[i]), np.full(len(pool), q_id[i]), c_row[pool], c_id[pool], c_has[pool], score[pool]))
    q_row, q_id, c_row, c_id, has, score = map(np.concatenate, zip(*found, strict=True)) if found else [np.empty(0, "i8")] * 4 + [np.empty(0, bool), np.empty(0, "i8")]
    return pa.table({"query_row": pa.array(q_row), "query_id": pa.array(q_id), "row": pa.array(c_row), "vec_id": pa.array(c_id, pa.int64(), mask=~has), "score": pa.array(score)})


def usable(vectors: DataFrame, scale: float) -> DataFrame:
    """(row, vec_id, embedding) of the rows that take part: every row for itself, also those that repeat an id or have none.

    A null vector, or a null or non-finite component (scaled) leaves a row out. ``row`` numbers the rows once they are
    written; floats travel as floats.
    """
    kind = vectors.schema["embedding"].dataType
    e = F.col("embedding") if isinstance(kind.elementType, T.FloatType) else F.col("embedding").cast("array<double>")
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * F.lit(scale)) < F.lit(float("inf"))))
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("embedding")).where(F.col("embedding").isNotNull() & whole)
    return materialise(kept.select(F.monotonically_increasing_id().alias("row"), "vec_id", "embedding"), "vectors")


def top_k(vectors: DataFrame, is_query: F.Column, k: int = 20, scale: float = 64.0) -> DataFrame:
    """(query_id, rank, vec_id, score): the exact k best of every query row by inner product of floor(scale * x).

    Candidates are all other rows, those of the same id and those without one too; ties go to the smaller id, rows without
    an id last. ``is_query`` reads ``vec_id``; query rows that repeat an id have a list each. Only vectors of one length
    are compared. Fewer than k candidates give all of them; no candidates, no rows. Other columns are not read.
    """
    ship(vectors.sparkSession)
    rows = usable(vectors, scale).withColumn("dim", F.size("embedding"))
    n, n_queries = rows.agg(F.count("*"), F.count_if(is_query)).first()
    shards, blocks = max(1, math.ceil(n / TILE_VECTORS)), max(1, math.ceil(n_queries / TILE_QUERIES))
    place = lambda seed, m: F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(m)).cast("int")
    q = rows.where(is_query).select("dim", place(1, blocks).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "row", "vec_id", "embedding")
    c = rows.select(F.col("dim").alias("c_dim"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("c_block"), place(2, shards).alias("c_shard"), F.col("row").alias("c_row"), F.col("vec_id").alias("c_vec_id"), F.col("embedding").alias("c_embedding"))

    def best(key, left: pa.Table, right: pa.Table) -> pa.Table:
        found = tile_best(left, right, k, scale)
        return found.append_column("shard", pa.array([key[2].as_py()] * found.num_rows, pa.int32()))

    lists = q.groupBy("dim", "block", "shard").cogroup(c.groupBy("c_dim", "c_block", "c_shard")).applyInArrow(best, "query_row long, query_id long, row long, vec_id long, score long, shard int")
    order = (F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    left = shards
    while left > 1:
        lists = lists.withColumn("shard", (F.col("shard") / FAN_IN).cast("int"))
        w = Window.partitionBy("query_row", "shard").orderBy(*order)
        lists = lists.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).drop("rank")
        left = math.ceil(left / FAN_IN)
    w = Window.partitionBy("query_row").orderBy(*order)
    return lists.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
