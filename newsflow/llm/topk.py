"""Exact search for the highest inner products: tiled matrix products and a tree of merges."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of a tile: candidates of a shard, queries of a block, lists merged at once.
SHARD_ROWS, BLOCK_ROWS, MERGED = 8192, 2048, 16
FOUND = "query_id long, shard int, vec_id long, score long"
LONG = 2**63


def usable(vector: Column) -> Column:
    """Whether a vector is neither NULL nor holds a NULL or non-finite component."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")),
    )
    return vector.isNotNull() & finite


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Integer components as doubles; missing trailing components are zero."""
    out = np.zeros((len(vectors), width))
    for row, vector in zip(out, vectors, strict=True):
        row[: len(vector)] = vector
    return np.floor(256.0 * out)


def _scores(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Exact inner products: in floating point while that cannot round, else in whole numbers."""
    bound = np.abs(queries).max(initial=0.0) * np.abs(shard).max(initial=0.0) * shard.shape[1]
    if bound < 2**24:
        return (queries.astype("f4") @ shard.astype("f4").T).astype("i8")
    if bound < 2**53:
        return (queries @ shard.T).astype("i8")
    whole = [[int(x) for x in row] for row in shard]
    rows = [[sum(a * b for a, b in zip(q, v)) for v in whole] for q in
            ([int(x) for x in row] for row in queries)]
    clipped = [[min(max(x, -LONG), LONG - 1) for x in row] for row in rows]
    return np.array(clipped, dtype="i8").reshape(len(queries), len(shard))


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores of every row, ties to the smaller position."""
    n = scores.shape[1]
    if np.abs(scores).max(initial=0) < 2**62 // max(n, 1):
        ranked = scores * n - np.arange(n)  # a tie's place breaks it: no two are equal
        if n > k:
            return np.argpartition(ranked, n - k, axis=1)[:, n - k :]
        return np.broadcast_to(np.arange(n), scores.shape)
    return np.argsort(-scores.astype(object), axis=1, kind="stable")[:, :k]


def _tile(k: int):
    def search(key: tuple, queries: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({c: [] for c in ("query_id", "shard", "vec_id", "score")}, dtype="i8")
        if not len(queries) or not len(shard):
            return empty
        shard = shard.sort_values("vec_id", ignore_index=True)
        lengths = [*map(len, queries["query"]), *map(len, shard["vector"])]
        query_ids, vec_ids = queries["query_id"].to_numpy(), shard["vec_id"].to_numpy()
        candidates = _matrix(shard["vector"], max(lengths))
        found = []
        step = max(1, 2**22 // len(shard))
        for at in range(0, len(queries), step):
            ids = query_ids[at : at + step]
            scores = _scores(_matrix(queries["query"][at : at + step], max(lengths)), candidates)
            best = _best(scores, k + 1)  # one more: the query's own row goes
            frame = pd.DataFrame(
                {
                    "query_id": np.repeat(ids, best.shape[1]),
                    "shard": key[1],
                    "vec_id": vec_ids[best].ravel(),
                    "score": np.take_along_axis(scores, best, axis=1).ravel(),
                }
            )
            found.append(frame[frame["query_id"] != frame["vec_id"]])
        return pd.concat(found)

    return search


def _top(lists: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The ``k`` highest inner products of every query with all other vectors.

    Returns query_id, rank (from 1), vec_id, score; fewer rows where there are fewer candidates.
    Components become ``floor(256 * x)``; scores are exact and saturate at the bounds of a long.
    Equal scores go to the smaller id. Vectors that are NULL or hold a NULL or non-finite component,
    and rows without an id, take no part. Of rows repeated with one id the smallest vector counts,
    once. A shorter vector counts as padded with zeros. ``is_query`` is a condition on the id column.

    Queries in blocks meet candidates in shards, one matrix product per tile; the tile lists are
    merged in a tree, so no task sees more than ``MERGED`` lists of a query.
    """
    rows = (
        vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
        .select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"),
                is_query.alias("is_query"))
        .groupBy("vec_id").agg(F.min("vector").alias("vector"), F.max("is_query").alias("is_query"))
    )
    sizes = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("is_query").cast("long")), F.lit(0)))
    n, n_queries = sizes.first()
    shards, blocks = math.ceil(n / SHARD_ROWS) or 1, math.ceil(n_queries / BLOCK_ROWS) or 1

    def dealt(parts: int, salt: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(parts)).cast("int")

    def every(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    # fmt: off
    queries = rows.where("is_query").select(
        F.col("vec_id").alias("query_id"), F.col("vector").alias("query"),
        dealt(blocks, 1).alias("block"), every(shards).alias("shard"),
    )
    # fmt: on
    candidates = rows.select(
        "vec_id", "vector", every(blocks).alias("block"), dealt(shards, 2).alias("shard")
    )
    lists = (
        queries.groupBy("block", "shard")
        .cogroup(candidates.groupBy("block", "shard"))
        .applyInPandas(_tile(k), FOUND)
    )
    while shards > MERGED:
        lists = lists.withColumn("shard", (F.col("shard") / MERGED).cast("int"))
        lists = _top(lists, k, "query_id", "shard").drop("rank")
        shards = math.ceil(shards / MERGED)
    return _top(lists, k, "query_id").select("query_id", "rank", "vec_id", "score")
