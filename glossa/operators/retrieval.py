"""Retrieval scope (L1-L3): per-model vector scope, exact batch top-k, context of the hits.

The search is exact (brute force): every in-scope vector is scored against
the queries, a block of them at a time.  A block's size follows from the
dimension, so that neither its broadcast nor the scores of an Arrow batch
exceed a fixed number of bytes; blocks are scored one after the other, and
the driver holds one at a time.  Each partition scores its vectors with one
matrix product and keeps only its own k best per query, so at most k rows per
query and partition are shuffled for the final ranking; no (query, vector)
pair is ever a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glossa.operators.dimensions import materialize
from glossa.operators.keys import assign_ids

HIT_SCHEMA = "query_id long, vector_id long, unit_id long, score double"


def model_scope(vectors: DataFrame, model_id: int) -> DataFrame:
    """L1: only the vectors of one model (a pushed-down filter; partition pruning when stored by model)."""
    return vectors.where(F.col("model_id") == model_id)


#: Bytes of a block's matrix, and of the scores of one step of a task.
BLOCK_BYTES = 8 << 20
STEP_BYTES = 32 << 20


def block_size(dimension: int) -> int:
    """Queries in a block: at most BLOCK_BYTES of doubles, and 512."""
    return max(1, min(512, BLOCK_BYTES // (8 * max(dimension, 1))))


def best_of_step(pdf: pd.DataFrame, ids: np.ndarray, mat: np.ndarray, k: int) -> pd.DataFrame:
    """The ``k`` best vectors of ``pdf`` for each query, and all that tie with the ``k``-th."""
    emb = np.vstack([np.asarray(e, dtype=np.float64) for e in pdf["embedding"]])
    s = emb @ mat.T                                    # (vectors, queries)
    take = min(k, len(pdf))
    # the k-th best score of each query in this batch; every vector at or above it stays a
    # candidate, so vectors tied at the boundary all reach the (score, vector_id) ranking
    kth = -np.partition(-s, take - 1, axis=0)[take - 1]
    vi, qi = np.nonzero(s >= kth[None, :])
    return pd.DataFrame({
        "query_id": ids[qi],
        "vector_id": pdf["vector_id"].to_numpy()[vi],
        "unit_id": pdf["unit_id"].to_numpy()[vi],
        "score": s[vi, qi],
    })


def merge_best(best: pd.DataFrame | None, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """Only ``k`` per query across the batches of a partition (ties by vector id)."""
    best = rows if best is None else pd.concat([best, rows], ignore_index=True)
    return (best.sort_values(["query_id", "score", "vector_id"], ascending=[True, False, True])
                .groupby("query_id", sort=False).head(k))


def _score_block(scope: DataFrame, bq, k: int) -> DataFrame:
    """Per-partition candidates of one broadcast block of queries (at most k per query)."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, mat = bq.value
        best: pd.DataFrame | None = None
        step = max(1, STEP_BYTES // (8 * len(ids)))
        for pdf in (batch.iloc[a:a + step] for batch in batches for a in range(0, len(batch), step)):
            best = merge_best(best, best_of_step(pdf, ids, mat, k), k)
        if best is not None:
            yield best

    return scope.select("vector_id", "unit_id", "embedding").mapInPandas(score, HIT_SCHEMA)


def similar(queries: DataFrame, vectors: DataFrame, k: int, model_id: int | None = None,
            block_queries: int | None = None) -> DataFrame:
    """L2: top-``k`` vectors per query by dot product; ties broken by vector id.

    ``queries(query_id, embedding)``; ``vectors(vector_id, unit_id, model_id, embedding)``.
    The queries are numbered densely and scored in blocks (``block_size`` of
    their dimension unless ``block_queries`` says otherwise): each is one
    scoring pass over the in-scope vectors, whose candidates are written
    before the next block is sent, so any number of queries is handled exactly.
    """
    scope = model_scope(vectors, model_id) if model_id is not None else vectors
    spark = scope.sparkSession
    numbered = assign_ids(queries.select(F.col("query_id").cast("long"), "embedding"), ["query_id"], "_qn")
    n, dimension = numbered.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    size = block_queries or block_size(dimension or 1)
    candidates = None
    for lo in range(0, n, size):
        rows = numbered.where((F.col("_qn") > lo) & (F.col("_qn") <= lo + size)).select("query_id", "embedding").collect()
        bq = spark.sparkContext.broadcast((np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.float64)))
        part = materialize(_score_block(scope, bq, k))
        bq.unpersist()
        candidates = part if candidates is None else candidates.unionByName(part)
    if candidates is None:
        return spark.createDataFrame([], HIT_SCHEMA + ", rank long")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vector_id"))
    return (candidates.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k))


def centroid_queries(vectors: DataFrame, group_col: str) -> DataFrame:
    """Query vectors derived from the index: the mean embedding of each group (e.g. label)."""
    per_dim = (vectors.select(F.col(group_col).alias("query_id"), F.posexplode("embedding").alias("pos", "x"))
                      .groupBy("query_id", "pos").agg(F.avg(F.col("x").cast("double")).alias("x")))
    return (per_dim.groupBy("query_id")
                   .agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("_e"))
                   .select(F.col("query_id").cast("long"), F.transform("_e", lambda e: e["x"]).alias("embedding")))


def context_for(hits: DataFrame, view: DataFrame) -> DataFrame:
    """L3: the context-view rows of the hit units (inner join on unit_id)."""
    return hits.join(view, "unit_id")
