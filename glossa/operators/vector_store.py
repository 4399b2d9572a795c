"""Stored vectors for retrieval (L1, L2): partitioned by model, clustered, with bounds that let a search skip clusters.

A store is a folder: ``vectors`` (Parquet, partitioned by ``model_id`` and ``cluster``) and ``regions``, a row per model
and cluster with its centroid, number of vectors, radius and greatest norm.  The model's files alone are read (L1), and
of those only the clusters that can hold a top-k member (L2): no vector of a cluster scores above
``min(q.c + |q| radius, |q| max_norm)``.  The centroids are fitted on a bounded sample; every vector is stored, and the
bounds come from all of them, so the search is exact whatever the sample was.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossa.operators.dimensions import materialize
from glossa.operators.keys import assign_ids
from glossa.operators.retrieval import HIT_SCHEMA, STEP_BYTES, block_size, best_of_step, merge_best, model_scope

#: Bytes of doubles in the sample that the centroids are fitted on, and in all centroids together.
SAMPLE_BYTES = 64 << 20
CENTROID_BYTES = 8 << 20
#: The cluster of vectors that can't be scored: none, of another than the commonest length, or with an entry that is not finite.
UNSCORED = -1
ROUNDS = 10


def fit_centroids(sample: np.ndarray, clusters: int, seed: int = 5) -> np.ndarray:
    """Lloyd's rounds over the sample, from different rows of it drawn by the seed; a centroid without rows stays."""
    distinct = np.unique(sample, axis=0)
    rng = np.random.default_rng(seed)
    centroids = distinct[rng.permutation(len(distinct))[:clusters]]
    for _ in range(ROUNDS):
        owner = nearest(sample, centroids)[0]
        n = np.bincount(owner, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, owner, sample)
        centroids = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centroids)
    return centroids


def nearest(rows: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the nearest centroid of each row, the distance to it)."""
    owner = np.empty(len(rows), np.int64)
    step = max(1, STEP_BYTES // (8 * len(centroids)))
    half = (centroids ** 2).sum(axis=1) / 2
    for a in range(0, len(rows), step):
        owner[a:a + step] = np.argmax(rows[a:a + step] @ centroids.T - half, axis=1)
    return owner, np.sqrt(((rows - centroids[owner]) ** 2).sum(axis=1))


def write_store(vectors: DataFrame, path: str, clusters: int = 256) -> None:
    """Cluster ``vectors(vector_id, model_id, embedding, ...)`` and store them under ``path``.

    At most ``clusters`` centroids, shared by all models, fitted on the rows with the least hash of their id up to
    SAMPLE_BYTES.  A cluster that holds most rows is split over many tasks and files (a rebalance by model and cluster,
    which AQE cuts).  Vectors that can't be scored are stored, in a cluster of their own.  An empty frame gives an
    empty store.
    """
    spark = vectors.sparkSession
    lengths = vectors.where("embedding is not null").groupBy(F.size("embedding").alias("d")).count()
    common = lengths.orderBy(F.desc("count"), "d").first()
    dim = common["d"] if common else 0
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    usable = F.coalesce((F.size("embedding") == dim) & finite, F.lit(False)) if dim > 0 else F.lit(False)
    rows = SAMPLE_BYTES // (8 * max(dim, 1))
    drawn = vectors.where(usable).orderBy(F.xxhash64("vector_id")).select("embedding").limit(rows).collect()
    centroids = np.zeros((1, dim))
    if drawn:
        centroids = fit_centroids(np.array([r[0] for r in drawn], np.float64), max(1, min(clusters, CENTROID_BYTES // (8 * dim))))
    sent = spark.sparkContext.broadcast(centroids)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            cluster, distance, norm = np.full(len(pdf), UNSCORED, np.int32), np.zeros(len(pdf)), np.zeros(len(pdf))
            ok = np.flatnonzero(pdf["_usable"].to_numpy())
            if len(ok):
                mat = np.vstack([np.asarray(e, np.float64) for e in pdf["embedding"].iloc[ok]])
                cluster[ok], distance[ok] = nearest(mat, sent.value)
                norm[ok] = np.sqrt((mat ** 2).sum(axis=1))
            yield pdf.drop(columns="_usable").assign(cluster=cluster, distance=distance, norm=norm)

    schema = T.StructType([*vectors.schema.fields, T.StructField("cluster", T.IntegerType()),
                           T.StructField("distance", T.DoubleType()), T.StructField("norm", T.DoubleType())])
    placed = vectors.withColumn("_usable", usable).mapInPandas(assign, schema)
    placed.hint("rebalance", "model_id", "cluster").write.partitionBy("model_id", "cluster").parquet(f"{path}/vectors")
    stored = spark.read.schema(schema).parquet(f"{path}/vectors")
    middles = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centroids)], "cluster int, centroid array<double>")
    bounds = (stored.where(F.col("cluster") != UNSCORED).groupBy("model_id", "cluster")
              .agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("radius"), F.max("norm").alias("max_norm")))
    bounds.join(middles, "cluster").write.parquet(f"{path}/regions")


def read_store(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The stored vectors, ``schema`` being that of the frame that was written: filters on model_id and cluster choose files."""
    full = T.StructType([*schema.fields, T.StructField("cluster", T.IntegerType())])
    return spark.read.schema(full).parquet(f"{path}/vectors")


def _score(scope: DataFrame, sent, k: int) -> DataFrame:
    """Each partition's ``k`` best per query; a cluster meets the queries that it is wanted by."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, mat, wanted = sent.value
        best = None
        step = max(1, STEP_BYTES // (8 * len(ids)))
        for batch in batches:
            for cluster, rows in batch.groupby("cluster", sort=False):
                asked = wanted[int(cluster)]
                for a in range(0, len(rows), step):
                    best = merge_best(best, best_of_step(rows.iloc[a:a + step], ids[asked], mat[asked], k), k)
        if best is not None:
            yield best

    return scope.select("vector_id", "unit_id", "embedding", "cluster").mapInPandas(score, HIT_SCHEMA)


def similar_in_store(queries: DataFrame, path: str, schema: T.StructType, k: int, model_id: int,
                     block_queries: int | None = None) -> tuple[DataFrame, dict[str, int]]:
    """L2 on a store: (top-``k`` hits per query with rank, {"scored": pairs scored, "pairs": all pairs}).

    The same rows as ``retrieval.similar`` on the vectors that can be scored: ties by vector id, fewer than ``k`` where
    the model has fewer.  For every block of queries the clusters with the highest bounds, as many as hold ``k``
    vectors, are scored first; the ``k``-th score is the floor below which a cluster's bound excludes it, and the rest
    is scored next.  A query without an embedding, or a model without vectors, has no hits.
    """
    spark = queries.sparkSession
    regions = model_scope(spark.read.schema("cluster int, model_id int, n long, radius double, max_norm double, centroid array<double>")
                          .parquet(f"{path}/regions"), model_id).orderBy("cluster").collect()  # CENTROID_BYTES at most
    scope = model_scope(read_store(spark, path, schema), model_id)
    numbered = assign_ids(queries.where("embedding is not null").select(F.col("query_id").cast("long"), "embedding"), ["query_id"], "_qn")
    total = numbered.count()
    report = {"scored": 0, "pairs": total * sum(r["n"] for r in regions)}
    found = None
    if regions:
        cluster = np.array([r["cluster"] for r in regions])
        held = np.array([r["n"] for r in regions])
        centre = np.array([r["centroid"] for r in regions])
        radius, most = (np.array([r[c] for r in regions]) for c in ("radius", "max_norm"))
    size = block_queries or (block_size(centre.shape[1]) if regions else 1)
    for lo in range(0, total if regions else 0, size):
        rows = numbered.where((F.col("_qn") > lo) & (F.col("_qn") <= lo + size)).select("query_id", "embedding").collect()
        ids, mat = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.float64)
        if mat.ndim != 2 or mat.shape[1] != centre.shape[1]:
            raise ValueError(f"queries must have {centre.shape[1]} dimensions like the stored vectors")
        norm = np.sqrt((mat ** 2).sum(axis=1))[:, None]
        # the last term covers the rounding of sums over all dimensions
        bound = np.minimum(mat @ centre.T + norm * radius, norm * most) + 1e-9 * norm * (most + radius)
        order = np.argsort(-bound, axis=1, kind="stable")
        before = np.cumsum(held[order], axis=1) - held[order]
        first = np.zeros(bound.shape, bool)
        np.put_along_axis(first, order, before < k, axis=1)

        def scored(asked: np.ndarray) -> DataFrame:
            wanted = {int(cluster[c]): np.flatnonzero(asked[:, c]) for c in np.flatnonzero(asked.any(axis=0))}
            sent = spark.sparkContext.broadcast((ids, mat, wanted))
            out = materialize(_score(scope.where(F.col("cluster").isin(list(wanted))), sent, k))
            sent.unpersist()
            report["scored"] += int((asked * held).sum())
            return out

        parts = scored(first)
        floors = {r["query_id"]: r["score"] for r in _ranked(parts, k).where(F.col("rank") == k).select("query_id", "score").collect()}
        floor = np.array([floors.get(int(i), -np.inf) for i in ids])[:, None]
        rest = ~first & (bound >= floor)
        if rest.any():
            parts = parts.unionByName(scored(rest))
        found = parts if found is None else found.unionByName(parts)
    if found is None:
        return spark.createDataFrame([], HIT_SCHEMA + ", rank long"), report
    return _ranked(found, k), report


def _ranked(candidates: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vector_id"))
    return candidates.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)
