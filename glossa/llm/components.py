"""Connected components of an edge table: stars inside the tasks, then alternating large-star / small-star rounds on DataFrames."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import release, stage

#: Edges that a task holds at once.
HELD = 1 << 17


def _least(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node reachable over these edges) for every node that is not itself the least."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    least = np.arange(len(nodes))
    while (least[x] != least[y]).any():
        i, j = least[x], least[y]
        np.minimum.at(least, np.maximum(i, j), np.minimum(i, j))
        while (least[least] != least).any():
            least = least[least]
    moved = np.flatnonzero(least != np.arange(len(nodes)))
    return nodes[moved], nodes[least[moved]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars in place of the edges that come together, HELD of them at a time; what they connect stays the same."""
    held, n = [], 0

    def stars() -> pa.RecordBatch:
        ends = (np.concatenate([batch.column(c).to_numpy() for batch in held]) for c in "ab")
        return pa.RecordBatch.from_arrays([pa.array(x) for x in _least(*ends)], ["a", "b"])

    for batch in batches:
        for i in range(0, batch.num_rows, HELD):
            part = batch.slice(i, HELD)
            if held and n + part.num_rows > HELD:
                yield stars()
                held, n = [], 0
            held.append(part)
            n += part.num_rows
    if held:
        yield stars()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round over edges with a > b. large: each node sends its larger neighbours to its least neighbour; small: the
    others and itself."""
    turned = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    near = edges.select(F.explode(turned).alias("e")).select("e.*") if large else edges.select("a", "b")
    least = near.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("n", "m").alias("m"))
    moved = near.where(F.col("b") > F.col("a")) if large else near.select("a", F.explode(F.array("b", "a")).alias("b"))
    out = (moved.join(least, F.col("a") == F.col("n"))
           .select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).where("a != b"))
    return out if large else out.distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every edge points at its component's least node: no target has an edge of its own, no node has two."""
    ends = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.lit(None).cast("long").alias("b")))).alias("e")).select("e.*")
    of = ends.groupBy("a").agg(F.min("b").alias("lo"), F.max("b").alias("hi"), F.max(F.col("b").isNull()).alias("target"))
    return of.where("lo != hi or (lo is not null and target)").isEmpty()


def _contracted(edges: DataFrame) -> tuple[DataFrame, bool]:
    """(staged stars that connect what the edges connect, whether one piece held all of them); about HELD edges a task."""
    n = edges.count()
    return stage(edges.coalesce(max(1, -(-n // HELD))).mapInArrow(_contract, "a long, b long"), "edges"), n <= HELD


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the least node reachable, for every node of the edges (a, b) that is not itself the least.

    Before each round the tasks make stars of the edges they read, HELD at a time, so few rounds are left to do.  Each
    round is equi-joins and partial aggregations, so a hub's neighbours are never gathered in one place; the
    number of rounds grows with the logarithm of the longest chain.  Nulls and self-loops are dropped; repeated edges
    count once; no edges give an empty table.
    """
    down = edges.where("a is not null and b is not null and a != b").select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b"))
    now, whole = _contracted(down)
    for _ in range(max_rounds):
        if whole or _settled(now):
            break
        starred = stage(_star(_star(now, True), False), "starred")
        grown, whole = _contracted(starred)
        release(now, starred)
        now = grown
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    # settled: every edge points from a node to its component's least node
    out = now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    out._staged_path = now._staged_path
    return out
