"""Joins (B1/C1, C5, C6, C8, C11-C14).

Anti-joins are written as ``left_anti``, never as ``NOT IN``: Spark plans a
null-aware ``NOT IN`` as a broadcast of the whole right side whatever its
size.  The NULL rules of ``NOT IN`` are restored with one single-row
aggregate over the right keys.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.operators.dimensions import Size, materialize, maybe_broadcast


def audit_language_level(units: DataFrame, variants: DataFrame, variant_name: str, level: str) -> DataFrame:
    """B1 + C1: texts of one variant (by name) at one level; units without a variant drop out.

    The level filter sinks to the scan; the filtered dimension keeps its size-checked broadcast hint.
    """
    lv = variants.where(F.col("variant_name") == variant_name).select("variant_id", "variant_name")
    return (units.where(F.col("cefr_level") == level).join(lv, "variant_id")
            .select("content_raw", "variant_name", "cefr_level"))


def not_in(left: DataFrame, right: DataFrame, left_col: str, right_col: str | None = None) -> DataFrame:
    """``left WHERE left_col NOT IN (SELECT right_col FROM right)`` with SQL's NULL rules.

    Any NULL on the right empties the result; with a non-empty right side,
    left rows whose key is NULL are dropped; with an empty right side every
    left row stays.  The guard is one single-row aggregate (two scalars).
    """
    rc = right_col or left_col
    keys = right.select(F.col(rc).alias("_k"))
    guard = keys.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_k").isNull()).alias("nulls")).first()
    if guard["nulls"] > 0:
        return left.where(F.lit(False))
    if guard["n"] == 0:
        return left
    distinct_keys = keys.distinct()
    return (left.where(F.col(left_col).isNotNull())
                .join(distinct_keys, F.col(left_col) == F.col("_k"), "left_anti"))


def units_without_vector(units: DataFrame, vectors: DataFrame) -> DataFrame:
    """Units not yet in the vector index (NOT IN semantics, anti-join plan)."""
    return not_in(units.select("unit_id", "content_raw"), vectors, "unit_id")


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """C14: child rows whose non-NULL foreign key has no parent row (NULL keys are valid).

    Parent keys are de-duplicated before the anti-join, so a parent repeated
    many times does not inflate the build side.
    """
    keys = parent.select(F.col(pk).alias("_pk")).where(F.col("_pk").isNotNull()).distinct()
    return child.where(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_pk"), "left_anti")


def with_parent(variants: DataFrame, id_col: str = "variant_id", parent_col: str = "parent_variant_id",
                name_col: str = "variant_name") -> DataFrame:
    """C11: each variant with its parent's id and name (roots keep NULLs)."""
    p = variants.select(F.col(id_col).alias("_pid"), F.col(name_col).alias("parent_name"))
    return variants.join(p, F.col(parent_col) == F.col("_pid"), "left").drop("_pid")


def variant_roots(tree: DataFrame, id_col: str = "variant_id", parent_col: str = "parent_variant_id") -> DataFrame:
    """Every node with its root and depth, by pointer jumping.

    Each round replaces a node's known ancestor by that ancestor's ancestor
    and adds the distances, so a chain of depth d resolves in about log2(d)
    rounds of one equi-join each (not d rounds of a recursive CTE).  Every
    round is written to the checkpoint folder.  A node whose parent is not in
    the tree counts as a root; nodes on or below a cycle never reach a root
    and get NULL root and depth with ``in_cycle`` true.
    """
    nodes = tree.select(F.col(id_col).alias("node"), F.col(parent_col).alias("parent"))
    n_nodes = nodes.count()
    size = Size(n_nodes, 32 * n_nodes)  # the broadcast frames hold up to three fixed-width columns per node
    ids = nodes.select(F.col("node").alias("_known"))
    start = (nodes.join(maybe_broadcast(ids, size), F.col("parent") == F.col("_known"), "left")
                  .select("node",
                          F.when(F.col("_known").isNull(), F.col("node")).otherwise(F.col("parent")).alias("anc"),
                          F.when(F.col("_known").isNull(), F.lit(0)).otherwise(F.lit(1)).alias("dist")))
    state = materialize(start)
    rounds = max(1, math.ceil(math.log2(max(n_nodes, 2)))) + 1
    for _ in range(rounds):
        hop = state.select(F.col("node").alias("_a"), F.col("anc").alias("_anc2"), F.col("dist").alias("_d2"))
        nxt = (state.join(maybe_broadcast(hop, size), F.col("anc") == F.col("_a"))
                    .select("node", F.col("_anc2").alias("anc"),
                            F.when(F.col("_anc2") == F.col("anc"), F.col("dist"))
                             .otherwise(F.col("dist") + F.col("_d2")).alias("dist"),
                            (F.col("_anc2") != F.col("anc")).alias("_moved")))
        nxt = materialize(nxt)
        if nxt.where("_moved").limit(1).count() == 0:
            state = nxt.drop("_moved")
            break
        state = nxt.drop("_moved")
    # a root points at itself at distance 0; a cycle node may point at itself too, but never at distance 0
    roots = state.where((F.col("node") == F.col("anc")) & (F.col("dist") == 0)).select(F.col("node").alias("_r"))
    resolved = state.join(maybe_broadcast(roots, size), F.col("anc") == F.col("_r"), "left")
    done = F.col("_r").isNotNull()
    return resolved.select(F.col("node").alias(id_col),
                           F.when(done, F.col("anc")).alias("root_id"),
                           F.when(done, F.col("dist")).alias("depth"),
                           (~done).alias("in_cycle"))


def pivot_pairs(units: DataFrame, src_variant: int, pivot_variant: int, dst_variant: int,
                doc_col: str = "doc_id") -> DataFrame:
    """Source text -> pivot (English) -> target text of the same source document.

    One grouping by document brings its three legs together: the units are
    read and shuffled once.  A document without a source text has no row; one
    without a pivot or target text keeps NULLs.  A document has at most one
    unit for each variant and text, so a group holds a document's own units.
    """
    def leg(v):
        return F.collect_list(F.when(F.col("variant_id") == v, F.struct("unit_id", "content_raw")))

    legs = (units.where(F.col("variant_id").isin(src_variant, pivot_variant, dst_variant)).groupBy(doc_col)
            .agg(leg(src_variant).alias("src"), leg(pivot_variant).alias("pivot"), leg(dst_variant).alias("dst")))
    out = legs.withColumn("src", F.explode("src")).withColumn("pivot", F.explode_outer("pivot")).withColumn("dst", F.explode_outer("dst"))
    return out.select(doc_col, *[F.col(f"{tag}.{c}").alias(f"{tag}_{n}") for tag in ("src", "pivot", "dst")
                                 for c, n in (("unit_id", "unit_id"), ("content_raw", "text"))])
