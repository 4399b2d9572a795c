"""Ordered first-wins deduplication (E5, E6, E7) and link dedup.

``dropDuplicates`` keeps an arbitrary row.  Here the winner's order value is
the ``min`` of a primitive column per key (a hash aggregation that combines
map-side, so a key holding a third of all rows is reduced inside every map
task), and one join on key and order picks the winning rows.  No text enters
an aggregate.  Rows that tie (the same key and order: a document repeated in an
export) are told apart by a hash of the whole row, and of equal rows one is
kept by a window whose group limit already cuts them down inside the map tasks.

Joins whose sides both grow with the input are merge joins by hint
(``both_large``): Spark's estimate of a side is that of the files behind it,
which rows unpivoted, hashed or repeated there exceed many times, so by that
estimate it broadcasts, through the driver, tables that no driver holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def both_large(df: DataFrame) -> DataFrame:
    """One side of a join that must not be broadcast, however small its files look."""
    return df.hint("merge")


def row_hash(df: DataFrame, cols: Sequence[str], seed: int = 0) -> Column:
    """A 64-bit hash of some columns (maps, which have no hash, are left out)."""
    return F.xxhash64(F.lit(seed), *[F.col(c) for c in cols if not isinstance(df.schema[c].dataType, T.MapType)])


def one_each(df: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """One row per value of ``keys``, the one with the least ``by``; a key that many rows share is cut down to one row
    in every map task before the shuffle (the window's group limit)."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(by))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def first_wins(df: DataFrame, key_cols: Sequence[str | Column], order: str | Column) -> DataFrame:
    """Keep per key the row with the least ``order`` (a fixed-width column; NULL comes last).

    One row per key, whatever repeats: of rows equal in key and order the one
    with the least row hash stays, so reruns agree.  ``key_cols`` may be names
    or named Column expressions; the output has the key columns followed by
    all input columns that are not keys.  NULL keys are one key.
    """
    keyed = df.select(*[k for k in key_cols if not isinstance(k, str)], "*")
    added = [c for c in keyed.columns if c not in df.columns]
    names = [k if isinstance(k, str) else None for k in key_cols]
    spare = iter(added)
    names = [n or next(spare) for n in names]
    ordered = keyed.withColumn("_order", F.col(order) if isinstance(order, str) else order)
    least = ordered.groupBy(*[F.col(n).alias(f"_k{i}") for i, n in enumerate(names)]).agg(F.min("_order").alias("_least"))
    same = [F.col(n).eqNullSafe(F.col(f"_k{i}")) for i, n in enumerate(names)]
    won = ordered.join(both_large(least), [*same, F.col("_order").eqNullSafe(F.col("_least"))])
    rest = [c for c in df.columns if c not in names]
    return one_each(won.select(*names, *rest, row_hash(df, rest).alias("_tie")), names, "_tie").drop("_tie")


def dedup_media(df: DataFrame) -> DataFrame:
    """One asset per (unit_id, file_name); audio precedes image."""
    kind_rank = F.when(F.col("asset_type") == "audio", F.lit(0)).otherwise(F.lit(1))
    return first_wins(df, ["unit_id", "file_name"], kind_rank)


def dedup_links(df: DataFrame, cols: Sequence[str] = ("unit_id", "tag_id")) -> DataFrame:
    """Drop repeated link pairs."""
    return df.dropDuplicates(list(cols))


