"""Key assignment: dense ids, vocabulary enumeration and key continuation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossa.functions.scalars import in_order
from glossa.operators.dedup import both_large, first_wins, one_each, row_hash
from glossa.operators.dimensions import checked_dimension, materialize


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def assign_ids(df: DataFrame, order_cols: Sequence, id_col: str = "id", start: int | Column = 1,
               num_partitions: int | None = None) -> DataFrame:
    """Dense ids ``start .. start+n-1`` following the total order ``order_cols``.

    A global ``row_number()`` would pull every row into one task.  Instead:
    range-partition on the order, sort inside each partition, tag each row with
    its partition and position, write that once to the checkpoint folder (range
    boundaries are sampled, so both passes must see the same split), count rows
    per partition, turn the counts into prefix offsets (one row per partition:
    bounded by the partition count, so broadcast), and add them back.
    ``order_cols`` must be a total order (unique), or ids of ties are arbitrary.
    """
    order = _cols(order_cols)
    # without an explicit count the range shuffle starts at spark.sql.shuffle.partitions and AQE may merge
    # neighbouring ranges; merged ranges stay contiguous, so the position tags remain a total order
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    tagged = (ranged
                .sortWithinPartitions(*order)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_pos", F.monotonically_increasing_id()
                            - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    tagged = materialize(tagged)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_offset"))
    start_col = start if isinstance(start, Column) else F.lit(start)
    return (tagged.join(F.broadcast(offsets), "_pid")
                  .withColumn(id_col, (start_col + F.col("_offset") + F.col("_pos")).cast("long"))
                  .drop("_pid", "_pos", "_offset"))


def first_wins_with_ids(df: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str], id_col: str,
                        start: int | Column = 1, exclude: DataFrame | None = None,
                        carry: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """E5/E6 + E4: first row per key, numbered densely in ``order_cols`` order.

    The winners are found on narrow rows only (key, order and the small
    ``carry`` columns): first-wins with map-side partial aggregation, then the
    id pass, whose result is written once to the checkpoint folder.  The wide
    rows (texts) then meet the winners in one inner join on 128 bits of the
    whole row's hash, which picks exactly the winning rows: the texts are
    shuffled once and never aggregated, and the join key is free of hot values,
    as equal rows (a document repeated in the export) are cut down to one on
    either side of that shuffle.  Rows that tie in key and order but differ
    otherwise are told apart by that hash too, so a unit, its links and its
    media come from the same row.  ``exclude`` holds keys to skip (already
    stored: insert-if-absent).

    Returns (winning rows with ids, the written narrow frame: key, order,
    carry, id).  Consumers that need only the narrow columns (links, media)
    read the second one and never touch the texts again.
    """
    keys, order = list(key_cols), list(order_cols)
    narrow_cols = keys + [c for c in order + list(carry) if c not in keys]
    rows = df.withColumn("_h1", row_hash(df, df.columns, 1)).withColumn("_h2", row_hash(df, df.columns, 2))
    narrow = first_wins(rows.select(*narrow_cols, "_h1", "_h2"), keys, order[0])
    if exclude is not None:
        narrow = narrow.join(both_large(exclude.select(*keys)), keys, "left_anti")
    ids = assign_ids(narrow, order, id_col, start)
    numbered = ids.select(F.col("_h1").alias("_w1"), F.col("_h2").alias("_w2"), id_col)
    same = (F.col("_h1") == F.col("_w1")) & (F.col("_h2") == F.col("_w2"))
    wide = one_each(rows, ["_h1", "_h2"], "_h1").join(both_large(numbered), same).drop("_h1", "_h2", "_w1", "_w2")
    return wide, ids.drop("_h1", "_h2")


def enumerate_values(df: DataFrame, col: str, id_col: str = "id", start: int = 1,
                     drop_blank: bool = True, collation: str | None = None) -> tuple[DataFrame, int]:
    """Distinct values of ``col`` numbered ``start..`` through ``assign_ids`` whatever their number.

    The order is binary, or that of ``collation`` (values that are equal under it stay apart, in binary order).
    NULL and '' are dropped unless ``drop_blank`` is False.  Returns (frame, size).
    """
    values = df.select(F.col(col))
    if drop_blank:
        values = values.where(F.col(col).isNotNull() & (F.col(col) != F.lit("")))
    order = [in_order(col, collation).asc_nulls_first()] + ([F.col(col)] if collation else [])
    numbered = assign_ids(values.distinct(), order, id_col, start)
    return checked_dimension(numbered.select(F.col(id_col).cast("int").alias(id_col), col))


def next_start_value(target: DataFrame, id_col: str) -> int:
    row = target.agg(F.max(id_col).alias("m")).first()
    return int(row["m"] or 0) + 1
