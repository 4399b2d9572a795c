"""Labelled rows for the trained operators: which may be learned from, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: str = "doc_id") -> Column:
    """True where crc32(doc_id as text) mod 3 is 1; a row without a doc_id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_labels(labels: DataFrame, column: str, bound: int) -> DataFrame:
    """doc_id, label (0.0 or 1.0), fold (0 to 3) of at most about ``bound`` labelled documents that are not held out.

    Repeated labels of a document count as their majority (ties: 1); null ids and labels teach nothing.  The sample
    keeps the documents whose hash falls below bound / (number of labels): no sort, and the same rows in every run.
    """
    rows = (labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & ~held_out()).groupBy("doc_id")
            .agg((F.avg(F.col(column).cast("double")) >= 0.5).cast("double").alias("label")))
    n = labels.count()
    share = min(1.0, bound / n) if n else 1.0
    hashed = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1 << 30))
    return rows.where(hashed < int(share * (1 << 30))).withColumn("fold", F.pmod(F.xxhash64(F.lit(6), "doc_id"), F.lit(4)).cast("int"))
