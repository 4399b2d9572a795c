"""Bucketed storage of the tables that meet on ``unit_id`` (the layout behind H1, I1 and I4).

Units, their bridges, vectors and feedback stored in the same number of buckets of one key join without an exchange:
every bucket meets its like.  Bucketed tables are tables of the session's catalog, their files under a given folder.
A hot unit's rows stay in one bucket; where a single unit holds a large share of a bridge, leave that table unbucketed,
so that its exchange can be split by AQE.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BY_UNIT = ("content_unit", "rel_content_tone", "rel_content_context", "vector_index", "correction_feedback_log")


def write_bucketed(tables: Mapping[str, DataFrame], root: str, prefix: str, buckets: int, key: str = "unit_id",
                   names: Sequence[str] = BY_UNIT) -> dict[str, DataFrame]:
    """Store the tables in ``names`` in ``buckets`` sorted buckets of ``key`` as ``<prefix>_<name>`` and read them back;
    the others are passed through.

    Rows are shuffled by the bucket's own key first, so each bucket is one sorted file, and a write of n tasks doesn't
    leave n files a bucket.  An existing table of that name is an error, never overwritten.
    """
    out = dict(tables)
    for name in names:
        if name in tables:
            spark = tables[name].sparkSession
            (tables[name].repartition(buckets, F.col(key)).write.bucketBy(buckets, key).sortBy(key).format("parquet")
             .option("path", f"{root.rstrip('/')}/{name}").saveAsTable(f"{prefix}_{name}"))
            out[name] = spark.table(f"{prefix}_{name}")
    return out


def drop_bucketed(spark: SparkSession, prefix: str, names: Sequence[str] = BY_UNIT) -> None:
    """Take the tables out of the catalog (external tables: their files stay)."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {prefix}_{name}")
