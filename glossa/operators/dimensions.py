"""Small derived dimensions: materialise once, check the size, then broadcast.

A dimension derived from a fact table (the distinct languages of the
documents, the distinct sources) has no size bound by construction.  It is
written once to the reliable checkpoint folder, counted from those files,
and hinted for broadcast only when the count is within ``max_rows``;
beyond that the join stays a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.session import ensure_checkpoint_dir

# Limits above which a dimension is no longer broadcast.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 << 20


class Size(int):
    """A row count that also carries the dimension's serialized size in bytes."""

    def __new__(cls, rows: int, nbytes: int = 0):
        obj = int.__new__(cls, rows)
        obj.bytes = int(nbytes)
        return obj

    def plus(self, rows: int, nbytes: int) -> "Size":
        return Size(int(self) + rows, self.bytes + nbytes)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def checked_dimension(df: DataFrame) -> tuple[DataFrame, Size]:
    """Materialise a derived dimension; return it with its rows and (JSON-serialized) bytes, from one aggregate."""
    m = materialize(df)
    row = m.agg(F.count(F.lit(1)).alias("n"),
                F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*m.columns)))), F.lit(0)).alias("b")).first()
    return m, Size(row["n"], row["b"])


def maybe_broadcast(df: DataFrame, size: int, max_rows: int = MAX_BROADCAST_ROWS,
                    max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only within both limits (a plain int is a row count of a literal-sized frame)."""
    fits = int(size) <= max_rows and getattr(size, "bytes", 0) <= max_bytes
    return F.broadcast(df) if fits else df
