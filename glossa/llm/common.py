"""Helpers shared by the training-data operators: staged tables, word arrays, hashes, ordered prefix sums."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glossa.session import ensure_checkpoint_dir

#: A word, as the contracts state it: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that one vectorised step works on; bounds a task's memory whatever the batch size.
SLICE_BYTES = 2 << 20
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
GROUP_ROWS = "parquet.block.row.count.limit"


# --- staged tables -----------------------------------------------------------------------------------------------
def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new fully qualified path in the shared folder that ``spark.checkpoint.dir`` names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark)}/{tag}-{uuid.uuid4().hex}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(path).toString()


@contextmanager
def batches_of(spark: SparkSession, rows: int | None) -> Iterator[None]:
    """Jobs that run inside hand Python Arrow batches of at most ``rows`` rows (a smaller bound of the session holds).

    For wide rows: a batch lies in the JVM and in Python at once, outside the heap of either, for every core of an executor.
    """
    usual = spark.conf.get(BATCH_ROWS)
    if rows and not 0 < int(usual) <= rows:
        spark.conf.set(BATCH_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, usual)


def stage(df: DataFrame, tag: str, batch_rows: int | None = None, group_rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts lineage, survives lost executors.

    ``batch_rows``: as ``batches_of`` says.  ``group_rows``: most rows of a row group, for wide rows: a group is held
    while it is written, and by readers, which decode as much of it as they have rows in a batch.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    with batches_of(spark, batch_rows):
        (df.write.option(GROUP_ROWS, group_rows) if group_rows else df.write).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def release(*frames: DataFrame) -> None:
    """Delete staged tables that nothing reads any more, and let Spark's cleaner drop finished jobs' shuffle files.

    The cleaner waits for the driver's garbage collection, which a driver with little to do may put off for long.
    """
    if frames:
        frames[0].sparkSession._jvm.System.gc()
    for df in frames:
        path = getattr(df, "_staged_path", None)
        if path:
            p = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# --- words as arrays ---------------------------------------------------------------------------------------------
def slices(batches: Iterator[pa.RecordBatch], text: str, nbytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``nbytes`` of text (one row at least; a row is never cut)."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(lengths, dtype=np.int64) // nbytes
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def gathered(batches: Iterator[pa.RecordBatch], text: str, nbytes: int) -> Iterator[pa.RecordBatch]:
    """``slices``, with small batches put together to about ``nbytes`` of text."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in slices(batches, text, nbytes):
        more = pc.sum(pc.binary_length(batch.column(text))).as_py() or 0
        if held and size + more > nbytes:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += more
    if held:
        yield pa.concat_batches(held)


def text_array(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The texts without nulls, their bytes beginning at offset 0 (Arrow's case folding needs that)."""
    texts = pc.fill_null(batch.column(name).cast(pa.large_string()), "")
    if not len(texts):
        return texts
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = data.slice(int(ends[0]), int(ends[-1] - ends[0])) if data is not None else pa.py_buffer(b"")
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(ends - ends[0]), data)


class Words:
    """The words of a slice of texts: ``codes`` into ``vocab`` (bytes), text ``i`` owning ``bounds[i]:bounds[i + 1]``."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
        values = lists.flatten()
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
        real = pc.greater(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
        if not real.all():
            bounds = np.concatenate([[0], np.cumsum(real, dtype=np.int64)])[bounds]
            values = values.filter(pa.array(real))
        encoded = values.dictionary_encode()
        self.codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.vocab = [w.encode() for w in encoded.dictionary.to_pylist()]
        self.bounds = bounds

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word, in text order."""
        of = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in self.vocab), np.uint64, len(self.vocab))
        return of[self.codes] if len(self.vocab) else np.zeros(0, np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_STEP = np.uint64(0x9E3779B97F4A7C15)


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` values of the whole array (runs across texts included; callers mask those)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h *= _STEP
        h += words[j:j + n]
    h += np.uint64(k)
    return mix64(h)


def shingle_sets(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the sorted distinct ``k``-word shingles of each text; fewer words: the sequence as one."""
    h, bounds = words.hashes(), words.bounds
    n = np.diff(bounds)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(n)), count)
    first = np.concatenate([[0], np.cumsum(count)])
    full = window_hashes(h, k)
    at = bounds[owner] + np.arange(len(owner)) - first[owner]
    out = full[np.minimum(at, max(len(full) - 1, 0))] if len(full) else np.zeros(len(owner), np.uint64)
    for i in np.flatnonzero((n > 0) & (n < k)):
        out[first[i]] = window_hashes(h[bounds[i]:bounds[i + 1]], int(n[i]))[0]
    order = np.lexsort((out, owner))
    out, owner = out[order], owner[order]
    fresh = np.ones(len(out), bool)
    fresh[1:] = (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])
    return out[fresh], np.searchsorted(owner[fresh], np.arange(len(n) + 1))


# --- ordered prefix sums -----------------------------------------------------------------------------------------
def prefix_sums(df: DataFrame, order: Sequence[Column], value: str, out: str, group: str | None = None,
                tag: str = "prefix") -> tuple[DataFrame, DataFrame]:
    """``out``: the sum of ``value`` over the rows before each row in the total order (inside its ``group`` if given).

    No global window: the rows are range-partitioned by the order and written once with their partition's number
    (boundaries are sampled, so every later read must see the same split); sums inside a partition are windows of a
    partition's size, and each partition adds the sums of those before it, a frame of partitions x groups rows at
    most.  ``order`` must begin with the group when one is given.  Returns (result, staged rows).
    """
    keys = [group] if group else []
    rows = stage(df.repartitionByRange(partitions(df.sparkSession), *order).withColumn("_part", F.spark_partition_id()), tag)
    sums = rows.groupBy("_part", *keys).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    inside = Window.partitionBy("_part", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    names = ["_part", *keys]
    o = offsets.select(*[F.col(c).alias(f"_o{c}") for c in names], "_before")
    on = [local[c].eqNullSafe(o[f"_o{c}"]) for c in names]
    joined = local.join(o, [x for x in on], "inner")
    return joined.withColumn(out, F.col("_before") + F.col("_inside")).drop("_part", "_before", "_inside", *[f"_o{c}" for c in names]), rows
