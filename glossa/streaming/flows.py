"""Continuous flows on Structured Streaming (K1-K3).

* K1 ``ingest_stream``: phrase documents arrive continuously; every
  micro-batch runs the batch ingestion against the stored units
  (insert-if-absent on the content hash, ids after the stored maximum), so
  replaying a batch appends nothing.
* K2 ``feedback_stream``: feedback rows rolled up per day, model and
  severity with an event-time watermark; append mode emits a day once the
  watermark has passed its end, and the state holds one row per open group;
  ``late_feedback`` accounts for the rows that came behind the watermark.
* K3 ``pending_vectors``: units still without a vector, an anti-join of every
  micro-batch against the vector index as it then is; ``unindexed_units``: the
  same where vectors arrive as a stream of their own.

Sinks are Parquet folders with their checkpoint next to them, both under a
shared folder (the session's checkpoint folder by default).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from glossa.operators.joins import not_in
from glossa.plans.ingest import build_content
from glossa.session import ensure_checkpoint_dir

UNIT_COLUMNS = ("unit_id", "content_raw", "content_type", "content_hash", "cefr_level", "is_idiom", "difficulty",
                "source_origin", "variant_id", "source_metadata_json", "doc_id", "doc_pos")


def stream_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for one streaming run under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/glossa-streams/{name}-{uuid.uuid4().hex[:12]}"


def read_stream(spark: SparkSession, root: str, table: str, files_per_batch: int | None = None) -> DataFrame:
    """The driver table as a file stream (the glob lets a single-file table act as a source).

    ``files_per_batch`` bounds a micro-batch, so a backlog never becomes one batch.
    """
    from glossa.sources.tables import DRIVER_SCHEMAS
    reader = spark.readStream.schema(DRIVER_SCHEMAS[table])
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{root.rstrip('/')}/{table}.parq[u]et")


def arrival_number(df: DataFrame, order: str, arrivals: int) -> Column:
    """Which of ``arrivals`` ranges of equal width a row's ``order`` (a number or a time) falls into; NULL: the first."""
    value = F.col(order)
    if isinstance(df.schema[order].dataType, (T.TimestampNTZType, T.TimestampType)):
        value = F.unix_micros(value.cast("timestamp"))
    value = value.cast("long")
    bounds = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).first()
    if bounds["lo"] is None:
        return F.lit(0)
    width = F.lit(bounds["hi"] - bounds["lo"] + 1)
    return F.coalesce(F.floor((value - F.lit(bounds["lo"])) * arrivals / width), F.lit(0)).cast("int")


def in_arrivals(df: DataFrame, folder: str, table: str, order: str, arrivals: int = 3,
                again: Callable[[DataFrame, int], DataFrame] | None = None) -> Iterator[int]:
    """``df`` arrives in ``folder`` in ranges of ``order``, one after the other: each number is yielded once that arrival
    is there, and the caller runs its stream before the next one comes.

    Every row arrives, a NULL order with the first, in as many files as it has partitions.  ``again(df, k)`` gives
    rows that arrival ``k`` brings besides its own (repeats, or rows that are late).
    """
    numbered = df.withColumn("_arrival", arrival_number(df, order, arrivals))
    for k in range(arrivals):
        here = numbered.where(F.col("_arrival") == k).drop("_arrival")
        if again is not None:
            here = here.unionByName(again(numbered, k).drop("_arrival"))
        here.write.mode("append").parquet(f"{folder}/{table}.parquet")
        yield k


def run_available(df: DataFrame, folder: str, mode: str = "append", batch_fn=None,
                  state_partitions: int | None = None) -> StreamingQuery:
    """Process everything available now into ``folder/out`` (or through ``batch_fn``) and stop.

    ``state_partitions`` sets the shuffle partitions of a stateful query for its
    first run: the count is frozen into the checkpoint, so it is chosen from
    the expected state size rather than left at the session default.
    """
    spark = df.sparkSession
    previous = spark.conf.get("spark.sql.shuffle.partitions")
    if state_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        w = df.writeStream.option("checkpointLocation", f"{folder}/_checkpoint").outputMode(mode)
        if batch_fn is not None:
            w = w.foreachBatch(batch_fn)
        else:
            w = w.format("parquet").option("path", f"{folder}/out")
        q = w.trigger(availableNow=True).start()
        q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", previous)
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def state_partitions_for(spark: SparkSession, path: str, bytes_per_partition: int = 128 << 20) -> int:
    """State partitions for a stream over ``path``: one per ``bytes_per_partition`` of input, at least 1
    (a driver-side listing of file sizes, no data read)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    size = fs.getContentSummary(p).getLength() if fs.exists(p) else 0
    return max(1, -(-size // bytes_per_partition))


def hash_bucket(col: str = "content_hash", *, n_buckets: int) -> Column:
    """Bucket of a hex hash: the one of ``n_buckets`` equal ranges that its leading 32 bits fall into, so a bucket's files
    hold hashes of its range alone (letter-prefixed, so the partition values always read back as text)."""
    lead = F.conv(F.substring(col, 1, 8), 16, 10).cast("long")
    return F.concat(F.lit("b"), F.shiftright(lead * F.lit(n_buckets), 32).cast("string"))


def _read_or_none(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    try:
        r = spark.read.schema(schema) if schema else spark.read
        df = r.parquet(path)
        df.schema  # noqa: B018 - resolve now so a missing folder raises here
        return df
    except Exception as exc:
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc) or "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return None
        raise


#: Hashes of a micro-batch that are pushed into the scan of the stored units as values; a batch of more is joined.
MAX_PUSHED_KEYS = 5_000
#: Of them, values that one scan gets: Parquet nests a filter's alternatives, so they can't be many.
KEYS_OF_SCAN = 250
BLOOM = {"parquet.bloom.filter.enabled#content_hash": "true", "parquet.block.size": str(16 << 20)}


def stored_hashes(spark: SparkSession, units_path: str, hashes: DataFrame, n_buckets: int) -> tuple[DataFrame | None, dict]:
    """(stored units with one of the hashes at least: content_hash, unit_id; what it took: keys, rows_read).

    The stored files are partitioned by hash bucket, sorted by hash and carry Parquet Bloom filters on it.  A batch of
    at most MAX_PUSHED_KEYS different hashes is pushed into the scan as values: only row groups whose Bloom filter
    and pages whose range may hold one of them are read, and the filter is applied again to the rows, so a false
    positive costs reading alone.  A larger batch reads its buckets whole (``rows_read`` None).  Every match comes
    back either way.
    """
    stored = _read_or_none(spark, units_path)
    bucket = hash_bucket(n_buckets=n_buckets)
    keys = sorted((r["b"], r["content_hash"]) for r in hashes.distinct().limit(MAX_PUSHED_KEYS + 1).select(bucket.alias("b"), "content_hash").collect())  # bounded
    took = {"keys": len(keys), "rows_read": 0}
    if stored is None or not keys:
        return None if stored is None else stored.select("content_hash", "unit_id").limit(0), took
    if len(keys) > MAX_PUSHED_KEYS:
        buckets = [r[0] for r in hashes.select(bucket.alias("b")).distinct().collect()]  # at most n_buckets values
        return stored.where(F.col("hash_bucket").isin(buckets)).select("content_hash", "unit_id"), took | {"rows_read": None}
    threshold = "spark.sql.parquet.pushdown.inFilterThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, str(KEYS_OF_SCAN))
    found = None
    try:
        # keys in the order of their buckets: a bucket's files belong to one scan, or to few where it has many keys
        for k in range(0, len(keys), KEYS_OF_SCAN):
            some = keys[k:k + KEYS_OF_SCAN]
            here = F.col("hash_bucket").isin(sorted({b for b, _ in some})) & F.col("content_hash").isin([h for _, h in some])
            scan = stored.where(here).select("content_hash", "unit_id")
            found = scan if found is None else found.unionByName(scan)
        rows = found.collect()  # at most a row for each key: stored hashes are unique
        scans = found._jdf.queryExecution().executedPlan().collectLeaves()
        took["rows_read"] = sum(scans.apply(i).metrics().apply("numOutputRows").value() for i in range(scans.size()))
    finally:
        spark.conf.set(threshold, before)
    return spark.createDataFrame(rows, "content_hash string, unit_id long"), took


def ingest_stream(docs: DataFrame, target: str, n_buckets: int) -> callable:
    """K1: the ``foreachBatch`` function that appends each batch's new units to ``target/content_unit``.

    A unit is stored if its hash is not stored yet, whatever epoch or stream
    run it arrives in: a replayed batch appends nothing, and a stream started
    anew on an existing target (its epochs begin at 0 again) loses nothing.

    Stored units are partitioned by ``n_buckets`` hash buckets, sorted by hash
    and indexed by Bloom filters; ``stored_hashes`` reads only what a batch's
    hashes may be in, and ``target/_lookups`` records the rows it read.  The
    id high-water mark lives in ``target/_progress``: a batch reserves its ids
    there before it writes its units, so a crash in between can leave a gap
    in the ids but never uses one twice.
    """
    units_path, progress_path = f"{target}/content_unit", f"{target}/_progress"

    def load(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        progress = _read_or_none(spark, progress_path, "epoch long, max_unit_id long")
        reserved = 0 if progress is None else progress.agg(F.max("max_unit_id").alias("m")).first()["m"] or 0
        seen, took = stored_hashes(spark, units_path, build_content(batch)._candidates.select("content_hash"), n_buckets)
        spark.createDataFrame([(epoch_id, took["keys"], took["rows_read"])], "epoch long, n_keys long, rows_read long") \
            .write.mode("append").parquet(f"{target}/_lookups")
        built = build_content(batch, existing_units=seen, start=reserved + 1)
        n_new = built.unit_keys.count()  # narrow frame, already written; ids are dense from reserved + 1
        if not n_new:
            return
        spark.createDataFrame([(epoch_id, reserved + n_new)], "epoch long, max_unit_id long") \
            .write.mode("append").parquet(progress_path)
        new_units = built.units.select(*UNIT_COLUMNS).withColumn("hash_bucket", hash_bucket(n_buckets=n_buckets))
        # rebalance gathers a bucket's rows into few files, and splits a bucket too large for one task
        writer = new_units.hint("rebalance", "hash_bucket").sortWithinPartitions("hash_bucket", "content_hash").write
        writer.options(**BLOOM).mode("append").partitionBy("hash_bucket").parquet(units_path)

    return load


def without_repeats(docs: DataFrame, keep: str = "7 days") -> DataFrame:
    """K1: the documents of a stream without those that were sent before, by Spark's own state store.

    A document is one that was sent before if its position, id and every field are equal.  Event time is the time of
    arrival (a batch's own), so no document is ever late and none is lost; the state forgets a document ``keep`` after
    it arrived.  One that comes again later passes, and A4 drops it at the sink.
    """
    fields = [c for c in docs.columns if not isinstance(docs.schema[c].dataType, T.MapType)]
    same = F.sha2(F.to_json(F.struct(*fields)), 256)
    return (docs.withColumn("_arrived", F.current_timestamp()).withColumn("_document", same)
                .withWatermark("_arrived", keep).dropDuplicatesWithinWatermark(["_document"]).drop("_arrived", "_document"))


def recorded(load: Callable[[DataFrame, int], None], path: str, columns: tuple[str, ...]) -> Callable[[DataFrame, int], None]:
    """``load`` that also writes some columns of every batch it is given, a folder for each epoch (a replay rewrites it)."""
    def both(batch: DataFrame, epoch_id: int) -> None:
        batch.select(*columns).write.mode("overwrite").parquet(f"{path}/epoch={epoch_id}")
        load(batch, epoch_id)

    return both


def feedback_stream(log: DataFrame, delay: str = "1 hour", window: str = "1 day", by: tuple[str, ...] = ("model_id", "error_severity")) -> DataFrame:
    """K2: feedback per day window and the columns ``by`` (with ``training_cycle`` among them: per cycle).

    The watermark needs a TIMESTAMP; the wall-clock NTZ value is mapped to the
    UTC instant with the same wall clock (and back for the output), so day
    windows start at midnight whatever the session time zone.
    """
    tz = F.current_timezone()
    t = F.from_utc_timestamp(F.col("created_at").cast("timestamp"), tz)
    return (log.withColumn("_t", t).withWatermark("_t", delay)
               .groupBy(F.window("_t", window).alias("w"), *by)
               .agg(F.count(F.lit(1)).alias("n_feedback"))
               .select(F.to_utc_timestamp(F.col("w.start"), tz).cast("timestamp_ntz").alias("window_start"),
                       *by, "n_feedback"))


CYCLE = ("model_id", "training_cycle", "error_severity")


def late_feedback(log: DataFrame, emitted: DataFrame, delay: str = "1 hour", by: tuple[str, ...] = CYCLE) -> DataFrame:
    """K2: what the stream left out as late: window_start, ``by``, n_feedback (as emitted), n_late of every closed day.

    A row that arrives behind the watermark is in no emitted window, and Spark drops it without a trace.  This job
    accounts for it from the log that the stream read: a day that the watermark has passed holds, per group, the rows
    emitted and, for the rest, late ones.  A group of which every row was late has n_feedback 0.  Days that are still
    open are left out, as the stream may yet emit them.
    """
    end = log.agg((F.max("created_at") - F.expr(f"INTERVAL {delay}")).alias("w"))
    day = log.groupBy(F.date_trunc("day", "created_at").cast("timestamp_ntz").alias("window_start"), *by).agg(F.count(F.lit(1)).alias("_n"))
    closed = day.crossJoin(F.broadcast(end)).where(F.col("window_start") + F.expr("INTERVAL 1 DAY") <= F.col("w")).drop("w")  # one row
    names = ("window_start", *by)
    e = emitted.select(*[F.col(c).alias(f"_e_{c}") for c in names], F.col("n_feedback").alias("_out"))
    met = closed.join(e, [F.col(c).eqNullSafe(F.col(f"_e_{c}")) for c in names], "left")
    out = F.coalesce("_out", F.lit(0)).cast("long")
    return met.select(*names, out.alias("n_feedback"), (F.col("_n") - out).alias("n_late"))


def unindexed_units(units: DataFrame, vectors: DataFrame, patience: str, delay: str) -> DataFrame:
    """K3: units whose vector has not come ``patience`` after they were created, as a stream joined to a stream.

    ``units`` (unit_id, content_raw, created_at) and ``vectors`` (unit_id, indexed_at) both arrive continuously, each up
    to ``delay`` out of order.  The outer join holds a unit in its state until its vector comes or the watermark of both
    streams has passed created_at + ``patience``; then the unit is reported, once.  A unit that is still waiting is not in
    the result; rows that come later than ``delay`` behind are late for their stream, and rows without an id are no units.
    """
    wait = F.expr(f"INTERVAL {patience}")
    u = units.where("unit_id IS NOT NULL").select("unit_id", "content_raw", F.col("created_at").cast("timestamp").alias("created_at")).withWatermark("created_at", delay)
    v = vectors.select(F.col("unit_id").alias("_unit"), F.col("indexed_at").cast("timestamp").alias("indexed_at")).withWatermark("indexed_at", delay)
    in_time = (F.col("unit_id") == F.col("_unit")) & (F.col("indexed_at") >= F.col("created_at")) & (F.col("indexed_at") <= F.col("created_at") + wait)
    return u.join(v, in_time, "leftOuter").where(F.col("_unit").isNull()).select("unit_id", "content_raw")


def pending_vectors(vectors: Callable[[], DataFrame], out: str) -> callable:
    """K3: the ``foreachBatch`` function that writes the batch's units without a vector to ``out``.

    ``vectors()`` is read anew for every batch, so both the index and the NULL
    rule of NOT IN are those of the batch's own time.  A batch owns one folder
    and rewrites it when it is replayed.
    """
    def write(batch: DataFrame, epoch_id: int) -> None:
        not_in(batch.select("unit_id", "content_raw"), vectors(), "unit_id") \
            .write.mode("overwrite").parquet(f"{out}/epoch={epoch_id}")

    return write
