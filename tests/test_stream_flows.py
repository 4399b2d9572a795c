"""Arrivals lose nothing, the hash index equals the plain anti-join, repeats are dropped inside the stream."""

import datetime as dt

from pyspark.sql import functions as F

from glossa.streaming import flows

DOCS = "doc_pos long, doc_id string, text_it string, text_fi string, text_en string"


def test_null_keys_arrive_with_the_first_and_partitions_stay(spark, tmp_dir):
    df = spark.createDataFrame([(k,) for k in range(90)] + [(None,)] * 5, "id long").repartition(4)
    seen = []
    for k in flows.in_arrivals(df, f"{tmp_dir}/in", "t", "id"):
        seen.append(spark.read.parquet(f"{tmp_dir}/in/t.parquet").count())
    assert seen == [35, 65, 95]
    stored = spark.read.parquet(f"{tmp_dir}/in/t.parquet")
    assert stored.where("id is null").count() == 5 and len(stored.inputFiles()) > 6
    times = spark.createDataFrame([(dt.datetime(2024, 1, d),) for d in (1, 2, 9, 10)] + [(None,)], "ts timestamp_ntz")
    got = [r.n for r in times.select(flows.arrival_number(times, "ts", 3).alias("n")).collect()]
    assert got == [0, 0, 2, 2, 0]
    empty = times.where("ts is null")
    assert [r.n for r in empty.select(flows.arrival_number(empty, "ts", 3).alias("n")).collect()] == [0]


def test_the_index_finds_what_the_anti_join_finds_and_reads_less(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/units"
    units = spark.range(40_000).select(F.sha2(F.col("id").cast("string"), 256).alias("content_hash"), F.col("id").alias("unit_id"))
    (units.withColumn("hash_bucket", flows.hash_bucket(n_buckets=4)).repartition("hash_bucket").sortWithinPartitions("hash_bucket", "content_hash")
     .write.options(**flows.BLOOM | {"parquet.page.row.count.limit": "500"}).partitionBy("hash_bucket").parquet(path))
    asked = spark.range(39_990, 40_020).select(F.sha2(F.col("id").cast("string"), 256).alias("content_hash"))
    want = sorted(r.unit_id for r in units.join(asked, "content_hash", "left_semi").collect())
    found, took = flows.stored_hashes(spark, path, asked, 4)
    assert sorted(r.unit_id for r in found.collect()) == want == list(range(39_990, 40_000))
    assert took["keys"] == 30 and 10 <= took["rows_read"] < 20_000  # Bloom filters and page ranges skip the rest
    nothing, took = flows.stored_hashes(spark, path, asked.where("content_hash = 'x'"), 4)
    assert nothing.count() == 0 and took == {"keys": 0, "rows_read": 0}
    monkeypatch.setattr(flows, "KEYS_OF_SCAN", 7)  # several scans
    assert sorted(r.unit_id for r in flows.stored_hashes(spark, path, asked, 4)[0].collect()) == want
    monkeypatch.setattr(flows, "MAX_PUSHED_KEYS", 20)  # too many keys to push: the buckets are read
    found, took = flows.stored_hashes(spark, path, asked, 4)
    assert sorted(r.unit_id for r in found.join(asked, "content_hash", "left_semi").collect()) == want and took["rows_read"] is None


def test_repeats_are_dropped_inside_the_stream_and_late_ones_at_the_sink(spark, tmp_dir):
    def send(rows, name):
        spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_dir}/in/{name}")

    def run(keep, checkpoint):
        stream = flows.without_repeats(spark.readStream.schema(DOCS).parquet(f"{tmp_dir}/in/*"), keep)
        load = flows.recorded(flows.ingest_stream(stream, f"{tmp_dir}/t", 2), f"{tmp_dir}/offered-{checkpoint}", ("doc_id",))
        flows.run_available(stream, f"{tmp_dir}/{checkpoint}", batch_fn=load, state_partitions=2)
        return sorted(r.doc_id for r in spark.read.schema("doc_id string, epoch int").parquet(f"{tmp_dir}/offered-{checkpoint}").collect())

    a, b, changed = (1, "a", "uno", None, "one"), (2, "b", "due", None, None), (1, "a", "uno!", None, "one")
    send([a, a], "1")
    assert run("7 days", "c1") == ["a"]
    send([a, b], "2")
    assert run("7 days", "c1") == ["a", "b"]  # the repeat did not reach the sink
    send([changed, b], "3")
    assert run("7 days", "c1") == ["a", "a", "b"]  # a changed document is another one
    # a state that knows nothing of them: all come again, and the sink stores none of them again
    assert run("7 days", "c2") == ["a", "a", "b"]
    units = spark.read.parquet(f"{tmp_dir}/t/content_unit")
    assert sorted((r.unit_id, r.content_raw) for r in units.collect()) == [(1, "uno"), (2, "one"), (3, "due"), (4, "uno!")]
    lookups = spark.read.parquet(f"{tmp_dir}/t/_lookups").collect()
    assert len(lookups) >= 4 and all(r.rows_read is not None for r in lookups)


def test_late_feedback_is_counted(spark):
    at = lambda d, h=10: dt.datetime(2024, 1, d, h)
    schema = "created_at timestamp_ntz, model_id long, training_cycle int, error_severity string"
    log = spark.createDataFrame([(at(1), 1, 1, "low"), (at(1), 1, 1, "low"), (at(2), 1, None, "low"), (at(2), 2, 1, "high"), (at(5), 1, 1, "low")], schema)
    emitted = spark.createDataFrame([(at(1, 0), 1, 1, "low", 1), (at(2, 0), 1, None, "low", 1)],
                                    "window_start timestamp_ntz, model_id long, training_cycle int, error_severity string, n_feedback long")
    got = sorted((r.window_start.day, r.model_id, r.training_cycle or 0, r.n_feedback, r.n_late) for r in flows.late_feedback(log, emitted).collect())
    assert got == [(1, 1, 1, 1, 1), (2, 1, 0, 1, 0), (2, 2, 1, 0, 1)]


def test_units_are_reported_once_their_vector_is_overdue(spark, tmp_dir):
    at = lambda m: dt.datetime(2024, 1, 1, 0) + dt.timedelta(minutes=m)
    units, vectors = "unit_id long, content_raw string, created_at timestamp", "unit_id long, indexed_at timestamp"

    def arrive(name, us, vs):
        spark.createDataFrame(us, units).write.parquet(f"{tmp_dir}/u/{name}")
        spark.createDataFrame(vs, vectors).write.parquet(f"{tmp_dir}/v/{name}")
        df = flows.unindexed_units(spark.readStream.schema(units).parquet(f"{tmp_dir}/u/*"), spark.readStream.schema(vectors).parquet(f"{tmp_dir}/v/*"), "10 minutes", "1 minute")
        flows.run_available(df, f"{tmp_dir}/k3", state_partitions=2)
        return sorted(r.unit_id for r in spark.read.schema("unit_id long, content_raw string").parquet(f"{tmp_dir}/k3/out").collect())

    assert arrive("1", [(1, "a", at(0)), (2, "b", at(0)), (3, "c", at(5)), (None, "n", at(1))], [(1, at(4))]) == []
    # unit 2's vector comes too late, unit 3's in time in a later batch; unit 4 still waits
    assert arrive("2", [(4, "d", at(30))], [(2, at(20)), (3, at(9)), (9, at(30))]) == [2]
    assert arrive("3", [(5, "e", at(60))], [(4, at(35)), (9, at(60))]) == [2]
