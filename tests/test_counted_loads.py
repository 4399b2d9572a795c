import pytest

from glossa.sources import sinks

SCHEMA = "k string, pos int, note string"


def test_counts_ride_the_write(spark, tmp_dir):
    path = f"{tmp_dir}/target"
    first = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", None, "z"), (None, 1, "n"), (None, 2, "n")], SCHEMA)
    assert sinks.append_if_absent(path, first, ["k"], "pos") == {"written": 3, "skipped": 2}
    second = spark.createDataFrame([("a", 0, "late"), ("c", 1, "x"), ("c", 1, "x"), ("d", 1, None)], SCHEMA).repartition(3)
    assert sinks.append_if_absent(path, second, ["k"], "pos") == {"written": 2, "skipped": 2}
    stored = spark.read.schema(SCHEMA).parquet(path)
    assert sorted(map(tuple, stored.collect()), key=str) == sorted([("a", 1, "y"), ("b", None, "z"), (None, 1, "n"), ("c", 1, "x"), ("d", 1, None)], key=str)
    # the same rows once more: nothing but the NULL key, which conflicts with nothing, goes in
    assert sinks.append_if_absent(path, first, ["k"], "pos") == {"written": 1, "skipped": 4}


def test_counts_equal_what_insert_if_absent_gives(spark, tmp_dir):
    path = f"{tmp_dir}/target"
    rows = [(str(i * i % 41), i % 5, str(i % 7)) for i in range(500)]
    frame = spark.createDataFrame(rows, SCHEMA)
    early = frame.where("pos < 2")
    sinks.append_if_absent(path, early, ["k", "note"], "pos")
    stored = sinks.insert_if_absent(spark.createDataFrame([], SCHEMA), early, ["k", "note"], "pos")
    want = sinks.insert_if_absent(stored, frame, ["k", "note"], "pos")
    n = want.count()
    assert sinks.append_if_absent(path, frame, ["k", "note"], "pos") == {"written": n, "skipped": 500 - n}
    assert sorted(map(tuple, spark.read.schema(SCHEMA).parquet(path).collect())) == sorted(map(tuple, stored.unionByName(want).select("k", "pos", "note").collect()))


@pytest.mark.parametrize("keys", [["k"], ["k", "pos"]])
def test_empty_batches(spark, tmp_dir, keys):
    empty = spark.createDataFrame([], SCHEMA)
    assert sinks.append_if_absent(f"{tmp_dir}/t", empty, keys) == {"written": 0, "skipped": 0}
    assert sinks.append_if_absent(f"{tmp_dir}/t", empty, keys) == {"written": 0, "skipped": 0}
    assert sinks.append(f"{tmp_dir}/u", empty) == {"written": 0, "skipped": 0}


def test_publish_reports_its_writes(spark, tmp_dir):
    frames = {"x": spark.range(7).toDF("id"), "y": spark.range(0).toDF("id")}
    version, _ = sinks.publish(frames, f"{tmp_dir}/root", version="v1")
    assert {tuple(r) for r in sinks.read_load_report(spark, f"{tmp_dir}/root", version).collect()} == {("x", "written", 7), ("y", "written", 0)}
