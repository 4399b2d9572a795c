import pytest
from pyspark.sql import functions as F

from glossa.operators import contracts, maintain
from glossa.sources import sinks
from glossa.streaming import flows


def corpus(spark):
    return {
        "language_variant": spark.createDataFrame(
            [(1, "it-IT", "Standard Italian", False, None), (2, "nap-IT", "Neapolitan", False, 1),
             (3, "und", "Undetermined", False, None)],
            "variant_id int, iso_code string, variant_name string, is_pivot boolean, parent_variant_id int"),
        "content_unit": spark.createDataFrame([(10, "a", 1), (11, "b", 2), (12, "c", None)],
                                              "unit_id long, content_raw string, variant_id int"),
        "rel_content_tone": spark.createDataFrame([(10, 1), (11, 1)], "unit_id long, tone_id int"),
        "vector_index": spark.createDataFrame([(1, 10, 1), (2, 11, 1)], "vector_id long, unit_id long, model_id int"),
        "lemma": spark.createDataFrame([(100, "x", 2)], "lemma_id long, text_root string, variant_id int"),
        "morpho_form": spark.createDataFrame([(None, "xs", 100), (None, "ys", 101)],
                                             "form_id long, surface_form string, lemma_id long"),
    }


def test_cascade_delete_follows_the_registry(spark):
    t = corpus(spark)
    keys = spark.createDataFrame([(10,)], "unit_id long")
    out = maintain.delete_cascade(t, "content_unit", keys)
    assert sorted(r.unit_id for r in out["content_unit"].collect()) == [11, 12]
    assert [r.unit_id for r in out["rel_content_tone"].collect()] == [11]
    assert [r.unit_id for r in out["vector_index"].collect()] == [11]
    lem = maintain.delete_cascade(t, "lemma", spark.createDataFrame([(100,)], "lemma_id long"))
    assert [r.surface_form for r in lem["morpho_form"].collect()] == ["ys"]


def test_restrict_blocks_delete(spark):
    t = corpus(spark)
    keys = spark.createDataFrame([(2,)], "variant_id int")
    v = {(r.child, r.fk): r.referencing_rows for r in maintain.restrict_violations(t, "language_variant", keys).collect()}
    assert v == {("content_unit", "variant_id"): 1, ("lemma", "variant_id"): 1}
    with pytest.raises(ValueError):
        maintain.delete_cascade(t, "language_variant", keys)
    parent = spark.createDataFrame([(1,)], "variant_id int")  # nap-IT is a child of it-IT
    v2 = {r.child for r in maintain.restrict_violations(t, "language_variant", parent).collect()}
    assert "language_variant" in v2


def test_set_null_rekey_backfill_and_migration(spark):
    t = corpus(spark)
    keys = spark.createDataFrame([(1,)], "model_id int")
    sn = maintain.delete_set_null(t["vector_index"], "model_id", keys, "model_id")
    assert [r.model_id for r in sn.collect()] == [None, None]
    mapping = spark.createDataFrame([(2, 20)], "old_key int, new_key int")
    rk = maintain.rekey(t, "language_variant", mapping)
    assert sorted(r.variant_id for r in rk["language_variant"].collect()) == [1, 3, 20]
    assert [r.variant_id for r in rk["lemma"].collect()] == [20]
    assert sorted((r.variant_id for r in rk["content_unit"].collect()), key=lambda x: (x is None, x)) == [1, 20, None]
    no_owner = spark.createDataFrame([(1, 10)], "vector_id long, unit_id long")
    once = maintain.migrate_vector_owner(no_owner)
    twice = maintain.migrate_vector_owner(once)
    assert [tuple(r) for r in twice.collect()] == [tuple(r) for r in once.collect()] == [(1, 10, 1)]
    assert [r.model_id for r in maintain.migrate_vector_owner(sn).collect()] == [1, 1]


def test_assign_variant_and_reclassify(spark):
    t = corpus(spark)
    docs = spark.createDataFrame([("a", "IT"), ("b", "nap-IT"), ("c", "xx")], "doc_id string, iso_code string")
    got = {r.doc_id: r.variant_id for r in maintain.assign_variant(docs, t["language_variant"]).collect()}
    assert got == {"a": 1, "b": 2, "c": 3}
    units = spark.createDataFrame([(1, 3, 0.0), (2, 1, 0.9)], "unit_id long, variant_id int, variant_confidence double")
    results = spark.createDataFrame([(1, 2, 0.92), (2, 2, 0.99)], "unit_id long, variant_id int, variant_confidence double")
    rec = {r.unit_id: (r.variant_id, r.variant_confidence)
           for r in maintain.reclassify(units, results, t["language_variant"]).collect()}
    assert rec == {1: (2, 0.92), 2: (1, 0.9)}  # only 'und' rows change


def test_prepare_variants_and_vector_key(spark):
    lv = spark.createDataFrame([(1, "IT", "a", False, None), (2, "it-it", "b", False, None)],
                               "variant_id int, iso_code string, variant_name string, is_pivot boolean, parent_variant_id int")
    assert [(r.variant_id, r.iso_code) for r in maintain.prepare_variants(lv).collect()] == [(1, "it-IT")]
    v = spark.createDataFrame([(2, 10, 1), (1, 10, 1), (3, 10, 2)], "vector_id long, unit_id long, model_id int")
    assert sorted(r.vector_id for r in maintain.enforce_vector_key(v).collect()) == [1, 3]


def test_insert_if_absent_and_load_report(spark):
    target = spark.createDataFrame([("h1", 1)], "content_hash string, pos int")
    batch = spark.createDataFrame([("h1", 5), ("h2", 7), ("h2", 6)], "content_hash string, pos int")
    new = sinks.insert_if_absent(target, batch, ["content_hash"], "pos")
    assert [tuple(r) for r in new.collect()] == [("h2", 6)]
    rep = {(r.target, r.kind): r.rows for r in sinks.load_report({"units": new}, {"units": batch}).collect()}
    assert rep == {("units", "written"): 1, ("units", "skipped"): 3}


def test_publish_gate_and_export(spark, tmp_dir):
    lv = spark.createDataFrame([(1, "it-IT", "Standard Italian", False, None), (2, "und", "Undetermined", False, None)],
                               "variant_id int, iso_code string, variant_name string, is_pivot boolean, parent_variant_id int")
    units = spark.createDataFrame([(1, "a", 1, 0.9), (2, "b", 1, 0.69), (3, "c", None, 0.95), (4, "d", 2, None)],
                                  "unit_id long, content_raw string, variant_id int, variant_confidence double")
    root = f"{tmp_dir}/published"
    ok_gate = lambda t: contracts.check_fallback_variant(t)
    version, _ = sinks.publish({"language_variant": lv, "content_unit": units}, root, ok_gate, version="v1")
    assert sinks.current_version(spark, root) == "v1"
    bad_lv = lv.where(F.col("iso_code") != "und")
    with pytest.raises(RuntimeError):
        sinks.publish({"language_variant": bad_lv}, root, ok_gate, version="v2")
    assert sinks.current_version(spark, root) == "v1"  # failed version stays invisible
    assert sinks.read_current(spark, root, "content_unit").count() == 4
    with pytest.raises(FileExistsError):  # a published version is never rewritten
        sinks.publish({"language_variant": lv}, root, ok_gate, version="v1")
    assert sinks.read_current(spark, root, "content_unit").count() == 4
    out = sinks.export_training(units, lv, f"{tmp_dir}/export")
    assert sorted(r.unit_id for r in out.collect()) == [1]


def test_stream_ingest_replay_appends_nothing(spark, tmp_dir):
    src = f"{tmp_dir}/docs_in"
    rows = [(1, "a", "x", "y", None), (2, "b", "x", None, "z")]
    spark.createDataFrame(rows, "doc_pos long, doc_id string, text_it string, text_fi string, text_en string") \
        .write.parquet(src)
    schema = spark.read.parquet(src).schema
    target = f"{tmp_dir}/target"
    for attempt in range(2):  # the second run uses a fresh checkpoint: a full replay
        stream = spark.readStream.schema(schema).parquet(src)
        flows.run_available(stream, f"{tmp_dir}/run{attempt}", batch_fn=flows.ingest_stream(stream, target, 4))
    units = spark.read.parquet(f"{target}/content_unit")
    assert sorted((r.unit_id, r.content_raw, r.variant_id) for r in units.collect()) == \
        [(1, "x", 1), (2, "y", 2), (3, "z", 3)]


def test_stream_ingest_continues_ids_and_replays_append_nothing(spark, tmp_dir):
    schema = "doc_pos long, doc_id string, text_it string, text_fi string, text_en string"
    a = spark.createDataFrame([(1, "a", "x", "y", None)], schema)
    ab = spark.createDataFrame([(1, "a", "x", "y", None), (2, "b", "z", None, None)], schema)
    target = f"{tmp_dir}/t"
    load = flows.ingest_stream(a, target, 4)
    load(a, 0)
    load(ab, 1)
    load(ab, 1)  # a replay: every hash is stored
    units = sorted((r.unit_id, r.content_raw) for r in spark.read.parquet(f"{target}/content_unit").collect())
    assert units == [(1, "x"), (2, "y"), (3, "z")]
    progress = sorted(tuple(r) for r in spark.read.parquet(f"{target}/_progress").collect())
    assert progress == [(0, 2), (1, 3)]


def test_stream_ingest_restarted_epochs_lose_nothing(spark, tmp_dir):
    """A new checkpoint begins at epoch 0 again; its documents are new all the same."""
    schema = "doc_pos long, doc_id string, text_it string, text_fi string, text_en string"
    target = f"{tmp_dir}/t"
    for pos, text in ((1, "a"), (2, "c")):
        docs = spark.createDataFrame([(pos, f"d{pos}", text, None, None)], schema)
        flows.ingest_stream(docs, target, 4)(docs, 0)
    units = sorted((r.unit_id, r.content_raw) for r in spark.read.parquet(f"{target}/content_unit").collect())
    assert units == [(1, "a"), (2, "c")]


def test_feedback_stream_watermark_drops_late_rows(spark, tmp_dir):
    import datetime as dt

    from glossa.sources.bindings import feedback_log_from
    from glossa.sources.tables import DRIVER_SCHEMAS

    src, out = f"{tmp_dir}/events_in", f"{tmp_dir}/k2"
    schema = DRIVER_SCHEMAS["events"]

    def write(rows, name):
        spark.createDataFrame(rows, schema).write.parquet(f"{src}/{name}")

    def ev(i, day, hour, user):
        return (i, dt.datetime(2024, 1, day, hour), user, "click", 1.0, "{}")

    write([ev(1, 1, 10, 0), ev(2, 2, 10, 0), ev(3, 3, 10, 0)], "b1")
    stream = feedback_log_from(spark.readStream.schema(schema).parquet(f"{src}/*"))
    flows.run_available(flows.feedback_stream(stream), out)
    # day 3 is still open (watermark = Jan 3 09:00); day 1 and day 2 are final
    write([ev(4, 1, 12, 0), ev(5, 3, 12, 0), ev(6, 5, 10, 0)], "b2")
    stream = feedback_log_from(spark.readStream.schema(schema).parquet(f"{src}/*"))
    flows.run_available(flows.feedback_stream(stream), out)
    got = {(r.window_start.day, r.n_feedback) for r in spark.read.parquet(f"{out}/out").collect()}
    # the late Jan 1 row is dropped; Jan 3 closes with both of its rows; Jan 5 is still open
    assert got == {(1, 1), (2, 1), (3, 2)}
