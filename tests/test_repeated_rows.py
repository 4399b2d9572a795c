"""One row per key whatever repeats: rows repeated as a whole, and rows equal in key and order."""

import os
from collections import Counter

import pytest

from glossa.operators import maintain
from glossa.operators.dedup import dedup_media, first_wins
from glossa.plans.ingest import build_content, build_lexicon
from glossa.plans.load import load_export
from glossa.sources import sinks

SF = "/root/testdata/sf0.001"
DOCS = "doc_pos long, doc_id string, text_it string, text_fi string, text_en string, register string, theme_id string, audio_hint string, img_hint string"


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_first_wins_keeps_one_row_of_a_tie(spark):
    data = [("a", 2, "x"), ("a", 1, "y"), ("a", 1, "y"), ("a", 1, "z"), ("b", None, "n"), ("b", None, "n"), ("b", 7, "m"),
            (None, 3, "p"), (None, 3, "p"), ("c", None, "q"), ("c", None, "q")]
    df = spark.createDataFrame(data, "k string, o int, v string").repartition(4)
    got = rows(first_wins(df, ["k"], "o"), "k", "o", "v")
    assert [(k, o) for k, o, _ in got] == sorted([("a", 1), ("b", 7), (None, 3), ("c", None)], key=repr)
    assert got == rows(first_wins(df.repartition(2), ["k"], "o"), "k", "o", "v")  # ties are broken alike


def test_a_row_that_a_third_of_the_table_repeats(spark):
    df = spark.range(9000).selectExpr("if(id % 3 = 0, -1, id) AS k", "0 AS o", "'same' AS v").repartition(8)
    assert first_wins(df, ["k"], "o").count() == 6001


def test_units_links_and_media_of_repeated_documents(spark):
    docs = [(1, "d1", "uno", "yksi", "one", "formal", "t1", "a.mp3", "b.jpg"), (2, "d2", "due", None, "one", "slang", "t2", None, None),
            (3, "d3", "tre", "kolme", "three", None, "t1", "c.mp3", "c.mp3")]
    once = build_content(spark.createDataFrame(docs, DOCS))
    again = build_content(spark.createDataFrame(docs * 3 + docs[:1], DOCS).repartition(3))
    for name, cols in (("units", ("unit_id", "content_hash", "doc_id", "register")), ("tone_links", ("unit_id", "tone_id")),
                       ("theme_links", ("unit_id", "context_id")), ("media", ("unit_id", "asset_type", "file_name"))):
        assert rows(getattr(again, name), *cols) == rows(getattr(once, name), *cols), name
    # the same position and text with another register: one unit, and its link is that unit's register
    other = [*docs, (1, "d1", "uno", "yksi", "one", "vulgar", "t1", "a.mp3", "b.jpg")]
    mixed = build_content(spark.createDataFrame(other, DOCS))
    names = {r.tone_id: r.register for r in mixed.registers.collect()}
    of = {r.unit_id: r.register for r in mixed.units.collect()}
    assert len(of) == once.units.count() == mixed.units.count()
    assert all(names[r.tone_id] == of[r.unit_id] for r in mixed.tone_links.collect())


def test_lemmas_media_vectors_and_inserts(spark):
    vocab = spark.createDataFrame([(1, "v1", "Casa ", None, None, "dimora?x"), (2, "v2", "casa", None, None, "")] * 2,
                                  "doc_pos long, doc_id string, text_it string, text_fi string, text_en string, syn_it string")
    assert rows(build_lexicon(vocab).lemmas, "lemma_id", "text_root") == [(1, "Casa ")]
    assert build_lexicon(vocab).forms.count() == 1
    media = spark.createDataFrame([(1, "audio", "f"), (1, "audio", "f"), (1, "image", "f"), (2, "image", "f")], "unit_id long, asset_type string, file_name string")
    assert rows(dedup_media(media), "unit_id", "asset_type") == [(1, "audio"), (2, "image")]
    vectors = spark.createDataFrame([(5, 10, 1), (5, 10, 1), (6, 10, 1), (7, 10, 2), (7, 10, 2)], "vector_id long, unit_id long, model_id int")
    assert rows(maintain.enforce_vector_key(vectors), "vector_id") == [(5,), (7,)]
    target = spark.createDataFrame([("h1", 1)], "content_hash string, pos int")
    batch = spark.createDataFrame([("h1", 5), ("h2", 6), ("h2", 6), ("h3", 2), ("h3", 1)], "content_hash string, pos int")
    assert rows(sinks.insert_if_absent(target, batch, ["content_hash"], "pos"), "content_hash", "pos") == [("h2", 6), ("h3", 1)]
    assert Counter(r.content_hash for r in sinks.insert_if_absent(target, batch, ["content_hash"]).collect()) == {"h2": 1, "h3": 1}


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_driver_rows_united_with_themselves(spark):
    from glossa.sources.bindings import bound

    docs = bound(spark, SF).docs
    once, twice = build_content(docs), build_content(docs.unionByName(docs))
    assert rows(twice.units, "unit_id", "content_hash", "doc_id") == rows(once.units, "unit_id", "content_hash", "doc_id")
    assert rows(twice.theme_links, "unit_id", "context_id") == rows(once.theme_links, "unit_id", "context_id")


def test_an_export_whose_documents_repeat_is_loaded_once(spark, tmp_dir):
    import json

    def line(k, **doc):
        return json.dumps({"doc_id": f"d{k}", "doc_pos": k, **doc})

    def load(name, times):
        lines = [line(k, text={"it": f"frase {k}", "en": "same"}, register="formal", themeId="t", flashcard={"audio_hint": f"{k}.mp3"}) for k in (1, 2)]
        lines += [line(9, lemma={"it": "Casa"}, rawWithSynonyms={"it": "dimora"}, pos="noun")]
        with open(f"{tmp_dir}/{name}.jsonl", "w") as out:
            out.write("\n".join(lines * times))
        load_export(spark, f"{tmp_dir}/{name}.jsonl", f"{tmp_dir}/{name}", "jsonl", import_date="2026-01-01", version="v1")
        return {t: rows(sinks.read_current(spark, f"{tmp_dir}/{name}", t), *cols) for t, cols in
                {"content_unit": ("unit_id", "content_raw"), "rel_content_tone": ("unit_id", "tone_id"), "media_asset": ("asset_id", "file_name"),
                 "lemma": ("lemma_id", "text_root"), "morpho_form": ("form_id", "surface_form")}.items()}

    once, thrice = load("once", 1), load("thrice", 3)
    assert thrice == once and len(once["content_unit"]) == 3 and len(once["lemma"]) == 1


def stored_docs(spark, folder):
    docs = [(i, f"d{i}", f"uno {i % 40}", None, f"one {i % 70}", "formal", "t1", "a.mp3", None) for i in range(100)]
    spark.createDataFrame(docs, DOCS).write.parquet(f"{folder}/docs")
    return spark.read.parquet(f"{folder}/docs")


def broadcast_joins(df):
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin")


def test_sides_that_grow_with_the_input_are_not_broadcast(spark, tmp_dir):
    """Files that look small hold many rows: by Spark's estimate these joins were broadcast through the driver."""
    docs = stored_docs(spark, tmp_dir)
    assert broadcast_joins(first_wins(docs, ["text_en"], "doc_pos")) == 0
    build = build_content(docs)
    # the one broadcast is of the partitions' offsets
    assert broadcast_joins(build.units) == broadcast_joins(build.unit_keys) == 1
    assert sorted(r.unit_id for r in build.units.collect()) == list(range(1, 111))  # 40 texts and 70, each once


def test_what_is_stored_is_not_broadcast_to_a_later_load(spark, tmp_dir):
    docs = stored_docs(spark, tmp_dir)
    early, late = docs.where("doc_pos % 2 = 0"), docs.where("doc_pos % 2 = 1")
    assert broadcast_joins(sinks.insert_if_absent(early, docs, ["text_en"], "doc_pos")) == 0
    first = build_content(early).units
    build = build_content(late, existing_units=first)
    assert broadcast_joins(build.units) == 1
    ids = sorted(r.unit_id for r in first.unionByName(build.units).collect())
    assert ids == list(range(1, 111))
    old = build_lexicon(early)
    new = build_lexicon(docs, existing_lemmas=old.lemmas)
    assert broadcast_joins(new.lemmas) == 1
    assert new.lemmas.count() + old.lemmas.count() == 110
