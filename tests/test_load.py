"""The loader end to end on a small export object (the reference's entry point)."""

import json

from pyspark.sql import functions as F

from glossa.plans.load import load_export
from glossa.sources.documents import flatten_phrases, read_docs
from glossa.schemas import PHRASE_DOC
from glossa.sources.sinks import current_version, read_current

EXPORT = {
    "phrases": {
        "init_doc": {"text": {"it": "placeholder"}},
        "p1": {"text": {"it": "Essere come il prezzemolo.", "fi": "Olla kuin persilja.", "en": "To be like parsley."},
               "level": "B1", "idiom": True, "register": "informale", "themeId": "vita_sociale",
               "flashcard": {"difficulty": "medium", "audio_hint": "prezzemolo.mp3", "img_hint": "parsley.jpg"},
               "note_culturale": "ovunque"},
        "p2": {"text": {"it": "Essere come il prezzemolo.", "en": "Everywhere"}, "register": "formale",
               "themeId": "cibo_bevande", "flashcard": {"audio_hint": "x.mp3", "img_hint": "x.mp3"}},
        "p3": {},
    },
    "vocabulary": {
        "v1": {"lemma": {"it": "Casa", "en": "House"}, "rawWithSynonyms": {"it": " casa?x dimora ?y", "en": "home"},
               "pos": "noun", "register": "neutro", "themeId": "casa_vita_quotidiana"},
        "v2": {"lemma": {"it": "casa "}, "pos": "adj"},
    },
}


def _write(tmp_dir, name, obj):
    path = f"{tmp_dir}/{name}.json"
    with open(path, "w", encoding="utf-8") as fh:
        json.dump(obj, fh, ensure_ascii=False)
    return path


def test_export_reader_keeps_document_order(spark, tmp_dir):
    docs = flatten_phrases(read_docs(spark, _write(tmp_dir, "e", EXPORT), "phrases", PHRASE_DOC, "export"))
    assert [(r.doc_pos, r.doc_id) for r in docs.orderBy("doc_pos").collect()] == \
        [(0, "init_doc"), (1, "p1"), (2, "p2"), (3, "p3")]
    assert read_docs(spark, _write(tmp_dir, "n", {"phrases": {}}), "vocabulary", PHRASE_DOC, "export").count() == 0


def test_load_then_incremental_load(spark, tmp_dir):
    root = f"{tmp_dir}/corpus"
    v1, results = load_export(spark, _write(tmp_dir, "e1", EXPORT), root, import_date="2026-01-01", version="v1")
    assert results.where(F.col("status").startswith("FAIL")).count() == 0
    units = {r.unit_id: (r.content_raw, r.variant_id) for r in read_current(spark, root, "content_unit").collect()}
    assert units == {1: ("Essere come il prezzemolo.", 1), 2: ("Olla kuin persilja.", 2),
                     3: ("To be like parsley.", 3), 4: ("Everywhere", 3)}
    tones = {r.tone_name: r.tone_id for r in read_current(spark, root, "tone_marker").collect()}
    assert tones == {"formale": 1, "informale": 2, "neutro": 3}
    media = sorted((r.asset_id, r.unit_id, r.asset_type) for r in read_current(spark, root, "media_asset").collect())
    assert media == [(1, 1, "audio"), (2, 1, "image")]
    lemmas = sorted((r.lemma_id, r.text_root, r.grammatical_category) for r in read_current(spark, root, "lemma").collect())
    assert lemmas == [(1, "Casa", "noun"), (2, "House", "noun")]
    forms = sorted((r.lemma_id, r.surface_form) for r in read_current(spark, root, "morpho_form").collect())
    assert forms == [(1, "dimora"), (2, "home")]

    more = json.loads(json.dumps(EXPORT))
    more["phrases"]["p4"] = {"text": {"it": "Nuovo"}, "register": "amichevole", "themeId": "vita_sociale"}
    more["vocabulary"]["v3"] = {"lemma": {"fi": "Talo"}}
    v2, results2 = load_export(spark, _write(tmp_dir, "e2", more), root, import_date="2026-01-02", version="v2")
    assert current_version(spark, root) == "v2"
    assert results2.where(F.col("status").startswith("FAIL")).count() == 0
    units2 = {r.unit_id: r.content_raw for r in read_current(spark, root, "content_unit").collect()}
    assert len(units2) == 5 and units2[5] == "Nuovo"
    tones2 = {r.tone_name: r.tone_id for r in read_current(spark, root, "tone_marker").collect()}
    assert tones2 == {"formale": 1, "informale": 2, "neutro": 3, "amichevole": 4}  # stored ids kept
    links = {(r.unit_id, r.tone_id) for r in read_current(spark, root, "rel_content_tone").collect()}
    assert (5, 4) in links and len(links) == 5
    lemmas2 = sorted((r.lemma_id, r.text_root) for r in read_current(spark, root, "lemma").collect())
    assert lemmas2 == [(1, "Casa"), (2, "House"), (3, "Talo")]


def test_jsonl_reader_matches_export_reader(spark, tmp_dir):
    lines = [dict(doc_pos=i, doc_id=k, **v) for i, (k, v) in enumerate(EXPORT["phrases"].items())]
    path = f"{tmp_dir}/phrases.jsonl"
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(json.dumps(x, ensure_ascii=False) for x in lines))
    from_lines = flatten_phrases(read_docs(spark, path, "phrases", PHRASE_DOC, "jsonl"))
    from_export = flatten_phrases(read_docs(spark, _write(tmp_dir, "e", EXPORT), "phrases", PHRASE_DOC, "export"))
    def rows(df):
        return sorted(map(str, df.collect()))
    assert rows(from_lines) == rows(from_export)


def test_placeholder_vocabulary_values_get_no_id(spark, tmp_dir):
    export = json.loads(json.dumps(EXPORT))
    export["phrases"]["init_doc"] |= {"register": "aaa_placeholder", "themeId": "aaa_theme"}
    root = f"{tmp_dir}/corpus"
    load_export(spark, _write(tmp_dir, "p", export), root, import_date="2026-01-01", version="v1")
    tones = {r.tone_name: r.tone_id for r in read_current(spark, root, "tone_marker").collect()}
    assert tones == {"formale": 1, "informale": 2, "neutro": 3}
    assert read_current(spark, root, "cultural_context_tag").where("context_name = 'aaa_theme'").isEmpty()


def test_json_lines_without_positions_are_refused(spark, tmp_dir):
    import pytest

    path = f"{tmp_dir}/lines.jsonl"
    with open(path, "w", encoding="utf-8") as out:
        out.write(json.dumps({"doc_id": "p1", "text": {"it": "uno"}, "register": "formale"}) + "\n")
    with pytest.raises(ValueError, match="doc_pos"):
        load_export(spark, path, f"{tmp_dir}/corpus", fmt="jsonl")


def test_versions_must_sort_in_publication_order(spark, tmp_dir):
    import pytest

    root = f"{tmp_dir}/corpus"
    path = _write(tmp_dir, "e", EXPORT)
    load_export(spark, path, root, import_date="2026-01-01", version="v2")
    with pytest.raises(ValueError, match="sorts before"):
        load_export(spark, path, root, import_date="2026-01-01", version="v10")
