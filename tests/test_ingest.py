"""Ingestion edge cases (FIXTURES section 5)."""

from pyspark.sql import functions as F

from glossa.plans.ingest import build_content, build_lexicon

PHRASE = ("doc_pos long, doc_id string, text_it string, text_fi string, text_en string, level string, "
          "idiom boolean, register string, theme_id string, difficulty string, img_hint string, "
          "audio_hint string, note_culturale string")
VOCAB = ("doc_pos long, doc_id string, text_it string, text_fi string, text_en string, syn_it string, "
         "syn_fi string, syn_en string, pos string, register string, theme_id string, note_culturale string")


def phrases(spark, rows):
    full = []
    for r in rows:
        d = dict(doc_pos=None, doc_id=None, text_it=None, text_fi=None, text_en=None, level=None, idiom=None,
                 register=None, theme_id=None, difficulty=None, img_hint=None, audio_hint=None, note_culturale=None)
        d.update(r)
        full.append(tuple(d.values()))
    return spark.createDataFrame(full, PHRASE)


def test_missing_text_skipped_whitespace_kept(spark):
    df = phrases(spark, [dict(doc_pos=1, doc_id="a", text_it=None, text_fi="", text_en="   ")])
    units = build_content(df).units.collect()
    assert [(u.content_raw, u.variant_id) for u in units] == [("   ", 3)]


def test_placeholder_and_empty_documents_dropped(spark):
    df = phrases(spark, [dict(doc_pos=0, doc_id="init_doc", text_it="x"), dict(doc_pos=1, doc_id="e"),
                         dict(doc_pos=2, doc_id="b", text_it="y")])
    assert [u.content_raw for u in build_content(df).units.collect()] == ["y"]


def test_first_wins_drops_later_duplicates_with_links_and_media(spark):
    df = phrases(spark, [
        dict(doc_pos=1, doc_id="a", text_it="Casa", text_fi="Talo", register="formale", theme_id="t1",
             audio_hint="casa.mp3"),
        dict(doc_pos=2, doc_id="b", text_it="Casa", text_en="Casa", register="neutro", theme_id="t2",
             audio_hint="other.mp3", img_hint="img.jpg"),
        dict(doc_pos=3, doc_id="c", text_it="casa"),
    ])
    b = build_content(df)
    units = sorted((u.unit_id, u.content_raw, u.variant_id, u.doc_id) for u in b.units.collect())
    # same text + same variant later: dropped; same text, other variant: kept; case differs: kept
    assert units == [(1, "Casa", 1, "a"), (2, "Talo", 2, "a"), (3, "Casa", 3, "b"), (4, "casa", 1, "c")]
    tones = sorted((r.unit_id, r.tone_id) for r in b.tone_links.collect())
    regs = {r.register: r.tone_id for r in b.registers.collect()}
    assert tones == [(1, regs["formale"]), (2, regs["formale"]), (3, regs["neutro"])]
    media = sorted((m.unit_id, m.asset_type, m.file_name) for m in b.media.collect())
    assert media == [(1, "audio", "casa.mp3")]


def test_media_rules(spark):
    df = phrases(spark, [
        dict(doc_pos=1, doc_id="a", text_it="uno", audio_hint="same", img_hint="same"),
        dict(doc_pos=2, doc_id="b", text_fi="kaksi", audio_hint="x.mp3", img_hint="y.jpg"),
        dict(doc_pos=3, doc_id="c", text_it="tre", audio_hint="", img_hint="z.jpg"),
    ])
    media = sorted((m.unit_id, m.asset_type, m.file_format, m.file_name, m.variant_id)
                   for m in build_content(df).media.collect())
    # equal hints: audio only; no Italian text: no media; empty audio hint: image only (no variant)
    assert media == [(1, "audio", "mp3", "same", 1), (3, "image", "jpg", "z.jpg", None)]


def test_idiom_is_strict_and_unknown_register_gives_no_link(spark):
    df = phrases(spark, [dict(doc_pos=1, doc_id="a", text_it="x", idiom=None, register=None),
                         dict(doc_pos=2, doc_id="b", text_it="y", idiom=True, register="")])
    b = build_content(df)
    assert sorted((u.content_raw, u.is_idiom) for u in b.units.collect()) == [("x", False), ("y", True)]
    assert b.tone_links.count() == 0


def test_incremental_load_appends_nothing_and_ids_continue(spark):
    df = phrases(spark, [dict(doc_pos=1, doc_id="a", text_it="x", text_fi="y")])
    first = build_content(df).units
    again = build_content(df, existing_units=first).units
    assert again.count() == 0
    more = phrases(spark, [dict(doc_pos=1, doc_id="a", text_it="x"), dict(doc_pos=2, doc_id="b", text_it="z")])
    nxt = build_content(more, existing_units=first).units.collect()
    assert [(u.unit_id, u.content_raw) for u in nxt] == [(3, "z")]


def test_lemma_fold_dedup_and_synonyms(spark):
    rows = [(1, "a", "Casa", None, None, " a?x  b ?y a casa CASA c", None, None, "noun", None, None, None),
            (2, "b", "casa ", None, "A", None, None, " a?x  b ?y a", "adj", None, None, None),
            (3, "c", "CASA", None, None, None, None, None, None, None, None, None)]
    lex = build_lexicon(spark.createDataFrame(rows, VOCAB))
    lemmas = sorted((r.lemma_id, r.text_root, r.variant_id, r.grammatical_category) for r in lex.lemmas.collect())
    assert lemmas == [(1, "Casa", 1, "noun"), (2, "A", 3, "adj")]
    forms = sorted((r.lemma_id, r.surface_form) for r in lex.forms.collect())
    # root "Casa": tokens a, b, '', a, casa(=root), CASA(=root), c -> a, b, a, c ; root "A": b only
    assert forms == [(1, "a"), (1, "a"), (1, "b"), (1, "c"), (2, "b")]


def test_interference_json_only_for_italian(spark):
    rows = [(1, "a", "Andiamo", "Mennään", "Let's go", None, None, None, None, None, None, "nota")]
    lex = build_lexicon(spark.createDataFrame(rows, VOCAB)).lemmas
    got = {r.variant_id: r.interference_json for r in lex.collect()}
    assert got[2] is None and got[3] is None
    parsed = spark.createDataFrame([(got[1],)], "j string").select(
        F.from_json("j", "standard_translation_EN string, standard_translation_IT string, note_culturale string")
        .alias("p")).first().p
    assert (parsed.standard_translation_EN, parsed.standard_translation_IT, parsed.note_culturale) == \
        ("Let's go", "Andiamo", "nota")


def test_general_media_and_link_dedup(spark):
    from glossa.operators.dedup import dedup_links, dedup_media
    media = spark.createDataFrame([(1, "image", "a.x"), (1, "audio", "a.x"), (1, "image", "b.jpg"), (2, "image", "a.x")],
                                  "unit_id long, asset_type string, file_name string")
    got = sorted(tuple(r) for r in dedup_media(media).select("unit_id", "asset_type", "file_name").collect())
    assert got == [(1, "audio", "a.x"), (1, "image", "b.jpg"), (2, "image", "a.x")]
    links = spark.createDataFrame([(1, 5), (1, 5), (2, 5)], "unit_id long, tag_id int")
    assert dedup_links(links).count() == 2
