"""The loader end to end: export documents -> the twelve tables -> contracts -> atomic publish.

A first load numbers everything from 1 (vocabularies in sorted order, units
and lemmas in document order).  A later load reads the published version and
is incremental: stored content hashes and lemma keys are skipped, stored
vocabulary ids are kept and new values are numbered after the maximum, and
new rows get ids after the stored maximum.  Fact tables are append-only: a
version stores only its load's new rows and readers union the published
versions, so nothing stored is copied again.  The new version becomes
visible only if every contract passes on what readers would see.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.functions.scalars import present
from glossa.operators.dimensions import checked_dimension
from glossa.operators.keys import assign_ids, next_start_value
from glossa.operators.maintain import with_defaults
from glossa.plans.ingest import build_content, build_lexicon
from glossa.schemas import MODEL_ROWS, PHRASE_DOC, TABLE_NAMES, TABLES, VARIANT_ROWS, VOCAB_DOC
from glossa.sources.documents import (drop_placeholders, flatten_phrases, flatten_vocabulary, read_docs,
                                      require_positions)
from glossa.sources.sinks import current_version, publish, read_current

# Tables rewritten whole by every load (small); all other tables are append-only across versions.
DIMENSIONS = ("language_variant", "ai_model_registry", "tone_marker", "cultural_context_tag")


def _empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[table])


def _vocabulary_ids(values: DataFrame, col: str, stored: DataFrame | None, stored_name: str, stored_id: str,
                    id_col: str) -> tuple[DataFrame, int]:
    """Keep stored (name -> id); number new non-empty names in sorted order after the stored maximum."""
    names = values.select(F.col(col)).where(present(col)).distinct()
    if stored is None:
        new, start, kept = names, 1, None
    else:
        kept = stored.select(F.col(stored_name).alias(col), F.col(stored_id).cast("int").alias(id_col))
        new = names.join(kept.select(col), col, "left_anti")
        start = next_start_value(stored, stored_id)
    numbered = assign_ids(new, [col], id_col, start).select(col, F.col(id_col).cast("int").alias(id_col))
    both = numbered if kept is None else kept.unionByName(numbered)
    return checked_dimension(both)


def load_export(spark: SparkSession, path: str, root: str, fmt: str = "export", import_date: str | None = None,
                version: str | None = None) -> tuple[str, DataFrame]:
    """Load one export into a new published version under ``root``; returns (version, contract results)."""
    phrases = flatten_phrases(read_docs(spark, path, "phrases", PHRASE_DOC, fmt))
    vocab = flatten_vocabulary(read_docs(spark, path, "vocabulary", VOCAB_DOC, fmt))
    prev = current_version(spark, root)
    old = {t: read_current(spark, root, t) for t in TABLE_NAMES} if prev else {}

    for docs in (phrases, vocab):
        require_positions(docs)
    # A2 comes first: a placeholder's register or theme is no vocabulary value
    phrases, vocab = (drop_placeholders(d, [c for c in d.columns if c not in ("doc_pos", "doc_id")]) for d in (phrases, vocab))
    docs_regs = phrases.select("register", "theme_id").unionByName(vocab.select("register", "theme_id"))
    regs = _vocabulary_ids(docs_regs, "register", old.get("tone_marker"), "tone_name", "tone_id", "tone_id")
    themes = _vocabulary_ids(docs_regs, "theme_id", old.get("cultural_context_tag"), "context_name", "context_id",
                             "context_id")
    content = build_content(phrases, vocab, existing_units=old.get("content_unit"), import_date=import_date,
                            vocabularies=(regs, themes))
    lexicon = build_lexicon(vocab, existing_lemmas=old.get("lemma"))
    stamp = F.current_timestamp().cast("timestamp_ntz")

    media = content.media
    media_start = next_start_value(old["media_asset"], "asset_id") if "media_asset" in old else 1
    kind = F.when(F.col("asset_type") == "audio", F.lit(0)).otherwise(F.lit(1))
    media = assign_ids(media.withColumn("_kind", kind), ["unit_id", "_kind"], "asset_id", media_start)
    forms = lexicon.forms
    form_start = next_start_value(old["morpho_form"], "form_id") if "morpho_form" in old else 1
    forms = assign_ids(forms.drop("form_id"), ["lemma_id", "position"], "form_id", form_start)

    und_id = len(VARIANT_ROWS) + 1
    new = {
        "language_variant": spark.createDataFrame(VARIANT_ROWS + [(und_id, "und", "Undetermined", False, None)],
                                                  TABLES["language_variant"]),
        "ai_model_registry": with_defaults(spark.createDataFrame(
            MODEL_ROWS, "model_id int, model_name string, model_version string, training_status string"),
            "ai_model_registry"),
        "tone_marker": with_defaults(regs[0].select("tone_id", F.col("register").alias("tone_name")), "tone_marker"),
        "cultural_context_tag": with_defaults(themes[0].select(
            "context_id", F.col("theme_id").alias("context_name"), F.lit("thematic").alias("tag_category")),
            "cultural_context_tag"),
        "content_unit": with_defaults(content.units.withColumn("created_at", stamp), "content_unit"),
        "rel_content_tone": with_defaults(content.tone_links, "rel_content_tone"),
        "rel_content_context": with_defaults(content.theme_links, "rel_content_context"),
        "media_asset": with_defaults(media.withColumn("created_at", stamp), "media_asset"),
        "lemma": with_defaults(lexicon.lemmas, "lemma"),
        "morpho_form": with_defaults(forms, "morpho_form"),
    }
    tables = {}
    for t in TABLE_NAMES:
        if t in DIMENSIONS:
            tables[t] = new[t]                    # dimensions: the full, stable list, replaced per version
        else:
            tables[t] = new.get(t, _empty(spark, t))  # append-only: only this load's new rows are written
    version, results = publish(tables, root, version=version, appended=[t for t in TABLE_NAMES if t not in DIMENSIONS], by_load=True)
    return version, results
