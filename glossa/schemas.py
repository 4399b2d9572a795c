"""Declared shapes and registries: the one declarative source for table scans,
orphan checks, key-propagating maintenance, contracts and row scoping.

Nothing here touches data; it is read by the operators.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()
TS = T.TimestampNTZType()
SCORE = T.DecimalType(5, 2)


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


# --- documented nested shapes ------------------------------------------------

LANG_TRIPLE = T.StructType([_f("it", S), _f("fi", S), _f("en", S)])

INTERFERENCE = T.StructType([
    _f("standard_translation_EN", S), _f("standard_translation_IT", S), _f("note_culturale", S),
    _f("L1_transfer_errors", T.ArrayType(S)), _f("severity", S), _f("source_variant", S),
    _f("target_variants", T.ArrayType(S)),
])
GRAMMAR = T.StructType([_f("upos", S), _f("feats", T.MapType(S, S))])
DEPENDENCY = T.StructType([_f("id", I), _f("word", S), _f("rel", S), _f("head", I)])
SYNTAX = T.StructType([_f("dependencies", T.ArrayType(DEPENDENCY))])
TECH_META = T.StructType([_f("readability_index", D), _f("ai_confidence_score", D), _f("firebase_doc_id", S)])
SOURCE_META = T.StructType([_f("source", S), _f("import_date", S), _f("original_id", S), _f("note_culturale", S)])
LFS_POINTER = T.StructType([_f("lfs_url", S), _f("hf_url", S), _f("sha256", S)])

FLASHCARD = T.StructType([_f("difficulty", S), _f("img_hint", S), _f("audio_hint", S)])

# One phrase document of the export (keys the loader reads).
PHRASE_DOC = T.StructType([
    _f("text", LANG_TRIPLE), _f("level", S), _f("idiom", B), _f("register", S), _f("themeId", S),
    _f("flashcard", FLASHCARD), _f("note_culturale", S),
])
# One vocabulary document of the export.
VOCAB_DOC = T.StructType([
    _f("lemma", LANG_TRIPLE), _f("rawWithSynonyms", LANG_TRIPLE), _f("pos", S), _f("register", S),
    _f("themeId", S), _f("note_culturale", S),
])

# --- the twelve relational tables (effective shape after all migrations) -----

TABLES: dict[str, T.StructType] = {
    "ai_model_registry": T.StructType([
        _f("model_id", I, False), _f("model_name", S, False), _f("model_version", S, False),
        _f("hf_adapter_path", S), _f("training_status", S, False), _f("release_date", T.DateType()),
        _f("config_params_json", S)]),
    "cultural_context_tag": T.StructType([
        _f("context_id", I, False), _f("context_name", S, False), _f("tag_category", S),
        _f("cue_type", S), _f("description", S)]),
    "tone_marker": T.StructType([_f("tone_id", I, False), _f("tone_name", S, False), _f("cue_type", S)]),
    "language_variant": T.StructType([
        _f("variant_id", I, False), _f("iso_code", S, False), _f("variant_name", S, False),
        _f("is_pivot", B, False), _f("parent_variant_id", I)]),
    "lemma": T.StructType([
        _f("lemma_id", L, False), _f("text_root", S, False), _f("grammatical_category", S),
        _f("frequency_rank", I), _f("interference_json", S), _f("variant_id", I)]),
    "morpho_form": T.StructType([
        _f("form_id", L), _f("surface_form", S, False), _f("grammar_json", S), _f("lemma_id", L, False)]),
    "content_unit": T.StructType([
        _f("unit_id", L, False), _f("content_raw", S, False), _f("content_type", S, False),
        _f("content_hash", S, False), _f("cefr_level", S), _f("is_idiom", B, False), _f("difficulty", S),
        _f("variant_confidence", D), _f("source_origin", S), _f("created_at", TS),
        _f("syntax_ud_json", S), _f("tech_meta_json", S), _f("source_metadata_json", S), _f("variant_id", I)]),
    "correction_feedback_log": T.StructType([
        _f("log_id", L, False), _f("error_severity", S), _f("error_type", S), _f("correction_diff", S),
        _f("training_cycle", I, False), _f("feedback_source", S, False), _f("created_at", TS),
        _f("model_id", I), _f("unit_id", L)]),
    "media_asset": T.StructType([
        _f("asset_id", L, False), _f("asset_type", S, False), _f("file_format", S, False),
        _f("file_name", S, False), _f("storage_location", S, False), _f("lfs_pointer", S),
        _f("created_at", TS), _f("unit_id", L, False), _f("variant_id", I)]),
    "vector_index": T.StructType([
        _f("vector_id", L, False), _f("pinecone_id", S, False), _f("embedding_model", S, False),
        _f("vector_status", S, False), _f("indexed_at", TS), _f("model_id", I, False), _f("unit_id", L, False)]),
    "rel_content_context": T.StructType([
        _f("unit_id", L, False), _f("context_id", I, False), _f("relevance_score", SCORE)]),
    "rel_content_tone": T.StructType([
        _f("unit_id", L, False), _f("tone_id", I, False), _f("intensity_score", SCORE)]),
}

TABLE_NAMES = tuple(TABLES)

# Columns that hold JSON documents (for the table profile).
JSON_COLUMNS = {
    "ai_model_registry": ("config_params_json",),
    "lemma": ("interference_json",),
    "morpho_form": ("grammar_json",),
    "content_unit": ("syntax_ud_json", "tech_meta_json", "source_metadata_json"),
    "media_asset": ("lfs_pointer",),
}

PRIMARY_KEYS = {
    "ai_model_registry": ("model_id",), "cultural_context_tag": ("context_id",), "tone_marker": ("tone_id",),
    "language_variant": ("variant_id",), "lemma": ("lemma_id",), "morpho_form": ("form_id",),
    "content_unit": ("unit_id",), "correction_feedback_log": ("log_id",), "media_asset": ("asset_id",),
    "vector_index": ("vector_id",), "rel_content_context": ("unit_id", "context_id"),
    "rel_content_tone": ("unit_id", "tone_id"),
}

NATURAL_KEYS = {
    "language_variant": ("iso_code",), "content_unit": ("content_hash",), "vector_index": ("pinecone_id",),
}


@dataclass(frozen=True)
class ForeignKey:
    child: str
    column: str
    parent: str
    parent_key: str
    on_delete: str  # CASCADE | RESTRICT | SET NULL
    on_update: str = "CASCADE"

    @property
    def name(self) -> str:
        return f"{self.child}.{self.column}->{self.parent}.{self.parent_key}"


# The fourteen foreign keys with their effective delete action (last migration wins).
FOREIGN_KEYS: tuple[ForeignKey, ...] = (
    ForeignKey("language_variant", "parent_variant_id", "language_variant", "variant_id", "RESTRICT"),
    ForeignKey("lemma", "variant_id", "language_variant", "variant_id", "RESTRICT"),
    ForeignKey("morpho_form", "lemma_id", "lemma", "lemma_id", "CASCADE"),
    ForeignKey("content_unit", "variant_id", "language_variant", "variant_id", "RESTRICT"),
    ForeignKey("correction_feedback_log", "model_id", "ai_model_registry", "model_id", "RESTRICT"),
    ForeignKey("correction_feedback_log", "unit_id", "content_unit", "unit_id", "CASCADE"),
    ForeignKey("media_asset", "unit_id", "content_unit", "unit_id", "CASCADE"),
    ForeignKey("media_asset", "variant_id", "language_variant", "variant_id", "RESTRICT"),
    ForeignKey("vector_index", "model_id", "ai_model_registry", "model_id", "RESTRICT"),
    ForeignKey("vector_index", "unit_id", "content_unit", "unit_id", "CASCADE"),
    ForeignKey("rel_content_context", "unit_id", "content_unit", "unit_id", "CASCADE"),
    ForeignKey("rel_content_context", "context_id", "cultural_context_tag", "context_id", "RESTRICT"),
    ForeignKey("rel_content_tone", "unit_id", "content_unit", "unit_id", "CASCADE"),
    ForeignKey("rel_content_tone", "tone_id", "tone_marker", "tone_id", "RESTRICT"),
)

#: The name under which a corpus may carry the constraints that are in force on it, and their columns.
CONSTRAINTS = "_constraints"
CONSTRAINT_SCHEMA = T.StructType([_f(c, S) for c in ("child", "column", "parent", "parent_key", "on_delete", "on_update")])

# The allowed values the schema documents for its text "enums".
ALLOWED_VALUES = {
    ("ai_model_registry", "training_status"): ("pending", "training", "ready", "retired"),
    ("content_unit", "cefr_level"): ("A1", "A2", "B1", "B2", "C1", "C2"),
    ("content_unit", "difficulty"): ("easy", "medium", "hard"),
    ("content_unit", "content_type"): ("phrase", "vocabulary", "dialogue", "grammar_rule"),
    ("correction_feedback_log", "feedback_source"): ("database_out", "human_review", "automated"),
    ("correction_feedback_log", "error_severity"): ("low", "medium", "high", "critical"),
    ("media_asset", "asset_type"): ("audio", "image"),
    ("media_asset", "file_format"): ("mp3", "wav", "jpg", "png", "webp"),
    ("media_asset", "storage_location"): ("github_lfs", "hugging_face", "local"),
    ("vector_index", "vector_status"): ("pending", "indexed", "outdated", "error"),
    ("lemma", "grammatical_category"): ("noun", "verb", "adjective", "adverb", "phrase"),
}

# Column defaults on write.
DEFAULTS = {
    ("ai_model_registry", "training_status"): "pending",
    ("language_variant", "is_pivot"): False,
    ("content_unit", "is_idiom"): False,
    ("correction_feedback_log", "training_cycle"): 1,
    ("correction_feedback_log", "feedback_source"): "database_out",
    ("media_asset", "storage_location"): "github_lfs",
    ("vector_index", "vector_status"): "pending",
}

# --- row scoping --------------------------------------------------------------

# Which tables each reader may select from.
LINGUISTIC_TABLES = ("content_unit", "language_variant", "lemma", "morpho_form", "tone_marker",
                     "cultural_context_tag", "rel_content_tone", "rel_content_context")
STUDENT_TABLES = ("content_unit", "language_variant", "lemma", "morpho_form")

# The language variants and models the corpus is seeded with (the fallback variant
# 'und' is added after them, with the next id).
VARIANT_ROWS = [(1, "it-IT", "Standard Italian", False, None),
                (2, "fi-FI", "Standard Finnish", False, None),
                (3, "en-EN", "Standard English", True, None)]
MODEL_ROWS = [(1, "Poro", "poro-34b-v1.0", "pending"),
              (2, "Aya", "aya-23-35b-v1.0", "pending"),
              (3, "Gemma", "gemma-7b-v1.0", "pending")]

# The origin stamped on units the export loader creates, and the content type of phrases.
LOADER_SOURCE = "firebase"
PHRASE_CONTENT_TYPE = "phrase"

# The fallback variant code and the training-export threshold.
FALLBACK_ISO = "und"
EXPORT_MIN_CONFIDENCE = 0.7
