"""Document ingestion: export documents -> corpus tables (F2).

Phrase documents give content units, tone and theme links and media
assets; vocabulary documents give lemmas and their synonym forms.  The
order of operations follows the loader: unpivot (F1), skip missing text
(B9), hash (G1), first-wins dedup (E5/E6), dense ids (E4), then links and
assets from the surviving rows only.

Shuffles: one hash-keyed aggregation for the dedup, one range shuffle for
the ids (written once to the checkpoint folder), and broadcast joins with
the size-checked vocabularies.  Everything else is per-row.  Each product
is built on first use, so a caller that needs only the unpivoted rows does
not pay for ids or vocabularies.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.functions.scalars import (content_hash, fold, json_object, load_stamp, present,
                                     strict_bool)
from glossa.operators.dedup import both_large, first_wins
from glossa.operators.dimensions import maybe_broadcast
from glossa.operators.keys import assign_ids, enumerate_values, first_wins_with_ids, next_start_value
from glossa.operators.reshape import build_links, media_rows, synonym_forms, unpivot_langs
from glossa.schemas import LOADER_SOURCE, PHRASE_CONTENT_TYPE
from glossa.sources.documents import drop_placeholders

ORDER = ("doc_pos", "variant_id")
# small unit attributes carried through the narrow id pass (links and media are built from them)
UNIT_KEY_CARRY = ("doc_id", "register", "theme_id", "audio_hint", "img_hint")
PHRASE_FIELDS = ("text_it", "text_fi", "text_en", "level", "idiom", "register", "theme_id", "difficulty",
                 "img_hint", "audio_hint", "note_culturale")
VOCAB_FIELDS = ("text_it", "text_fi", "text_en", "syn_it", "syn_fi", "syn_en", "pos", "register", "theme_id",
                "note_culturale")


def _with_fields(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Add absent document fields as NULL strings (booleans for ``idiom``)."""
    for f in fields:
        if f not in df.columns:
            df = df.withColumn(f, F.lit(None).cast("boolean" if f == "idiom" else "string"))
    return df


def _phrase_docs(phrases: DataFrame) -> DataFrame:
    return drop_placeholders(_with_fields(phrases, PHRASE_FIELDS).select("doc_pos", "doc_id", *PHRASE_FIELDS),
                             list(PHRASE_FIELDS))


def _vocab_docs(vocabulary: DataFrame) -> DataFrame:
    return drop_placeholders(_with_fields(vocabulary, VOCAB_FIELDS).select("doc_pos", "doc_id", *VOCAB_FIELDS),
                             list(VOCAB_FIELDS))


def register_vocabularies(frames: Sequence[DataFrame]) -> tuple[tuple[DataFrame, int], tuple[DataFrame, int]]:
    """D9 + E3 over all collections: (register -> tone_id), (theme -> context_id)."""
    regs = themes = None
    for f in frames:
        r, t = f.select("register"), f.select("theme_id")
        regs = r if regs is None else regs.unionByName(r)
        themes = t if themes is None else themes.unionByName(t)
    return (enumerate_values(regs, "register", "tone_id"), enumerate_values(themes, "theme_id", "context_id"))


class ContentBuild:
    """Products of one phrase load, each built on first use (ids and vocabularies are written once)."""

    def __init__(self, docs: DataFrame, vocab_docs: DataFrame | None = None,
                 existing_units: DataFrame | None = None, import_date: str | None = None,
                 vocabularies: tuple[tuple[DataFrame, int], tuple[DataFrame, int]] | None = None,
                 start: int | None = None):
        self.docs, self.vocab_docs = docs, vocab_docs
        self.existing_units, self.import_date = existing_units, import_date
        self.start = start  # first id to give; default: 1, or after the maximum of existing_units
        if vocabularies is not None:  # fixed (register -> tone_id), (theme -> context_id) from a stored load
            self._vocabularies = vocabularies

    @cached_property
    def langs(self) -> DataFrame:
        """one row per (document, language), before any skip."""
        return unpivot_langs(self.docs)

    @cached_property
    def _candidates(self) -> DataFrame:
        """B9 + G1: rows with text, hashed."""
        return self.langs.where(present("content_raw")).withColumn("content_hash",
                                                                   content_hash("content_raw", "variant_id"))

    @property
    def _stored_hashes(self) -> DataFrame | None:
        return None if self.existing_units is None else self.existing_units.select("content_hash")

    @cached_property
    def survivors(self) -> DataFrame:
        """E5: first row per content hash (when incremental: new hashes only, A4), found on narrow rows."""
        return self._ided[0]

    @cached_property
    def _ided(self) -> tuple[DataFrame, DataFrame]:
        start = self.start or (1 if self.existing_units is None else next_start_value(self.existing_units, "unit_id"))
        return first_wins_with_ids(self._candidates, ["content_hash"], ORDER, "unit_id", start,
                                   exclude=self._stored_hashes, carry=UNIT_KEY_CARRY)

    @property
    def unit_keys(self) -> DataFrame:
        """The written narrow frame: content_hash, unit_id and the link/media attributes (no text)."""
        return self._ided[1]

    @property
    def units(self) -> DataFrame:
        """E5 + E4 (+E8): content_unit rows with dense ids, continuing after the stored maximum."""
        meta = json_object(source=F.lit(LOADER_SOURCE), import_date=load_stamp(self.import_date).cast("string"),
                           original_id=F.col("doc_id"), note_culturale=F.col("note_culturale"))
        return self._ided[0].select(
            "unit_id", "content_raw", F.lit(PHRASE_CONTENT_TYPE).alias("content_type"), "content_hash",
            F.col("level").alias("cefr_level"), strict_bool("idiom").alias("is_idiom"), "difficulty",
            F.lit(LOADER_SOURCE).alias("source_origin"), F.col("variant_id").cast("int").alias("variant_id"),
            meta.alias("source_metadata_json"),
            "doc_id", "doc_pos", "lang", "register", "theme_id", "audio_hint", "img_hint")

    @cached_property
    def _vocabularies(self):
        frames = [self.docs] + ([self.vocab_docs] if self.vocab_docs is not None else [])
        return register_vocabularies(frames)

    @property
    def registers(self) -> DataFrame:
        """E3 vocabulary register -> tone_id."""
        return self._vocabularies[0][0]

    @property
    def themes(self) -> DataFrame:
        """E3 vocabulary theme -> context_id."""
        return self._vocabularies[1][0]

    @property
    def tone_links(self) -> DataFrame:
        (regs, n), _ = self._vocabularies
        return build_links(self.unit_keys, "register", maybe_broadcast(regs, n), "register", "tone_id",
                           "intensity_score")

    @property
    def theme_links(self) -> DataFrame:
        _, (themes, n) = self._vocabularies
        return build_links(self.unit_keys, "theme_id", maybe_broadcast(themes, n), "theme_id", "context_id",
                           "relevance_score")

    @property
    def media(self) -> DataFrame:
        return media_rows(self.unit_keys)


def build_content(phrases: DataFrame, vocabulary: DataFrame | None = None, existing_units: DataFrame | None = None,
                  import_date: str | None = None, vocabularies=None, start: int | None = None) -> ContentBuild:
    """Phrase documents (flat columns, see ``flatten_phrases``) -> units, links and media.

    With ``existing_units`` the load is incremental (A4 + E8): hashes already
    stored are skipped and ids continue after the stored maximum.  The
    register/theme vocabularies span both collections.
    """
    vocab_docs = _vocab_docs(vocabulary) if vocabulary is not None else None
    return ContentBuild(_phrase_docs(phrases), vocab_docs, existing_units, import_date, vocabularies, start)


class LexiconBuild:
    """Products of one vocabulary load, built on first use."""

    def __init__(self, docs: DataFrame, existing_lemmas: DataFrame | None = None):
        self.existing_lemmas = existing_lemmas
        self.docs = docs.withColumn("_interference", json_object(standard_translation_EN=F.col("text_en"),
                                                                 standard_translation_IT=F.col("text_it"),
                                                                 note_culturale=F.col("note_culturale")))

    @cached_property
    def langs(self) -> DataFrame:
        return unpivot_langs(self.docs, extra_prefixes=("syn_",))

    @cached_property
    def lemmas(self) -> DataFrame:
        """E6 fold dedup, E4 ids, G13 part of speech, G20 interference object for Italian rows."""
        kept = self.langs.where(present("content_raw"))
        # the key holds the variant, so the document's position orders the rows of a key
        firsts = first_wins(kept, [fold("content_raw").alias("_fold"), "variant_id"], "doc_pos")
        start = 1
        if self.existing_lemmas is not None:  # natural key (folded text, variant): stored lemmas are skipped
            stored = self.existing_lemmas.select(fold("text_root").alias("_fold"), "variant_id")
            firsts = firsts.join(both_large(stored), ["_fold", "variant_id"], "left_anti")
            start = next_start_value(self.existing_lemmas, "lemma_id")
        # lemma rows are short (a word and its synonyms): the whole winning row goes through the id pass once
        ided = assign_ids(firsts, list(ORDER), "lemma_id", start)
        return ided.select(
            "lemma_id", F.col("content_raw").alias("text_root"),
            F.col("pos").alias("grammatical_category"),  # G13: known values stand for themselves, unknown ones pass
            F.lit(None).cast("int").alias("frequency_rank"),
            F.when(F.col("lang") == "it", F.col("_interference")).alias("interference_json"),
            F.col("variant_id").cast("int").alias("variant_id"),
            "doc_id", "doc_pos", "syn")

    @property
    def forms(self) -> DataFrame:
        """synonym surface forms of the surviving lemmas."""
        return synonym_forms(self.lemmas)


def build_lexicon(vocabulary: DataFrame, existing_lemmas: DataFrame | None = None) -> LexiconBuild:
    """Vocabulary documents -> lemmas and synonym forms (incremental against ``existing_lemmas``)."""
    return LexiconBuild(_vocab_docs(vocabulary), existing_lemmas)
