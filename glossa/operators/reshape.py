"""Reshaping (F1, F3, F4, F8, F9): unpivot, token explosion, hint-to-asset rows, links.

All of them are narrow (per-row generators): no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.functions.scalars import asset_format, first_piece, present, score, split_ws, trim_ws
from glossa.schemas import DEFAULTS

# The three source languages and their variant ids, in load order.
LANGS = (("it", 1), ("fi", 2), ("en", 3))


def unpivot_langs(df: DataFrame, text_prefix: str = "text_", langs: Sequence[tuple[str, int]] = LANGS,
                  extra_prefixes: Sequence[str] = (), out_text: str = "content_raw") -> DataFrame:
    """one row per (document, language); document attributes are copied.

    ``text_<lang>`` becomes ``out_text``; each ``<prefix><lang>`` column of
    ``extra_prefixes`` becomes ``<prefix>`` (e.g. ``syn_`` -> ``syn``).
    """
    per_lang = [c for c in df.columns
                if any(c == f"{p}{lang}" for p in (text_prefix, *extra_prefixes) for lang, _ in langs)]
    keep = [c for c in df.columns if c not in per_lang]
    items = [F.struct(F.lit(lang).alias("lang"), F.lit(vid).alias("variant_id"),
                      F.col(f"{text_prefix}{lang}").alias(out_text),
                      *[F.col(f"{p}{lang}").alias(p.rstrip("_")) for p in extra_prefixes])
             for lang, vid in langs]
    return df.select(*keep, F.inline(F.array(*items)))


def synonym_forms(lemmas: DataFrame, syn_col: str = "syn", root_col: str = "text_root",
                  id_col: str = "lemma_id") -> DataFrame:
    """synonyms -> surface forms.

    Split on whitespace, keep the text before the first '?', trim, drop blanks
    and tokens equal (case-insensitively) to the root; repeats stay.
    """
    tokens = lemmas.where(present(syn_col)).select(
        id_col, root_col, F.posexplode(split_ws(syn_col)).alias("position", "_tok"))
    form = trim_ws(first_piece("_tok", "?"))
    return (tokens.select(id_col, "position", form.alias("surface_form"), root_col)
                  .where((F.col("surface_form") != "") & (F.lower("surface_form") != F.lower(F.col(root_col))))
                  .select(F.lit(None).cast("long").alias("form_id"), "surface_form",
                          F.lit(None).cast("string").alias("grammar_json"), F.col(id_col).alias("lemma_id"),
                          "position"))


def media_rows(units: DataFrame, italian_variant: int = 1) -> DataFrame:
    """F4 (+E7): Italian units' hints -> assets: audio (mp3, Italian variant) and image (jpg, no variant).

    An image hint equal to the audio hint is the same (unit, file name) and
    loses to the audio row.  Both rows come from the same unit row, so this
    first-wins rule is applied inside the row: no shuffle.
    """
    audio_ok = present("audio_hint")
    image_ok = present("img_hint") & ~(audio_ok & (F.col("img_hint") == F.col("audio_hint")))
    audio = F.when(audio_ok, F.struct(F.lit("audio").alias("asset_type"), F.col("audio_hint").alias("file_name"),
                                      F.lit(italian_variant).alias("variant_id")))
    image = F.when(image_ok, F.struct(F.lit("image").alias("asset_type"), F.col("img_hint").alias("file_name"),
                                      F.lit(None).cast("int").alias("variant_id")))
    return (units.where(F.col("variant_id") == italian_variant)
                 .select("unit_id", F.inline(F.array_compact(F.array(audio, image))))
                 .select("unit_id", "asset_type", asset_format("asset_type").alias("file_format"), "file_name",
                         F.lit(DEFAULTS[("media_asset", "storage_location")]).alias("storage_location"),
                         "variant_id"))


def build_links(units: DataFrame, natural_col: str, vocab: DataFrame, vocab_key: str, id_col: str,
                score_col: str) -> DataFrame:
    """F9 (+C10): (unit, tag id, 1.00) for units whose value is in the vocabulary.

    A missing or unknown value gives no link.  Each unit row gives at most
    one link per vocabulary, so (unit, tag) pairs are unique without a
    de-duplication shuffle.
    """
    v = vocab.select(F.col(vocab_key).alias("_v"), F.col(id_col))
    return (units.join(v, F.col(natural_col) == F.col("_v"))
                 .select("unit_id", id_col, score(F.lit(1.0)).alias(score_col)))
