"""Nested JSON columns (A6, F5-F7, G10): parse with a declared schema, then explode.

The JSON text is parsed once per row with ``from_json`` into the documented
struct; a NULL document, ``{}`` or a document without the key gives no rows
(``inline``/``explode`` of NULL emits nothing).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.schemas import GRAMMAR, INTERFERENCE, SYNTAX


def scan_syntax(units: DataFrame) -> DataFrame:
    """The two columns the syntax consumer reads (pruned at the Parquet scan)."""
    return units.select("content_raw", "syntax_ud_json")


def explode_dependencies(docs: DataFrame, json_col: str = "syntax_ud_json", id_col: str = "unit_id") -> DataFrame:
    """one row per dependency: (unit, id, word, upper-cased relation, head)."""
    deps = F.from_json(F.col(json_col), SYNTAX).getField("dependencies")
    return (docs.select(id_col, F.inline(deps))
                .select(id_col, "id", "word", F.upper("rel").alias("rel"), "head"))


def explode_transfer_errors(lemmas: DataFrame, json_col: str = "interference_json") -> DataFrame:
    """one row per L1 transfer error, with the lemma's severity."""
    doc = F.from_json(F.col(json_col), INTERFERENCE)
    return (lemmas.select("lemma_id", doc.alias("_d"))
                  .select("lemma_id", F.explode(F.col("_d.L1_transfer_errors")).alias("transfer_error"),
                          F.col("_d.severity").alias("severity")))


def explode_feats(forms: DataFrame, json_col: str = "grammar_json") -> DataFrame:
    """one row per morphological feature (name, value) with the form's UPOS tag."""
    doc = F.from_json(F.col(json_col), GRAMMAR)
    return (forms.select("form_id", "lemma_id", doc.alias("_g"))
                 .select("form_id", "lemma_id", F.col("_g.upos").alias("upos"),
                         F.explode(F.col("_g.feats")).alias("feature", "value")))
