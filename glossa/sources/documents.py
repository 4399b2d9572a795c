"""Document sources (A1-A3).

The export is a JSON object per collection keyed by document id.  At scale
it is JSON Lines (one document per line, with ``doc_id`` and ``doc_pos``)
or Parquet, both splittable; the single-object form is read whole by one
task and is meant for small exports only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossa.operators.dimensions import maybe_broadcast

PLACEHOLDER_ID = "init_doc"


def read_docs(spark: SparkSession, path: str, collection: str, schema: T.StructType,
              fmt: str = "jsonl") -> DataFrame:
    """A1: one row per document: ``doc_pos``, ``doc_id`` and the declared document fields.

    ``fmt='jsonl'``: records carry ``doc_id`` and ``doc_pos`` next to the
    document fields (``require_positions`` checks the latter).  ``fmt='export'``: the whole
    export object; ``doc_pos`` is the position of the key in the collection.
    A missing collection gives an empty frame.
    """
    if fmt == "jsonl":
        fields = [T.StructField("doc_pos", T.LongType()), T.StructField("doc_id", T.StringType())]
        full = T.StructType(fields + [f for f in schema.fields if f.name not in ("doc_id", "doc_pos")])
        return spark.read.schema(full).json(path)
    if fmt != "export":
        raise ValueError(f"unknown format {fmt!r}")
    export = T.StructType([T.StructField(collection, T.MapType(T.StringType(), schema))])
    raw = spark.read.text(path, wholetext=True)
    parsed = raw.select(F.from_json("value", export).getField(collection).alias("_c"))
    return (parsed.select(F.posexplode(F.map_entries("_c")).alias("doc_pos", "_e"))
                  .select(F.col("doc_pos").cast("long").alias("doc_pos"), F.col("_e.key").alias("doc_id"),
                          *[F.col("_e.value").getField(f.name).alias(f.name) for f in schema.fields]))


def require_positions(docs: DataFrame) -> None:
    """Refuse documents without a position: which text wins, and every id, follows the documents' order."""
    if not docs.where(F.col("doc_pos").isNull()).isEmpty():
        raise ValueError("documents without doc_pos: JSON Lines records must carry their position")


def drop_placeholders(df: DataFrame, payload_cols: list[str] | None = None) -> DataFrame:
    """A2: drop the ``init_doc`` placeholder and empty documents (every field NULL)."""
    cols = payload_cols or [c for c in df.columns if c not in ("doc_id", "doc_pos")]
    any_field = F.greatest(*[F.col(c).isNotNull() for c in cols]) if len(cols) > 1 else F.col(cols[0]).isNotNull()
    return df.where((F.col("doc_id") != PLACEHOLDER_ID) & any_field)


def load_dimension(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """A3: a literal dimension; broadcast where it is joined if its rows are within the limit."""
    return maybe_broadcast(spark.createDataFrame(rows, schema), len(rows))


def flatten_phrases(docs: DataFrame) -> DataFrame:
    """Nested phrase documents -> the flat columns the ingestion reads."""
    return docs.select(
        "doc_pos", "doc_id",
        F.col("text.it").alias("text_it"), F.col("text.fi").alias("text_fi"), F.col("text.en").alias("text_en"),
        "level", "idiom", "register", F.col("themeId").alias("theme_id"),
        F.col("flashcard.difficulty").alias("difficulty"), F.col("flashcard.img_hint").alias("img_hint"),
        F.col("flashcard.audio_hint").alias("audio_hint"), "note_culturale")


def flatten_vocabulary(docs: DataFrame) -> DataFrame:
    """Nested vocabulary documents -> flat columns."""
    return docs.select(
        "doc_pos", "doc_id",
        F.col("lemma.it").alias("text_it"), F.col("lemma.fi").alias("text_fi"), F.col("lemma.en").alias("text_en"),
        F.col("rawWithSynonyms.it").alias("syn_it"), F.col("rawWithSynonyms.fi").alias("syn_fi"),
        F.col("rawWithSynonyms.en").alias("syn_en"),
        "pos", "register", F.col("themeId").alias("theme_id"), "note_culturale")
