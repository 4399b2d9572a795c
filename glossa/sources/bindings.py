"""The driver's tables bound as the corpus tables.

Each property is one lazily built DataFrame.  Small derived dimensions
(language variants, context tags, the register/theme vocabularies) are
materialised once to the checkpoint folder and size-checked before they are
hinted for broadcast; literal dimensions are broadcast as they are.
A binding lives for one query, so dimensions and facts always come from the
same state of the folder.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.functions.scalars import content_hash
from glossa.operators.dimensions import maybe_broadcast
from glossa.operators.keys import enumerate_values
from glossa.operators.contracts import registry_frame
from glossa.schemas import CONSTRAINTS, MODEL_ROWS
from glossa.sources.tables import read_driver_table

# Binding constants (FIXTURES): tones of the label table, the fallback variant id,
# and the size of one bound syntax document.
TONE_ROWS = [(1, "plain"), (2, "polished"), (3, "toxic")]
FALLBACK_VARIANT_ID = 99
DEPS_PER_DOCUMENT = 64


class Corpus:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return read_driver_table(self.spark, self.root, name)

    # --- dimensions -----------------------------------------------------------

    @cached_property
    def _language_variant(self) -> tuple[DataFrame, int]:
        codes, n = enumerate_values(self.raw("documents").where("lang is not null").select(F.col("lang").alias("iso_code")),
                                    "iso_code", "variant_id", drop_blank=False)
        und = self.spark.createDataFrame([(FALLBACK_VARIANT_ID, "und")], "variant_id int, iso_code string")
        lv = codes.unionByName(und).select(
            "variant_id", "iso_code", F.upper("iso_code").alias("variant_name"),
            (F.col("iso_code") == "en").alias("is_pivot"),
            F.lit(None).cast("int").alias("parent_variant_id"))
        return lv, n.plus(1, 64)

    @property
    def language_variant(self) -> DataFrame:
        df, n = self._language_variant
        return maybe_broadcast(df, n)

    @cached_property
    def _context_tag(self) -> tuple[DataFrame, int]:
        return enumerate_values(self.raw("documents").select(F.col("source").alias("context_name")),
                                "context_name", "context_id", drop_blank=False)

    @property
    def cultural_context_tag(self) -> DataFrame:
        df, n = self._context_tag
        return maybe_broadcast(df, n)

    @property
    def tone_marker(self) -> DataFrame:
        return F.broadcast(self.spark.createDataFrame(TONE_ROWS, "tone_id int, tone_name string"))

    @property
    def ai_model_registry(self) -> DataFrame:
        return F.broadcast(self.spark.createDataFrame(
            MODEL_ROWS, "model_id int, model_name string, model_version string, training_status string"))

    # --- facts ------------------------------------------------------------------

    @property
    def content_unit(self) -> DataFrame:
        return self.content_unit_from(self.raw("documents"))

    def content_unit_from(self, documents: DataFrame) -> DataFrame:
        """The content_unit binding over any documents frame (batch or stream)."""
        d = documents.alias("d")
        lv = self.language_variant.select("variant_id", "iso_code").alias("v")
        lab = self.raw("labels").alias("l")
        n = F.col("d.n_chars")
        level = (F.when(n < 200, "A1").when(n < 1000, "A2").when(n < 3000, "B1")
                  .when(n < 8000, "B2").when(n < 16000, "C1"))
        q, t = F.col("l.quality"), F.col("l.toxic")
        conf = (F.when(F.col("l.doc_id").isNull(), F.lit(None))
                 .when((q == 1) & (t == 0), 0.9).when(q == 1, 0.7).when(t == 0, 0.4).otherwise(0.0))
        doc_id = F.col("d.doc_id")
        # a language the dimension does not hold, or none at all, falls back to 'und' (I9): no unit is lost
        return (d.join(lv, F.col("v.iso_code") == F.col("d.lang"), "left")
                 .join(lab, F.col("l.doc_id") == doc_id, "left")
                 .select(doc_id.alias("unit_id"), F.col("d.text").alias("content_raw"),
                         F.lit("phrase").alias("content_type"), level.alias("cefr_level"),
                         (doc_id % 7 == 0).alias("is_idiom"), F.lit(None).cast("string").alias("difficulty"),
                         conf.cast("double").alias("variant_confidence"),
                         F.col("d.source").alias("source_origin"),
                         F.when(doc_id % 40 == 39, F.lit(None))
                          .otherwise(F.coalesce(F.col("v.variant_id"), F.lit(FALLBACK_VARIANT_ID))).cast("int").alias("variant_id")))

    @property
    def rel_content_tone(self) -> DataFrame:
        lab = self.raw("labels")
        tones = F.array_compact(F.array((F.col("quality") + 1).cast("int"),
                                        F.when(F.col("toxic") == 1, F.lit(3))))
        return lab.select(F.col("doc_id").alias("unit_id"), F.explode(tones).alias("tone_id"))

    @property
    def rel_content_context(self) -> DataFrame:
        d = self.raw("documents").select("doc_id", "source")
        cct = self.cultural_context_tag
        doc_id, cid = F.col("doc_id"), F.col("context_id")
        links = F.array_compact(F.array(F.when(doc_id % 9 != 0, cid),
                                        F.when(doc_id % 5 == 0, (cid % 20 + 1).cast("int"))))
        return (d.join(cct, d.source == cct.context_name)
                 .select(doc_id.alias("unit_id"), F.explode(links).alias("context_id")))

    @property
    def vector_index(self) -> DataFrame:
        e = self.raw("embeddings")
        lab = F.col("label")
        status = (F.when(lab < 6, "indexed").when(lab < 8, "pending").when(lab == 8, "outdated")
                   .otherwise("error"))
        return e.select(F.col("vec_id").alias("vector_id"), F.col("vec_id").alias("unit_id"),
                        (lab % 3 + 1).alias("model_id"), status.alias("vector_status"), "embedding")

    @property
    def lemma(self) -> DataFrame:
        p = self.raw("part")
        key = F.col("p_partkey")
        return p.select(key.alias("lemma_id"),
                        F.concat("p_name", F.lit(" "), F.col("p_size").cast("string")).alias("text_root"),
                        F.when(key % 50 == 0, F.lit(None)).otherwise(key % 4 + 1).cast("int").alias("variant_id"))

    @property
    def annotated_lemma(self) -> DataFrame:
        """Lemmas with an interference document: brand and type as transfer errors, a severity for two sizes in three."""
        size = F.col("p_size")
        doc = F.struct(F.array("p_brand", "p_type").alias("L1_transfer_errors"),
                       F.when(size % 3 == 1, F.lit("low")).when(size % 3 == 2, F.lit("high")).alias("severity"))
        return self.raw("part").select(F.col("p_partkey").alias("lemma_id"), F.to_json(doc).alias("interference_json"))

    @property
    def annotated_form(self) -> DataFrame:
        """Forms with a grammar document: one feature for the brand, one for the type."""
        feats = F.create_map(F.lit("Brand"), F.col("p_brand"), F.lit("Type"), F.col("p_type"))
        doc = F.struct(F.lit("NOUN").alias("upos"), feats.alias("feats"))
        key = F.col("p_partkey")
        return self.raw("part").select((key + 1000).alias("form_id"), key.alias("lemma_id"), F.to_json(doc).alias("grammar_json"))

    @property
    def morpho_form(self) -> DataFrame:
        li = self.raw("lineitem")
        return li.select(F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(F.col("l_orderkey"))
                          .alias("form_id"),
                         F.concat("l_returnflag", "l_linestatus").alias("surface_form"),
                         F.col("l_partkey").alias("lemma_id"))

    @property
    def correction_feedback_log(self) -> DataFrame:
        return feedback_log_from(self.raw("events"))

    @property
    def variant_tree(self) -> DataFrame:
        r = self.raw("region").select((F.col("r_regionkey") + 1000).alias("variant_id"),
                                      F.col("r_name").alias("variant_name"),
                                      F.lit(None).cast("int").alias("parent_variant_id"))
        n = self.raw("nation").select(F.col("n_nationkey").alias("variant_id"), F.col("n_name").alias("variant_name"),
                                      (F.col("n_regionkey") + 1000).alias("parent_variant_id"))
        return r.unionByName(n)

    def tables(self) -> dict[str, DataFrame]:
        """The bound corpus tables by name (media assets come from ingestion, not from a driver table)."""
        names = ("content_unit", "language_variant", "tone_marker", "rel_content_tone", "cultural_context_tag",
                 "rel_content_context", "vector_index", "lemma", "morpho_form", "correction_feedback_log",
                 "ai_model_registry")
        return {n: getattr(self, n) for n in names}

    def faulty_tables(self) -> dict[str, DataFrame]:
        """The bound tables with faults that the contracts look for, all made from the driver's own rows: missing and
        repeated keys, wrong hashes, values out of range, a second fallback variant, a model without its registry row."""
        t = self.tables()
        unit, vector, log = F.col("unit_id"), F.col("vector_id"), F.col("log_id")
        marked = F.when(unit % 30 == 0, F.concat("content_raw", F.lit("!"))).otherwise(F.col("content_raw"))
        t["content_unit"] = (t["content_unit"]
                             .withColumn("variant_id", F.when(unit % 50 == 0, F.lit(77)).otherwise(F.col("variant_id")))
                             .withColumn("cefr_level", F.when(unit % 25 == 0, F.lit("Z9")).otherwise(F.col("cefr_level")))
                             .withColumn("variant_confidence", F.char_length("content_raw") / F.lit(2000.0))
                             .withColumn("content_hash", content_hash(marked, F.col("variant_id"))))
        t["language_variant"] = t["language_variant"].unionByName(self.spark.createDataFrame(
            [(98, "und", "UND", True, None)], "variant_id int, iso_code string, variant_name string, is_pivot boolean, parent_variant_id int"))
        t["tone_marker"] = t["tone_marker"].where("tone_id < 3")
        t["ai_model_registry"] = t["ai_model_registry"].where("model_id < 3")
        t["rel_content_tone"] = t["rel_content_tone"].unionByName(t["rel_content_tone"].where(unit % 10 == 0))
        t["vector_index"] = t["vector_index"].select(
            "vector_id", (vector % 300).alias("unit_id"), F.when(vector % 9 != 0, F.col("model_id")).alias("model_id"),
            F.when(vector % 8 == 0, F.lit("lost")).otherwise(F.col("vector_status")).alias("vector_status"), "embedding")
        t["correction_feedback_log"] = (t["correction_feedback_log"]
                                        .withColumn("unit_id", F.when(log % 5 == 0, unit + 100_000_000).otherwise(unit))
                                        .withColumn("error_severity", F.when(log % 7 == 0, F.lit("minor")).otherwise(F.col("error_severity"))))
        # constraints in force that the registry forbids: feedback that loses its model, keys not followed, vectors deleted along
        rule = lambda child, column: (F.col("child") == child) & (F.col("column") == column)
        t[CONSTRAINTS] = (registry_frame(self.spark)
                          .withColumn("on_delete", F.when(rule("correction_feedback_log", "model_id"), F.lit("SET NULL"))
                                      .when(rule("vector_index", "model_id"), F.lit("CASCADE")).otherwise(F.col("on_delete")))
                          .withColumn("on_update", F.when(rule("correction_feedback_log", "unit_id"), F.lit("NO ACTION")).otherwise(F.col("on_update"))))
        return t

    # --- ingestion inputs -------------------------------------------------------

    @property
    def docs(self) -> DataFrame:
        """Export documents (FIXTURES 3.1): one row per document, flattened."""
        return docs_from(self.raw("part"))

    @property
    def vocabulary_docs(self) -> DataFrame:
        """The same documents read as the vocabulary collection: one synonym text for every language."""
        d = self.docs
        return d.select("doc_pos", "doc_id", "text_it", "text_fi", "text_en",
                        *[F.col("synonyms").alias(f"syn_{lang}") for lang in ("it", "fi", "en")],
                        "register", "theme_id")

    @property
    def syntax_documents(self) -> DataFrame:
        """Conversations bound as syntax-tree documents (JSON text): one dependency per turn, with the
        whole turn text as its word, the role as relation and the previous turn as head.

        Turns are packed ``DEPS_PER_DOCUMENT`` at a time, so no document (and
        no aggregation group) grows with the length of one conversation.
        """
        c = self.raw("conversations")
        dep = F.struct(F.col("turn").cast("int").alias("id"), F.col("text").alias("word"),
                       F.col("role").alias("rel"), (F.col("turn") - 1).cast("int").alias("head"))
        chunk = F.floor(F.col("turn") / DEPS_PER_DOCUMENT)
        grouped = c.groupBy(F.col("conv_id").alias("unit_id"), chunk.alias("chunk")).agg(
            F.array_sort(F.collect_list(dep)).alias("deps"))
        return grouped.select("unit_id", "chunk",
                              F.to_json(F.struct(F.col("deps").alias("dependencies"))).alias("syntax_ud_json"))


def feedback_log_from(events: DataFrame) -> DataFrame:
    """The correction_feedback_log binding over any events frame (batch or stream)."""
    v = F.col("value")
    sev = F.when(v < 5, "low").when(v < 20, "medium").when(v < 60, "high").otherwise("critical")
    return events.select(F.col("event_id").alias("log_id"), F.col("event_type").alias("error_type"),
                         sev.alias("error_severity"), (F.col("user_id") % 3 + 1).alias("model_id"),
                         F.dayofmonth("ts").cast("int").alias("training_cycle"), F.col("ts").alias("created_at"),
                         F.col("user_id").alias("unit_id"))


def docs_from(part: DataFrame) -> DataFrame:
    """The export-document binding over any part frame (batch or stream)."""
    key = F.col("p_partkey")
    name_size = F.concat("p_name", F.lit(" "), F.col("p_size").cast("string"))
    return part.select(
        key.alias("doc_pos"),
        F.when(key == 0, F.lit("init_doc")).otherwise(F.concat(F.lit("doc_"), key.cast("string"))).alias("doc_id"),
        F.when(key % 11 == 0, F.lit(None)).when(key % 17 == 0, F.lit("")).otherwise(name_size).alias("text_it"),
        F.when(key % 13 == 0, F.lit(None)).otherwise(F.concat("p_brand", F.lit(" "), "p_type")).alias("text_fi"),
        name_size.alias("text_en"),
        F.when(key % 19 == 0, F.lit(None)).otherwise(F.col("p_type")).alias("register"),
        F.col("p_brand").alias("theme_id"),
        F.when(key % 3 == 0, F.concat("p_name", F.lit(".mp3"))).alias("audio_hint"),
        F.when(key % 6 == 0, F.concat("p_name", F.lit(".mp3")))
         .when(key % 2 == 0, F.concat("p_brand", F.lit(".jpg"))).alias("img_hint"),
        F.concat(F.lit(" "), F.upper("p_name"), F.lit("?x "), "p_name", F.lit("  ?y "), "p_type").alias("synonyms"))


def bound(spark: SparkSession, root: str) -> Corpus:
    return Corpus(spark, root)
