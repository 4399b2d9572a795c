"""Registered queries: operator id + slug -> callable(spark, data_root) -> DataFrame.

Each callable binds the driver's tables as the corpus tables (see
``glossa.sources.bindings``) and applies one operator over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.functions.scalars import (content_hash, eligible, has_member, has_path, json_text, map_or_keep, member_state, normalize_iso, parsed,
                                      variant_text)
from glossa.operators import aggregates as agg
from glossa.operators import context, contracts, incremental, joins, maintain, nested, retrieval, vector_store
from glossa.operators.dedup import dedup_links
from glossa.operators.dimensions import materialize
from glossa.operators.keys import enumerate_values
from glossa.plans.ingest import ContentBuild, LexiconBuild, build_content, build_lexicon
from glossa.session import scratch_folder, shuffle_partitions
from glossa.sources.bindings import bound, docs_from, feedback_log_from
from glossa.sources import layout, sinks
from glossa.sources.documents import drop_placeholders
from glossa.streaming import flows

Query = Callable[[SparkSession, str], DataFrame]


def d1_count_by_level(spark, root):
    return agg.count_by_level(bound(spark, root).content_unit)


def b1_audit_language_level(spark, root):
    c = bound(spark, root)
    return joins.audit_language_level(c.content_unit, c.language_variant, "FR", "B2")


def c2_theme_coverage(spark, root):
    c = bound(spark, root)
    return agg.theme_coverage(c.cultural_context_tag, c.rel_content_context)


def c5_units_without_vector(spark, root):
    c = bound(spark, root)
    return joins.units_without_vector(c.content_unit, c.vector_index)


def c3_morpho_density(spark, root):
    c = bound(spark, root)
    return agg.morpho_density(c.language_variant, c.lemma, c.morpho_form)


def d4_shared_roots(spark, root):
    c = bound(spark, root)
    return agg.shared_roots(c.lemma, c.language_variant)


def content(spark, root) -> ContentBuild:
    c = bound(spark, root)
    return build_content(c.docs, c.vocabulary_docs)


def lexicon(spark, root) -> LexiconBuild:
    return build_lexicon(bound(spark, root).vocabulary_docs)


def a2_drop_placeholders(spark, root):
    d = bound(spark, root).docs
    return drop_placeholders(d).select("doc_pos", "doc_id")


def f1_unpivot_langs(spark, root):
    return content(spark, root).langs.select("doc_pos", "doc_id", "variant_id", "content_raw")


def e5_dedup_by_hash(spark, root):
    return content(spark, root).survivors.select("content_hash", "doc_id", "variant_id", "content_raw")


def e4_assign_ids(spark, root):
    return content(spark, root).unit_keys.select("unit_id", "doc_id", "variant_id", "content_hash")


def e6_dedup_by_fold(spark, root):
    return lexicon(spark, root).lemmas.select("lemma_id", "doc_id", "variant_id", "text_root")


def f3_synonym_forms(spark, root):
    return lexicon(spark, root).forms.select("lemma_id", "surface_form")


def f4_media_rows(spark, root):
    return content(spark, root).media


def f9_tone_links(spark, root):
    return content(spark, root).tone_links


def f9_theme_links(spark, root):
    return content(spark, root).theme_links


def e3_enumerate_registers(spark, root):
    return content(spark, root).registers


def d13_skip_counts(spark, root):
    cb = content(spark, root)
    return agg.skip_counts(cb.langs.withColumn("content_hash", content_hash("content_raw", "variant_id")))


def c13_pivot_pairs(spark, root):
    return joins.pivot_pairs(content(spark, root).units, 1, 3, 2)


def h1_full_context(spark, root):
    return context.full_context(bound(spark, root).tables())


def h3_student_context(spark, root):
    return context.scoped_context(bound(spark, root).tables(), "authenticated", "student")


def b7_eligible_export(spark, root):
    c = bound(spark, root)
    return (c.content_unit.where(eligible())
             .join(c.language_variant.select("variant_id", "iso_code"), "variant_id")
             .select("unit_id", "content_raw", "iso_code", "variant_confidence"))


def c11_with_parent(spark, root):
    return joins.with_parent(bound(spark, root).variant_tree)


def c12_variant_roots(spark, root):
    return joins.variant_roots(bound(spark, root).variant_tree).drop("in_cycle")


def d11_feedback_by_cycle(spark, root):
    return agg.feedback_by_cycle(bound(spark, root).correction_feedback_log)


def d11_feedback_by_source(spark, root):
    log = maintain.with_defaults(bound(spark, root).correction_feedback_log, "correction_feedback_log")
    return agg.feedback_by_cycle(log, with_source=True)


def d12_vector_progress(spark, root):
    return agg.vector_progress(bound(spark, root).vector_index)


def c14_feedback_orphans(spark, root):
    c = bound(spark, root)
    indexed = c.vector_index.where(F.col("vector_status") == "indexed")
    return joins.orphans(c.correction_feedback_log, "unit_id", indexed, "unit_id").select(
        "log_id", "unit_id", "model_id")


def c6_not_in_null_right(spark, root):
    c = bound(spark, root)
    return joins.not_in(c.lemma.select("lemma_id"), c.morpho_form, "lemma_id", "form_id")


def c6_not_in_null_left(spark, root):
    c = bound(spark, root)
    return joins.not_in(c.morpho_form.select("form_id", "lemma_id"), c.lemma, "form_id", "lemma_id")


def f5_explode_dependencies(spark, root):
    return nested.explode_dependencies(bound(spark, root).syntax_documents)


def g8_normalize_iso(spark, root):
    d = bound(spark, root).raw("documents")
    return d.groupBy(normalize_iso("lang").alias("iso_code")).agg(F.count(F.lit(1)).alias("n_documents"))


def _with_units(spark, root) -> dict:
    """Bound tables with the ingested units as content_unit (for the hash contract)."""
    t = bound(spark, root).tables()
    t["content_unit"] = content(spark, root).units
    return t


def j2_foreign_keys(spark, root):
    return contracts.check_foreign_keys(bound(spark, root).tables())


def j10_hash_unique(spark, root):
    return contracts.check_hash_unique(_with_units(spark, root))


def j11_bridge_keys(spark, root):
    return contracts.check_bridge_keys(bound(spark, root).tables())


def j13_profile_tables(spark, root):
    return contracts.profile_tables(bound(spark, root).tables())


def j14_check_confidence(spark, root):
    return contracts.check_confidence(bound(spark, root).tables())


def j16_vector_owner(spark, root):
    return contracts.check_vector_owner(bound(spark, root).tables())


def j17_vector_pair(spark, root):
    return contracts.check_vector_pair(bound(spark, root).tables())


def j18_iso_normal(spark, root):
    return contracts.check_iso_normal(bound(spark, root).tables())


def j19_fallback_variant(spark, root):
    return contracts.check_fallback_variant(bound(spark, root).tables())


def j20_model_restrict(spark, root):
    return contracts.check_model_restrict(bound(spark, root).tables())


def j_contracts(spark, root):
    """J1-J20 on the bound tables, a row for each check and subject."""
    return contracts.run_contracts(bound(spark, root).tables())


def j_contracts_faulty(spark, root):
    """J1-J20 on the bound tables with faults: the rows that must fail do."""
    return contracts.run_contracts(bound(spark, root).faulty_tables())


def j21_gate_faulty(spark, root):
    return contracts.gate(contracts.run_contracts(bound(spark, root).faulty_tables()))


def j21_contract_gate(spark, root):
    return contracts.gate(contracts.run_contracts(bound(spark, root).tables()))


def _in_two_loads(tables: dict) -> DataFrame:
    """Contracts of a second load (the rest of every fact table) on the ledger that the first one left."""
    facts = {"content_unit": "unit_id", "rel_content_tone": "unit_id", "rel_content_context": "unit_id", "vector_index": "vector_id",
             "correction_feedback_log": "log_id", "lemma": "lemma_id", "morpho_form": "lemma_id"}
    first, second = ({t: df if t not in facts else df.where((F.pmod(F.col(facts[t]), F.lit(7)) < 3) == early) for t, df in tables.items()}
                     for early in (True, False))
    dimensions = [t for t in tables if t not in facts]
    _, ledger = incremental.run_contracts(first, None, None, dimensions)
    return incremental.run_contracts(second, {t: first[t] for t in facts}, ledger, dimensions)[0]


def j21_incremental(spark, root):
    return _in_two_loads(bound(spark, root).tables())


def j21_incremental_faulty(spark, root):
    return _in_two_loads(bound(spark, root).faulty_tables())


def i1_delete_cascade(spark, root):
    t = bound(spark, root).tables()
    doomed = t["content_unit"].where(F.col("cefr_level") == "C1").select("unit_id")
    after = maintain.delete_cascade(t, "content_unit", doomed)
    names = ("content_unit", "rel_content_tone", "rel_content_context", "vector_index", "correction_feedback_log")
    out = None
    for n in names:
        c = after[n].agg(F.count(F.lit(1)).alias("remaining_rows")).select(F.lit(n).alias("table_name"),
                                                                         "remaining_rows")
        out = c if out is None else out.unionByName(c)
    return out


def i2_restrict_violations(spark, root):
    t = bound(spark, root).tables()
    keys = t["language_variant"].where(F.col("variant_name") == "EN").select("variant_id")
    return maintain.restrict_violations(t, "language_variant", keys)


def i4_rekey(spark, root):
    t = bound(spark, root).tables()
    mapping = t["language_variant"].select(F.col("variant_id").alias("old_key"),
                                           (F.col("variant_id") + 100).alias("new_key"))
    return maintain.rekey(t, "language_variant", mapping)["lemma"].select("lemma_id", "text_root", "variant_id")


def i3_delete_set_null(spark, root):
    c = bound(spark, root)
    gone = c.ai_model_registry.where(F.col("model_name") == "Gemma").select("model_id")
    return maintain.delete_set_null(c.vector_index.select("vector_id", "unit_id", "model_id", "vector_status"),
                                    "model_id", gone, "model_id")


def i7_prepare_variants(spark, root):
    lv = bound(spark, root).language_variant
    return maintain.prepare_variants(lv).select("variant_id", "iso_code", "variant_name")


def i9_assign_variant(spark, root):
    c = bound(spark, root)
    docs = c.raw("documents").select("doc_id", F.col("lang").alias("iso_code"))
    assigned = maintain.assign_variant(docs, c.language_variant)
    return assigned.groupBy("variant_id").agg(F.count(F.lit(1)).alias("n_documents"))


def a4_second_load(spark, root):
    """Two loads of the documents, even positions first: what is stored is not repeated, and ids go on."""
    docs = bound(spark, root).docs
    first = build_content(docs.where(F.col("doc_pos") % 2 == 0)).units.select("unit_id", "doc_id", "variant_id", "content_raw", "content_hash")
    first = materialize(first)
    second = build_content(docs.where(F.col("doc_pos") % 2 == 1), existing_units=first).units
    return first.drop("content_hash").unionByName(second.select("unit_id", "doc_id", "variant_id", "content_raw"))


def a9_training_export(spark, root):
    """The export as it is read back from its files."""
    c = bound(spark, root)
    path = flows.stream_folder(spark, "export")
    out = sinks.export_training(c.content_unit, c.language_variant, path)
    return out.select("unit_id", "iso_code", "variant_confidence")


def g9_stored_units(spark, root):
    """Units as they are stored: type, origin, idiom flag and the metadata document."""
    units = build_content(bound(spark, root).docs, import_date="2026-01-01").units
    return units.select("unit_id", "content_type", "source_origin", "is_idiom", "source_metadata_json")


def g20_interference(spark, root):
    """Lemmas as they are stored: the interference document stands at the Italian ones."""
    return lexicon(spark, root).lemmas.select("lemma_id", "variant_id", "interference_json")


def i4_rekey_tables(spark, root):
    """Every table that the re-keying rewrites: rows by table and variant."""
    t = bound(spark, root).tables()
    mapping = t["language_variant"].select(F.col("variant_id").alias("old_key"), (F.col("variant_id") + 100).alias("new_key"))
    after = maintain.rekey(t, "language_variant", mapping)
    out = None
    for name in ("content_unit", "language_variant", "lemma"):
        rows = after[name].groupBy("variant_id").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "variant_id", "n_rows")
        out = rows if out is None else out.unionByName(rows)
    return out


def i5_backfill(spark, root):
    return maintain.backfill(bound(spark, root).lemma, "variant_id", 1).select("lemma_id", "variant_id")


def i6_add_column(spark, root):
    """An absent column is added with its default; a present one stays as it is."""
    lemma = maintain.add_column(bound(spark, root).lemma, "frequency_rank", "int", 7)
    return maintain.add_column(lemma, "variant_id", "int", 5).select("lemma_id", "variant_id", "frequency_rank")


def i8_vector_key(spark, root):
    return maintain.enforce_vector_key(bound(spark, root).faulty_tables()["vector_index"]).select("vector_id", "unit_id", "model_id")


def i10_reclassify(spark, root):
    """Units under the fallback variant (every tenth here) take the result set's variant and confidence."""
    c = bound(spark, root)
    units = c.content_unit.select("unit_id", F.when(F.col("unit_id") % 10 == 0, F.lit(99)).otherwise(F.col("variant_id")).alias("variant_id"), "variant_confidence")
    results = c.raw("labels").select(F.col("doc_id").alias("unit_id"), (F.col("quality") + 1).alias("variant_id"), F.lit(0.5).alias("variant_confidence"))
    return maintain.reclassify(units, results, c.language_variant)


def i11_vector_owner(spark, root):
    """Run twice: the second migration changes nothing."""
    vectors = bound(spark, root).faulty_tables()["vector_index"].select("vector_id", "model_id")
    return maintain.migrate_vector_owner(maintain.migrate_vector_owner(vectors))


def f6_transfer_errors(spark, root):
    return nested.explode_transfer_errors(bound(spark, root).annotated_lemma)


def f7_feats(spark, root):
    return nested.explode_feats(bound(spark, root).annotated_form)


def g11_json_members(spark, root):
    """G10 and G11 on the annotated lemmas: whether there is a severity, and its text."""
    return bound(spark, root).annotated_lemma.select("lemma_id", has_path("interference_json", "severity").alias("has_severity"),
                                                     json_text("interference_json", "severity").alias("severity"))


def d7_unit_tones(spark, root):
    c = bound(spark, root)
    return (c.rel_content_tone.join(c.tone_marker, "tone_id").groupBy("unit_id")
            .agg(agg.ordered_string_agg("tone_name", "tone_id").alias("tones")))


def d10_dedup_links(spark, root):
    return dedup_links(bound(spark, root).faulty_tables()["rel_content_tone"], ("unit_id", "tone_id"))


def b6_units_at_levels(spark, root):
    return bound(spark, root).content_unit.where(F.col("cefr_level").isin("A1", "B2")).select("unit_id", "cefr_level")


def b11_toxic_members(spark, root):
    """Labels whose list of tones holds the toxic one; the list is NULL for every seventh."""
    lab = bound(spark, root).raw("labels")
    tones = F.when(F.col("doc_id") % 7 != 0, F.array((F.col("quality") + 1).cast("int"), (F.col("toxic") * 3).cast("int")))
    return lab.select("doc_id", has_member(tones, 3).alias("is_toxic"))


def k1_ingest_stream(spark, root):
    """The parts arrive in three ranges, a run of the stream after each."""
    folder = flows.stream_folder(spark, "k1")
    for _ in flows.in_arrivals(bound(spark, root).raw("part"), f"{folder}/in", "part", "p_partkey"):
        stream = docs_from(flows.read_stream(spark, f"{folder}/in", "part"))
        flows.run_available(stream, folder, batch_fn=flows.ingest_stream(stream, folder, shuffle_partitions(spark)))
    return spark.read.parquet(f"{folder}/content_unit").select("unit_id", "doc_id", "variant_id", "content_hash")


def k1_stream_dedup(spark, root):
    """Every arrival after the first sends the parts of the one before again: how often each document reached the sink,
    and the units that it holds."""
    folder = flows.stream_folder(spark, "k1d")
    parts = bound(spark, root).raw("part")
    state = flows.state_partitions_for(spark, f"{root.rstrip('/')}/part.parquet")
    for _ in flows.in_arrivals(parts, f"{folder}/in", "part", "p_partkey", again=lambda df, k: df.where(F.col("_arrival") == k - 1)):
        stream = flows.without_repeats(docs_from(flows.read_stream(spark, f"{folder}/in", "part")))
        load = flows.recorded(flows.ingest_stream(stream, folder, shuffle_partitions(spark)), f"{folder}/offered", ("doc_id",))
        flows.run_available(stream, folder, batch_fn=load, state_partitions=state)
    offered = spark.read.schema("doc_id string, epoch int").parquet(f"{folder}/offered").groupBy(F.col("doc_id").alias("_doc")).agg(F.count(F.lit(1)).alias("n_offered"))
    units = spark.read.parquet(f"{folder}/content_unit").select("unit_id", "doc_id", "variant_id", "content_hash")
    return units.join(offered, F.col("doc_id") == F.col("_doc")).drop("_doc")


def k2_feedback_stream(spark, root):
    """The events arrive in three ranges of time, a run of the stream after each.

    Append mode: a day comes out once the watermark has passed its end, so the last open day is not in the result.
    """
    folder = flows.stream_folder(spark, "k2")
    parts = flows.state_partitions_for(spark, f"{root.rstrip('/')}/events.parquet")
    for _ in flows.in_arrivals(bound(spark, root).raw("events"), f"{folder}/in", "events", "ts"):
        log = feedback_log_from(flows.read_stream(spark, f"{folder}/in", "events"))
        flows.run_available(flows.feedback_stream(log), folder, state_partitions=parts)
    return spark.read.parquet(f"{folder}/out")


def k2_feedback_by_cycle(spark, root):
    """Feedback per day, model, training cycle and severity; every fiftieth event of the first range comes with the last
    one and is counted as late where its day was closed by then."""
    folder = flows.stream_folder(spark, "k2c")
    events = bound(spark, root).raw("events")
    parts = flows.state_partitions_for(spark, f"{root.rstrip('/')}/events.parquet")
    number = flows.arrival_number(events, "ts", 3)
    held = (number == 0) & (F.col("event_id") % 50 == 0)
    for k in range(3):
        here = events.where((number == k) & ~held)
        (here.unionByName(events.where(held)) if k == 2 else here).write.mode("append").parquet(f"{folder}/in/events.parquet")
        log = feedback_log_from(flows.read_stream(spark, f"{folder}/in", "events"))
        flows.run_available(flows.feedback_stream(log, by=flows.CYCLE), folder, state_partitions=parts)
    schema = "window_start timestamp_ntz, model_id long, training_cycle int, error_severity string, n_feedback long"
    return flows.late_feedback(feedback_log_from(spark.read.parquet(f"{folder}/in/events.parquet")), spark.read.schema(schema).parquet(f"{folder}/out"))


def k3_pending_vectors_stream(spark, root):
    """The documents arrive in three ranges, a run of the stream after each."""
    c = bound(spark, root)
    folder = flows.stream_folder(spark, "k3")
    for _ in flows.in_arrivals(c.raw("documents"), f"{folder}/in", "documents", "doc_id"):
        units = c.content_unit_from(flows.read_stream(spark, f"{folder}/in", "documents"))
        flows.run_available(units, folder, batch_fn=flows.pending_vectors(lambda: c.vector_index, f"{folder}/out"))
    return spark.read.parquet(f"{folder}/out").drop("epoch")


def k3_unindexed_stream(spark, root):
    """Documents and vectors arrive as two streams, three ranges each: the units without a vector five minutes after they
    were made.  A document is made at a minute of its own, its vector comes as many minutes later as its label says."""
    c = bound(spark, root)
    folder = flows.stream_folder(spark, "k3u")
    parts = flows.state_partitions_for(spark, f"{root.rstrip('/')}/documents.parquet")
    at = lambda minutes: F.timestamp_seconds(F.lit(1_700_000_000) + minutes * 60)
    arrivals = zip(flows.in_arrivals(c.raw("documents"), f"{folder}/in", "documents", "doc_id"),
                   flows.in_arrivals(c.raw("embeddings"), f"{folder}/in", "embeddings", "vec_id"))
    for _ in arrivals:
        units = flows.read_stream(spark, f"{folder}/in", "documents").select(
            F.col("doc_id").alias("unit_id"), F.col("text").alias("content_raw"), at(F.col("doc_id")).alias("created_at"))
        vectors = flows.read_stream(spark, f"{folder}/in", "embeddings").select(
            F.col("vec_id").alias("unit_id"), at(F.col("vec_id") + F.col("label")).alias("indexed_at"))
        flows.run_available(flows.unindexed_units(units, vectors, "5 minutes", "30 minutes"), folder, state_partitions=parts)
    return spark.read.schema("unit_id long, content_raw string").parquet(f"{folder}/out")


def a6_syntax_scan(spark, root):
    """The syntax consumer: its two columns of the syntax documents (the unit's id and part as content), and the
    dependencies that it reads from them."""
    units = bound(spark, root).syntax_documents.withColumn("content_raw", F.concat_ws("/", "unit_id", "chunk"))
    return nested.explode_dependencies(nested.scan_syntax(units), id_col="content_raw").select("content_raw", "id", "rel", "head")


def a7_load_report(spark, root):
    """Two loads into two stored tables, the second load of all rows, and a plain append of the feedback: what each write
    job counted as written and skipped."""
    c = bound(spark, root)
    units = c.content_unit.select("unit_id", "content_raw", content_hash("content_raw", F.coalesce("variant_id", F.lit(0))).alias("content_hash"))
    links = c.faulty_tables()["rel_content_tone"].select("unit_id", "tone_id")
    targets = {"content_unit": (units, ["content_hash"], "unit_id"), "rel_content_tone": (links, ["unit_id", "tone_id"], None)}
    folder, counts = scratch_folder(spark, "loads"), []
    for target, (rows, keys, order) in targets.items():
        for load, batch in enumerate((rows.where("unit_id % 3 = 0"), rows), 1):
            counts += [(target, load, kind, n) for kind, n in sinks.append_if_absent(f"{folder}/{target}", batch, keys, order).items()]
    log = c.correction_feedback_log
    for load in (1, 2):
        counts += [("correction_feedback_log", load, kind, n) for kind, n in sinks.append(f"{folder}/correction_feedback_log", log).items()]
    return spark.createDataFrame(counts, "target string, load int, kind string, rows long")


def g10_member_states(spark, root):
    """Members of the events' properties and of a document around them, parsed once: text and state of each; every
    eleventh text is cut off and is no document."""
    props = F.col("props")
    text = (F.when(F.col("event_id") % 11 == 0, F.concat(F.lit('{"props": '), props))
             .when(F.col("event_id") % 3 == 0, F.concat(F.lit('{"user": null, "props": '), props, F.lit("}")))
             .otherwise(F.concat(F.lit('{"user": '), F.col("user_id").cast("string"), F.lit(', "props": '), props, F.lit("}"))))
    doc = bound(spark, root).raw("events").select("event_id", parsed(text).alias("doc"))
    return doc.select("event_id", F.col("doc").isNull().alias("malformed"), variant_text("doc", "props.k").alias("k"),
                      variant_text("doc", "user").alias("user_text"), member_state("doc", "user").alias("user_state"),
                      member_state("doc", "session").alias("session_state"))


def _words(spark, root) -> DataFrame:
    return bound(spark, root).raw("documents").select(F.explode(F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))).alias("word"))


def e3_collated_words(spark, root):
    """Every different word of the documents, numbered in the order of the Unicode collation."""
    return enumerate_values(_words(spark, root), "word", "word_id", collation="UNICODE")[0]


def e2_collated_roots(spark, root):
    """D4 on the words of the documents as roots, by language; roots and names in the order of the Unicode collation
    (the place of each root among all is returned, as an order can't be compared)."""
    c = bound(spark, root)
    docs = c.raw("documents").join(c.language_variant, F.col("lang") == F.col("iso_code"))
    names = c.language_variant.select("variant_id", F.when(F.col("is_pivot"), F.lower("variant_name")).otherwise(F.col("variant_name")).alias("variant_name"))
    words = docs.select("variant_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))).alias("text_root"))
    roots = materialize(agg.shared_roots(words.distinct(), names, collation="UNICODE"))
    place = enumerate_values(roots, "text_root", "place", collation="UNICODE")[0]
    return roots.join(place, "text_root").select("place", "text_root", "shared_by")


def g13_value_map(spark, root):
    """Event types under other names, where the map has one; all others (NULL too) stay."""
    names = {"view": "read", "click": "act"}
    return bound(spark, root).raw("events").select("event_id", map_or_keep("event_type", names).alias("kind"))


def g14_nested_fields(spark, root):
    """A field two levels down in each event's document; NULL where the document is, or either level is null or missing."""
    props, key = F.col("props"), F.col("event_id")
    text = (F.when(key % 7 == 0, F.lit(None)).when(key % 7 == 1, F.lit("{}")).when(key % 7 == 2, F.lit('{"props": null}'))
             .when(key % 7 == 3, F.lit('{"props": {"other": 1}}')).otherwise(F.concat(F.lit('{"props": '), props, F.lit("}"))))
    doc = bound(spark, root).raw("events").select("event_id", F.from_json(text, "props struct<k: int>").alias("doc"))
    return doc.select("event_id", F.col("doc.props.k").alias("k"))


def h1_bucketed_context(spark, root):
    """The context view over tables stored in buckets of unit_id."""
    folder = scratch_folder(spark, "bucketed")
    prefix = "b" + folder.rsplit("-", 1)[1]
    stored = layout.write_bucketed(bound(spark, root).tables(), folder, prefix, shuffle_partitions(spark))
    view = materialize(context.full_context(stored).select("unit_id", "iso_code", "variant_name", "tone_name", "theme"))
    layout.drop_bucketed(spark, prefix)
    return view


def _vector_store(spark, root) -> tuple[DataFrame, str]:
    v = bound(spark, root).vector_index
    path = scratch_folder(spark, "vectors")
    vector_store.write_store(v, path)
    return v, path


def l1_stored_scope(spark, root):
    """The vectors of one model, from a store partitioned by model."""
    v, path = _vector_store(spark, root)
    return retrieval.model_scope(vector_store.read_store(spark, path, v.schema), 2).select("vector_id", "unit_id", "vector_status")


def l2_clustered_top5(spark, root):
    """The five best vectors of model 1 for the mean of each model, from a clustered store."""
    v, path = _vector_store(spark, root)
    hits, _ = vector_store.similar_in_store(retrieval.centroid_queries(v, "model_id"), path, v.schema, 5, 1)
    return hits.select("query_id", "rank", "vector_id", "unit_id")


def l2_similar_top5(spark, root):
    v = bound(spark, root).vector_index
    queries = retrieval.centroid_queries(v, "model_id")
    hits = retrieval.similar(queries, v, 5, model_id=1)
    return hits.select("query_id", "rank", "vector_id", "unit_id")


def l3_context_for_hits(spark, root):
    c = bound(spark, root)
    hits = l2_similar_top5(spark, root)
    return retrieval.context_for(hits.select("query_id", "rank", "unit_id"), context.full_context(c.tables())).select(
        "query_id", "rank", "unit_id", "variant_name", "tone_name", "theme")


QUERIES: dict[str, Query] = {
    "d1_count_by_level": d1_count_by_level,
    "b1_audit_language_level": b1_audit_language_level,
    "c2_theme_coverage": c2_theme_coverage,
    "c5_units_without_vector": c5_units_without_vector,
    "c3_morpho_density": c3_morpho_density,
    "d4_shared_roots": d4_shared_roots,
    "a2_drop_placeholders": a2_drop_placeholders,
    "f1_unpivot_langs": f1_unpivot_langs,
    "e5_dedup_by_hash": e5_dedup_by_hash,
    "e4_assign_ids": e4_assign_ids,
    "e6_dedup_by_fold": e6_dedup_by_fold,
    "f3_synonym_forms": f3_synonym_forms,
    "f4_media_rows": f4_media_rows,
    "f9_tone_links": f9_tone_links,
    "f9_theme_links": f9_theme_links,
    "e3_enumerate_registers": e3_enumerate_registers,
    "d13_skip_counts": d13_skip_counts,
    "c13_pivot_pairs": c13_pivot_pairs,
    "h1_full_context": h1_full_context,
    "h3_student_context": h3_student_context,
    "b7_eligible_export": b7_eligible_export,
    "c11_with_parent": c11_with_parent,
    "c12_variant_roots": c12_variant_roots,
    "d11_feedback_by_cycle": d11_feedback_by_cycle,
    "d11_feedback_by_source": d11_feedback_by_source,
    "d12_vector_progress": d12_vector_progress,
    "c14_feedback_orphans": c14_feedback_orphans,
    "c6_not_in_null_right": c6_not_in_null_right,
    "c6_not_in_null_left": c6_not_in_null_left,
    "f5_explode_dependencies": f5_explode_dependencies,
    "g8_normalize_iso": g8_normalize_iso,
    "j2_foreign_keys": j2_foreign_keys,
    "j10_hash_unique": j10_hash_unique,
    "j11_bridge_keys": j11_bridge_keys,
    "j13_profile_tables": j13_profile_tables,
    "j14_check_confidence": j14_check_confidence,
    "j16_vector_owner": j16_vector_owner,
    "j17_vector_pair": j17_vector_pair,
    "j18_iso_normal": j18_iso_normal,
    "j19_fallback_variant": j19_fallback_variant,
    "j20_model_restrict": j20_model_restrict,
    "j21_contract_gate": j21_contract_gate,
    "j21_gate_faulty": j21_gate_faulty,
    "j_contracts": j_contracts,
    "j_contracts_faulty": j_contracts_faulty,
    "j21_incremental": j21_incremental,
    "j21_incremental_faulty": j21_incremental_faulty,
    "i1_delete_cascade": i1_delete_cascade,
    "i2_restrict_violations": i2_restrict_violations,
    "i4_rekey": i4_rekey,
    "i3_delete_set_null": i3_delete_set_null,
    "i7_prepare_variants": i7_prepare_variants,
    "i9_assign_variant": i9_assign_variant,
    "a4_second_load": a4_second_load,
    "a9_training_export": a9_training_export,
    "g9_stored_units": g9_stored_units,
    "g20_interference": g20_interference,
    "i4_rekey_tables": i4_rekey_tables,
    "i5_backfill": i5_backfill,
    "i6_add_column": i6_add_column,
    "i8_vector_key": i8_vector_key,
    "i10_reclassify": i10_reclassify,
    "i11_vector_owner": i11_vector_owner,
    "f6_transfer_errors": f6_transfer_errors,
    "f7_feats": f7_feats,
    "g11_json_members": g11_json_members,
    "d7_unit_tones": d7_unit_tones,
    "d10_dedup_links": d10_dedup_links,
    "b6_units_at_levels": b6_units_at_levels,
    "b11_toxic_members": b11_toxic_members,
    "k1_ingest_stream": k1_ingest_stream,
    "k2_feedback_stream": k2_feedback_stream,
    "k1_stream_dedup": k1_stream_dedup,
    "k2_feedback_by_cycle": k2_feedback_by_cycle,
    "k3_unindexed_stream": k3_unindexed_stream,
    "k3_pending_vectors_stream": k3_pending_vectors_stream,
    "a6_syntax_scan": a6_syntax_scan,
    "a7_load_report": a7_load_report,
    "g10_member_states": g10_member_states,
    "e3_collated_words": e3_collated_words,
    "e2_collated_roots": e2_collated_roots,
    "g13_value_map": g13_value_map,
    "g14_nested_fields": g14_nested_fields,
    "h1_bucketed_context": h1_bucketed_context,
    "l1_stored_scope": l1_stored_scope,
    "l2_clustered_top5": l2_clustered_top5,
    "l2_similar_top5": l2_similar_top5,
    "l3_context_for_hits": l3_context_for_hits,
}
