"""Aggregations.

Where a bridge or fact table is joined to a small dimension and then
counted, the fact side is aggregated by id first (partial aggregation
collapses hot keys map-side) and only the aggregated rows meet the
dimension; Catalyst does not push aggregates below joins on its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.functions.scalars import in_order, present


def count_by_level(units: DataFrame, level: str = "cefr_level") -> DataFrame:
    """D1 (+E1): units per level, largest first; NULL level is its own group."""
    return (units.groupBy(level).agg(F.count(F.lit(1)).alias("total_units"))
                 .orderBy(F.desc("total_units"), F.col(level).asc_nulls_first()))


def theme_coverage(tags: DataFrame, links: DataFrame) -> DataFrame:
    """C2 + D2: linked units per context name (names are not unique, so re-aggregate by name)."""
    per_id = links.groupBy("context_id").agg(F.count("unit_id").alias("n"))
    return (per_id.join(tags.select("context_id", "context_name"), "context_id")
                  .groupBy("context_name").agg(F.sum("n").cast("long").alias("unit_count"))
                  .orderBy(F.desc("unit_count"), "context_name"))


def morpho_density(variants: DataFrame, lemmas: DataFrame, forms: DataFrame) -> DataFrame:
    """Forms per variant name; ``total_morpho_forms`` counts non-NULL form ids, ``total_rows`` all rows.

    Forms are pre-aggregated per lemma (a hot lemma collapses map-side), so
    the joins only see one row per lemma.
    """
    per_lemma = forms.groupBy("lemma_id").agg(F.count("form_id").alias("n_ids"),
                                              F.count(F.lit(1)).alias("n_rows"))
    lemma_variant = lemmas.select("lemma_id", "variant_id").join(
        variants.select("variant_id", "variant_name"), "variant_id")
    return (lemma_variant.join(per_lemma, "lemma_id")
                         .groupBy("variant_name")
                         .agg(F.sum("n_ids").cast("long").alias("total_morpho_forms"),
                              F.sum("n_rows").cast("long").alias("total_rows"))
                         .orderBy(F.desc("total_morpho_forms"), "variant_name"))


def shared_roots(lemmas: DataFrame, variants: DataFrame, sep: str = " | ", collation: str | None = None) -> DataFrame:
    """D4 (+D5, D6, C7): roots present in more than one variant, with the variant names joined.

    One pass instead of IN-subquery + join.  Lemmas are first counted per
    (root, variant id) so that the per-root collection holds one entry per
    variant, not one per lemma row; names repeat by their count when the
    string is built (the reference's string_agg has no DISTINCT).  The
    distinct-variant test counts every non-NULL variant id, including ids
    missing from the dimension, exactly like the subquery; names come only
    from ids the dimension knows, like the outer join.  Names and roots are
    sorted, in binary order or that of ``collation``; roots that are equal
    under it stay apart.
    """
    per_variant = (lemmas.where(F.col("variant_id").isNotNull())
                         .groupBy("text_root", "variant_id").agg(F.count(F.lit(1)).alias("n")))
    named = per_variant.join(variants.select("variant_id", "variant_name"), "variant_id", "left")
    rank = F.struct(in_order("variant_name", collation).alias("rank"), "variant_name", "n")
    entry = F.when(F.col("variant_name").isNotNull(), rank)
    grouped = named.groupBy("text_root").agg(F.count(F.lit(1)).alias("n_variants"),
                                             F.collect_list(entry).alias("names"))
    names = F.array_sort(F.col("names"))
    repeated = F.transform(names, lambda e: F.concat(F.repeat(F.concat(e["variant_name"], F.lit(sep)), (e["n"] - 1).cast("int")),
                                                     e["variant_name"]))
    return (grouped.where((F.col("n_variants") > 1) & (F.size("names") > 0))
                   .select("text_root", F.array_join(repeated, sep).alias("shared_by"))
                   .orderBy(in_order("text_root", collation), "text_root"))


def ordered_string_agg(value, order, sep: str = ", "):
    """``STRING_AGG(value, sep ORDER BY order)`` as an aggregate Column (NULL values skipped).

    Meant for small groups (key columns of a table, tags of one unit): the
    group's values are collected before they are joined.
    """
    v = F.col(value) if isinstance(value, str) else value
    o = F.col(order) if isinstance(order, str) else order
    items = F.array_sort(F.collect_list(F.when(v.isNotNull(), F.struct(o.alias("o"), v.alias("v")))))
    return F.array_join(F.transform(items, lambda e: e["v"]), sep)


def feedback_by_cycle(log: DataFrame, with_source: bool = False) -> DataFrame:
    """Feedback rows per model, training cycle and severity (and source)."""
    keys = ["model_id", "training_cycle", "error_severity"] + (["feedback_source"] if with_source else [])
    return log.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_feedback"))


def vector_progress(vectors: DataFrame) -> DataFrame:
    """Vectors per model and status."""
    return vectors.groupBy("model_id", "vector_status").agg(F.count(F.lit(1)).alias("n_vectors"))


def skip_counts(langs: DataFrame, text: str = "content_raw", hash_col: str = "content_hash",
                n_langs: int = 3) -> DataFrame:
    """One row of load accounting over the unpivoted input.

    ``missing`` are NULL/empty texts, ``duplicates`` repeated hashes among the
    rest, ``kept`` the surviving rows; ``reference_skipped`` is the loader's
    own figure (documents x 3 - kept), which counts missing texts as
    duplicates.  The unpivot emits exactly one row per (document, language),
    so documents = candidates / ``n_langs`` without a distinct over ids; the
    only shuffle is the distinct over the hashes.
    """
    ok = present(text)
    return langs.agg(
        (F.count(F.lit(1)) / F.lit(n_langs)).cast("long").alias("documents"),
        F.count(F.lit(1)).alias("candidates"),
        F.count_if(~ok).alias("missing"),
        (F.count_if(ok) - F.count_distinct(F.when(ok, F.col(hash_col)))).alias("duplicates"),
        F.count_distinct(F.when(ok, F.col(hash_col))).alias("kept"),
    ).withColumn("reference_skipped", F.col("documents") * 3 - F.col("kept"))
