"""Mixing sources to target weights by weighted fair queueing.

Every source is a flow whose documents, in a shuffled order, are served one after the other, pass after pass.  A
document finishes at the virtual time (words of its source up to its end) / (target of the source).  One queue holds all
flows, range-sorted by finish, and ends where its running sum of words reaches the total budget.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import WORD, prefix_sums, stage

SEED = 17


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size: the words of each whole text (null: 0)."""
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def source_targets(sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), budget: float = 1.5, cap: float = 2.0) -> DataFrame:
    """source, source_size, target: ``budget`` times all sizes shared by weight, none above ``cap`` times its size.

    Sources by code point, null last, take the weights in turn.  What a capped source can't take is shared again by
    weight, until none is above: the level at which sum(min(cap, level * weight)) is the budget, found by prefix sums
    over the table of sources; the driver gets four numbers.
    """
    spark = sizes.sparkSession
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.lit(1).cast("long").alias("one"))
    # code points in UTF-8 order; the rank is a prefix count, so the table of sources needs no single task either
    ranked, _ = prefix_sums(per, [F.col("source").asc_nulls_last()], "one", "rank", tag="sources")
    table = stage(ranked.select("source", "source_size", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")).alias("weight"), (F.col("source_size") * F.lit(float(cap))).alias("most")), "sources")
    # the level in one pass: by rising most/weight, it is the first row's (total - what all before take at most) / (weights
    # from here on) that no longer exceeds the row's own most/weight; sizes and weights are whole, so the sums are exact
    total, weight = table.agg(F.coalesce(F.sum("source_size"), F.lit(0)) * F.lit(float(budget)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    ratio = F.col("most") / F.col("weight")
    rising = [ratio, F.col("source").asc_nulls_last()]
    first, _ = prefix_sums(table, rising, "most", "most_before", tag="levels")
    both, _ = prefix_sums(first, rising, "weight", "weight_before", tag="levels")
    here = (F.lit(float(total)) - F.col("most_before")) / (F.lit(float(weight)) - F.col("weight_before"))
    found, highest = both.select(ratio.alias("r"), here.alias("level")).agg(F.min_by("level", F.when(F.col("level") <= F.col("r"), F.col("r"))), F.max("r")).first()
    level = found if found is not None else (highest or 0.0)  # none: all sources are capped
    return table.select("source", "source_size", F.least("most", F.col("weight") * F.lit(level)).alias("target"))


def fair_schedule(sizes: DataFrame, targets: DataFrame, cap: int = 2, seed: int = SEED) -> DataFrame:
    """The mix: doc_id, source, size, source_size, target, pass, finish, position, taken for each part of a serving in it.

    ``finish`` is the virtual time at which a part ends.  All parts of all flows are range-sorted by it into one queue,
    ``position`` is the number of words before a part, and the queue is truncated at the total budget (the sum of the
    targets, whole words): a part gives the words that lie before the cut.  So that one long document can't carry its
    source far past the target or leave it far behind, the serving under way at virtual time one is queued in parts: the
    words finished by then, the word under way, and the rest; each source ends within a word of its target.  The order of
    a pass depends on doc_id and seed alone, so reruns agree; equal rows are interchangeable.  Documents without words
    are never served.  A source is never gathered: the sums are prefix sums over range partitions, so one holding most
    rows spreads like any other.
    """
    passes = sizes.where("size > 0").select("*", F.explode(F.array(*[F.lit(p) for p in range(cap)])).alias("pass"))
    order = [F.col("source").asc_nulls_last(), F.col("pass"), F.xxhash64(F.lit(seed), "pass", "doc_id", "size"), F.col("doc_id"), F.col("size")]
    served, _ = prefix_sums(passes, order, "size", "before", group="source", tag="passes")
    t = targets.select(F.col("source").alias("_source"), "source_size", "target")
    flows = served.join(t, served["source"].eqNullSafe(t["_source"])).drop("_source")
    due = (F.floor("target") - F.col("before")).cast("long")

    def inside(words):
        return F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), words))

    ends = F.array_distinct(F.array(F.lit(0).cast("long"), inside(due), inside(due + 1), F.col("size")))
    parts = (flows.withColumn("ends", ends).withColumn("i", F.explode(F.sequence(F.lit(1), F.size("ends") - 1)))
             .withColumn("start", F.col("ends")[F.col("i") - 1]).withColumn("words", F.col("ends")[F.col("i")] - F.col("start"))
             .withColumn("finish", (F.col("before") + F.col("start") + F.col("words")) / F.col("target")).drop("ends", "i"))
    queue = [F.col("finish"), F.col("source").asc_nulls_last(), F.col("pass"), F.col("doc_id"), F.col("size"), F.col("start")]
    queued, _ = prefix_sums(parts, queue, "words", "position", tag="mix")
    budget = int(targets.agg(F.coalesce(F.floor(F.round(F.sum("target"), 6)), F.lit(0))).first()[0])
    taken = F.least(F.col("words"), F.lit(budget).cast("long") - F.col("position")).cast("long")
    return queued.withColumn("taken", taken).where("taken > 0").drop("before", "one", "start", "words")


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), budget: float = 1.5, cap: int = 2, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken, source, position for every row of ``docs``: what the fair queue takes of it.

    ``position`` is the place in the mix of the first word that it gives (words before it; null if it gives none).

    A null text has size 0; a null source is a source of its own, the last; an empty table gives an empty result.  A
    row that repeats a doc_id, or has none, is a document like any other: rows alike in doc_id, source and size share
    their servings evenly.  Columns other than doc_id, source and text are ignored.
    """
    sizes = stage(document_sizes(docs), "sizes")
    targets = stage(source_targets(sizes, weights, budget, cap), "targets")
    taken = fair_schedule(sizes, targets, cap, seed).groupBy("doc_id", "source", "size").agg(F.sum("taken").alias("t"), F.min("position").alias("position"))
    same = [F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("size").alias("_z")]
    rows = sizes.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n"))
    t = taken.select(*same, "t", "position")
    one = rows.join(t, rows["doc_id"].eqNullSafe(t["_d"]) & rows["source"].eqNullSafe(t["_s"]) & rows["size"].eqNullSafe(t["_z"]), "left")
    s = targets.select(F.col("source").alias("_src"), "source_size", "target")
    full = one.join(s, one["source"].eqNullSafe(s["_src"]))
    share = F.coalesce(F.col("t"), F.lit(0))
    # copy i of n gets an even part of what they take together
    copies = full.select("doc_id", "source", "size", "source_size", "target", share.alias("t"), "position", "n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("i"))
    part = (F.floor(F.col("t") * F.col("i") / F.col("n")) - F.floor(F.col("t") * (F.col("i") - 1) / F.col("n"))).cast("long")
    return copies.select("doc_id", "size", "source_size", "target", part.alias("taken"), "source", F.when(part > 0, F.col("position")).alias("position"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text up to the end of its word number ``words``."""
    for batch in batches:
        texts = []
        for text, n in zip(batch.column("text").to_pylist(), batch.column("words").to_pylist()):
            raw = text.encode()
            rest = raw.split(None, n)[n:]
            texts.append((raw[:len(raw) - len(rest[0])] if rest else raw).rstrip(b" \t\n\x0b\x0c\r").decode())
        yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))


def mixed_documents(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), budget: float = 1.5, cap: int = 2, seed: int = SEED) -> DataFrame:
    """``docs`` as the mix serves them, with their columns: a row for each whole serving of a document, and a row with
    the first words of one that the mix cuts (its n_chars, if there is such a column, follows).

    Documents that the mix doesn't reach are left out; rows alike in doc_id, source and words get the same servings.
    """
    key = ["doc_id", "source", "size"]
    share = mix(docs, weights, budget, cap, seed).groupBy(*key).agg(F.min("taken").alias("taken")).where("taken > 0")
    share = share.select(*[F.col(k).alias(f"{k}_of") for k in key], "taken")
    # the rows travel as one column, so no column of theirs can be mistaken for one of these
    sized = docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), F.struct("*").alias("row"))
    met = sized.join(share, F.col("doc_id").eqNullSafe(F.col("doc_id_of")) & F.col("source").eqNullSafe(F.col("source_of")) & (F.col("size") == F.col("size_of")))
    times = F.floor(F.col("taken") / F.col("size")).cast("long")
    whole = met.where(times > 0).select("row", F.explode(F.sequence(F.lit(1).cast("long"), times)).alias("copy")).select("row.*")
    part = met.select("row", F.col("row.text").alias("text"), (F.col("taken") % F.col("size")).alias("words")).where("words > 0")
    cut = part.mapInArrow(_cut, part.schema).select(F.col("row").withField("text", F.col("text")).alias("row")).select("row.*")
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return whole.unionByName(cut)
