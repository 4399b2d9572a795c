"""Benchmark decontamination by spaced seeds.

Fixed masks slide over the words of a benchmark item and of a document; a mask compares some positions of its window
and ignores the others, so a passage with substituted words still meets its item in a window whose substitutions fall
on ignored positions.  Around each hit the whole diagonal is compared, and an overlap counts if any run of it is long
and alike enough; the longest such run is reported.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import Words, mix64, release, slices, stage, text_array

# 1 compares a position, 0 ignores it.  Six words are compared, substitutions between them are not seen.
MASKS = ("11011011", "1110111", "11110011", "110101101")
# For items of up to SHORT_ITEM words, whose few windows the masks above may all miss.  Wherever the
# substitutions that the rule allows fall in such an item, one of these masks sees none of them.
SHORT_MASKS = ("1111", "11101", "10111", "11011", "111001")
SHORT_ITEM = 15
#: An overlap runs over so many words at least (or the whole item), of which this share is equal.
MIN_WORDS = 13
MIN_SAME = 0.75
#: Items of fewer words are no passages: they never contaminate.
MIN_ITEM = 5
#: Benchmark words that go out to the tasks at once; more come in further blocks.
BLOCK_WORDS = 200_000
OVERLAP = pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("words", pa.int64()), ("same", pa.int64())])


def bare(word: bytes) -> bytes:
    """A word without what isn't a letter or digit at its ends; all of it if nothing else is left."""
    text = word.decode()
    a, b = 0, len(text)
    while a < b and not text[a].isalnum():
        a += 1
    while b > a and not text[b - 1].isalnum():
        b -= 1
    return text[a:b].encode() or word


def compared(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds) of the words as they are compared: lower case, bare."""
    words = Words(texts, lower=True)
    of = np.fromiter((xxhash.xxh64_intdigest(bare(w)) for w in words.vocab), np.uint64, len(words.vocab))
    return (of[words.codes] if len(of) else np.zeros(0, np.uint64)), words.bounds


def spaced(words: np.ndarray, mask: str) -> np.ndarray:
    """The hash of the compared positions of every window."""
    n = len(words) - len(mask) + 1
    h = np.full(max(n, 0), xxhash.xxh64_intdigest(mask), np.uint64)
    for j, c in enumerate(mask):
        if c == "1" and n > 0:
            h = h * np.uint64(0x9E3779B97F4A7C15) + words[j:j + n]
    return mix64(h)


class Seeds:
    """A block of benchmark items, known by their row: their words, ids (null too), and where each spaced hash occurs in them."""

    def __init__(self, items: Sequence[tuple[int | None, str]]):
        self.words, self.bounds = compared(pa.array([t or "" for _, t in items], pa.large_string()))
        self.ids = [i for i, _ in items]
        sizes = np.diff(self.bounds)
        short = bool(((sizes >= MIN_ITEM) & (sizes <= SHORT_ITEM)).any())
        self.masks = [*MASKS, *(SHORT_MASKS if short else ())]
        keys, items_, places = [], [], []
        for mask in self.masks:
            for k in np.flatnonzero(sizes >= max(MIN_ITEM, len(mask))).tolist():
                if mask in MASKS or sizes[k] <= SHORT_ITEM:
                    h = spaced(self.words[self.bounds[k]:self.bounds[k + 1]], mask)
                    keys.append(h), items_.append(np.full(len(h), k)), places.append(np.arange(len(h)))
        join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        keys = join(keys, np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.items, self.places = keys[order], join(items_, np.int64)[order], join(places, np.int64)[order]
        self.sieve = np.zeros(1 << 22, bool)
        self.sieve[keys >> np.uint64(42)] = True

    def hits(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, where the item would begin) of every equal spaced hash."""
        items, begins = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for mask in self.masks:
            h = spaced(words, mask)
            at = np.flatnonzero(self.sieve[h >> np.uint64(42)])
            lo, hi = np.searchsorted(self.keys, h[at], "left"), np.searchsorted(self.keys, h[at], "right")
            n = hi - lo
            k = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            items.append(self.items[k]), begins.append(np.repeat(at, n) - self.places[k])
        return np.concatenate(items), np.concatenate(begins)

    def overlap(self, words: np.ndarray, item: int, begin: int) -> tuple[int, int, int] | None:
        """(start, words, same) of the longest run on a diagonal of which MIN_SAME is equal; None if it is too short."""
        own = self.words[self.bounds[item]:self.bounds[item + 1]]
        a, b = max(0, -begin), min(len(own), len(words) - begin)
        equal = np.concatenate([[0], np.cumsum(own[a:b] == words[begin + a:begin + b])])
        # a run from i to j is alike enough if gain[i] <= gain[j]; the first such i is where the running minimum gets there
        gain = equal - MIN_SAME * np.arange(len(equal))
        first = np.searchsorted(-np.minimum.accumulate(gain), -gain, "left")
        end = int(np.argmax(np.arange(len(gain)) - first))
        start = int(first[end])
        n = end - start
        return (begin + a + start, n, int(equal[end] - equal[start])) if n >= min(MIN_WORDS, len(own)) else None


def _finder(seeds: Seeds, column: str):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words, bounds = compared(text_array(batch, "text"))
            items, begins = seeds.hits(words)
            found: dict[int, dict] = {}
            # a hit is a diagonal of one text; windows that run over two texts are compared with each, and fail there
            for item, begin in np.unique(np.column_stack([items, begins]), axis=0).tolist():
                size = int(seeds.bounds[item + 1] - seeds.bounds[item])
                for doc in range(max(0, int(np.searchsorted(bounds, begin, "right")) - 1), min(len(bounds) - 1, int(np.searchsorted(bounds, begin + size, "left")))):
                    a, b = int(bounds[doc]), int(bounds[doc + 1])
                    if a < b and begin < b and begin + size > a and (best := seeds.overlap(words[a:b], item, begin - a)):
                        runs = found.setdefault(doc, {})
                        runs[item, best[0]] = max(best, runs.get((item, best[0]), best))
            old = batch.column(column).to_pylist() if found else None
            rows = batch.column(column)
            if found:
                for doc, runs in found.items():
                    old[doc] = (old[doc] or []) + [{"item_id": seeds.ids[i], "start": s, "words": n, "same": e} for (i, s), (_, n, e) in sorted(runs.items())]
                rows = pa.array(old, pa.list_(OVERLAP))
            yield batch.set_column(batch.schema.get_field_index(column), column, rows)
    return find


def blocks(benchmark: DataFrame) -> list[DataFrame]:
    """The benchmark's different items in frames of about BLOCK_WORDS words each; nothing is collected yet."""
    items = benchmark.where("text is not null").select(F.col("item_id").cast("long"), "text").distinct()
    total = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    n = -(-total // BLOCK_WORDS)
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) for k in range(n)]


def seeds_of(block: DataFrame) -> Seeds:
    """The seeds of a block's items."""
    return Seeds([(r["item_id"], r["text"]) for r in block.orderBy("item_id", "text").collect()])


def overlaps(docs: DataFrame, benchmark: DataFrame, column: str = "overlaps") -> DataFrame:
    """``docs`` with one more column: (item_id, start, words, same) of each overlap with a benchmark item; [] if none.

    Every word of every text is looked at.  The benchmark goes out in blocks of about BLOCK_WORDS words, however large
    it is, without a shuffle of the documents.  Before a further block is collected, the documents that passed the one
    before are staged with their overlaps, so driver, plan and tasks hold one block at a time, and two copies of the
    documents at most are on disk; a benchmark of one block is one scan and stages nothing.  A null text or one without
    words has no overlaps, an item with a null text none with any; an item with a null item_id is judged like others, its
    overlaps have a null item_id.  Repeated documents are judged each, items equal in id and text are one; empty tables
    give an empty result or no overlaps.  Other columns pass through; ``column`` must not be one of them.
    """
    out = docs.withColumn(column, F.array().cast("array<struct<item_id:bigint,start:bigint,words:bigint,same:bigint>>"))
    schema = out.schema
    passed = None  # the staged rows that ``out`` reads
    for k, block in enumerate(blocks(benchmark)):
        if k:
            done = stage(out, "overlaps")
            if passed is not None:
                release(passed)
            out = passed = done
        out = out.mapInArrow(_finder(seeds_of(block), column), schema)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, n_overlaps, longest, item_ids for every row of ``docs``."""
    found = overlaps(docs.select("doc_id", "text"), benchmark)
    return found.select("doc_id", (F.size("overlaps") > 0).alias("contaminated"), F.size("overlaps").cast("long").alias("n_overlaps"),
                        F.coalesce(F.array_max("overlaps.words"), F.lit(0)).cast("long").alias("longest"),
                        F.array_sort(F.array_distinct("overlaps.item_id")).alias("item_ids"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that overlap with no benchmark item, with their columns."""
    column = "overlaps"
    while column in docs.columns:
        column = f"_{column}"
    return overlaps(docs, benchmark, column).where(F.size(column) == 0).drop(column)
