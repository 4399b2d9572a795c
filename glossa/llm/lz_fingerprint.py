"""Document fingerprints: the phrases of a Lempel-Ziv parse, compared through minimum-hash signatures.

A text is parsed from left to right into the shortest phrases not met before (LZ78 over code points); texts that share
passages share phrases.  The fingerprint keeps one byte of the least hash for each of HASHES hash functions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glossa.llm.common import mix64, stage

HASHES = 128
SEED = 23
_rng = np.random.default_rng(SEED)
_A = _rng.integers(1, 2 ** 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_NONE = np.uint64(2 ** 64 - 1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> list[np.ndarray]:
    """Powers 0 to n of the base and of its inverse modulo 2^64."""
    while len(_powers[0]) <= n:
        for k, base in enumerate((_BASE, _BACK)):
            p = _powers[k]
            _powers[k] = np.concatenate([p, p * np.uint64(pow(base, len(p), 1 << 64))])
    return _powers


def phrase_ends(text: str, seen: set[str]) -> list[int]:
    """Where the phrases of ``text`` end; ``seen`` holds the phrases before it and takes its own."""
    ends, phrase, at = [], "", 0
    for c in text:
        phrase += c
        if phrase not in seen:
            seen.add(phrase)
            at += len(phrase)
            ends.append(at)
            phrase = ""
    return ends


def phrase_hashes(text: str, ends: list[int]) -> np.ndarray:
    """A 64-bit hash of each phrase."""
    if not ends:
        return np.zeros(0, np.uint64)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)[:ends[-1]].astype(np.uint64) + np.uint64(1)
    forth, back = _power(len(codes))
    upto = np.concatenate([[np.uint64(0)], np.cumsum(codes * forth[:len(codes)], dtype=np.uint64)])
    e = np.array(ends)
    s = np.concatenate([[0], e[:-1]])
    return mix64((upto[e] - upto[s]) * back[s] + (e - s).astype(np.uint64))


def least(hashes: np.ndarray) -> np.ndarray:
    out = np.full(HASHES, _NONE)
    for i in range(0, len(hashes), 512):
        out = np.minimum(out, (hashes[i:i + 512, None] * _A).min(0))
    return out


def fingerprint(minima: np.ndarray) -> str:
    """Hex, a byte for each hash function; of a text without phrases: empty."""
    return "" if minima[0] == _NONE and (minima == _NONE).all() else (mix64(minima) & np.uint64(255)).astype(np.uint8).tobytes().hex()


def likeness(a: str, b: str) -> float:
    """Estimated share of common phrases, 0 to 1: equal bytes, less those equal by chance.  Two empty texts are alike."""
    if not a or not b:
        return float(a == b)
    same = float((np.frombuffer(bytes.fromhex(a), np.uint8) == np.frombuffer(bytes.fromhex(b), np.uint8)).mean())
    return max(0.0, (same - 1 / 256) / (1 - 1 / 256))


class Parsed:
    """A text with its parse, and the fingerprint of it."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.seen: set[str] = set()
        self.ends = phrase_ends(self.text, self.seen)
        self.hashes = phrase_hashes(self.text, self.ends)
        self.print = fingerprint(least(self.hashes))

    def edited(self, other: str, share: int = 4) -> tuple[str, str]:
        """(text, fingerprint) with the last 1/share of the code points replaced by the first as many of ``other``.

        The parse of what stays is taken over up to the last phrase that ends in it.
        """
        n = len(self.text)
        kept = n - n // share
        k = int(np.searchsorted(self.ends, kept, "right"))
        at = self.ends[k - 1] if k else 0
        text = self.text[:kept] + other[:n // share]
        seen = {self.text[a:b] for a, b in zip([0, *self.ends[:k]], self.ends[:k])}
        ends = phrase_ends(text[at:], seen)
        return text, fingerprint(np.minimum(least(self.hashes[:k]), least(phrase_hashes(text[at:], ends))))


SCHEMA = "part long, kind int, doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, text string"
RESULT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
FINISHED, FIRST, LAST = range(3)


def _compare(doc_id: int | None, doc: Parsed, other: Parsed) -> tuple:
    text, edited = doc.edited(other.text)
    return (doc_id, len(doc.text), hashlib.sha256(text.encode()).hexdigest(), doc.print, edited, likeness(doc.print, edited), likeness(doc.print, other.print))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], [c.split()[0] for c in SCHEMA.split(", ")])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents in order: each is compared with the next; the partition's first and last texts go out as they are."""
    part, held = TaskContext.get().partitionId(), None
    blank = (None,) * 6
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            rows = []
            for doc_id, text in zip(*(batch.column(c).slice(i, 256).to_pylist() for c in ("doc_id", "text"))):
                doc = Parsed(text)
                rows.append((part, FIRST, doc_id, *blank, doc.text) if held is None else (part, FINISHED, *_compare(*held, doc), None))
                held = doc_id, doc
            yield _batch(rows)
    if held:
        yield _batch([(part, LAST, held[0], *blank, held[1].text)])


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(0, FINISHED, *_compare(r["doc_id"], Parsed(r["text"]), Parsed(r["next_text"])), None) for r in batch.to_pylist()]
        if rows:
            yield _batch(rows)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row of ``docs``.

    The texts are range-partitioned by doc_id once and compared with their successors inside each partition; what is
    left are as many pairs as there are partitions, joined across the borders (the last document's successor is the
    first).  A null text is empty: fingerprint "", like another empty text and unlike any other; a null doc_id comes
    first; rows that repeat a doc_id follow each other in the order of a hash of their texts; a lone document is its
    own successor; an empty table gives an empty result.  Other columns are ignored.
    """
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ranged = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stage(ranged.mapInArrow(_scan, SCHEMA), "fingerprints")
    first = rows.where(F.col("kind") == FIRST)
    # one row for each partition
    following = first.select(F.col("part").alias("p"), F.lead("part").over(Window.orderBy("part")).alias("q"), F.min("part").over(Window.partitionBy()).alias("least"))
    border = (rows.where(F.col("kind") == LAST).select("part", "doc_id", "text")
              .join(following, F.col("part") == F.col("p")).withColumn("q", F.coalesce("q", "least"))
              .join(first.select(F.col("part").alias("_q"), F.col("text").alias("next_text")), F.col("q") == F.col("_q"))
              .select("doc_id", "text", "next_text").mapInArrow(_finish, SCHEMA))
    return rows.where(F.col("kind") == FINISHED).select(*RESULT).unionByName(border.select(*RESULT))
