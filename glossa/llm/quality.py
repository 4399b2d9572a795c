"""Quality classifier: document statistics, random Fourier features, ridge by normal equations, isotonic calibration.

Only the text is looked at: labels, lang, source and doc_id are never inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import Words, mix64, slices, stage, text_array
from glossa.llm.labelled import held_out, training_labels

#: Rows that may be learned from: a documented bound.
MAX_TRAINING_ROWS = 100_000
FEATURES = 192
SEED = 11
RIDGE = 1e-3
BINS = 1000
BLOCK = 16
TRAINING_PARTITIONS = 32

# Byte classes of the character statistics.
CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789", "blank": b" \t",
           "line": b"\n\r", "stop": b".?", "comma": b",;:", "bang": b"!", "pipe": b"|", "symbol": b"#$%&*@<>{}[]\\/=+_^~`",
           "quote": b"\"'()-"}
_CLASS_OF = np.full(256, len(CLASSES), np.uint8)  # the last class: bytes of other characters, and control codes
for _k, _v in enumerate(CLASSES.values()):
    _CLASS_OF[list(_v)] = _k
N_CLASSES = len(CLASSES) + 1
#: Bytes whose classes and hashes are looked up at once.
CHUNK = 1 << 18
_BYTE_HASH = mix64(np.arange(1, 257, dtype=np.uint64))
STATS = [*(f"share_{c}" for c in CLASSES), "share_other", "log_words", "word_length", "word_spread", "distinct", "top_word", "distinct_pairs",
         "line_words", "distinct_lines", "caps_words", "symbol_words", "single_words", "long_words", "sentences"]


def _per_text(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, values, n) if len(owner) else np.zeros(n)


def _distinct(owner: np.ndarray, keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of each text, and the count of its commonest key."""
    if not len(owner):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((keys, owner))
    o, k = owner[order], keys[order]
    first = np.flatnonzero(np.concatenate([[True], (o[1:] != o[:-1]) | (k[1:] != k[:-1])]))
    runs = np.diff(np.append(first, len(o)))
    top = np.zeros(n)
    np.maximum.at(top, o[first], runs)
    return np.bincount(o[first], minlength=n), top


def _by_chunk(data: np.ndarray, offsets: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of each class by text, sum of the byte hashes before each of the sorted ``cuts``), CHUNK bytes at a time."""
    n = len(offsets) - 1
    chars, total = np.zeros(n * N_CLASSES, np.int64), np.zeros(len(cuts), np.uint64)
    carry = np.uint64(0)
    for a in range(0, len(data), CHUNK):
        part = data[a:a + CHUNK]
        owner = np.searchsorted(offsets, np.arange(a, a + len(part)), "right") - 1
        chars += np.bincount(owner * N_CLASSES + _CLASS_OF[part], minlength=n * N_CLASSES)
        sums = np.concatenate([[carry], carry + np.cumsum(_BYTE_HASH[part], dtype=np.uint64)])
        lo, hi = np.searchsorted(cuts, a, "left"), np.searchsorted(cuts, a + len(part), "right")
        total[lo:hi] = sums[cuts[lo:hi] - a]
        carry = sums[-1]
    return chars.reshape(n, N_CLASSES), total


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of STATS for each whole text; a text without words has zeros."""
    n = len(texts)
    raw = texts.buffers()
    offsets = np.frombuffer(raw[1], np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(raw[2], np.uint8)[offsets[0]:offsets[-1]] if raw[2] else np.zeros(0, np.uint8)
    sizes = np.diff(offsets)
    # lines: sums of byte hashes between the line ends tell apart all but lines of the same bytes in another order
    ends = np.flatnonzero(data == 10)
    cut = np.sort(np.concatenate([ends, offsets[1:] - offsets[0]]))
    chars, total = _by_chunk(data, offsets - offsets[0], cut)
    words = Words(texts)
    count = np.diff(words.bounds)
    of = np.repeat(np.arange(n), count)
    length = np.array([len(w) for w in words.vocab] or [0], float)[words.codes]
    caps = np.array([w.isupper() and len(w) > 1 for w in words.vocab] or [0], float)[words.codes]
    marked = np.array([sum(c in b"#$%&*@|" for c in w) > 0 for w in words.vocab] or [0], float)[words.codes]
    some, one = np.maximum(count, 1), np.maximum(sizes, 1)
    mean = _per_text(of, length, n) / some
    spread = np.sqrt(np.maximum(_per_text(of, length ** 2, n) / some - mean ** 2, 0))
    distinct, top = _distinct(of, words.codes, n)
    pairs = words.codes[:-1] * (len(words.vocab) + 1) + words.codes[1:]
    inside = of[:-1] == of[1:]
    pair_kinds, _ = _distinct(of[:-1][inside], pairs[inside], n)
    line_hash = np.diff(total, prepend=np.uint64(0)).astype(np.int64)
    line_owner = np.sort(np.concatenate([np.searchsorted(offsets - offsets[0], ends, "right") - 1, np.arange(n)]))
    lines, _ = _distinct(line_owner, line_hash, n)
    n_lines = np.bincount(line_owner, minlength=n)
    stats = [*(chars[:, k] / one for k in range(N_CLASSES)), np.log1p(count), mean, spread, distinct / np.sqrt(some), top / some, pair_kinds / some,
             np.log1p(count / np.maximum(n_lines, 1)), lines / np.maximum(n_lines, 1), _per_text(of, caps, n) / some,
             _per_text(of, marked, n) / some, _per_text(of, (length <= 2).astype(float), n) / some,
             _per_text(of, (length >= 15).astype(float), n) / some, np.log1p(chars[:, 5] / some * 100)]
    out = np.column_stack(stats)
    out[count == 0] = 0
    return out


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        x = statistics(text_array(batch, "text"))
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel().astype(np.float32)), x.shape[1]).cast(pa.list_(pa.float32()))], ["row", "doc_id", "x"])


def document_statistics(docs: DataFrame) -> DataFrame:
    """row, doc_id, x of every whole text (null: empty), staged: the texts are read once."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text")
    return stage(rows.mapInArrow(_features, "row long, doc_id long, x array<float>"), "statistics")


# --- the model ---------------------------------------------------------------------------------------------------
@dataclass
class Model:
    """Standardisation, Fourier directions, ridge weights, and the calibration's steps."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    at: np.ndarray
    level: np.ndarray

    def fourier(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        wave = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / self.directions.shape[1])
        return np.column_stack([np.ones(len(x)), wave])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.fourier(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.at, self.level), 0, 1)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def isotonic(at: np.ndarray, hits: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Non-decreasing levels nearest to hits / weight (pool adjacent violators)."""
    pools: list[list[float]] = []
    for h, w in zip(hits, weight):
        pools.append([h, w, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            h2, w2, n2 = pools.pop()
            pools[-1] = [pools[-1][0] + h2, pools[-1][1] + w2, pools[-1][2] + n2]
    return np.repeat([h / w for h, w, _ in pools], [n for _, _, n in pools])


def _sums(model: Model, weigh: tuple[float, float]):
    size = len(model.weights)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            y = batch.column("label").to_numpy(zero_copy_only=False)
            f = model.fourier(_matrix(batch.column("x")))
            w = np.where(y > 0.5, weigh[1], weigh[0])[:, None]
            total += f.T @ np.column_stack([f * w, (2 * y - 1)[:, None] * w])
        blocks = list(range(0, size, BLOCK))
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array([total[b:b + BLOCK].tobytes() for b in blocks], pa.binary())], ["block", "part"])
    return sums


def _add(pdf):
    import pandas as pd

    total = sum(np.frombuffer(p) for p in pdf["part"])
    return pd.DataFrame({"block": [pdf["block"].iloc[0]], "part": [total.tobytes()]})


def _scorer(model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = model.score(_matrix(batch.column("x"))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), pa.array(s, pa.float64())], ["row", "doc_id", "score"])
    return score


def fit(stats: DataFrame, labels: DataFrame, column: str = "quality", bound: int = MAX_TRAINING_ROWS) -> Model:
    """Train on about ``bound`` labelled rows: folds 1 to 3 of them give the ridge weights, fold 0 the calibration.

    Each partition sums its part of the normal equations; the sums meet in blocks of rows, whose size depends on the
    number of features alone.  Without labels of both kinds every score is one half.
    """
    d = len(STATS)
    rng = np.random.default_rng(SEED)
    model = Model(np.zeros(d), np.ones(d), rng.normal(size=(d, FEATURES)) / np.sqrt(d), rng.uniform(0, 2 * np.pi, FEATURES),
                  np.zeros(FEATURES + 1), np.array([0.0]), np.array([0.5]))
    rows = stage(stats.join(training_labels(labels, column, bound), "doc_id").select("x", "label", "fold").repartition(TRAINING_PARTITIONS), "training")
    moments = rows.where("fold > 0").agg(F.count("*"), F.sum("label"), *[F.avg(F.col("x")[k]) for k in range(d)], *[F.stddev_pop(F.col("x")[k]) for k in range(d)]).first()
    n, ones = moments[0], moments[1] or 0
    if not 0 < ones < n:
        return model
    model.mean, model.scale = np.array(moments[2:2 + d]), np.maximum(np.array(moments[2 + d:]), 1e-3)
    weigh = (n / (2 * (n - ones)), n / (2 * ones))
    parts = rows.where("fold > 0").mapInArrow(_sums(model, weigh), "block long, part binary").groupBy("block").applyInPandas(_add, "block long, part binary").collect()
    equations = np.concatenate([np.frombuffer(r["part"]).reshape(-1, FEATURES + 2) for r in sorted(parts, key=lambda r: r["block"])])
    model.weights = np.linalg.solve(equations[:, :-1] + RIDGE * n * np.eye(FEATURES + 1), equations[:, -1])
    raw = Model(**{**model.__dict__, "at": np.array([-2.0, 2.0]), "level": np.array([0.0, 1.0])})  # scores as they come, to count them by bin
    binned = (rows.withColumn("row", F.lit(0).cast("long")).withColumn("doc_id", F.col("label").cast("long")).where("fold = 0")
              .mapInArrow(_scorer(raw), "row long, doc_id long, score double").groupBy(F.round(F.col("score") * BINS).alias("bin"))
              .agg(F.sum("doc_id").alias("hits"), F.count("*").alias("n")).orderBy("bin").collect())
    if binned:
        hits, count = np.array([r["hits"] for r in binned], float), np.array([r["n"] for r in binned], float)
        prior = (hits.sum() + 0.5) / (count.sum() + 1)
        model.at = np.array([r["bin"] for r in binned]) / BINS * 4 - 2
        model.level = isotonic(model.at, hits + 0.02 * prior, count + 0.02)
    return model


def score(docs: DataFrame, labels: DataFrame, column: str = "quality", bound: int = MAX_TRAINING_ROWS) -> DataFrame:
    """row, doc_id, held_out, score, predicted for every row of ``docs``.

    A null text is empty; every text has a score, equal texts the same; repeated rows are scored each; a null doc_id is
    kept, not held out and teaches nothing; empty tables give an empty result.  Other columns are ignored.
    """
    stats = document_statistics(docs)
    model = fit(stats, labels, column, bound)
    return stats.mapInArrow(_scorer(model), "row long, doc_id long, score double").select(
        "row", "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _keeper(model: Model):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield batch.filter(pa.array(model.score(statistics(text_array(batch, "text"))) >= 0.5))
    return keep


def keep_good(docs: DataFrame, labels: DataFrame, column: str = "quality") -> DataFrame:
    """The rows of ``docs`` that the classifier doesn't reject, with all their columns; a second pass, no join."""
    return docs.mapInArrow(_keeper(fit(document_statistics(docs), labels, column)), docs.schema)
