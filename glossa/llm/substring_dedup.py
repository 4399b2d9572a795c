"""Substring dedup on the de Bruijn graph of the corpus: every 13-word window is an edge.

An edge met in several documents is repeated; its source is its occurrence in the document with the least doc_id.
Edges meet in a shuffle by hash, each slice of the input sending its different edges once, packed; what comes back to
a slice are the addresses of its repeated edges, each joined with its source's.  Edges that follow each other in a
document while their sources follow each other too form a nonbranching path: such paths are compacted into runs, so
from there on the work is in spans and no longer in words.  Each run is verified: its words and those at its source's
coordinates must agree under a second, independent hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import Words, gathered, mix64, release, slices, stage, text_array, window_hashes

WINDOW = 13
#: Text that one bucket of edges stands for: bounds the memory of a task that sorts a bucket.
BUCKET_BYTES = 6 << 20
SLICE = 6 << 20
CHECK_SEED = 77
#: Rows of packed edges, and of texts, in one Arrow batch.
PACKED_ROWS, TEXT_ROWS = 64, 512

ROWS = "kind int, bucket long, slice long, doc_id long, text_key long, idx long, packed binary"
EDGES, REPEATS, DOCUMENT = range(3)


# --- packing -----------------------------------------------------------------------------------------------------
def pack(**columns: np.ndarray) -> bytes:
    """Columns of one length, each as planes of equally significant bytes, compressed together."""
    n = len(next(iter(columns.values())))
    parts = [np.array([n], np.int64).tobytes()]
    for x in columns.values():
        parts.append(np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(n, x.dtype.itemsize).T).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(packed: bytes, **kinds: str) -> dict[str, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    n, at, out = int(np.frombuffer(raw[:8], np.int64)[0]), 8, {}
    for name, kind in kinds.items():
        size = np.dtype(kind).itemsize
        out[name] = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T.copy().view(kind).ravel()
        at += n * size
    return out


EDGE = {"step": "<u8", "doc": "<u4", "at": "<u4"}
ANSWER = {"idx": "<u4", "at": "<u4", "source_slice": "<i8", "source_idx": "<u4", "source_at": "<u4"}


# --- edges of a slice --------------------------------------------------------------------------------------------
def _rows(kind: int, n: int, **given) -> pa.RecordBatch:
    columns = {"kind": pa.array(np.full(n, kind, np.int32))}
    for name, of in (("bucket", pa.int64()), ("slice", pa.int64()), ("doc_id", pa.int64()), ("text_key", pa.int64()), ("idx", pa.int64()), ("packed", pa.binary())):
        columns[name] = pa.array(given[name], of) if name in given else pa.nulls(n, of)
    return pa.RecordBatch.from_pydict(columns)


def _edges(buckets: int) -> Callable:
    width = np.uint64((1 << 64) // buckets + 1) if buckets > 1 else np.uint64(2 ** 64 - 1)

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        for batch in gathered(batches, "text", SLICE):
            batch = batch.take(pa.array(np.argsort(batch.column("doc_id").to_numpy(), kind="stable")))
            ids = batch.column("doc_id").to_numpy()
            any_bucket = hash(number) % buckets  # what only passes through the shuffle is spread by its slice
            yield _rows(DOCUMENT, len(ids), bucket=np.full(len(ids), any_bucket), slice=np.full(len(ids), number), doc_id=ids, text_key=batch.column("text_key"), idx=np.arange(len(ids)))
            words = Words(text_array(batch, "text"))
            hashes, bounds = words.hashes(), words.bounds
            del words
            count = np.maximum(np.diff(bounds) - WINDOW + 1, 0)
            doc = np.repeat(np.arange(len(ids), dtype=np.uint32), count)
            at = (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)).astype(np.uint32)
            h = window_hashes(hashes, WINDOW)[bounds[doc] + at] if len(doc) else np.zeros(0, np.uint64)
            del hashes
            order = np.argsort(h, kind="stable")  # documents ascend, so an edge's first row is its source here
            h, doc, at = h[order], doc[order], at[order]
            del order
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, int)
            source = np.repeat(first, np.diff(np.append(first, len(h))))
            known = ids[doc] > ids[doc[source]]  # repeated inside the slice: answered here
            s = source[known]
            del first, source
            if len(s):
                yield _rows(REPEATS, 1, bucket=[any_bucket], slice=[number], packed=[pack(idx=doc[known].astype("<u4"), at=at[known].astype("<u4"), source_slice=np.full(len(s), number, "<i8"),
                                                                    source_idx=doc[s].astype("<u4"), source_at=at[s].astype("<u4"))])
            del s
            h, doc, at = h[~known], doc[~known], at[~known]
            bucket = (h // width).astype(np.int64)
            cuts = np.append(np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(h) else np.zeros(0, int), len(h))
            out = []
            for a, b in zip(cuts, cuts[1:]):
                here, local = np.unique(doc[a:b], return_inverse=True)
                step = np.diff(h[a:b], prepend=np.uint64(0))
                edges_ = pack(step=step, doc=local.astype("<u4"), at=at[a:b].astype("<u4"))
                head = pack(idx=here.astype("<u4"), doc_id=ids[here].astype("<i8"))
                out.append((int(bucket[a]), np.array([len(head)], "<u4").tobytes() + head + edges_))
                if len(out) >= 16:
                    yield _rows(EDGES, len(out), bucket=[k for k, _ in out], slice=[number] * len(out), packed=[p for _, p in out])
                    out = []
            if out:
                yield _rows(EDGES, len(out), bucket=[k for k, _ in out], slice=[number] * len(out), packed=[p for _, p in out])
            number += 1
    return edges


# --- runs of equal keys in sorted rows ---------------------------------------------------------------------------
def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[tuple[int, bytes]]]]:
    """(key, [(slice, packed)]) of each run of equal keys."""
    last, held = None, []
    for batch in batches:
        keys, numbers, packed = (batch.column(c) for c in (key, "slice", "packed"))
        for i in range(batch.num_rows):
            k = keys[i].as_py()
            if held and k != last:
                yield last, held
                held = []
            last = k
            held.append((numbers[i].as_py(), packed[i].as_py()))
    if held:
        yield last, held


def _edge_rows(batches: Iterator[pa.RecordBatch], others: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of each batch; its other rows are put into ``others``."""
    for batch in batches:
        kinds = batch.column("kind").to_numpy()
        if (kinds != EDGES).any():
            others.append(batch.filter(pa.array(kinds != EDGES)))
        if (kinds == EDGES).any():
            yield batch.filter(pa.array(kinds == EDGES))


def _sources(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each slice the addresses of its repeated edges in a bucket, with their sources'; other rows pass."""
    others: list[pa.RecordBatch] = []
    for _, parts in _groups(_edge_rows(batches, others), "bucket"):
        yield from others
        others.clear()
        if len(parts) > 1:
            yield from _answers(parts)
    yield from others


def _answers(parts: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    columns: dict[str, list[np.ndarray]] = {c: [] for c in ("h", "doc_id", "part", "idx", "at")}
    slice_of = np.array([number for number, _ in parts], np.int64)
    for part, (_, packed) in enumerate(parts):
        size = int(np.frombuffer(packed[:4], "<u4")[0])
        head, e = unpack(packed[4:4 + size], idx="<u4", doc_id="<i8"), unpack(packed[4 + size:], **EDGE)
        columns["h"].append(np.cumsum(e["step"], dtype=np.uint64)), columns["at"].append(e["at"])
        columns["doc_id"].append(head["doc_id"][e["doc"]]), columns["idx"].append(head["idx"][e["doc"]])
        columns["part"].append(np.full(len(e["at"]), part, np.uint32))
    h, doc_id, part, idx, at = (np.concatenate(columns.pop(c)) for c in ("h", "doc_id", "part", "idx", "at"))
    order = np.argsort(h, kind="stable")
    h = h[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    sizes = np.diff(np.append(first, len(h)))
    del h, first
    # single edges are no repeats: go on with the others alone
    more = np.repeat(sizes > 1, sizes)
    order, sizes = order[more], sizes[sizes > 1]
    if not len(order):
        return
    doc_id, number, idx, at = doc_id[order], slice_of[part[order]], idx[order], at[order]
    del order, part, more
    of = np.repeat(np.arange(len(sizes)), sizes)
    least = np.minimum.reduceat(doc_id, np.cumsum(sizes) - sizes)
    # the first row of each edge that is in the least document
    rows = np.flatnonzero(doc_id == least[of])
    source = rows[np.unique(of[rows], return_index=True)[1]]
    again = np.flatnonzero(doc_id > least[of])
    again = again[np.argsort(number[again], kind="stable")]
    cuts = np.append(np.flatnonzero(np.concatenate([[True], np.diff(number[again]) != 0])) if len(again) else np.zeros(0, int), len(again))
    for a, b in zip(cuts, cuts[1:]):
        k = again[a:b]
        s = source[of[k]]
        yield _rows(REPEATS, 1, slice=[int(number[k[0]])], packed=[pack(idx=idx[k], at=at[k], source_slice=number[s].astype("<i8"), source_idx=idx[s], source_at=at[s])])


RUN = "slice long, idx long, start long, n long, source_slice long, source_idx long, source_start long"


def _compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nonbranching paths of repeated edges of each slice: runs of n windows."""
    for number, parts in _groups(batches, "slice"):
        e = [unpack(p, **ANSWER) for _, p in parts]
        c = {k: np.concatenate([x[k] for x in e]).astype(np.int64) for k in ANSWER}
        order = np.lexsort((c["at"], c["idx"]))
        c = {k: v[order] for k, v in c.items()}
        follows = ((np.diff(c["idx"]) == 0) & (np.diff(c["at"]) == 1) & (np.diff(c["source_slice"]) == 0) & (np.diff(c["source_idx"]) == 0)
                   & (np.diff(c["source_at"]) == 1))
        start = np.flatnonzero(np.concatenate([[True], ~follows]))
        n = np.diff(np.append(start, len(c["at"])))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.full(len(start), number, np.int64), c["idx"][start], c["at"][start], n, c["source_slice"][start], c["source_idx"][start], c["source_at"][start])],
                                         [x.split()[0] for x in RUN.split(", ")])


# --- back to the texts -------------------------------------------------------------------------------------------
SPANS = "array<struct<start:bigint,n:bigint>>"
FINISHED = "doc_id long, text_key long, n_words long, n_removed long, kept_sha256 string, checks array<struct<start:bigint,n:bigint,check:bigint>>"


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drop the words under the spans; hash the words of every span and of every span asked for as a source."""
    for batch in slices(batches, "text", SLICE):
        words = Words(text_array(batch, "text"))
        second = words.hashes(CHECK_SEED)
        vocab = np.array(words.vocab, object)
        rows = []
        for i, (spans, asked) in enumerate(zip(batch.column("spans").to_pylist(), batch.column("asked").to_pylist())):
            a, b = words.bounds[i], words.bounds[i + 1]
            own = words.codes[a:b]
            keep = np.ones(b - a, bool)
            checks = []
            for s in spans or ():
                keep[s["start"]:s["start"] + s["n"] + WINDOW - 1] = False
            for s in {(s["start"], s["n"]) for s in (*(spans or ()), *(asked or ()))}:
                checks.append({"start": s[0], "n": s[1], "check": int(_ordered(second[a + s[0]:a + s[0] + s[1] + WINDOW - 1]).view(np.int64))})
            kept = vocab[own[keep]] if len(own) else []
            rows.append((b - a, int((~keep).sum()), hashlib.sha256(b" ".join(kept)).hexdigest(), checks))
        n, removed, digest, checks = zip(*rows)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest),
                                          pa.array(checks, pa.list_(pa.struct([("start", pa.int64()), ("n", pa.int64()), ("check", pa.int64())])))],
                                         ["doc_id", "text_key", "n_words", "n_removed", "kept_sha256", "checks"])


def _ordered(words: np.ndarray) -> np.ndarray:
    """A hash of the words in their order."""
    return mix64((words * (np.arange(1, len(words) + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(0x9E3779B97F4A7C15))).sum(dtype=np.uint64, keepdims=True))[0]


def repeated_runs(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(runs, addresses), staged: the compacted runs of repeated windows, and the doc_id and text_key behind (slice, idx).

    The edges cross the network once and are never written; what is kept is the answers.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    edges = docs.where("doc_id is not null").select("doc_id", "text_key", "text").mapInArrow(_edges(max(1, -(-size // BUCKET_BYTES))), ROWS)
    found = stage(edges.repartition(F.col("bucket")).sortWithinPartitions("bucket").mapInArrow(_sources, ROWS), "answers", PACKED_ROWS)
    answers = found.where(F.col("kind") == REPEATS).select("slice", "packed")
    runs = stage(answers.repartition(F.col("slice")).sortWithinPartitions("slice").mapInArrow(_compact, RUN), "runs", PACKED_ROWS)
    place = stage(found.where(F.col("kind") == DOCUMENT).select("slice", "idx", "doc_id", "text_key"), "addresses")
    release(found)
    return runs, place


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of ``docs``.

    A word goes if a window of 13 words that covers it also starts in a document with a smaller doc_id.  Words are
    compared as they are.  A null, empty or short text has no windows and loses nothing; rows that repeat a doc_id
    never cost each other words; a row without a doc_id neither loses words nor costs others any; an empty table gives
    an empty result.  Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text").withColumn("text_key", F.xxhash64("text"))
    runs, place = repeated_runs(rows)
    source = place.select(F.col("slice").alias("source_slice"), F.col("idx").alias("source_idx"), F.col("doc_id").alias("source_doc"), F.col("text_key").alias("source_key"))
    placed = stage(runs.join(place, ["slice", "idx"]).join(source, ["source_slice", "source_idx"])
                   .select("doc_id", "text_key", "start", "n", "source_doc", "source_key", "source_start").distinct(), "spans")
    release(runs, place)
    span = F.struct("start", "n")
    # a document's spans are bounded by its words; so are the different spans asked of a source, however many ask
    own = placed.select("doc_id", "text_key", span.alias("s")).groupBy("doc_id", "text_key").agg(F.collect_set("s").alias("spans"))
    asked = (placed.select(F.col("source_doc").alias("doc_id"), F.col("source_key").alias("text_key"), F.struct(F.col("source_start").alias("start"), "n").alias("s")).distinct()
             .groupBy("doc_id", "text_key").agg(F.collect_set("s").alias("asked")))
    wanted = own.join(asked, ["doc_id", "text_key"], "full").select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_k"), "spans", "asked")

    def finish(texts: DataFrame, wanted: DataFrame) -> DataFrame:
        met = texts.join(wanted, (F.col("doc_id") == F.col("_d")) & (F.col("text_key") == F.col("_k")), "left")
        return met.select("doc_id", "text_key", "text", "spans", "asked").mapInArrow(_finish, FINISHED)

    done = stage(finish(rows, wanted), "kept", TEXT_ROWS)
    checks = done.select("doc_id", "text_key", F.explode("checks").alias("c")).select("doc_id", "text_key", "c.*").distinct()
    theirs = checks.select(F.col("doc_id").alias("source_doc"), F.col("text_key").alias("source_key"), F.col("start").alias("source_start"), "n", F.col("check").alias("source_check"))
    wrong = (placed.join(checks, ["doc_id", "text_key", "start", "n"]).join(theirs, ["source_doc", "source_key", "source_start", "n"])
             .where("check != source_check").select("doc_id", "text_key", "start", "n", "source_doc", "source_key", "source_start"))
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    if wrong.isEmpty():
        return done.select(*columns)
    # a window hash met by chance: its documents are done again with their other spans
    wrong = stage(wrong, "wrong")
    hit = wrong.select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_k")).distinct()
    again = rows.join(hit, (F.col("doc_id") == F.col("_d")) & (F.col("text_key") == F.col("_k")), "left_semi")
    right = placed.join(wrong, placed.columns, "left_anti").select("doc_id", "text_key", span.alias("s")).groupBy("doc_id", "text_key").agg(F.collect_set("s").alias("spans"))
    right = right.select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_k"), "spans", F.lit(None).cast(SPANS).alias("asked"))
    rest = done.join(hit, (F.col("doc_id") == F.col("_d")) & (F.col("text_key") == F.col("_k")), "left_anti")
    return rest.select(*columns).union(finish(again, right).select(*columns))
