"""Ranked lexical search over bit-sliced Bloom signatures.

Documents of like size stand side by side in blocks.  A block's signature has a row of bits for each position, one bit
for each document; a term sets a few rows for the document, once for each power of two that its occurrences reach.  The
rows of a term, and-ed, show every document that holds it so often, and some that don't: weighted sums of these slices
are upper bounds of the scores.  Documents whose bound stays under the tenth score found so far are provably excluded;
all others are scored exactly from their terms.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glossa.llm.common import Words, batches_of, gathered, release, stage, text_array

TOP = 10
#: Bits of a signature for each entry (a term and a power of two) of the fullest document of its block, and rows of an entry.
BITS_PER_ENTRY = 12
ROWS_OF_ENTRY = 4
#: Bytes of text that one set of blocks is made of.
INDEXED_BYTES = 2 << 20
#: Most texts, and most rows of the index (of up to some MB), that are handed to Python, written or read at once.
TEXT_ROWS, INDEX_ROWS = 512, 8
#: Bytes of benchmark text that go out to the tasks at once; more come in further passes over the index.
QUERY_BYTES = 1 << 20
#: Pairs of a query's term and a document whose bounds are summed at once.
BOUNDED_AT_ONCE = 2 << 20
#: Documents that a block scores for a query before it looks for others that can't be excluded.
FIRST = 16
INDEX = "doc_id array<long>, n array<long>, terms array<string>, starts array<int>, codes array<int>, times array<int>, width int, bits binary"

# Letters and digits of ASCII and all other characters make terms; only A-Z are lower-cased.
_FOLD = np.full(256, ord(" "), np.uint8)
for _a, _b in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _FOLD[_a:_b + 1] = np.arange(_a, _b + 1)
_FOLD[0x41:0x5B] += 32


def folded(texts: pa.LargeStringArray) -> pa.LargeStringArray:
    """The texts in lower case with a blank for every character that is in no term (their bytes begin at offset 0)."""
    if not len(texts) or texts.buffers()[2] is None:
        return texts
    _, ends, data = texts.buffers()
    return pa.LargeStringArray.from_buffers(len(texts), ends, pa.py_buffer(_FOLD[np.frombuffer(data, np.uint8)]))


def _hashes(terms: Sequence[bytes], level: int) -> np.ndarray:
    """A hash of each term at 2^level occurrences."""
    return np.fromiter((xxhash.xxh64_intdigest(t, level) for t in terms), np.uint64, len(terms))


def _rows(h: np.ndarray, width: int) -> np.ndarray:
    """The signature rows of each hash."""
    step = (h >> np.uint64(32)) | np.uint64(1)
    return ((h[:, None] + np.arange(ROWS_OF_ENTRY, dtype=np.uint64) * step[:, None]) >> np.uint64(7)).astype(np.int64) % width


def _signature(terms: list[bytes], doc: np.ndarray, code: np.ndarray, times: np.ndarray, n_docs: int) -> tuple[int, bytes]:
    """(rows, bits): the documents' bitmaps, row by row."""
    level = np.log2(times).astype(np.int64)
    entries = np.bincount(doc, level + 1, n_docs)
    width = -(-int(BITS_PER_ENTRY * entries.max(initial=1)) // 64) * 64
    bits = np.zeros((width, n_docs), bool)
    for k in range(int(level.max(initial=0)) + 1):
        at = level >= k
        used, inverse = np.unique(code[at], return_inverse=True)
        rows = _rows(_hashes([terms[c] for c in used.tolist()], k), width)
        bits[rows[inverse].ravel(), np.repeat(doc[at], ROWS_OF_ENTRY)] = True
    return width, np.packbits(bits, axis=1).tobytes()


def _list(values: np.ndarray | pa.Array, kind: pa.DataType) -> pa.Array:
    """A column of one row that holds all the values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values if isinstance(values, pa.Array) else pa.array(values, kind))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in gathered(batches, "text", INDEXED_BYTES):
        words = Words(folded(text_array(batch, "text")))
        ids, n = batch.column("doc_id"), np.diff(words.bounds)
        key = np.repeat(np.arange(len(n)), n) * (len(words.vocab) + 1) + words.codes
        key, times = np.unique(key, return_counts=True)
        doc, code = np.divmod(key, len(words.vocab) + 1)
        entries = np.bincount(doc, np.log2(times).astype(np.int64) + 1, len(n)).astype(np.int64)
        kind = np.ceil(np.log2(np.maximum(entries, 1))).astype(np.int64)
        for k in np.unique(kind[n > 0]).tolist():
            docs = np.flatnonzero((kind == k) & (n > 0))
            place = np.full(len(n), -1)
            place[docs] = np.arange(len(docs))
            mine = place[doc] >= 0
            used, local = np.unique(code[mine], return_inverse=True)
            terms = [words.vocab[c] for c in used.tolist()]
            at = place[doc[mine]]
            width, bits = _signature(terms, at, local, times[mine], len(docs))
            integers = (np.searchsorted(at, np.arange(len(docs) + 1)), local, times[mine])
            columns = [_list(ids.take(pa.array(docs)), pa.int64()), _list(n[docs], pa.int64()), _list(pa.array([t.decode() for t in terms], pa.string()), pa.string()),
                       *(_list(x.astype(np.int32), pa.int32()) for x in integers), pa.array([width], pa.int32()), pa.array([bits], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in INDEX.split(", ")])


def index(docs: DataFrame) -> DataFrame:
    """The staged blocks of all documents with a term: ids, lengths, terms with their occurrences, and the signature."""
    return stage(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_blocks, INDEX), "signatures", TEXT_ROWS, INDEX_ROWS)


# --- queries -----------------------------------------------------------------------------------------------------
def query_blocks(benchmark: DataFrame) -> list[DataFrame]:
    """The benchmark in frames of about QUERY_BYTES each; nothing is collected yet."""
    items = benchmark.where("text is not null").select(F.col("item_id").cast("long"), "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // QUERY_BYTES)
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) for k in range(n)]


@dataclass
class Queries:
    """A block of queries: their ids, and the pairs of a query with one of its terms (a place in ``terms``), by query,
    with how often it occurs there."""

    ids: list[int | None]
    terms: list[bytes]
    query: np.ndarray
    term: np.ndarray
    times: np.ndarray

    @cached_property
    def names(self) -> pa.Array:
        return pa.array([t.decode() for t in self.terms], pa.string())

    @cached_property
    def starts(self) -> np.ndarray:
        """Where the pairs of each query with a term begin."""
        return np.flatnonzero(np.concatenate([[True], self.query[1:] != self.query[:-1]])) if len(self.query) else np.zeros(0, np.int64)

    def hashes(self, level: int) -> np.ndarray:
        while len(self._hashes) <= level:
            self._hashes.append(_hashes(self.terms, len(self._hashes)))
        return self._hashes[level]

    def __post_init__(self):
        self._hashes: list[np.ndarray] = []

    def places(self, block_terms: pa.Array) -> np.ndarray:
        """For each term its place among a block's terms; -1 if it isn't there."""
        return pc.fill_null(pc.index_in(self.names, block_terms.cast(pa.string())), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def queries(block: DataFrame) -> Queries:
    """The block's rows in the order of id and text."""
    rows = block.orderBy("item_id", "text").collect()
    words = Words(folded(text_array(pa.RecordBatch.from_pydict({"text": pa.array([r["text"] for r in rows], pa.string())}), "text")))
    size = len(words.vocab) + 1
    pairs, times = np.unique(np.repeat(np.arange(len(rows)), np.diff(words.bounds)) * size + words.codes, return_counts=True)
    return Queries([r["item_id"] for r in rows], words.vocab, pairs // size, pairs % size, times)


@dataclass
class Corpus:
    """Documents with a term, their terms with repeats, and the weight of each term of a block of queries."""

    n: int
    total: int
    weight: np.ndarray


def corpus(blocks: DataFrame, q: Queries) -> Corpus:
    """Counts over all documents; a partition sends the documents of each of the queries' terms."""
    size = len(q.terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = np.zeros(size, np.int64)
        for batch in batches:
            for r in range(batch.num_rows):
                at = q.places(batch.column("terms")[r].values)
                held = np.bincount(batch.column("codes")[r].values.to_numpy(zero_copy_only=False), minlength=int(at.max(initial=0)) + 1)
                docs += np.where(at >= 0, held[np.maximum(at, 0)], 0)
        some = np.flatnonzero(docs)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(docs[some])], ["term", "docs"])

    sums = blocks.agg(F.sum(F.size("n").cast("long")), F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda s, x: s + x))).first()
    n, total = sums[0] or 0, sums[1] or 0
    df = np.zeros(size, np.int64)
    holders = blocks.select("terms", "codes").mapInArrow(count, "term long, docs long").groupBy("term").agg(F.sum("docs").alias("docs"))
    with batches_of(blocks.sparkSession, INDEX_ROWS):
        for r in holders.collect():
            df[r["term"]] = r["docs"]
    return Corpus(n, total, np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64))


def _part(times: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term gives a document by its occurrences, without its weight; it grows with them."""
    return 1_000_000_000 * times // (1000 * times + 8 * m)


class Block:
    """One row of the index, ready to be asked for a block of queries."""

    def __init__(self, batch: pa.RecordBatch, row: int, q: Queries, c: Corpus):
        def values(name: str) -> np.ndarray:
            return batch.column(name)[row].values.to_numpy(zero_copy_only=False)

        self.ids = batch.column("doc_id")[row].values.to_pylist()
        self.m = 100 - 75 + 75 * values("n") * c.n // c.total
        starts, self.codes, self.times = values("starts").astype(np.int64), values("codes").astype(np.int64), values("times").astype(np.int64)
        d = len(self.ids)
        self.place = q.places(batch.column("terms")[row].values)
        self.size = len(batch.column("terms")[row].values)
        self.key = np.repeat(np.arange(d), np.diff(starts)) * self.size + self.codes
        top = np.maximum.reduceat(self.times, starts[:-1])
        # slices: how far a document's occurrences of a term may go, in powers of two
        width, bits = batch.column("width")[row].as_py(), np.frombuffer(batch.column("bits")[row].as_buffer(), np.uint8)
        bits = bits.reshape(width, -1)
        self.level = np.zeros((len(q.terms), d), np.int8)
        here = np.arange(len(q.terms))
        for k in range(int(top.max()).bit_length()):
            shown = np.bitwise_and.reduce(bits[_rows(q.hashes(k)[here], width)], axis=1)
            some = shown.any(1)
            here, shown = here[some], np.unpackbits(shown[some], axis=1, count=d).astype(bool)
            if not len(here):
                break
            self.level[here] = np.where(shown & (self.level[here] == k), k + 1, self.level[here])
        most = [np.zeros(d, np.int64), *(np.minimum((1 << (k + 1)) - 1, top) for k in range(int(self.level.max(initial=0))))]
        self.most = np.array([_part(t, self.m) for t in most])

    def bounds(self, q: Queries, weight: np.ndarray) -> np.ndarray:
        """An upper bound of each document's score, a row for each query with a term; ``weight`` is that of the pairs."""
        out = np.zeros((len(q.starts), len(self.ids)), np.int64)
        step = max(BOUNDED_AT_ONCE // max(len(q.term), 1), 1)
        for a in range(0, len(self.ids), step):
            docs = np.arange(a, min(a + step, len(self.ids)))
            part = self.most[self.level[:, docs], docs]
            out[:, docs] = np.add.reduceat(part[q.term] * weight[:, None], q.starts, axis=0)
        return out

    def exact(self, docs: np.ndarray, terms: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """The scores of some documents."""
        place = self.place[terms]
        here = place >= 0
        wanted = docs[:, None] * self.size + place[here]
        at = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
        times = np.where(self.key[at] == wanted, self.times[at], 0)
        return (weight[here] * _part(times, self.m[docs][:, None])).sum(1)


def _searcher(q: Queries, c: Corpus, k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple]] = {}  # (-score, no id, id) of the partition's best documents, in order
        rescored = np.zeros(len(q.ids), np.int64)
        least = np.ones(len(q.starts), np.int64)  # the score that a document needs at least, by query with a term
        weight = q.times * c.weight[q.term]
        ends = np.append(q.starts[1:], len(q.term))
        for batch in batches:
            for row in range(batch.num_rows):
                block = Block(batch, row, q, c)
                bound = block.bounds(q, weight)
                for i in np.flatnonzero((bound >= least[:, None]).any(1)).tolist():
                    pairs = slice(q.starts[i], ends[i])
                    number = int(q.query[q.starts[i]])
                    open_ = np.flatnonzero(bound[i] >= least[i])
                    first = open_[np.argsort(-bound[i, open_], kind="stable")[:max(FIRST, k)]]
                    for docs in (first, None):
                        if docs is None:  # all others that the scores found by now don't exclude
                            docs = np.setdiff1d(open_[bound[i, open_] >= least[i]], first)
                        if not len(docs):
                            continue
                        rescored[number] += len(docs)
                        scores = block.exact(docs, q.term[pairs], weight[pairs])
                        found = [(-s, block.ids[d] is None, block.ids[d] or 0) for d, s in zip(docs.tolist(), scores.tolist()) if s > 0]
                        best[number] = sorted(best.get(number, []) + found)[:k]
                        if len(best[number]) == k:
                            least[i] = -best[number][-1][0]
        rows = [(i, None if none else d, -s, None) for i, found in best.items() for s, none, d in found]
        rows += [(i, None, None, int(r)) for i, r in enumerate(rescored) if r]
        columns = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                                         ["number", "doc_id", "score", "rescored"])
    return search


def _found(docs_index: DataFrame, block: DataFrame, k: int) -> tuple[DataFrame, Queries, Corpus]:
    q = queries(block)
    c = corpus(docs_index, q)
    return docs_index.mapInArrow(_searcher(q, c, k), "number int, doc_id long, score long, rescored long"), q, c


def search(docs: DataFrame, benchmark: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: for each row of ``benchmark`` its ``k`` best documents with a score above 0.

    Every whole text is indexed, every document is bounded for every query.  Queries go out in blocks of about
    QUERY_BYTES, each a pass over the index; a partition sends ``k`` documents a query, which are ranked by score and
    doc_id.  A null text, or one without terms, is no document and no query with results; a null doc_id comes after all
    others of its score; rows that repeat a doc_id are documents each, rows that repeat an item_id queries each.
    Empty tables give an empty result.  Other columns are ignored.
    """
    spark = docs.sparkSession
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    built = index(docs)
    for block in query_blocks(benchmark):
        rows, q, c = _found(built, block, k)
        if not c.n:
            continue
        best = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = rows.where("score > 0").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        ids = spark.createDataFrame(list(enumerate(q.ids)), "_number int, item_id long")
        named = ranked.join(F.broadcast(ids), F.col("number") == F.col("_number"))  # a block's ids: at most QUERY_BYTES of them
        out = out.unionByName(stage(named.select("item_id", "rank", "doc_id", "score"), "found", INDEX_ROWS))
    release(built)
    return out


def rescored(docs: DataFrame, benchmark: DataFrame, k: int = TOP) -> tuple[int, int]:
    """(pairs of a query and a document that were scored exactly, all pairs)."""
    built = index(docs)
    scored = pairs = 0
    for block in query_blocks(benchmark):
        rows, q, c = _found(built, block, k)
        if c.n:
            with batches_of(docs.sparkSession, INDEX_ROWS):
                scored += rows.agg(F.sum("rescored")).first()[0] or 0
            pairs += c.n * len(q.ids)
    release(built)
    return scored, pairs
