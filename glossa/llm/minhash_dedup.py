"""Near-dedup: MinHash bands find candidates, odd sketches sift them, full shingle sets confirm them.

The first ROWS * BANDS of each text's SAMPLES minimum hashes make BANDS band keys (candidates share one), and all of
them are folded into an odd sketch: a bitmap in which every sample toggles one bit.  The bits in which two sketches differ are those toggled by the samples
in which the texts differ, so their number estimates high similarities sharply; only pairs that it can't rule out have
their full sets compared.  At similarity 0.75 a pair shares no band with probability (1 - 0.75^4)^32 = 5e-6, and the
sketch's margin lies almost five standard deviations beyond it.

Groups never become all their pairs.  Equal sets (by 128 bits of their shingles) are one node.  In a band each node is first held against one member
of its bucket, another one in each band, and a node confirms its likeliest partners alone; components follow.  After that only pairs between
different components are looked for, with block-wise sketch comparisons inside the tasks, and confirmed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import Words, mix64, release, shingle_sets, slices, stage, text_array
from glossa.llm.components import components

SHINGLE = 5
#: Linked from this percentage of common shingles.
PERCENT = 75
ROWS, BANDS = 4, 32
SAMPLES = 256
BITS = 1024
#: Sketches that differ in more bits can't be at PERCENT: 113 +- 11.5 are expected there, 168 at 0.6.
MOST_BITS = 168
#: Partners that a node confirms in the first round.
FIRST = 2
#: Members of a bucket that are compared in one piece, and shingles that they have together.
BLOCK = 1024
BLOCK_SHINGLES = 1 << 21
#: Rows in one Arrow batch: texts or pairs of texts, and nodes.
TEXT_ROWS, NODE_ROWS = 512, 2048
SEED = 41
#: A set is known by 128 bits: sums over its shingles' hashes under each of these.
_SALTS = (np.uint64(0), np.uint64(0xC2B2AE3D27D4EB4F))
_A = np.random.default_rng(SEED).integers(1, 2 ** 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(sets: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(band keys, sketches as 64-bit words) of every set; sets without elements get zeros."""
    n = len(bounds) - 1
    some = np.flatnonzero(np.diff(bounds))
    minima = np.zeros((n, SAMPLES), np.uint64)
    if len(some):
        for j in range(SAMPLES):
            minima[some, j] = np.minimum.reduceat((sets * _A[j]) >> np.uint64(32), bounds[some])
    grouped = minima[:, :ROWS * BANDS].reshape(n, BANDS, ROWS)
    keys = np.zeros((n, BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(ROWS):
        keys = mix64(keys) + grouped[:, :, r]
    toggled = mix64(minima + (np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32))) % np.uint64(BITS)
    parity = np.bincount((np.arange(n, dtype=np.int64)[:, None] * BITS + toggled.astype(np.int64)).ravel(), minlength=n * BITS) & 1
    return mix64(keys), np.packbits(parity.reshape(n, BITS).astype(bool), axis=1).view(np.uint64)


def _lists(x: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(x).view(np.int64).ravel()), x.shape[1]).cast(pa.list_(pa.int64()))


def _short(sets: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The sets with 16 bits of each shingle: common values of two of them are never fewer than their common shingles."""
    data = (sets >> np.uint64(48)).astype("<u2").tobytes()
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * 2).astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _told_apart(signed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``signed`` with a node of its own for every different (node, check), the staged nodes that several sets shared).

    Nodes are 64 bits, so at billions of texts a few unlike sets share one by chance; their other 64 bits differ.  Those
    nodes are very few whatever the input: all sets but the one with the least check move to a node hashed from both.
    """
    checks = signed.where("node is not null").groupBy("node").agg(F.min("check").alias("lo"), F.max("check").alias("hi"))
    mixed = stage(checks.where("lo != hi").select(F.col("node").alias("_node"), "lo"), "mixed")
    if mixed.isEmpty():
        out = signed.drop("check")
    else:
        moved = F.when(F.col("check") != F.col("lo"), F.xxhash64("node", "check")).otherwise(F.col("node"))
        joined = signed.join(mixed, F.col("node") == F.col("_node"), "left")
        out = joined.withColumn("node", moved).drop("_node", "lo", "check")
    out._staged_path = signed._staged_path
    return out, mixed


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 1 << 20):
        sets, bounds = shingle_sets(Words(text_array(batch, "text"), lower=True), SHINGLE)
        size = np.diff(bounds)
        keys, sketches = signatures(sets, bounds)
        node, check = ((mix64(_sums(mix64(sets ^ salt), bounds) + size.astype(np.uint64))).view(np.int64) for salt in _SALTS)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(size), pa.array(node, mask=size == 0), pa.array(check), _lists(keys), _lists(sketches), _short(sets, bounds)],
                                         ["doc_id", "text_key", "n_shingles", "node", "check", "bands", "sketch", "short"])


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose full shingle sets are alike enough."""
    for batch in slices(batches, "text", 2 << 20):
        sides = [shingle_sets(Words(text_array(batch, c), lower=True), SHINGLE) for c in ("text", "other")]
        linked = []
        for i in range(batch.num_rows):
            x, y = (sets[bounds[i]:bounds[i + 1]] for sets, bounds in sides)
            common = len(np.intersect1d(x, y, assume_unique=True))
            linked.append(100 * common >= PERCENT * (len(x) + len(y) - common) and common > 0)
        yield batch.select(["a", "b", "ca", "cb"]).filter(pa.array(linked, pa.bool_()))


def _near(best_only: bool) -> Callable:
    """Pairs (a, b, bits) of different components (ca, cb) inside each run of equal (key, i, j) that the sketches don't
    rule out; best_only: for each node the likeliest of them."""
    def pairs(rows: pa.Table) -> pa.RecordBatch:
        node, group, size, left = (rows.column(c).to_numpy() for c in ("node", "component", "n_shingles", "left"))
        sketch = rows.column("sketch").combine_chunks().flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(node), -1)
        whole = (rows.column("i")[0] == rows.column("j")[0])
        if not best_only:
            short = rows.column("short").to_pylist()
            values, has = np.frombuffer(b"".join(short), "<u2"), np.zeros(1 << 16, bool)
            starts = np.concatenate([[0], np.cumsum([len(v) // 2 for v in short])])
        x = np.arange(len(node)) if whole else np.flatnonzero(left)
        y = np.arange(len(node)) if whole else np.flatnonzero(~left)
        a, b, bits = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]  # a, b: positions
        for k in x:
            z = (y if best_only else y[y > k]) if whole else y
            z = z[(group[z] != group[k]) & (100 * np.minimum(size[z], size[k]) >= PERCENT * np.maximum(size[z], size[k]))]
            if not len(z):
                continue
            d = np.bitwise_count(sketch[z] ^ sketch[k]).sum(1).astype(np.int64)
            near = np.flatnonzero(d <= MOST_BITS)
            if best_only and len(near):
                near = near[[np.argmin(d[near])]]
            elif len(near):  # an upper bound of the common shingles rules out all but the pairs about to be confirmed
                has[:] = False
                has[values[starts[k]:starts[k + 1]]] = True
                most = np.add.reduceat(has[values], starts[:-1], dtype=np.int64)[z[near]]
                near = near[100 * most >= PERCENT * (size[z[near]] + size[k] - most)]
            a.append(np.full(len(near), k)), b.append(z[near]), bits.append(d[near])
        a, b, bits = (np.concatenate(c) for c in (a, b, bits))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (node[a], node[b], bits, group[a], group[b])], ["a", "b", "bits", "ca", "cb"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        last = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            names = list(zip(*(table.column(c).to_pylist() for c in ("key", "i", "j"))))
            cuts = [0, *(k for k in range(1, len(names)) if names[k] != names[k - 1]), len(names)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if held and names[a] != last:
                    yield pairs(pa.concat_tables(held))
                    held = []
                held.append(table.slice(a, b - a))
                last = names[a]
        if held:
            yield pairs(pa.concat_tables(held))
    return run


_DIFFERENT_BITS = "aggregate(zip_with(sketch_a, sketch_b, (x, y) -> bit_count(x ^ y)), 0, (s, v) -> s + v)"


def _sift(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b, bits) of the pairs that sizes and sketches don't rule out."""
    a, b = (nodes.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}")) for x in "ab")
    both = pairs.join(a, "a").join(b, "b").where(f"100 * least(n_a, n_b) >= {PERCENT} * greatest(n_a, n_b)")
    return both.withColumn("bits", F.expr(_DIFFERENT_BITS)).where(F.col("bits") <= MOST_BITS).select("a", "b", "bits")


def _confirmed(pairs: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b, ca, cb) that are linked, by the full sets of one text of each node."""
    ids = nodes.select("node", "doc_id", "text_key")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(ids, "node")
    own = needed.select("node", F.col("doc_id").alias("_d"), F.col("text_key").alias("_k"))
    found = texts.join(own, (F.col("doc_id") == F.col("_d")) & (F.col("text_key") == F.col("_k"))).dropDuplicates(["doc_id", "text_key"]).select("node", "text")
    first = pairs.select("a", "b", "ca", "cb").join(found.select(F.col("node").alias("a"), "text"), "a")
    both = first.join(found.select(F.col("node").alias("b"), F.col("text").alias("other")), "b")
    return both.select("a", "b", "ca", "cb", "text", "other").mapInArrow(_confirm, "a long, b long, ca long, cb long")


def _ordered(pairs: DataFrame) -> DataFrame:
    """The different pairs (a, b), a < b, with their components (the lesser first, as links are the same both ways)."""
    return pairs.select(*(f(*x).alias(x[k]) for x in (("a", "b"), ("ca", "cb")) for k, f in enumerate((F.least, F.greatest)))).dropDuplicates(["a", "b"])


def _likeliest(pairs: DataFrame, n: int) -> DataFrame:
    """(a, b, ca, cb), a < b: of each node's partners (a bounded number) the n likeliest."""
    nearest = F.slice(F.array_sort(F.collect_set(F.struct("bits", "b", "cb"))), 1, n)
    picked = pairs.groupBy("a").agg(nearest.alias("s"), F.min("ca").alias("ca")).select("a", "ca", F.explode("s").alias("s"))
    return _ordered(picked.select("a", "ca", "s.b", "s.cb"))


def _merged(placed: DataFrame, links: DataFrame) -> DataFrame:
    """``placed`` with the components that the links join made one."""
    whole = components(links.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    met = placed.join(whole.select(F.col("node").alias("_c"), F.col("component").alias("_whole")), F.col("component") == F.col("_c"), "left")
    out = stage(met.withColumn("component", F.coalesce("_whole", "component")).drop("_c", "_whole"), "placed")
    release(placed, whole, links)
    return out


def _in_buckets(placed: DataFrame, nodes: DataFrame, best_only: bool) -> DataFrame:
    """(a, b, bits, ca, cb) of the likely pairs of different components that share a bucket.

    Buckets of one component have none; best_only: buckets of two nodes are left out, those were compared already.  A
    bucket is compared in pieces of about BLOCK nodes and BLOCK_SHINGLES shingles, two at a time, so none is gathered
    whole.
    """
    bands = placed.select(F.explode("bands").alias("key"), "node", "component", "n_shingles")
    open_ = (bands.groupBy("key").agg(F.count("*").alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi"), F.sum("n_shingles").alias("all"))
             .where(f"n > {2 if best_only else 1} and lo != hi").select(F.col("key").alias("_key"), F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("all") / BLOCK_SHINGLES)).cast("int").alias("pieces")))
    members = (bands.join(open_, F.col("key") == F.col("_key")).drop("_key")
               .withColumn("own", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int"))
               .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
               .select("key", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), (F.col("own") <= F.col("with")).alias("left"), "node", "component", "n_shingles"))
    ready = members.join(nodes.select("node", "sketch", *(() if best_only else ("short",))), "node").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    columns = ready.select("key", "i", "j", "left", "node", "component", "n_shingles", "sketch", *(() if best_only else ("short",)))
    return columns.mapInArrow(_near(best_only), "a long, b long, bits long, ca long, cb long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    Shingles are of five lower-case words (fewer words: the sequence as one).  A null, empty or blank text has no
    shingles and is linked with nothing; texts with equal sets are linked whatever their spelling of white space.
    A row that repeats a doc_id is a document of its own under that id; a row without a doc_id is its own
    component, null, and kept (no copies can be told apart there).  An empty table gives an empty result.  Other
    columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long"), "text").withColumn("text_key", F.xxhash64("text"))
    signed = stage(texts.mapInArrow(_sign, "doc_id long, text_key long, n_shingles long, node long, check long, bands array<long>, sketch array<long>, short binary"), "signatures", TEXT_ROWS)
    signed, mixed = _told_apart(signed)
    real = signed.where("node is not null and doc_id is not null")
    # one node for each different set, shown by its least document
    shown = F.struct("doc_id", "text_key", "n_shingles", "bands", "sketch", "short")
    nodes = stage(real.groupBy("node").agg(F.min_by(shown, "doc_id").alias("s")).select("node", "s.*"), "nodes")
    sets = stage(signed.select("doc_id", "n_shingles", "node"), "sets")
    release(signed, mixed)
    bands = nodes.select(F.explode("bands").alias("key"), "node")
    # every node against one member of each of its buckets; the key decides which, so it differs from band to band
    turned = F.col("node").bitwiseXOR(F.xxhash64("key"))
    hubs = bands.groupBy("key").agg(F.min(turned).alias("t"), F.count("*").alias("n")).where("n > 1").select(F.col("key").alias("_key"), F.col("t").bitwiseXOR(F.xxhash64("key")).alias("b"))
    met = bands.join(hubs, F.col("key") == F.col("_key")).where("node != b")
    stars = met.groupBy(F.col("node").alias("a")).agg(F.collect_set("b").alias("b")).select("a", F.explode("b").alias("b"))  # BANDS at most
    sifted = _sift(stars, nodes).select("a", "b", "bits", F.col("a").alias("ca"), F.col("b").alias("cb"))
    tested = stage(_likeliest(sifted, FIRST), "best")
    links = stage(_confirmed(tested, nodes, texts), "links", TEXT_ROWS)
    placed = _merged(nodes.select("node", "n_shingles", "bands", F.col("doc_id").alias("least"), F.col("node").alias("component")), links)
    # each node's likeliest partners of another component among all that share a bucket with it
    closer = stage(_likeliest(_in_buckets(placed, nodes, True), FIRST).join(tested, ["a", "b"], "left_anti"), "closer", NODE_ROWS)
    placed = _merged(placed, stage(_confirmed(closer, nodes, texts), "links", TEXT_ROWS))
    # every pair that is still likely and between components
    near = _ordered(_in_buckets(placed, nodes, False))
    rest = stage(near.join(tested.union(closer), ["a", "b"], "left_anti"), "rest", NODE_ROWS)
    placed = _merged(placed, stage(_confirmed(rest, nodes, texts), "links", TEXT_ROWS))
    release(nodes, tested, closer, rest)
    of = placed.select("node", F.col("component").alias("whole"), "least")
    smallest = of.groupBy("whole").agg(F.min("least").alias("component_id"))
    named = of.join(smallest, "whole").select(F.col("node").alias("_n"), "component_id")
    out = sets.join(named, (F.col("node") == F.col("_n")) & F.col("doc_id").isNotNull(), "left")
    own = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near-duplicates, with their columns: of each component the document with the least
    doc_id stays.  Rows that repeat its doc_id are that document and stay with it; rows without a doc_id stay."""
    kept = near_duplicates(docs).where("kept").select(F.col("doc_id").alias("_kept")).where("_kept is not null").distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.struct("*").alias("_row"))
    return rows.join(kept, F.col("_id") == F.col("_kept"), "left").where(F.col("_kept").isNotNull() | F.col("_id").isNull()).select("_row.*")
