import math
import random
import re
from collections import Counter

import pyarrow.dataset as ds

from glossa.llm import lexical_search as S
from glossa.llm.common import BATCH_ROWS, batches_of, stage

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: chr(i).lower() for i in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    """(item_id, rank, doc_id, score) by scoring everything."""
    held = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs if terms(t)]
    total, n = sum(x for _, _, x in held), len(held)
    out = []
    for item, text in items:
        scored = []
        for d, tf, size in held:
            m = 25 + 75 * size * n // total
            s = 0
            for t, times in Counter(terms(text)).items():
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * sum(t in c for _, c, _ in held) + 1)))
                s += times * w * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m))
            if s > 0:
                scored.append((-s, d is None, d or 0))
        out += [(item, i + 1, None if none else d, -s) for i, (s, none, d) in enumerate(sorted(scored)[:k])]
    return out


def order(rows):
    return sorted((tuple((x is None, x or 0) for x in r) for r in rows))


def corpus(rng, n):
    vocab = [f"t{i}" for i in range(300)] + ["Été", "naïve", "日本", "X1"]
    weights = [1 / (i + 1) for i in range(len(vocab))]
    for d in range(n):
        size = rng.choice((0, 1, 3, 30, 30, 200, 2000))
        yield d, rng.choice((" ", ", ", "-", "\n", "\x00")).join(rng.choices(vocab, weights, k=size))


def test_ranks_equal_brute_force(spark):
    rng = random.Random(4)
    docs = list(corpus(rng, 400))
    docs += [(docs[5][0], docs[5][1]), (None, docs[6][1]), (None, None), (900, "t1 " * 500), (901, "t1 " * 500)]
    items = [(i, t[:150]) for i, t in list(corpus(rng, 25))] + [(3, "t1 t1 t2"), (None, "naïve été"), (77, None), (78, "--"), (79, "unknownterm")]
    got = S.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
                   spark.createDataFrame(items, "item_id long, text string").repartition(2)).collect()
    assert order(tuple(r) for r in got) == order(brute(docs, items))


def test_queries_in_several_blocks_and_more_results(spark, monkeypatch):
    rng = random.Random(9)
    docs, items = list(corpus(rng, 120)), [(i, t[:80]) for i, t in corpus(rng, 12)]
    monkeypatch.setattr(S, "QUERY_BYTES", 100)
    got = S.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), k=25).collect()
    assert order(tuple(r) for r in got) == order(brute(docs, items, 25))


def test_odd_rows(spark, odd, empty):
    items = spark.createDataFrame([(1, "quick brown fox gate"), (2, "w1 w2 two words"), (3, None)], "item_id long, text string")
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = S.search(odd, items.selectExpr("*", "'x' AS number", "1 AS score")).collect()
    assert order(tuple(r) for r in got) == order(brute(rows, [(r.item_id, r.text) for r in items.collect()]))
    assert S.search(empty, items).count() == 0 and S.search(odd, items.limit(0)).count() == 0
    assert S.search(odd, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_most_documents_are_excluded_by_their_bounds(spark):
    rng = random.Random(5)
    vocab = [f"v{i}" for i in range(5000)]
    docs = spark.createDataFrame([(d, " ".join(rng.choices(vocab, k=80))) for d in range(3000)], "doc_id long, text string").repartition(2)
    items = spark.createDataFrame([(i, " ".join(rng.choices(vocab, k=12))) for i in range(10)], "item_id long, text string")
    scored, pairs = S.rescored(docs, items)
    assert pairs == 30_000 and 100 <= scored < pairs / 10


def test_few_rows_of_the_index_are_held_at_once(spark, monkeypatch):
    sizes = [1 << k for k in range(13)] * 2
    docs = spark.createDataFrame([(d, " ".join(f"w{(d + j) % 5003}" for j in range(size))) for d, size in enumerate(sizes)], "doc_id long, text string").coalesce(1)
    built = S.index(docs)
    groups = [g.num_rows for f in ds.dataset(built._staged_path.removeprefix("file:")).get_fragments() for g in f.row_groups]
    assert sum(groups) > S.INDEX_ROWS >= max(groups)  # a row for each power of two of entries
    assert built.agg({"doc_id": "count"}).first()[0] == sum(groups)

    bounds, limits = {}, []  # what the jobs that hand texts or blocks to Python ran with

    def recorded(df, tag, batch_rows=None, group_rows=None):
        bounds[tag] = (batch_rows, group_rows)
        return stage(df, tag, batch_rows, group_rows)

    def counted(session, rows):
        limits.append(rows)
        return batches_of(session, rows)

    monkeypatch.setattr(S, "stage", recorded)
    monkeypatch.setattr(S, "batches_of", counted)
    usual = spark.conf.get(BATCH_ROWS)
    items = spark.createDataFrame([(1, "w1 w2 w3"), (2, "w4000")], "item_id long, text string")
    got = S.search(docs, items).collect()
    assert order(tuple(r) for r in got) == order(brute([(r.doc_id, r.text) for r in docs.collect()], [(1, "w1 w2 w3"), (2, "w4000")]))
    assert bounds == {"signatures": (S.TEXT_ROWS, S.INDEX_ROWS), "found": (S.INDEX_ROWS, None)} and limits == [S.INDEX_ROWS]
    assert S.TEXT_ROWS <= 2048 and S.INDEX_ROWS <= 16 and spark.conf.get(BATCH_ROWS) == usual
