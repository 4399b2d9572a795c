import collections
import re

import pytest

from glossa.llm import mixing as M


def level(sizes, budget=1.5, cap=2.0):
    """Targets by their definition: share the budget by weight, cap, share the excess again, until none is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), budget * sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total >= cap * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in free}
        for s in over:
            target[s] = cap * sizes[s]
        left -= sum(target[s] for s in over)
        free -= over
    return target


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(rows, got):
    """rows: (doc_id, source, text)."""
    sizes = collections.Counter()
    for _, s, t in rows:
        sizes[s] += words(t)
    want = level(sizes)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted((d is None, d or 0, words(t)) for d, _, t in rows)
    taken = collections.Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1


def test_sources_meet_their_targets(spark):
    rows = [(i, f"s{i % 7}" if i % 3 else "hot", "w " * (1 + i * 37 % 91)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = M.mix(docs).collect()
    check(rows, got)
    again = M.mix(docs.repartition(7)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)


def test_odd_rows(odd, empty):
    rows = [(r.doc_id, r.source, r.text) for r in odd.collect()]
    check(rows, M.mix(odd).collect())
    assert M.mix(empty).count() == 0
    out = M.mixed_documents(odd)
    assert out.columns == odd.columns
    served = collections.Counter()
    for r in out.collect():
        served[r.source] += words(r.text)
        assert r.node == "clash-node"
    sizes = collections.Counter()
    for _, s, t in rows:
        sizes[s] += words(t)
    for s, t in level(sizes).items():
        assert abs(served[s] - t) <= 1
    assert M.mixed_documents(empty).count() == 0


def test_the_mix_is_one_queue(spark):
    rows = [(i, "ab"[i % 2], "w " * 10) for i in range(60)]
    sizes = M.document_sizes(spark.createDataFrame(rows, "doc_id long, source string, text string"))
    queue = sorted(M.fair_schedule(sizes, M.source_targets(sizes)).collect(), key=lambda r: r.position)
    assert [r.position for r in queue] == [sum(x.taken for x in queue[:k]) for k in range(len(queue))]
    assert [r.finish for r in queue] == sorted(r.finish for r in queue)


def test_the_queue_ends_at_the_total_budget(spark):
    """Order and cut against the queue by its definition, sources of unequal sizes and one very long document."""
    rows = [(i, f"s{i % 5}" if i % 4 else None, "w " * (1 + i * 53 % 47)) for i in range(150)] + [(900, "s1", "w " * 3000)]
    sizes = M.document_sizes(spark.createDataFrame(rows, "doc_id long, source string, text string"))
    targets = M.source_targets(sizes)
    queue = sorted(M.fair_schedule(sizes, targets).collect(), key=lambda r: r.position)
    want = {r.source: r.target for r in targets.collect()}
    budget = int(round(sum(want.values()), 6))
    assert sum(r.taken for r in queue) == budget
    assert [r.finish for r in queue] == sorted(r.finish for r in queue)
    # by definition: every source gives the words finished at virtual time one, then single words by their finish
    share = {s: int(t) for s, t in want.items()}
    for s in sorted(want, key=lambda s: ((int(want[s]) + 1) / want[s], s is None, s or ""))[:budget - sum(share.values())]:
        share[s] += 1
    got = collections.Counter()
    for r in queue:
        got[r.source] += r.taken
    assert got == share


def test_levels_when_all_sources_are_capped(spark):
    sizes = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, None, 5)], "doc_id long, source string, size long")
    assert {r.source: r.target for r in M.source_targets(sizes, budget=3.0).collect()} == {"a": 20.0, "b": 40.0, None: 10.0}
    assert sum(r.taken for r in M.fair_schedule(sizes, M.source_targets(sizes, budget=3.0)).collect()) == 70
