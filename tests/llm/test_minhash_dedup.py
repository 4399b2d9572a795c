import collections
import random
import re

import numpy as np
import pyarrow as pa

from glossa.llm import components as K
from glossa.llm import minhash_dedup as M
from glossa.llm.components import components

LOWER = {i: chr(i).lower() for i in range(65, 91)}


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """component of each position: single linkage over all pairs."""
    sets = [shingles(t) for _, t in rows]
    boss = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is not None and rows[j][0] is not None and sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = boss[i], boss[j]
                boss = [b if x == a else x for x in boss]
    least = collections.defaultdict(list)
    for (d, _), b in zip(rows, boss):
        least[b].append(d)
    return [(d, len(s), None if d is None else min(least[b])) for (d, _), s, b in zip(rows, sets, boss)]


def test_components_equal_brute_force(spark):
    rng = random.Random(3)
    words = [f"v{i}" for i in range(400)]
    rows = []
    for g in range(12):
        base = [rng.choice(words) for _ in range(rng.choice((4, 30, 120)))]
        for _ in range(rng.choice((1, 3, 14))):
            w = list(base)
            for _ in range(rng.choice((0, 0, 1, 2, 3))):
                w[rng.randrange(len(w))] = rng.choice(words)
            rows.append((len(rows), rng.choice((" ", "  ", "\n")).join(w)))
    rng.shuffle(rows)
    got = sorted(tuple(r) for r in M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_shingles", "component_id").collect())
    assert got == sorted(brute(rows))


def test_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    out = M.near_duplicates(odd)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()), key=key)
    assert got == sorted(brute(rows), key=key)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out.collect() if r.doc_id is not None)
    assert M.near_duplicates(empty).count() == 0
    kept = M.keep_one(odd)
    assert kept.columns == odd.columns
    order = lambda d: (d is None, d or 0)
    assert sorted((r.doc_id for r in kept.collect()), key=order) == sorted((d for d, _, c in brute(rows) if d == c), key=order)


def test_a_sketch_estimates_high_similarity():
    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(0, 2 ** 63, 3000, dtype=np.uint64))[:2800]
    bits = []
    for _ in range(20):
        common, rest = base[:2400], rng.integers(0, 2 ** 63, 800, dtype=np.uint64)
        x, y = np.sort(np.concatenate([common, rest[:400]])), np.sort(np.concatenate([common, rest[400:]]))  # 2400 of 3200
        _, s = M.signatures(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]))
        bits.append(int(np.bitwise_count(s[0] ^ s[1]).sum()))
    assert 100 < np.mean(bits) < 127 and max(bits) <= M.MOST_BITS


def test_long_chain_is_one_component(spark):
    n = 200
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(5, 5), (None, 3), (7, 8)], "a long, b long")
    assert {(r.node, r.component) for r in components(edges).collect()} == {(i, 0) for i in range(1, n + 1)}
    assert components(edges.limit(0)).count() == 0


def test_unlike_sets_never_share_a_node(spark):
    rows = [(1, 10, 5), (2, 10, 5), (3, 10, 7), (4, 10, 7), (5, 10, 9), (6, 11, 5), (7, None, 0), (8, None, 3)]
    signed = M.stage(spark.createDataFrame(rows, "doc_id long, node long, check long"), "signed")
    out, mixed = M._told_apart(signed)
    node = {r.doc_id: r.node for r in out.collect()}
    assert out.columns == ["doc_id", "node"] and len(node) == 8 and mixed.count() == 1
    assert node[1] == node[2] == 10 and node[6] == 11 and node[7] is None and node[8] is None
    assert node[3] == node[4] and len({node[1], node[3], node[5], node[6]}) == 4
    same, none = M._told_apart(M.stage(signed.where("check = 5"), "signed"))
    assert {r.doc_id: r.node for r in same.collect()} == {1: 10, 2: 10, 6: 11} and none.count() == 0


def pairs_of(edges):
    return pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], ["a", "b"])


def least_reachable(edges):
    boss = {x: x for e in edges for x in e}
    for a, b in edges:
        x, y = sorted((boss[a], boss[b]))
        boss = {k: x if v == y else v for k, v in boss.items()}
    return {(k, v) for k, v in boss.items() if k != v}


def test_a_piece_of_edges_becomes_stars(monkeypatch):
    rng = random.Random(7)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(50)] + [(2 ** 62, -5)]
    edges = [(max(e), min(e)) for e in edges]
    whole = list(K._contract(iter([pairs_of(edges[:90]), pairs_of([]), pairs_of(edges[90:])])))
    assert len(whole) == 1 and set(zip(*whole[0].to_pydict().values())) == least_reachable(edges)
    monkeypatch.setattr(K, "HELD", 32)
    parts = list(K._contract(iter([pairs_of(edges)])))
    assert len(parts) > 5 and least_reachable([e for b in parts for e in zip(*b.to_pydict().values())]) == least_reachable(edges)


def test_edges_of_several_pieces_take_rounds(spark, monkeypatch):
    monkeypatch.setattr(K, "HELD", 16)  # here the driver's: a task for every 16 edges
    rng = random.Random(11)
    edges = [(i, i + 1) for i in range(120)] + [(rng.randrange(500, 900), rng.randrange(500, 900)) for _ in range(250)]
    rng.shuffle(edges)
    got = components(spark.createDataFrame(edges + edges[:40], "a long, b long").repartition(6)).collect()
    assert {(r.node, r.component) for r in got} == least_reachable(edges) and len(got) == len(least_reachable(edges))


def test_few_links_need_no_rounds(spark, monkeypatch):
    """A chain within one piece is settled without shuffles; each round of stars has several."""
    monkeypatch.setattr(K, "_star", None)
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long").repartition(7)
    assert {(r.node, r.component) for r in components(edges).collect()} == {(i, 0) for i in range(1, 301)}


def test_tasks_of_a_group_of_near_copies(spark):
    """A group of near copies takes few shuffles, whatever their partitions: 1,325 tasks here, 3,495 before."""
    rng = random.Random(17)
    words = [f"v{i}" for i in range(3000)]
    base = [rng.choice(words) for _ in range(120)]
    rows = [(i, " ".join(base[:60 + i % 3] + [f"n{i}"] + base[61 + i % 3:])) for i in range(150)] + [(1000 + i, " ".join(rng.choices(words, k=80))) for i in range(50)]
    held = {"spark.sql.shuffle.partitions": "100", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        spark.sparkContext.setJobGroup("near copies", "")
        got = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in was.items():
            spark.conf.set(k, v)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute(rows))
    of = spark.sparkContext.statusTracker()
    stages = {s for j in of.getJobIdsForGroup("near copies") for s in of.getJobInfo(j).stageIds}
    tasks = sum(x.numCompletedTasks for x in map(of.getStageInfo, stages) if x)
    assert 0 < tasks < 2400
