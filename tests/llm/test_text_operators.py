import hashlib
import itertools
import math
import random
import re

import numpy as np

from glossa.llm import decontaminate as D
from glossa.llm import lz_fingerprint as L
from glossa.llm import substring_dedup as S
from tests.llm.conftest import PASSAGE


# --- fingerprints
def phrases(text):
    seen, phrase = set(), ""
    for c in text:
        phrase += c
        if phrase not in seen:
            seen.add(phrase)
            phrase = ""
    return seen


def similar(a, b):
    a, b = phrases(a), phrases(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_equal_brute_force(odd, empty):
    rows = sorted(((r.doc_id, r.text or "") for r in odd.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    got = L.fingerprints(odd).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.edited_sha256): r for r in got}
    prints = {}
    ids = [d for d, _ in rows]
    for k, (d, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        if ids.count(d) > 1 or ids.count(ids[(k + 1) % len(rows)]) > 1:
            continue  # ties follow each other in an order of their own
        n = len(t)
        edited = t[:n - n // 4] + following[:n // 4]
        r = by[d, hashlib.sha256(edited.encode()).hexdigest()]
        assert r.n_chars == n
        assert abs(r.near_edited - similar(t, edited)) < 0.2 and abs(r.near_next - similar(t, following)) < 0.2
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint
    assert len({r.fingerprint for r in got if r.n_chars == 9}) == 1  # equal texts
    assert L.fingerprints(empty).count() == 0
    lone = L.fingerprints(odd.where("doc_id = 1")).collect()
    assert len(lone) == 1 and lone[0].near_next == 1


def test_parse_and_hashes():
    rng = random.Random(2)
    for text in ["", "a", "aaaa", "abababab", *("".join(rng.choice("ab🙂é") for _ in range(300)) for _ in range(5))]:
        seen = set()
        ends = L.phrase_ends(text, seen)
        assert seen == phrases(text)
        parts = [text[a:b] for a, b in zip([0, *ends], ends)]
        h = L.phrase_hashes(text, ends).tolist()
        assert len(set(zip(parts, h))) == len(set(parts)) == len(set(h))
        assert L.Parsed(text).edited("xyz" * 50)[1] == L.Parsed(L.Parsed(text).edited("xyz" * 50)[0]).print


# --- substring dedup
def brute_windows(rows):
    first = {}
    for d, t in rows:
        if d is not None:
            w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
            for i in range(len(w) - 12):
                k = tuple(w[i:i + 13])
                first[k] = min(first.get(k, d), d)
    out = []
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        keep = [True] * len(w)
        if d is not None:
            for i in range(len(w) - 12):
                if first[tuple(w[i:i + 13])] < d:
                    keep[i:i + 13] = [False] * 13
        left = " ".join(x for x, k in zip(w, keep) if k)
        out.append((d, len(w), keep.count(False), hashlib.sha256(left.encode()).hexdigest()))
    return sorted(out, key=str)


def test_substring_dedup_equals_brute_force(spark, odd, empty, monkeypatch):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted(map(tuple, S.dedup_substrings(odd).collect()), key=str) == brute_windows(rows)
    assert S.dedup_substrings(empty).count() == 0
    rng = random.Random(4)
    pool = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(10, 60))) for _ in range(12)]
    rows = [(d, " ".join(rng.choice(pool) if rng.random() < 0.5 else rng.choice("xyz") + str(rng.random()) for _ in range(rng.randint(0, 25)))) for d in range(80)]
    rows += [(100, "again " * 40), (101, "again " * 30), (102, "again " * 30)]
    rng.shuffle(rows)
    monkeypatch.setattr(S, "BUCKET_BYTES", 4000)  # several buckets
    got = S.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert sorted(map(tuple, got.collect()), key=str) == brute_windows(rows)


def test_packing_round_trip():
    x, y = np.array([5, 2 ** 63, 0], "<u8"), np.array([1, 2 ** 31, 3], "<u4")
    got = S.unpack(S.pack(a=x, b=y), a="<u8", b="<u4")
    assert got["a"].tolist() == x.tolist() and got["b"].tolist() == y.tolist()
    assert S.unpack(S.pack(a=x[:0]), a="<u8")["a"].tolist() == []


# --- decontamination
def test_leaks_are_found_with_substitutions(spark, odd, empty, monkeypatch):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijk") for _ in range(6))
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate((15, 20, 40, 59, 7, 3))] + [(6, None), (7, "")]
    docs, leaks = [], set()
    for d in range(60):
        w = [word() for _ in range(rng.randint(0, 200))]
        if d % 4 == 0:
            k = rng.choice((0, 1, 2, 3, 4))
            p = items[k][1].upper().split() if d % 8 else [x + "," for x in items[k][1].split()]
            if k != 4:
                for i in range(3, len(p), 7):
                    p[i] = word()
            at = rng.randint(0, len(w))
            w[at:at] = p
            leaks.add((d, k))
        elif d % 4 == 1:
            w += items[2][1].split()[:6] + [word()] + items[3][1].split()[:6]  # too little of either
        docs.append((d, " ".join(w)))
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    for size in (D.BLOCK_WORDS, 50):  # in one block, and in several
        monkeypatch.setattr(D, "BLOCK_WORDS", size)
        got = D.contamination(table, bench).collect()
        assert {(r.doc_id, i) for r in got for i in r.item_ids} == leaks
        assert {r.doc_id for r in got if not r.contaminated} == {d for d, _ in docs} - {d for d, _ in leaks}
    mine = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    clean = D.decontaminate(odd, mine)
    assert clean.columns == odd.columns
    assert sorted((r.doc_id for r in clean.collect()), key=str) == sorted((4, 5, 6, 7, 8, 9, 9, 10, 2 ** 40, None, None), key=str)
    assert D.decontaminate(odd, mine.limit(0)).count() == odd.count() and D.decontaminate(empty, mine).count() == 0


def longest_run(same):
    """(start, words, same) of the first longest run that meets the rule, trying every run."""
    runs = [(i, j - i, sum(same[i:j])) for i in range(len(same)) for j in range(i + 1, len(same) + 1) if 4 * sum(same[i:j]) >= 3 * (j - i)]
    best = max(runs, key=lambda r: (r[1], -r[0]), default=None)
    return best if best and best[1] >= min(D.MIN_WORDS, len(same)) else None


def test_overlaps_equal_brute_force_at_every_substitution(spark):
    rng = random.Random(8)
    for n in (*range(5, 17), 30):
        own = [f"w{n}x{i}" for i in range(n)]
        seeds = D.Seeds([(1, " ".join(own))])
        masks = [[1] * n, *([int(i != k) for i in range(n)] for k in range(n)), *([int(rng.random() > 0.2) for _ in range(n)] for _ in range(200))]
        masks += [list(map(int, "111111111101011"))] if n == 15 else []
        for same in masks:
            words = D.compared(D.pa.array([" ".join(["before"] * 3 + [w if s else "other" for w, s in zip(own, same)] + ["behind"] * 3)]))[0]
            want = longest_run(same)
            assert seeds.overlap(words, 0, 3) == (want and (want[0] + 3, *want[1:])), (n, same)
    item = [f"word{i}" for i in range(13)]
    docs = [(k, " ".join(["before", *item[:k], "other", *item[k + 1:], "behind"])) for k in range(13)]
    got = D.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"))
    assert {(r.doc_id, r.longest) for r in got.collect()} == {(k, 13) for k in range(13)}


def test_short_items_are_hit_wherever_words_are_substituted():
    for n in range(D.MIN_ITEM, D.SHORT_ITEM + 1):
        own = [f"w{n}x{i}" for i in range(n)]
        seeds = D.Seeds([(1, " ".join(own))])
        allowed = n - math.ceil(D.MIN_SAME * n)
        for gone in itertools.combinations(range(n), allowed):
            words = seeds.words.copy()
            words[list(gone)] = 7
            items, begins = seeds.hits(words)
            assert (items[begins == 0] == 0).any(), (n, gone)
            assert seeds.overlap(words, 0, 0)
    few = D.Seeds([(1, "a b c d")])
    assert not len(few.keys) and not len(few.hits(few.words)[0])


def test_repeated_benchmark_rows_are_one_item(spark):
    bench = spark.createDataFrame([(1, PASSAGE), (2, PASSAGE), (None, PASSAGE)] * 50, "item_id long, text string")
    (block,) = D.blocks(bench)
    assert block.count() == 3 and sorted(map(str, D.seeds_of(block).ids)) == ["1", "2", "None"]


def test_items_without_an_id_are_judged_like_others(spark, monkeypatch):
    a, b = (" ".join(f"{c}{i}" for i in range(14)) for c in "ab")
    bench = spark.createDataFrame([(None, a), (None, b), (None, None), (3, a), (3, a)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x " + a), (2, b + " y"), (3, "z " * 30), (None, a), (4, None)], "doc_id long, text string")
    for size in (D.BLOCK_WORDS, 10):  # in one block, and in several
        monkeypatch.setattr(D, "BLOCK_WORDS", size)
        got = {r.doc_id: (r.contaminated, r.n_overlaps, r.longest, r.item_ids) for r in D.contamination(docs, bench).collect()}
        assert got == {1: (True, 2, 14, [3, None]), 2: (True, 1, 14, [None]), 3: (False, 0, 0, []), None: (True, 2, 14, [3, None]), 4: (False, 0, 0, [])}
        assert sorted(r.doc_id for r in D.decontaminate(docs, bench).collect()) == [3, 4]


def test_one_block_of_the_benchmark_at_a_time(spark, odd, monkeypatch):
    bench = spark.createDataFrame([(1, PASSAGE), *((k, " ".join(f"w{k}x{i}" for i in range(20))) for k in range(2, 12))], "item_id long, text string")
    rows = lambda df: sorted((r.doc_id, r.text, r.found) for r in df.select("doc_id", "text", "found").collect() if r.found)
    whole = D.overlaps(odd, bench, "found")
    monkeypatch.setattr(D, "BLOCK_WORDS", 50)
    assert len(D.blocks(bench)) > 2
    parts = D.overlaps(odd, bench, "found")
    assert parts.columns == whole.columns and parts.count() == odd.count()
    assert parts._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1  # the others are done and staged
    assert rows(parts) == rows(whole) != []
