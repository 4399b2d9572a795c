import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from glossa.llm import repetition as R
from glossa.llm.common import Words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def under(words, size):
    """Positions in windows of ``size`` words that are found twice or more."""
    seen = Counter(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    return {i + j for i in range(len(words) - size + 1) if seen[tuple(words[i:i + size])] > 1 for j in range(size)}


def all_repeats(words, least):
    """(first start, words, occurrences) of the substrings that occur twice and can't be extended without losing an occurrence."""
    places = {}
    for i in range(len(words)):
        for j in range(i + least, len(words) + 1):
            places.setdefault(tuple(words[i:j]), []).append(i)
    out = set()
    for s, at in places.items():
        left = {words[i - 1] if i else None for i in at}
        right = {words[i + len(s)] if i + len(s) < len(words) else None for i in at}
        if len(at) > 1 and (len(left) > 1 or left == {None}) and len(right) > 1:
            out.add((at[0], len(s), len(at)))
    return out


def brute(text):
    words = WORD.findall(text or "")
    lines = (text or "").split("\n")
    repeated = len(under(words, 3))
    failed = len(words) < 50 or 100 * repeated > 50 * len(words)
    covered = len(under(words, R.MIN_REPEAT))
    longest = max((n for n in range(1, len(words)) if under(words, n)), default=0) if len(words) < 400 else None
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in R.SYMBOLS for c in text or ""),
            "n_dup_lines": sum(bool(WORD.search(x)) and x in lines[:i] for i, x in enumerate(lines)), "n_repeat_words": repeated,
            "covered_words": covered, "base_failed": failed,
            "longest_repeat": None if longest is None else longest if longest >= R.MIN_REPEAT else 0}


def random_texts(rng, n):
    for _ in range(n):
        vocab = [f"w{i}é" for i in range(rng.choice((2, 5, 40, 400)))]
        words = [rng.choice(vocab) for _ in range(rng.choice((0, 1, 2, 6, 40, 200)))]
        for _ in range(rng.choice((0, 0, 1, 3))):
            if words:
                a = rng.randrange(len(words))
                words[rng.randrange(len(words)):0] = words[a:a + rng.choice((3, 8, 60))]
        yield "".join(w + rng.choice((" ", " ", "\n", "\t", " \n")) for w in words)


def test_counts_equal_brute_force(spark, odd, empty):
    rng = random.Random(2)
    texts = list(random_texts(rng, 120)) + ["a " * 300, "x\ny\n" * 40, "#" * 60 + " | " * 55, " \n ", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for row in R.repetition_rules(docs).collect():
        want = brute(texts[row.doc_id])
        assert {k: row[k] for k, v in want.items() if v is not None} == {k: v for k, v in want.items() if v is not None}
        fine = 100 * row.covered_words <= R.MAX_COVERED_PERCENT * row.n_words and row.longest_repeat <= R.MAX_REPEAT_WORDS
        assert row.kept == (not row.base_failed and fine)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted(((r.doc_id, r.n_words, r.n_repeat_words) for r in R.repetition_rules(odd).collect()), key=key)
    want = [(d, (b := brute(t))["n_words"], b["n_repeat_words"]) for d, t, *_ in ((r.doc_id, r.text) for r in odd.collect()) if len(t or "") < 10_000]
    assert sorted([g for g in got if g[0] not in (7, 8)], key=key) == sorted(want, key=key)
    assert R.repetition_rules(empty).count() == 0 and R.repeats(empty).count() == 0


def test_maximal_repeats_equal_brute_force(spark):
    rng = random.Random(7)
    texts = [t for t in random_texts(rng, 60) if len(t) < 700] + ["a b c d e f a b c d e f a b c d e", "p " * 12]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(-1, None)], "doc_id long, text string")
    for least in (2, 5):
        got = {}
        for r in R.repeats(docs, least).collect():
            got.setdefault(r.doc_id, set()).add((r.start, r.words, r.occurrences))
        assert got == {i: want for i, t in enumerate(texts) if (want := all_repeats(WORD.findall(t), least))}


def test_a_boilerplate_text_goes_and_a_long_clean_one_stays():
    rng = random.Random(1)
    clean = " ".join(f"v{rng.randrange(3000)}" for _ in range(20_000))
    passage = " ".join(f"v{rng.randrange(3000)}" for _ in range(60))
    r = R.repetition(Words(pa.array([clean, clean + " " + passage + " and " + passage, "buy this now at once please " * 30], pa.large_string())))
    assert r.longest_repeat[0] < R.MIN_REPEAT and r.longest_repeat[1] >= 60 and r.covered_words[2] == r.n_words[2]
    assert np.all(r.covered_words[:2] * 100 <= R.MAX_COVERED_PERCENT * r.n_words[:2])
