import random

import numpy as np
import pyarrow as pa
import pytest

from glossa.llm import quality as Q
from glossa.llm import toxicity as T

rng = random.Random(1)
VOCAB = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 8))) for _ in range(500)]


def sentence(n):
    return (" ".join(rng.choice(VOCAB) for _ in range(n))).capitalize() + "."


@pytest.fixture(scope="module")
def corpus(spark):
    docs, labels = [], []
    for i in range(600):
        good, toxic = i % 3 != 0, i % 5 == 0
        text = "\n".join(sentence(rng.randint(6, 14)) for _ in range(rng.randint(2, 9)))
        if toxic:
            text += " You are a pathetic idiot. They are zorgling trash." if i % 2 else " " + " ".join(f"zorg{rng.choice(VOCAB)}" for _ in range(4))
        if not good:
            text = " ".join(w + "$$$" for w in text.split()) if i % 2 else (text.split()[0] + " ") * 80
        docs.append((i, text))
        labels.append((i, int(good), int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def accuracy(scored, labels, column):
    rows = scored.join(labels, "doc_id").where("held_out").select("predicted", column).collect()
    assert len(rows) > 100
    return np.mean([r[0] == r[1] for r in rows])


def test_held_out_accuracy(corpus):
    docs, labels = corpus
    assert accuracy(Q.score(docs, labels), labels, "quality") > 0.95
    assert accuracy(T.score(docs, labels), labels, "toxic") > 0.95


def test_held_out_labels_and_other_columns_teach_nothing(spark, corpus):
    from pyspark.sql import functions as F

    docs, labels = corpus
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    one = {r.doc_id: (r.score, r.held_out) for r in Q.score(docs, labels).collect()}
    other = {r.doc_id: (r.score, r.held_out) for r in Q.score(docs.withColumn("source", F.lit("x")), turned).collect()}
    assert one.keys() == other.keys() and all(one[k][1] == other[k][1] and abs(one[k][0] - other[k][0]) < 1e-9 for k in one)
    import zlib
    assert all(h == (zlib.crc32(str(k).encode()) % 3 == 1) for k, (_, h) in one.items())


def test_odd_rows(spark, odd, empty, corpus):
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 1), (3, 0, 1), (7, None, None), (None, 1, 1), (8, 1, 0), (2 ** 40, 0, 1), (10, 1, 0), (6, 0, 1)], "doc_id long, quality int, toxic int")
    for scored in (Q.score(odd, labels), T.score(odd, labels), Q.score(odd, labels.limit(0)), T.score(odd, labels.limit(0))):
        rows = scored.collect()
        assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id == 9}) == 1 and all(not r.held_out for r in rows if r.doc_id is None)
    assert Q.score(empty, labels).count() == 0 and T.score(empty, labels).count() == 0
    kept = Q.keep_good(odd, labels)
    assert kept.columns == odd.columns and Q.keep_good(empty, labels).count() == 0
    docs, known = corpus
    good = {r.doc_id for r in Q.score(docs, known).where("predicted = 1").collect()}
    assert {r.doc_id for r in Q.keep_good(docs, known).collect()} == good


def test_isotonic_levels():
    got = Q.isotonic(np.arange(6), np.array([0, 2, 1, 1, 4, 3.0]), np.full(6, 4.0))
    assert got.tolist() == pytest.approx([0, 1 / 3, 1 / 3, 1 / 3, 0.875, 0.875])


def test_scopes_of_the_grammar():
    def features(text):
        return T.clause_features(pa.array([text], pa.large_string()), T.Lexicon())[0]

    def scope(text):
        return np.flatnonzero(features(text)[:2 * T.N_MARKS]).tolist()

    assert scope("what an idiot") == [0]
    assert scope("you are an idiot") == [4] and scope("you are not an idiot") == [6]
    assert scope("he said you idiot") == [5]
    assert scope("not here. you idiot") == [4]  # a clause ends the scopes
    assert scope("I will kill you") == [20] and scope("you will die") == [16] and scope("to kill time") == [12]
    assert scope("idiots like you") == [8] and scope("what a moron he is") == [8] and scope("not idiots like you") == [10]
    assert scope("idiot one two three four you") == [0]  # out of the target's reach
    assert scope("no idiot like you, he said") == [11] and scope("you idiot wrote me") == [5]
    assert scope("not one two three four idiot") == [0]  # out of the negation's reach
    assert not features("a calm and clean text").any() and not features("").any()


def test_matches_equal_a_reading_without_machines():
    """The composed machines against the rules read word by word, on random clauses."""
    rng = np.random.default_rng(3)
    for _ in range(400):
        kinds = rng.choice(T.N_SYMBOLS, rng.integers(0, 14), p=[0.4, 0.12, 0.12, 0.08, 0.18, 0.1]).tolist()
        want = []
        for i, k in enumerate(kinds):
            if k not in (T.INSULT, T.THREAT):
                continue
            gap = T.INSULT_GAP if k == T.INSULT else 0
            j = i - 1
            while j >= 0 and i - 1 - j < gap and kinds[j] == T.OTHER:
                j -= 1
            event = T.GOES_ON if j >= 0 and kinds[j] == k else T.BEGINS
            aim = 1 if T.TARGET in kinds[:i] else 2 if T.TARGET in kinds[i + 1:i + 1 + T.AIM_REACH] else 0
            denied = T.NEGATION in kinds[max(0, i - T.NEGATION_REACH):i]
            reported = T.REPORT in kinds[:i] + kinds[i + 1:]
            want.append((i, (k == T.THREAT) * T.N_MARKS + 4 * aim + 2 * denied + reported, event))
        assert T.matches(kinds) == want


def test_a_phrase_is_one_match():
    one, two = (T.clause_features(pa.array([t], pa.large_string()), T.Lexicon())[0] for t in ("you stupid old fool", "you stupid very old fool"))
    assert one[-3] == np.log1p(1) and two[-3] == np.log1p(2) and one[4] == two[4] == np.log1p(6)


def test_statistics_equal_a_count_by_hand(monkeypatch):
    import re

    monkeypatch.setattr(Q, "CHUNK", 7)  # counts run over chunk borders
    texts = ["", "One two. ONE $two\n\nOne two. ONE $two\nlast | line", " \n ", "a", "é è\n" * 5 + "É", "x y x y x y"]
    got = Q.statistics(pa.array(texts, pa.large_string()))
    for text, row in zip(texts, got):
        s = dict(zip(Q.STATS, row))
        raw, words = text.encode(), re.findall(rb"[^\x20\x09-\x0D]+", text.encode())
        if not words:
            assert not row.any()
            continue
        lines = text.split("\n")
        want = {"log_words": np.log1p(len(words)), "word_length": np.mean([len(w) for w in words]), "word_spread": np.std([len(w) for w in words]),
                "distinct": len(set(words)) / len(words) ** 0.5, "top_word": max(map(words.count, words)) / len(words),
                "distinct_pairs": len(set(zip(words, words[1:]))) / len(words),                 "line_words": np.log1p(len(words) / len(lines)), "single_words": np.mean([len(w) <= 2 for w in words]),
                "caps_words": np.mean([w.isupper() and len(w) > 1 for w in words])}
        want |= {f"share_{c}": sum(b in of for b in raw) / len(raw) for c, of in Q.CLASSES.items()}
        assert all(abs(s[k] - v) < 1e-9 for k, v in want.items()), (text, s, want)
