"""Quality rules: repetition inside a text, by suffix arrays.

The suffixes of every text, word by word, are sorted by prefix doubling; the longest common prefixes of neighbours make
intervals, and an interval whose occurrences are preceded by different words is a maximal repeated substring.  The spans
of the repeats are united; a text is rejected if they cover too large a part of it or one of them is too long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import Words, slices, text_array

#: Repeats of fewer words don't count.
MIN_REPEAT = 5
#: Rejected: repeats cover more than this percentage of the words, or one is of more words than this.
MAX_COVERED_PERCENT = 30
MAX_REPEAT_WORDS = 49
#: The base rules: words a text needs, and the percentage of its words that may lie in repeated windows.
MIN_WORDS = 50
WINDOW = 3
MAX_WINDOW_PERCENT = 50
#: The symbols that are counted.
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"
#: Bytes of text that are sorted at once.
SORTED_BYTES = 2 << 20


@dataclass
class Suffixes:
    """The sorted suffixes of several texts: ``order`` of their starts, and ``common[i]``, the words that the suffixes
    ``order[i - 1]`` and ``order[i]`` have in common (0 between texts, and where it would be fewer than the least asked for)."""

    order: np.ndarray
    common: np.ndarray


def suffixes(codes: np.ndarray, bounds: np.ndarray, least: int) -> Suffixes:
    """Sort the suffixes of each text (``bounds``) of the word codes; common prefixes of ``least`` words or more are found.

    A rank tells the first 2^k words of a suffix, and a text from another.  Each round sorts only the suffixes that are
    still level with another one, by their rank and the rank 2^k words on; the ranks of all rounds are kept, and a
    common prefix is put together from the largest round down.
    """
    n = len(codes)
    if not n:
        return Suffixes(np.zeros(0, np.int64), np.zeros(0, np.int64))
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    end = bounds[1:][owner]
    key = owner * (int(codes.max()) + 1) + codes
    order = np.argsort(key, kind="stable")
    slots = np.arange(n)

    def first_of_run(keys: np.ndarray, at: np.ndarray) -> np.ndarray:
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        return at[np.flatnonzero(new)][np.cumsum(new) - 1]

    rank = np.zeros(n, np.int64)
    rank[order] = first_of_run(key[order], slots)
    rounds = [rank.astype(np.int32 if n < 2 ** 31 else np.int64)]
    step = 1
    while True:
        level = rank[order]
        alone = np.concatenate([[True], level[1:] != level[:-1]]) & np.concatenate([level[1:] != level[:-1], [True]])
        open_ = np.flatnonzero(~alone)
        if not len(open_):
            break
        here = order[open_]
        ahead = here + step
        after = np.where(ahead < end[here], rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = rank[here] * (n + 1) + after
        turn = np.argsort(key, kind="stable")
        order[open_] = here[turn]
        rank = rank.copy()
        rank[here[turn]] = first_of_run(key[turn], open_)
        rounds.append(rank.astype(rounds[0].dtype))
        step *= 2
    common = np.zeros(n, np.int64)
    deep = min(least.bit_length() - 1, len(rounds) - 1)  # neighbours that differ in their first 2^deep words have too little in common
    level = rounds[deep][order]
    at = np.flatnonzero(np.concatenate([[False], level[1:] == level[:-1]])) if deep + 1 < len(rounds) else np.zeros(0, np.int64)
    a, b = order[at - 1], order[at]
    size = np.zeros(len(at), np.int64)
    for k in range(len(rounds) - 1, -1, -1):
        x, y = a + size, b + size
        same = (x < end[a]) & (y < end[b])
        same[same] = rounds[k][x[same]] == rounds[k][y[same]]
        size[same] += 1 << k
    common[at] = np.where(size >= least, size, 0)
    return Suffixes(order, common)


def longest_at(found: Suffixes) -> np.ndarray:
    """For every word of the texts: how many words from there on are found elsewhere in its text."""
    out = np.zeros(len(found.order), np.int64)
    out[found.order] = np.maximum(found.common, np.append(found.common[1:], 0))
    return out


def maximal_repeats(found: Suffixes, codes: np.ndarray, bounds: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first start, words, occurrences) of every maximal repeated substring of ``least`` words or more.

    Each is an interval of the suffix order whose least common prefix no neighbour reaches, and whose occurrences are
    preceded by different words (or one of them by none).
    """
    common = found.common
    lo, hi, size = [], [], []
    open_: list[tuple[int, int]] = []  # (words, first slot) of the intervals that are not closed yet
    at = np.flatnonzero(common >= least)
    last = -2
    for slot, words in zip(at.tolist(), common[at].tolist()):
        if slot != last + 1:
            for w, first in open_:
                lo.append(first), hi.append(last), size.append(w)
            open_ = []
        begin = slot - 1
        while open_ and open_[-1][0] > words:
            w, begin = open_.pop()
            lo.append(begin), hi.append(slot - 1), size.append(w)
        if not open_ or open_[-1][0] < words:
            open_.append((words, begin))
        last = slot
    for w, first in open_:
        lo.append(first), hi.append(last), size.append(w)
    lo, hi, size = (np.array(x, np.int64) for x in (lo, hi, size))
    if not len(lo):
        return lo, hi, size
    before = np.full(len(codes), -1, np.int64)
    before[1:] = codes[:-1]
    firsts = bounds[:-1][np.diff(bounds) > 0]
    before[firsts] = -1 - np.arange(len(firsts))
    word = before[found.order]
    changes = np.concatenate([[0], np.cumsum(word[1:] != word[:-1])])
    apart = changes[hi] > changes[lo]
    lo, hi, size = lo[apart], hi[apart], size[apart]
    if not len(lo):
        return lo, hi, size
    cuts = np.column_stack([lo, hi + 1]).ravel()
    start = np.minimum.reduceat(np.append(found.order, len(codes)), cuts)[::2]
    return start, size, hi - lo + 1


def covered(starts: np.ndarray, sizes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Words of each text under the union of the spans."""
    n = int(bounds[-1])
    edges = np.bincount(starts, minlength=n + 1) - np.bincount(starts + sizes, minlength=n + 1)
    under = np.concatenate([[0], np.cumsum(np.cumsum(edges[:n]) > 0)])
    return under[bounds[1:]] - under[bounds[:-1]]


@dataclass
class Repetition:
    """What the rules look at, for each text."""

    n_words: np.ndarray
    n_repeat_words: np.ndarray
    n_repeats: np.ndarray
    covered_words: np.ndarray
    longest_repeat: np.ndarray


def repetition(words: Words, least: int = MIN_REPEAT) -> Repetition:
    bounds = words.bounds
    found = suffixes(words.codes, bounds, min(WINDOW, least))
    longest = longest_at(found)
    window, long = np.flatnonzero(longest >= WINDOW), np.flatnonzero(longest >= least)
    start, size, _ = maximal_repeats(found, words.codes, bounds, least)
    text = np.searchsorted(bounds, start, "right") - 1
    top = np.zeros(len(bounds) - 1, np.int64)
    np.maximum.at(top, text, size)
    # the longest repeat that starts at a word lies in a maximal one, and each occurrence of a maximal one is the longest
    # from its start or lies in that: the union is the same, and every word is looked at once
    return Repetition(np.diff(bounds), covered(window, np.full(len(window), WINDOW), bounds), np.bincount(text, minlength=len(top)),
                      covered(long, longest[long], bounds), top)


def _repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    seen: set[str] = set()
    n = 0
    for line in text.split("\n"):
        if line in seen:
            n += 1
        elif line.strip(WHITE):
            seen.add(line)
    return n


OUT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_repeats long, covered_words long, "
       "longest_repeat long")


def _judge(keep: list[str]):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SORTED_BYTES):
            texts = text_array(batch, "text")
            words = Words(texts)
            r = repetition(words)
            owner = np.repeat(np.arange(len(texts)), r.n_words)
            vocab = [w.decode() for w in words.vocab]
            chars, marks = (np.bincount(owner, np.array([f(w) for w in vocab] or [0])[words.codes], len(texts)).astype(np.int64)
                            for f in (len, lambda w: sum(map(w.count, SYMBOLS))))
            lines = np.array([_repeated_lines(t.as_py()) for t in texts], np.int64)
            stats = [r.n_words, chars, marks, lines, r.n_repeat_words, r.n_repeats, r.covered_words, r.longest_repeat]
            names = [c.split()[0] for c in OUT.split(", ")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *(pa.array(s.astype(np.int64)) for s in stats)], [*keep, *names])
    return judge


def repetition_rules(docs: DataFrame) -> DataFrame:
    """doc_id, the counts of OUT, base_failed and kept for every row of ``docs``; one pass, no shuffle.

    The whole text is sorted, whatever its length, and repeats are looked for inside a text only.  A null, empty or
    blank text has no words and fails the base rules.  Repeated rows are judged each, equal texts alike; a null doc_id
    is kept as it is; an empty table gives an empty result.  Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_judge(["doc_id"]), f"doc_id long, {OUT}")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_WINDOW_PERCENT * F.col("n_words"))
    fine = (100 * F.col("covered_words") <= MAX_COVERED_PERCENT * F.col("n_words")) & (F.col("longest_repeat") <= MAX_REPEAT_WORDS)
    return rows.withColumn("base_failed", failed).withColumn("kept", ~failed & fine)


def _listed(least: int):
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SORTED_BYTES):
            words = Words(text_array(batch, "text"))
            start, size, times = maximal_repeats(suffixes(words.codes, words.bounds, least), words.codes, words.bounds, least)
            text = np.searchsorted(words.bounds, start, "right") - 1
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(text)), pa.array(start - words.bounds[text]), pa.array(size), pa.array(times)],
                                             ["doc_id", "start", "words", "occurrences"])
    return listed


def repeats(docs: DataFrame, least: int = MIN_REPEAT) -> DataFrame:
    """doc_id, start (word of the first occurrence), words, occurrences of every maximal repeated substring of
    ``least`` words or more; texts without any, null and empty ones have no row."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(_listed(least), "doc_id long, start long, words long, occurrences long")
