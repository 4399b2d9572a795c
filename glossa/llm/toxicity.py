"""Toxicity: a weighted finite-state grammar of insult, threat, target, negation and reported speech.

Words become symbols (their class, and a weight for insults and threats).  Small transducers read the symbols of a
clause and are composed into two machines.  The one that reads forwards holds the insult and the threat transducer
(which find matches: phrases of such words) and the scopes of target, negation and report that stand open; the one that
reads backwards says whether a target or a report follows ("idiots like you", "what a moron he is", "idiot, he said").
A match stands in what both machines say of it: aimed from before, from behind or at nobody, denied or not, reported
or not.  A document's score is a logistic function of its matched clauses, so an isolated word weighs less than the
same word aimed at somebody, and less again when it is denied or quoted.  Lexeme weights and the function are learned
from labelled texts; only the text is looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import Words, release, slices, stage, text_array
from glossa.llm.labelled import held_out, training_labels

#: Rows that may be learned from, and lexemes that may be learned: documented bounds.
MAX_TRAINING_ROWS = 24_000
MAX_LEXEMES = 3_000
MIN_TOXIC_DOCS = 4
MIN_LOG_ODDS = 2.0
STEMS = range(3, 9)
NEGATION_REACH = 3
#: Symbols that a target may stand behind a match, and words of no class that may stand inside an insult ("stupid old fool").
AIM_REACH = 4
INSULT_GAP = 1

# The grammar's closed word lists, in four languages.
INSULTS = """ass asshole bastard bitch brainless clown coward creep cretin crap cunt deplorable disgrace disgusting dumb dumbass fool
freak fuck fucking garbage hideous idiot idiotic idiots imbecile jerk liar loser losers lowlife moron moronic morons parasite
pathetic pig pigs rat repulsive ridiculous scum scumbag shit sick slut stupid subhuman swine trash ugly useless vermin vile
worthless abruti bouffon connard connasse con crétin débile enculé idiote imbécile lâche merde minable nul ordure pourriture
salaud salope stupide abschaum arsch arschloch blöd depp dreck dumm dummkopf hässlich hurensohn idioten scheiße schwein trottel
versager widerlich wertlos asqueroso basura cabrón cobarde estúpido estúpida gilipollas idiotas imbécil inútil mierda patético
payaso perdedor puta repugnante tonto""".split()
THREATS = """kill murder destroy hurt hang shoot stab beat burn strangle die tuer tuerai tue frapper crever mourir détruire töten
umbringen schlagen sterben vernichten erschießen matar mataré morir golpear destruir""".split()
TARGETS = """you your yours u ya he him his she her they them their these those this such people tu toi te vous votre vos il elle ils
elles eux ces du dich dir ihr euch sie dein deine euer diese tú ti usted ustedes vosotros él ella ellos ellas tus sus esos""".split()
NEGATIONS = """not no never nobody none isn't aren't wasn't don't doesn't didn't won't can't cannot without ne pas jamais aucun ni sans
nicht kein keine nie niemals ohne nunca jamás ningún sin tampoco""".split()
REPORTS = """said says say called calls quoted quote wrote reported claims claimed alleged according dit disait déclaré appelé selon
sagte sagt nannte schrieb laut dijo dice llamó escribió según""".split()

OTHER, TARGET, NEGATION, REPORT, INSULT, THREAT = range(6)
N_SYMBOLS = 6


# --- transducers -------------------------------------------------------------------------------------------------
@dataclass
class Transducer:
    """For each (state, symbol) the next state and the output, which is below ``outputs``."""

    arcs: np.ndarray
    marks: np.ndarray
    outputs: int

    def compose(self, other: "Transducer") -> "Transducer":
        """One machine that does what both do on the same symbols; its output holds both outputs."""
        n = len(self.arcs) * len(other.arcs)
        arcs = self.arcs[:, None] * len(other.arcs) + other.arcs[None]
        marks = self.marks[:, None] * other.outputs + other.marks[None]
        return Transducer(arcs.reshape(n, N_SYMBOLS), marks.reshape(n, N_SYMBOLS), self.outputs * other.outputs)


def scope(opens: int, reach: int | None) -> Transducer:
    """Puts out 1 for ``reach`` symbols after the symbol ``opens``, or up to the clause's end (None)."""
    n = 1 if reach is None else reach
    arcs = np.zeros((n + 1, N_SYMBOLS), int)
    for state in range(1, n + 1):
        arcs[state] = state if reach is None else state - 1
    arcs[:, opens] = n
    return Transducer(arcs, np.repeat((np.arange(n + 1) > 0).astype(int)[:, None], N_SYMBOLS, 1), 2)


NO_MATCH, BEGINS, GOES_ON = range(3)


def phrase(of: int, gap: int) -> Transducer:
    """Matches phrases of the symbol ``of`` with up to ``gap`` words of no class between two: BEGINS at the first, GOES_ON at the others."""
    arcs = np.zeros((gap + 2, N_SYMBOLS), int)
    for state in range(1, gap + 2):
        arcs[state, OTHER] = state - 1
    arcs[:, of] = gap + 1
    marks = np.zeros((gap + 2, N_SYMBOLS), int)
    marks[0, of], marks[1:, of] = BEGINS, GOES_ON
    return Transducer(arcs, marks, 3)


#: Outputs: (insult match, threat match, target open, negation open, report open), and (target follows, report follows).
FORWARDS = (phrase(INSULT, INSULT_GAP).compose(phrase(THREAT, 0))
            .compose(scope(TARGET, None)).compose(scope(NEGATION, NEGATION_REACH)).compose(scope(REPORT, None)))
BACKWARDS = scope(TARGET, AIM_REACH).compose(scope(REPORT, None))
N_MARKS = 12
N_FEATURES = 2 * N_MARKS + 8


def standing(forward: int, backward: int) -> tuple[int, int]:
    """(cell, match event) of a symbol from both machines' outputs; the cell is N_MARKS * threat + 4 * aim + 2 * denied +
    reported, where aim is 0 (at nobody), 1 (target before) or 2 (target behind only)."""
    events, scopes = divmod(forward, 8)
    insult, threat = divmod(events, 3)
    aim = 1 if scopes & 4 else 2 if backward & 2 else 0
    return (N_MARKS if threat else 0) + 4 * aim + (scopes & 2) + (scopes & 1 | backward & 1), insult or threat


STANDING = [[standing(f, b) for b in range(BACKWARDS.outputs)] for f in range(FORWARDS.outputs)]


def matches(kinds: list[int]) -> list[tuple[int, int, int]]:
    """(place, cell, event) of every symbol of a clause that belongs to a match."""
    behind, state = [], 0
    for kind in reversed(kinds):
        behind.append(int(BACKWARDS.marks[state, kind]))
        state = BACKWARDS.arcs[state, kind]
    out, state = [], 0
    for place, kind in enumerate(kinds):
        cell, event = STANDING[FORWARDS.marks[state, kind]][behind[-1 - place]]
        if event:
            out.append((place, cell, event))
        state = FORWARDS.arcs[state, kind]
    return out


@dataclass
class Lexicon:
    """Symbol and weight of a word: the closed lists, and learned words and stems ("stem*")."""

    weights: dict[str, float] = field(default_factory=dict)
    closed: dict[str, tuple[int, float]] = field(default_factory=lambda: {
        **{w: (TARGET, 0.0) for w in TARGETS}, **{w: (NEGATION, 0.0) for w in NEGATIONS}, **{w: (REPORT, 0.0) for w in REPORTS},
        **{w: (THREAT, 2.0) for w in THREATS}, **{w: (INSULT, 3.0) for w in INSULTS}})

    def symbol(self, word: str) -> tuple[int, float]:
        kind, weight = self.closed.get(word, (OTHER, 0.0))
        if self.weights:
            learned = max([self.weights.get(word, 0.0), *(self.weights.get(word[:n] + "*", 0.0) for n in STEMS if n <= len(word))])
            if learned > weight:
                return (kind if kind in (INSULT, THREAT) else INSULT), learned
        return kind, weight


def plain(word: bytes) -> str:
    """Lower case, without what isn't a letter or digit at either end."""
    text = word.decode().lower()
    a, b = 0, len(text)
    while a < b and not text[a].isalnum():
        a += 1
    while b > a and not text[b - 1].isalnum():
        b -= 1
    return text[a:b]


_ENDS = (b".", b"!", b"?", b";", b":", b"|")


def clause_features(texts: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """One row for each whole text: what its matches weigh by standing; words in matches; clauses with a match; matches and weight per 100
    words; weight and matches in all; clauses with a match that is aimed, not denied and not reported; the heaviest clause.
    All 0 without a match."""
    words = Words(texts)
    n, bounds = len(texts), words.bounds
    known = [lexicon.symbol(plain(w)) for w in words.vocab]
    kinds = np.array([k for k, _ in known] or [0])[words.codes]
    weights = np.array([w for _, w in known] or [0.0])[words.codes]
    ends = np.array([w.endswith(_ENDS) for w in words.vocab] or [False])[words.codes]
    out = np.zeros((n, N_FEATURES))
    hits = np.flatnonzero((kinds == INSULT) | (kinds == THREAT))
    if len(hits):
        # a clause ends behind a word with an end mark, and at the text's end
        cuts = np.unique(np.concatenate([np.flatnonzero(ends) + 1, bounds]))
        clauses = np.unique(np.searchsorted(cuts, hits, "right") - 1)
        owners = np.searchsorted(bounds, cuts[clauses], "right") - 1
        for clause, owner in zip(clauses.tolist(), owners.tolist()):
            a, b = cuts[clause], cuts[clause + 1]
            total, meant = 0.0, False
            found = matches(kinds[a:b].tolist())
            for place, cell, event in found:
                weight = weights[a + place]
                out[owner, cell] += weight
                total += weight
                out[owner, -3] += event == BEGINS
                meant |= cell % N_MARKS in (4, 8)
            out[owner, -1] = max(out[owner, -1], total)
            out[owner, -2] += meant
            out[owner, -7] += 1
            out[owner, -8] += len(found)
    size = np.maximum(np.diff(bounds), 1)
    whole = out[:, :2 * N_MARKS].sum(1)
    out[:, -4] = whole
    out[:, -5] = 100 * whole / size
    out[:, -6] = 100 * out[:, -3] / size
    return np.log1p(out)


# --- learning ----------------------------------------------------------------------------------------------------
def _lexeme_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Toxic and other documents of each half that hold each word and stem, summed over a slice."""
    for batch in slices(batches, "text"):
        words = Words(text_array(batch, "text"))
        cell = 2 * batch.column("half").to_numpy(zero_copy_only=False) + (batch.column("label").to_numpy(zero_copy_only=False) > 0.5)
        of: dict[str, int] = {}
        forms: list[np.ndarray] = []
        for w in words.vocab:
            p = plain(w)
            names = [p, *(p[:k] + "*" for k in STEMS if k <= len(p))] if p else []
            forms.append(np.array([of.setdefault(x, len(of)) for x in names], np.int64))
        counts = np.zeros((4, len(of)), np.int64)
        for i, c in enumerate(cell.tolist()):
            codes = np.unique(words.codes[words.bounds[i]:words.bounds[i + 1]])
            if len(codes):
                counts[c, np.unique(np.concatenate([forms[k] for k in codes.tolist()]))] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(of), pa.string()), *(pa.array(k) for k in counts)], ["lexeme", "o0", "t0", "o1", "t1"])


def learn_lexicons(sample: DataFrame) -> list[Lexicon]:
    """Of half 0, of half 1, and of both: words and stems that stand in toxic rather than other texts, weighed by their
    log odds; MAX_LEXEMES at most each."""
    sizes = sample.groupBy("half", "label").count().collect()
    n = {(r["half"], int(r["label"] > 0.5)): r["count"] for r in sizes}
    counts = stage(sample.select("text", "label", "half").mapInArrow(_lexeme_counts, "lexeme string, o0 long, t0 long, o1 long, t1 long")
                   .groupBy("lexeme").agg(*[F.sum(c).alias(c) for c in ("o0", "t0", "o1", "t1")]).where(F.col("t0") + F.col("t1") >= MIN_TOXIC_DOCS), "lexemes")
    out = []
    for halves in ((0,), (1,), (0, 1)):
        n0, n1 = (sum(n.get((h, k), 0) for h in halves) for k in (0, 1))
        if not n0 or not n1:
            out.append(Lexicon())
            continue
        toxic, other = (sum((F.col(f"{k}{h}") for h in halves[1:]), F.col(f"{k}{halves[0]}")) for k in "to")
        odds = F.log((toxic + 0.5) / F.lit(n1 + 1)) - F.log((other + 0.5) / F.lit(n0 + 1))
        surprise = (toxic - (toxic + other) * F.lit(n1 / (n0 + n1))) / F.sqrt(toxic + other)
        best = counts.where(toxic >= MIN_TOXIC_DOCS).withColumn("odds", odds).where(F.col("odds") >= MIN_LOG_ODDS).orderBy(surprise.desc(), "lexeme").limit(MAX_LEXEMES).collect()
        out.append(Lexicon({r["lexeme"]: float(r["odds"]) for r in best}))
    release(counts)
    return out


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, rounds: int = 40) -> np.ndarray:
    """Weights (constant first) of a ridge logistic regression by Newton steps."""
    z = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(z.shape[1])
    keep = ridge * np.eye(len(w))
    keep[0, 0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p) + 1e-9)[:, None]) + keep, z.T @ (y - p) - keep @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _feature_rows(lexicon: Lexicon):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x = clause_features(text_array(batch, "text"), lexicon)
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(list(x), pa.list_(pa.float64()))], ["label", "x"])
    return rows


def _scorer(lexicon: Lexicon, weights: np.ndarray):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x = clause_features(text_array(batch, "text"), lexicon)
            s = 1 / (1 + np.exp(-np.clip(weights[0] + x @ weights[1:], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s, pa.float64())], ["doc_id", "score"])
    return score


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic", bound: int = MAX_TRAINING_ROWS) -> tuple[Lexicon, np.ndarray]:
    """(lexicon, logistic weights) from about ``bound`` labelled texts.

    Cross-fitted: each half's features come from the lexicon of the other half, so the weights see lexemes as new
    texts do; the final lexicon is learned from both.  Without labels of both kinds the closed lists stand, with the
    weights of a plain prior.
    """
    known = F.broadcast(training_labels(labels, column, bound))  # at most about ``bound`` rows of three numbers
    sample = stage(docs.select(F.col("doc_id").cast("long"), "text").join(known, "doc_id").select("text", "label", (F.col("fold") % 2).alias("half")), "training")
    lexicons = learn_lexicons(sample)
    rows = [r for half in (0, 1) for r in sample.where(F.col("half") == half).select("text", "label").mapInArrow(_feature_rows(lexicons[1 - half]), "label double, x array<double>").collect()]  # bounded as the sample is
    release(sample)
    y = np.array([r["label"] for r in rows])
    if not len(y) or not 0 < y.sum() < len(y):
        weights = np.zeros(N_FEATURES + 1)
        weights[0], weights[-3], weights[-1] = -3.0, 1.0, 1.0
        return lexicons[2], weights
    return lexicons[2], logistic(np.array([r["x"] for r in rows]), y)


def score(docs: DataFrame, labels: DataFrame, column: str = "toxic", bound: int = MAX_TRAINING_ROWS, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    A null text is empty and scores as one without a match; equal texts score alike; repeated rows are scored each; a
    null doc_id is kept, not held out and teaches nothing; empty tables give an empty result.  Other columns are
    ignored.
    """
    lexicon, weights = fit(docs, labels, column, bound)
    scored = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_scorer(lexicon, weights), "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
