"""Operator 10: toxicity by a weighted finite-state pattern grammar.

Words become symbols: insult, threat, target, negation, report, other; sentence ends
and line ends part the clauses. Transducers read the symbols and write symbols:

* negation: what stands within three words after a negation is written as negated;
* reported speech: what follows a reporting verb or an opening quotation mark, to the
  closing one or the end of the clause, is written as quoted. Within a line of a text
  the marks open and close by turns;
* target: an insult in a clause with a target is written as directed, a threat
  counts only where a target follows or precedes it in the clause;
* weights: each symbol that is left gets its weight.

They are composed once into one machine, which runs over every clause that holds an
insult or a threat; isolated words never count by themselves. A document's evidence
is the sum over its clauses, its score a logistic function of that.

Learned from labelled rows: the insult words and stems (beginnings of words that
stand in toxic and not in other texts, strongly enough not to be chance), and the
two numbers of the logistic function. At most TRAIN_ROWS labelled rows are used, those with
the smallest hash of doc_id among the rows that `training` allows. The fixed
lists below always count.

Null and empty texts have no clause and get the score of no evidence. Documents
without label are scored like all others; rows of `labels` that are null, repeated or without
document do no harm (repeated: the largest label counts). Without any label, or with
one class only, default numbers hold. Repeated documents get equal scores.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.textscan import (
    ALNUM,
    bounded_batches,
    scan,
    scan_column,
    slices,
    text_buffer,
    window_keys,
    word_key,
    word_keys,
)

TRAIN_ROWS = 8_000
THRESHOLD = 0.7
STEMS = range(3, 9)

# Word lists of the grammar.
INSULTS = (
    "idiot idiots moron morons scum loser losers trash worthless pathetic disgusting stupid clown"
    " bastard asshole bitch filth vermin imbecile cretin retard pig dumbass"
).split()
THREATS = "kill murder hurt beat destroy strangle shoot stab hang burn crush".split()
TARGETS = (
    "you your yours yourself u ur they them their he him she her these those people"
    " tu vous toi du dich ihr euch sie usted ustedes"
).split()
NEGATIONS = "not no never nobody isn aren wasn don doesn didn nicht kein keine pas jamais nunca".split()
REPORTS = (
    "said says say told wrote writes quoted quotes called calls claimed claims reported alleged"
    " dit sagte dijo"
).split()

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END, CLOSE = range(8)
# symbols that only transducers write
NEGATED, QUOTED, DIRECTED, AIMED, CARRIED = range(8, 13)
# Weights of what is left after all transducers. AIMED is a target
# after an insult, CARRIED a threat that has found its target.
WEIGHTS = {INSULT: 1.0, DIRECTED: 1.5, AIMED: 0.5, CARRIED: 1.5, NEGATED: 0.1, QUOTED: 0.2}
NEGATION_REACH = 3
DEFAULT = (6.0, -2.5)


@dataclass
class Transducer:
    """`arcs[state, symbol]` is the next state and the symbol written; 0 is the start."""

    arcs: dict[tuple, tuple] = field(default_factory=dict)

    def step(self, state, symbol: int) -> tuple:
        return self.arcs.get((state, symbol), (state, symbol))


def negation() -> Transducer:
    t = Transducer()
    for state in range(NEGATION_REACH + 1):
        less = max(state - 1, 0)
        for symbol in (OTHER, TARGET, REPORT):
            t.arcs[state, symbol] = (less, symbol)
        for symbol in (INSULT, THREAT):
            t.arcs[state, symbol] = (less, NEGATED if state else symbol)
        t.arcs[state, NEGATION] = (NEGATION_REACH, OTHER)
        t.arcs[state, END] = (0, END)
    return t


def reported() -> Transducer:
    t = Transducer()
    for state in (0, 1):
        t.arcs[state, REPORT] = (1, OTHER)
        t.arcs[state, END] = (0, END)
        t.arcs[state, CLOSE] = (0, OTHER)
    for symbol in (INSULT, THREAT, NEGATED):
        t.arcs[1, symbol] = (1, QUOTED)
    return t


def target() -> Transducer:
    """States: 0 nothing, 1 target seen, 2 insult seen before any target, 3 threat open."""
    t = Transducer()
    t.arcs[0, TARGET] = (1, OTHER)
    t.arcs[1, TARGET] = (1, OTHER)
    t.arcs[2, TARGET] = (1, AIMED)
    t.arcs[3, TARGET] = (1, CARRIED)
    t.arcs[0, INSULT] = (2, INSULT)
    t.arcs[1, INSULT] = (1, DIRECTED)
    t.arcs[2, INSULT] = (2, INSULT)
    t.arcs[3, INSULT] = (2, INSULT)
    t.arcs[0, THREAT] = (3, OTHER)
    t.arcs[1, THREAT] = (1, CARRIED)
    t.arcs[2, THREAT] = (2, OTHER)
    t.arcs[3, THREAT] = (3, OTHER)
    for state in range(4):
        t.arcs[state, END] = (0, END)
    return t


def compose(first: Transducer, second: Transducer) -> Transducer:
    """What `second` makes of what `first` writes; states are pairs."""
    out, seen, todo = Transducer(), {(0, 0)}, [(0, 0)]
    names = {(0, 0): 0}
    while todo:
        pair = todo.pop()
        for symbol in range(8):
            a, middle = first.step(pair[0], symbol)
            b, written = second.step(pair[1], middle)
            if (a, b) not in seen:
                seen.add((a, b))
                names[a, b] = len(names)
                todo.append((a, b))
            out.arcs[names[pair], symbol] = (names[a, b], written)
    return out


def machine() -> tuple[list[list[int]], list[list[float]]]:
    """Next state and weight by state and input symbol, of all transducers together."""
    whole = compose(compose(negation(), reported()), target())
    states = 1 + max(s for s, _ in whole.arcs)
    step = [[whole.arcs[s, x][0] for x in range(8)] for s in range(states)]
    gain = [[WEIGHTS.get(whole.arcs[s, x][1], 0.0) for x in range(8)] for s in range(states)]
    return step, gain


@dataclass
class Lexicon:
    """Keys of whole words by symbol, and of stems by their length in bytes."""

    words: dict[str, int]
    stems: dict[str, float]

    def __post_init__(self):
        keys = {word_key(w): s for w, s in self.words.items()}
        self.keys = np.array(sorted(keys), np.uint64)
        self.symbols = np.array([keys[k] for k in sorted(keys)], np.int64)
        self.by_length: dict = {}
        for stem in self.stems:
            raw = stem.encode()
            self.by_length.setdefault(len(raw), []).append((word_key(stem), self.stems[stem]))
        for n, pairs in self.by_length.items():
            keys, strengths = zip(*sorted(pairs), strict=True)
            self.by_length[n] = np.array(keys, np.uint64), np.array(strengths)

    def classes(self, low: np.ndarray, words) -> tuple[np.ndarray, np.ndarray]:
        """Symbol of every word, and its strength: that of its longest stem, else 1."""
        at = np.minimum(np.searchsorted(self.keys, words.key), len(self.keys) - 1)
        out = np.where(self.keys[at] == words.key, self.symbols[at], OTHER)
        strength = np.ones(len(out))
        length = words.end - words.start
        for n in sorted(self.by_length, reverse=True):
            keys, strengths = self.by_length[n]
            some = np.flatnonzero((length >= n) & (out == OTHER))
            begin = words.start[some]
            own = word_keys(low, begin, begin + n)
            at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            same = keys[at] == own
            out[some[same]] = INSULT
            strength[some[same]] = strengths[at[same]]
        return out, strength


def fixed_words() -> dict[str, int]:
    out = {}
    for symbol, words in (
        (REPORT, REPORTS),
        (NEGATION, NEGATIONS),
        (TARGET, TARGETS),
        (THREAT, THREATS),
        (INSULT, INSULTS),
    ):
        out.update(dict.fromkeys(words, symbol))
    return out


_END = np.zeros(256, dtype=bool)
_END[[ord(c) for c in ".!?;:\n\r|"]] = True


def _marks(raw: np.ndarray, bounds: np.ndarray, words, owner: np.ndarray) -> np.ndarray:
    """REPORT or CLOSE for each word, by the last quotation mark before it; 0 without one.

    Only marks after the word before, within the word's own text and clause, count.
    """
    at = np.flatnonzero(raw == 34)
    out = np.zeros(len(words.start), np.int64)
    if not len(at):
        return out
    # number of each mark in its line of its text
    line = np.searchsorted(np.flatnonzero((raw == 10) | (raw == 13)), at)
    text = np.searchsorted(bounds, at, side="right")
    head = np.ones(len(at), dtype=bool)
    head[1:] = (line[1:] != line[:-1]) | (text[1:] != text[:-1])
    number = np.arange(len(at))
    number -= np.maximum.accumulate(np.where(head, number, 0))
    since = bounds[owner]
    since[1:] = np.maximum(since[1:], words.end[:-1])
    ends = np.flatnonzero(_END[raw])
    if len(ends):
        last = np.searchsorted(ends, words.start) - 1
        since = np.maximum(since, np.where(last >= 0, ends[last] + 1, 0))
    last = np.searchsorted(at, words.start) - 1
    some = (last >= 0) & (at[last] >= since)
    out[some] = np.where(number[last[some]] % 2 == 0, REPORT, CLOSE)
    return out


def evidence(column: pa.Array, lexicon: Lexicon, table) -> np.ndarray:
    """Sum of the clause weights of every text (lower-cased) of a column."""
    step, gain = table
    buf, bounds = text_buffer(column)
    out = np.zeros(len(column))
    for lo, hi in slices(bounds):
        own = bounds[lo : hi + 1]
        raw = buf[own[0] : own[-1]]
        words = scan(raw, own - own[0], ALNUM)
        if not len(words.key):
            continue
        symbol, strength = lexicon.classes(raw, words)
        ends = np.cumsum(_END[raw])
        owner = words.owner()
        gap = np.zeros(len(symbol), np.int64)
        gap[1:] = ends[words.start[1:]] - ends[words.end[:-1] - 1]
        quoted = _marks(raw, own - own[0], words, owner)
        opens = gap > 0
        opens[0] = True
        opens[1:] |= owner[1:] != owner[:-1]
        clause = np.cumsum(opens) - 1
        hot = np.unique(clause[(symbol == INSULT) | (symbol == THREAT)])
        begin = np.flatnonzero(opens)
        stop = np.append(begin[1:], len(symbol))
        for c in hot:
            state, total = 0, 0.0
            a, b = begin[c], stop[c]
            rows = symbol[a:b].tolist(), quoted[a:b].tolist(), strength[a:b].tolist()
            for x, q, much in zip(*rows, strict=True):
                if q:
                    state = step[state][q]
                total += gain[state][x] * much
                state = step[state][x]
            out[lo + owner[a]] += total
    return out


def _lower(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit("")))


def _sample(docs: DataFrame, labels: DataFrame, training: Column | None, rows: int) -> DataFrame:
    """(text, toxic) of at most `rows` labelled rows, those of the smallest hash of doc_id."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    known = known.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    known = known if training is None else known.where(training)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    text = docs.select("doc_id", _lower(F.col("text")).alias("text"))
    found = text.join(F.broadcast(known), "doc_id").select("text", "toxic")

    def mark(batches):
        for batch in batches:
            marks = []
            for lo, hi, words in scan_column(batch.column(0), ALNUM):
                keys, at = window_keys(words.key, words.first, 4)
                own = np.zeros(hi - lo, np.uint64)
                text_of = np.searchsorted(words.first, at, side="right") - 1
                order = np.lexsort((keys, text_of))
                owner, head = np.unique(text_of[order], return_index=True)
                own[owner] = keys[order][head]
                marks.append(own.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.concatenate(marks))], ["text", "toxic", "mark"]
            )

    # copies and near copies of a text would make chance words look significant: of the
    # texts with one least four-word run, one of each class stays
    marked = found.mapInArrow(mark, "text string, toxic int, mark long")
    return marked.groupBy("mark", "toxic").agg(F.min("text").alias("text")).select("text", "toxic")


def _features(text: str) -> set[str]:
    out = set()
    column = pa.array([text])
    buf, bounds = text_buffer(column)
    words = scan(buf, bounds, ALNUM)
    raw = buf.tobytes()
    for word in {raw[a:b] for a, b in zip(words.start.tolist(), words.end.tolist(), strict=True)}:
        name = word.decode()
        out.add(name + "$")
        out.update(name[:n] for n in STEMS if len(name) >= n)
    return out


def learn_stems(sample: DataFrame) -> dict[str, float]:
    """Stems and words (ending in `$`) that mark toxic texts beyond chance."""

    def count(batches):
        bad, good = Counter(), Counter()
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1), strict=True):
                kind = bad if toxic.as_py() else good
                kind.update(_features(text.as_py()))
                kind[""] += 1
        names = list(bad | good)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names, pa.string()),
                pa.array([bad[n] for n in names], pa.int64()),
                pa.array([good[n] for n in names], pa.int64()),
            ],
            ["f", "bad", "good"],
        )

    counts = sample.mapInArrow(count, "f string, bad long, good long")
    counts = counts.groupBy("f").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    enough = (F.col("bad") >= 3) & (F.col("bad") > 2 * F.col("good"))
    rows = {
        r.f: (r.bad, r.good) for r in counts.where((F.col("f") == "") | enough).collect()
    }
    toxic, clean = rows.pop("", (0, 0))
    if not toxic or not clean:
        return {}
    # chance of so many toxic texts among a feature's texts, for a million features tried
    rate = toxic / (toxic + clean)
    least = math.log(1e6)

    def surprise(a: int, b: int) -> float:
        n, p = a + b, a / (a + b)
        return n * (p * math.log(p / rate) + (1 - p) * math.log(max(1 - p, 1e-9) / (1 - rate)))

    strong = {f: ab for f, ab in rows.items() if surprise(*ab) >= least}
    kept: dict[str, float] = {}
    for f in sorted(strong, key=len):
        a, b = strong[f]
        odds = (a + 0.5) / (toxic + 1) / ((b + 0.5) / (clean + 1))
        strength = min(1.0, math.log(odds) / math.log(100))
        if f.endswith("$"):
            kept.setdefault(f[:-1], strength)
            continue
        longer = [g for g in strong if len(g) == len(f) + 1 and g.startswith(f) and g[-1] != "$"]
        if any(strong[g][0] >= 0.98 * a for g in longer):
            continue  # a longer stem says the same more exactly
        if any(w.startswith(f) for w in INSULTS):
            continue  # the fixed word says the same more exactly
        shorter = [kept[f[:n]] for n in STEMS if f[:n] in kept]
        if not shorter or strength > max(shorter):
            kept[f] = strength
    return kept


def fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = 30) -> tuple[float, float]:
    """Newton steps for slope and intercept, pulled towards the defaults."""
    if len(y) == 0 or y.min() == y.max():
        return DEFAULT
    w = np.array(DEFAULT)
    design = np.stack([x, np.ones_like(x)], 1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-design @ w))
        gradient = design.T @ (p - y) + 0.1 * (w - DEFAULT)
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2)
        w = w - np.linalg.solve(hessian, gradient)
        w = np.clip(w, (0.1, -12), (20, 5))
    return float(w[0]), float(w[1])


@dataclass
class Model:
    lexicon: Lexicon
    slope: float
    intercept: float

    def scores(self, column: pa.Array) -> np.ndarray:
        found = np.log1p(evidence(column, self.lexicon, machine()))
        return 1 / (1 + np.exp(-(self.slope * found + self.intercept)))


def train(
    docs: DataFrame, labels: DataFrame, training: Column | None = None, rows: int = TRAIN_ROWS
) -> Model:
    """Fit on labelled rows that `training` (a condition on doc_id) allows."""
    bounded_batches(docs.sparkSession)
    sample = _sample(docs, labels, training, rows)
    lexicon = Lexicon(fixed_words(), learn_stems(sample))

    def measure(batches):
        for batch in batches:
            found = np.log1p(evidence(batch.column(0), lexicon, machine()))
            yield pa.RecordBatch.from_arrays([pa.array(found), batch.column(1)], ["x", "y"])

    rows_ = sample.mapInArrow(measure, "x double, y int").groupBy("x", "y").count().collect()
    x = np.repeat([r[0] for r in rows_], [r[2] for r in rows_]).astype(float)
    y = np.repeat([r[1] for r in rows_], [r[2] for r in rows_]).astype(float)
    return Model(lexicon, *fit_logistic(x, (y > 0).astype(float)))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted of every document."""
    bounded_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            p = model.scores(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", _lower(F.col("text")).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def remove_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are not predicted toxic, all columns as they are."""
    bounded_batches(docs.sparkSession)
    place = len(docs.columns)

    def run(batches):
        for batch in batches:
            clean = model.scores(batch.column(place)) < threshold
            rows = pa.RecordBatch.from_arrays(batch.columns[:place], schema=batch.schema.remove(place))
            yield rows.filter(pa.array(clean))

    # by position: a column of the documents may have any name
    lowered = docs.select("*", _lower(docs["text"]).alias("text lowered for scoring"))
    return lowered.mapInArrow(run, docs.schema)
