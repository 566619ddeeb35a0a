"""Toxicity by a weighted finite-state grammar of clauses.

Words become symbols: insult, harm, will, speaker, target, negation, report, quote, other.
Small weighted transducers are composed to one machine, the later ones reading what the
earlier ones write:

* *negation*: an insult within a few words after a negation is written as a denied one;
* *report*: an insult that the clause reports somebody to have said, before or after the word
  that says so, and inside quotation marks if there are any, is written as a told one;
* *insult*: an insult word costs its learned weight, a denied or told one less;
* *target*: more if a person is addressed in the same clause;
* *threat*: a word of harm after "will" and with a target is a match of its own.

The score of a text comes from the weights of its matched clauses, not from single words.
The insult vocabulary (whole words, and stems with changing endings) is learned from
labelled texts by log-odds. An entry must follow many different words, so the neighbours of
an insult in a much copied text are not picked up. Counts are taken by Spark over the sample;
entries that pass and one weight a text come to the driver.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Hashable
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm import words as W
from granary.llm.quality import _curve, held_out, training_rows
from granary.llm.shared import written

#: Labelled rows the vocabulary and the curve are learned from.
SAMPLE_ROWS = 24_000
#: Letters of a stem, toxic texts an entry must be in, its least log-odds, and how many
#: different words must stand before it, as a share of those texts.
STEM = (4, 5, 6, 7)
SUPPORT = 3
ODDS = 2.5
VARIETY = 0.5
THRESHOLD = 0.5

#: Fixed words of the grammar, by symbol.
LEXICON = {
    "target": "you your yours he she they him her them du dich dir ihr euch sie tu te toi vous tú usted ustedes vosotros",
    "speaker": "i we ich wir je nous yo nosotros",
    "will": "will shall gonna going i'll we'll werde werden vais allons voy vamos",
    "harm": "kill hurt destroy murder beat burn shoot stab töten umbringen schlagen tuer frapper matar golpear",
    "negation": "not never no isn't aren't wasn't don't doesn't nicht kein keine nie pas jamais nunca jamás",
    "report": "said says wrote called calls quoted reported sagte schrieb zitierte dit écrit disait dijo escribió",
}
SYMBOLS = ("other", "insult", "harm", "will", "speaker", "target", "negation", "report", "quote", "denied", "told", "denied told")
#: Changes of a match's weight, on the scale of log-odds.
TARGETED, NEGATED, REPORTED, THREAT = 1.0, -2.0, -2.0, 4.0
#: Words over which a negation and an announced act reach.
REACH = 3

_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
#: Words and quotation marks; an apostrophe inside a word is none.
_TOKEN = re.compile(_WORD.pattern + r"|[\"“”„«»‘]|['’]")
#: Ends of clauses; not before a closing quotation mark, nor a colon before an opening one.
_CLAUSE = re.compile(r"(?:[.!?;]+(?![.!?;\"”»'’])|:(?!\s*[\"“„«'‘])|\n)+")
_KNOWN = {w: SYMBOLS.index(k) for k, held in LEXICON.items() for w in held.split()}
_QUOTE = SYMBOLS.index("quote")


@dataclass
class Transducer:
    """Arcs ``(state, symbol) -> (state, weight)``; a missing arc keeps the state at weight 0.
    ``writes`` has the symbols written where they are not the ones read, and ``final`` adds
    a weight to what a clause has matched by the end."""

    start: int
    arcs: dict[tuple[int, int], tuple[int, float]]
    final: dict[int, float] = field(default_factory=dict)
    writes: dict[tuple[int, int], int] = field(default_factory=dict)

    def step(self, state: int, symbol: int) -> tuple[int, float]:
        return self.arcs.get((state, symbol), (state, 0.0))

    def written(self, state: int, symbol: int) -> int:
        return self.writes.get((state, symbol), symbol)


def machine(start: Hashable, move: Callable[[Hashable, str], tuple[Hashable, float, str]], final: Callable[[Hashable], float] = lambda s: 0.0) -> Transducer:
    """The transducer of a rule: state and symbol read to state, weight and symbol written."""
    number, todo = {start: 0}, [start]
    made = Transducer(0, {})
    while todo:
        state = todo.pop()
        here = number[state]
        made.final[here] = final(state)
        for x, symbol in enumerate(SYMBOLS):
            there, weight, out = move(state, symbol)
            if there not in number:
                number[there] = len(number)
                todo.append(there)
            made.arcs[here, x] = (number[there], weight)
            made.writes[here, x] = SYMBOLS.index(out)
    return made


def cascade(first: Transducer, second: Transducer) -> Transducer:
    """The machine in which ``second`` reads what ``first`` writes; weights add up."""

    def move(state, symbol):
        a, b = state
        x = SYMBOLS.index(symbol)
        (a2, wa), y = first.step(a, x), first.written(a, x)
        (b2, wb), z = second.step(b, y), second.written(b, y)
        return (a2, b2), wa + wb, SYMBOLS[z]

    return machine((first.start, second.start), move, lambda s: first.final.get(s[0], 0.0) + second.final.get(s[1], 0.0))


def compose(parts: list[Transducer]) -> Transducer:
    """The machine that runs all parts side by side on what is read; weights add up."""

    def move(state, symbol):
        steps = [p.step(s, SYMBOLS.index(symbol)) for p, s in zip(parts, state, strict=True)]
        return tuple(s for s, _ in steps), sum(w for _, w in steps), symbol

    return machine(tuple(p.start for p in parts), move, lambda s: sum(p.final.get(x, 0.0) for p, x in zip(parts, s, strict=True)))


_INSULTS = ("insult", "denied", "told", "denied told")


def _negation() -> Transducer:
    """State: words that a negation still reaches."""

    def move(reach, symbol):
        if symbol == "negation":
            return REACH, 0.0, symbol
        if symbol == "quote" or not reach:
            return reach, 0.0, symbol
        return reach - 1, 0.0, "denied" if symbol == "insult" else symbol

    return machine(0, move)


def _report() -> Transducer:
    """State: whether a word of saying was read, whether quotation marks are absent, open or
    closed, and whether an insult waits for a word of saying behind it."""

    def move(state, symbol):
        said, marks, waits = state
        if symbol == "quote":
            return (said, "closed" if marks == "open" else "open", waits), 0.0, symbol
        if symbol == "report" and marks != "open":
            return (True, marks, False), REPORTED if waits else 0.0, symbol
        if symbol in _INSULTS and marks != "closed":
            if said:
                return state, 0.0, "denied told" if symbol == "denied" else "told"
            return (said, marks, True), 0.0, symbol
        return state, 0.0, symbol

    return machine((False, "absent", False), move)


def _insult() -> Transducer:
    less = {"denied": NEGATED, "told": REPORTED, "denied told": NEGATED + REPORTED}
    return machine(0, lambda state, symbol: (0, less.get(symbol, 0.0), symbol))


def _target() -> Transducer:
    def move(state, symbol):
        target, insult = state
        return (target or symbol == "target", insult or symbol in _INSULTS), 0.0, symbol

    return machine((False, False), move, lambda s: TARGETED if all(s) else 0.0)


def _threat() -> Transducer:
    """State: how many of speaker, will, harm and target were read in this order, each within
    reach of the last, and the words since."""
    order = ("speaker", "will", "harm", "target")

    def move(state, symbol):
        k, since = state
        if symbol == "quote":
            return state, 0.0, symbol
        if k and symbol == order[k]:
            return ((0, 0), THREAT, symbol) if k == 3 else ((k + 1, 0), 0.0, symbol)
        if k and symbol == order[k - 1]:
            return (k, 0), 0.0, symbol
        if not k:
            return ((1, 0) if symbol == "speaker" else state), 0.0, symbol
        return ((k, since + 1) if since < REACH else (0, 0)), 0.0, symbol

    return machine((0, 0), move)


def grammar() -> Transducer:
    """The composed clause machine. Weights of insult words are added where they match."""
    return cascade(cascade(_negation(), _report()), compose([_insult(), _target(), _threat()]))


def _clause_begin(text: str, hit: int) -> int:
    """Where the clause around ``hit`` begins."""
    at = hit
    while True:
        at = max(text.rfind(c, 0, at) for c in ".!?;:\n")
        if at < 0:
            return 0
        end = _CLAUSE.match(text, at)
        if end and end.end() <= hit:
            return end.end()


@dataclass
class Model:
    """Insult words and stems with their weights, and the curve from weight to score."""

    words: dict[str, float]
    stems: dict[str, float]
    slope: float = 1.0
    offset: float = -2.0

    def ready(self) -> Model:
        self.machine = grammar()
        self.finder = ahocorasick.Automaton()
        for w in {*self.words, *self.stems, *LEXICON["harm"].split()}:
            self.finder.add_word(w, w)
        if len(self.finder):
            self.finder.make_automaton()
        return self

    def insult(self, word: str) -> float:
        return max([self.words.get(word, 0.0), *(self.stems.get(word[:k], 0.0) for k in STEM if len(word) >= k)])

    def clauses(self, text: str) -> list[tuple[int, int, float]]:
        """(begin, end, weight) of each matched clause of the whole text."""
        low = text.lower()
        # Clauses without an insult or a word of harm match nothing; they are not parsed.
        hits = [end for end, _ in self.finder.iter(low)] if len(self.finder) else []
        out, last = [], -1
        for hit in hits:
            if hit < last:
                continue
            begin = _clause_begin(low, hit)
            stop = _CLAUSE.search(low, hit + 1)
            last = stop.start() if stop else len(low)
            state, total, found, seen = self.machine.start, 0.0, False, set()
            for m in _TOKEN.finditer(low, begin, last):
                token = m.group()
                mark = not token[0].isalnum()
                weight = 0.0 if mark else self.insult(token)
                if weight and token in seen:
                    continue  # a word that a clause repeats is no second insult
                seen.add(token)
                symbol = _QUOTE if mark else 1 if weight else _KNOWN.get(token, 0)
                state, more = self.machine.arcs[state, symbol]
                # A negated or reported insult weighs no less than nothing.
                total += max(weight + more, 0.0) if weight else more
                found = found or bool(weight) or more > 0
            if found:
                out.append((begin, last, total + self.machine.final[state]))
        return out

    @staticmethod
    def weight(clauses: list[tuple[int, int, float]]) -> float:
        """The strongest clause, and a little for each further one."""
        found = sorted((w for _, _, w in clauses if w > 0), reverse=True)
        return found[0] + float(np.log1p(sum(found[1:]))) if found else 0.0

    def score(self, clauses: list[tuple[int, int, float]]) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.weight(clauses) + self.offset, -30, 30))))


def _entries(text: str) -> set[str]:
    words = set(_WORD.findall(text.lower()))
    return {w for w in words if len(w) > 2} | {w[:k] + "*" for w in words for k in STEM if len(w) > k}


def _odds(held: int, clean: int, n_toxic: int, n_clean: int) -> float:
    """Log-odds of an entry in toxic texts against clean ones."""
    return float(np.log((held + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1)))


def _around(texts: list[str], worth: dict[str, float]) -> tuple[set[tuple[str, str]], Counter[tuple[str, str]]]:
    """(entry, word before it) pairs in toxic texts, and how often a stem stands for a word."""
    before, forms = set(), Counter()
    for t in texts:
        words = _WORD.findall(t.lower())
        for last, w in zip(["", *words], words, strict=False):
            if w in worth:
                before.add((w, last))
            for k in STEM:
                stem = w[:k] + "*"
                if len(w) > k and stem in worth:
                    before.add((stem, last))
                    forms[stem, w] += 1
    return before, forms


def _vocabulary(held: dict[str, int], odds: dict[str, float], variety: dict[str, int], forms: dict[str, tuple[int, int]]) -> Model:
    """Words and stems of the entries in ``odds``: ``held`` toxic texts have an entry, which
    stands after ``variety`` words; ``forms`` has a stem's commonest word's and all counts."""
    # Copies of one toxic text make its other words look toxic, but always after the same word.
    worth = {e for e in odds if variety.get(e, 0) >= max(SUPPORT, VARIETY * held[e])}
    stems: dict[str, float] = {}
    for e in sorted((e for e in worth if e.endswith("*")), key=lambda e: (len(e), e)):
        known = any(e[:k] in stems for k in STEM if k < len(e) - 1)
        most, total = forms[e]
        if not known and most <= VARIETY * total:
            stems[e[:-1]] = odds[e]
    return Model({e: odds[e] for e in worth if not e.endswith("*") and not any(e[:k] in stems for k in STEM)}, stems)


def learned(texts: list[str], labels: np.ndarray) -> Model:
    """Vocabulary of the toxic texts, and the curve on the resulting weights: what ``train``
    learns, from texts in memory."""
    toxic = [t for t, y in zip(texts, labels, strict=True) if y == 1]
    n_toxic, n_clean = len(toxic), int((labels == 0).sum())
    if not n_toxic or not n_clean:
        return Model({}, {}, 0.0, 30.0 if n_toxic else -30.0).ready()
    held = Counter(e for t in toxic for e in _entries(t))
    clean = Counter(e for t, y in zip(texts, labels, strict=True) if y == 0 for e in _entries(t) & held.keys())
    odds = {e: _odds(n, clean[e], n_toxic, n_clean) for e, n in held.items() if n >= SUPPORT}
    odds = {e: x for e, x in odds.items() if x >= ODDS}
    before, counted = _around(toxic, odds)
    forms: dict[str, tuple[int, int]] = {}
    for (e, _), n in counted.items():
        most, total = forms.get(e, (0, 0))
        forms[e] = (max(most, n), total + n)
    model = _vocabulary(held, odds, Counter(e for e, _ in before), forms).ready()
    weight = np.array([model.weight(model.clauses(t)) for t in texts])
    model.slope, model.offset = _curve(weight, labels)
    return model


def _counted(batches):
    """Texts of each kind that have an entry, summed over the rows of a task."""
    toxic, clean = Counter(), Counter()
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            (toxic if label == 1 else clean).update(_entries(text))
    entries = list(toxic.keys() | clean.keys())
    yield pa.RecordBatch.from_arrays(
        [pa.array(entries, pa.string()), *(pa.array([c[e] for e in entries], pa.int64()) for c in (toxic, clean))], names=["entry", "toxic", "clean"]
    )


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = SAMPLE_ROWS) -> Model:
    """The model of ``rows`` labelled rows at most.

    Entries are counted by Spark. To the driver come entries above SUPPORT and ODDS, with
    their counts, and one weight for each row of the sample; texts do not.
    """
    sample = written(training_rows(docs, labels, label, rows), "toxicity-sample")
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return Model({}, {}, 0.0, 30.0 if n_toxic else -30.0 if n_clean else 0.0)

    counts = sample.select("text", "label").mapInArrow(_counted, "entry string, toxic long, clean long")
    counts = counts.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).filter(F.col("toxic") >= SUPPORT)
    chance = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    likely = counts.filter(chance >= ODDS - 1e-9).collect()
    odds = {r["entry"]: _odds(r["toxic"], r["clean"], n_toxic, n_clean) for r in likely}
    odds = {e: x for e, x in odds.items() if x >= ODDS}
    held = {r["entry"]: r["toxic"] for r in likely}

    def around(batches):
        before, forms = set(), Counter()
        for batch in batches:
            more, counted = _around(batch.column("text").to_pylist(), odds)
            before |= more
            forms.update(counted)
        found = [(e, "before", w, 1) for e, w in before] + [(e, "form", w, n) for (e, w), n in forms.items()]
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], k) for i, k in enumerate(kinds)], names=["entry", "kind", "word", "n"])

    near = sample.filter("label = 1").select("text").mapInArrow(around, "entry string, kind string, word string, n long")
    form = F.when(F.col("kind") == "form", F.col("n"))
    facts = (
        near.groupBy("entry", "kind", "word").agg(F.sum("n").alias("n"))
        .groupBy("entry").agg(F.count_if(F.col("kind") == "before").alias("variety"), F.max(form).alias("most"), F.sum(form).alias("total"))
        .collect()
    )
    model = _vocabulary(held, odds, {r["entry"]: r["variety"] for r in facts}, {r["entry"]: (r["most"] or 0, r["total"] or 0) for r in facts})

    def weights(batches):
        own = Model(model.words, model.stems).ready()
        for batch in W.parts(batches):
            found = [own.weight(own.clauses(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(found, pa.float64())], names=["id", "label", "weight"])

    table = sample.mapInArrow(weights, "id long, label int, weight double").toArrow().sort_by([(c, "ascending") for c in ("id", "label", "weight")])
    model.slope, model.offset = _curve(table.column("weight").to_numpy(), table.column("label").to_numpy())
    return model


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_clauses`` for each row of ``docs(doc_id, text, ...)``.

    The score (0 to 1, higher: label 1 likelier) depends on the whole text alone. Null and
    empty texts and texts without a matched clause get the score of no match. Null and
    repeated ids are scored like others; a null id is not held out. Other columns are
    ignored, whatever their names. An empty table gives no rows.
    """

    def run(batches):
        own = Model(model.words, model.stems, model.slope, model.offset).ready()
        for batch in W.parts(batches):
            found = [own.clauses(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([own.score(c) for c in found], pa.float64()), pa.array([len(c) for c in found], pa.int64())],
                names=["doc_id", "score", "n_clauses"],
            )

    return (
        docs.select(F.col("doc_id").cast("long"), "text")
        .mapInArrow(run, "doc_id long, score double, n_clauses long")
        .select(
            "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_clauses"
        )
    )
