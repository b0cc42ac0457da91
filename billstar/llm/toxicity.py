"""Toxicity scoring with a weighted finite-state pattern grammar.

A text is cut into clauses and each clause's words become symbols: insult
I, threat verb T, target Y (someone addressed), negation N, reported
speech R, other O. Five small transducers read the symbols. Each rewrites
a symbol or multiplies its weight, and their composition is one
deterministic machine:

* threat: a threat verb counts only once a target follows it in the clause;
* insult: an insult by itself leaves a small weight; a target before or
  after it, or a second insult, completes it to a hit;
* target: hits weigh more after a target;
* negation: hits within its scope weigh less;
* reported speech: hits after it, up to the clause's end, weigh less.

The score comes from the matched clauses through a logistic calibration,
not from isolated words. The insult lexicon (words, and word beginnings
that stand for their inflections) and all its weights are learnt from a bounded
sample of labelled texts; every text is scored whole. Words are compared
without accents.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log, log1p
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billstar.llm.common import fold, fresh, label_sample, logistic_fit, logistic_predict

HOLDOUT_MOD, HOLDOUT_AT = 4, 2

# Closed word classes of the grammar: general vocabulary in four languages.
TARGETS = frozenset("you your yours yourself u he she they them her him du dich dir dein euch ihr sie "
                    "tu te toi ton vous votre usted ustedes ti tus ellos ellas".split())
NEGATIONS = frozenset("not no never neither nor without isn aren wasn don doesn didn nicht kein keine nie "
                      "niemals pas jamais aucun sans nunca ninguno sin tampoco".split())
REPORTS = frozenset("said says told wrote quoted claimed reported called sagte schrieb behauptete zitierte "
                    "dit disait ecrit affirmait dijo escribio afirmaba citado".split())
THREATS = frozenset("kill murder destroy hurt stab shoot punish strangle toten umbringen vernichten "
                    "tuer detruire frapper matar destruir golpear".split())
THREAT_WEIGHT = 3.0
#: What an insult weighs that nothing in its clause completes.
LONE = 0.25

TOKEN = re.compile(r"\w+|[.!?;\n]+")
STOPS = frozenset(".!?;\n")
SYMBOLS = "ITYNRO"
#: Word beginnings of these lengths stand for longer words.
STEMS = (4, 5)
#: Distinct contexts, odds and likelihood ratio a term needs.
MIN_CONTEXTS, MIN_LOG_ODDS, MIN_LLR = 4, 3.0, 10.0


#: Sample documents whose contexts are held in a task at a time.
FIT_ROWS = 16


_MARKS = re.compile("[\u0300-\u036f]+")


def words_of(text: str | None) -> list[str]:
    """Lower-case words without accents, and runs of clause ends."""
    text = (text or "").lower()
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFD", text))
    return TOKEN.findall(text)


# ------------------------------------------------------------ transducers
@dataclass(frozen=True)
class Transducer:
    """Deterministic: arcs[(state, symbol)] = (output, factor, next state).
    Without an arc a symbol passes unchanged to ``default[state]``, or
    stays in the state."""

    arcs: dict
    default: dict = field(default_factory=dict)

    def step(self, state, symbol):
        arc = self.arcs.get((state, symbol))
        return arc if arc else (symbol, 1.0, self.default.get(state, state))


def threat() -> Transducer:
    """T alone is nothing; a target after it, within the clause, makes a hit on that target (K)."""
    return Transducer({
        (0, "T"): ("O", 1.0, 1), (1, "T"): ("O", 1.0, 1), (1, "Y"): ("K", 1.0, 0),
    })


def insult() -> Transducer:
    """The first insult of a clause without a target is pending (P). A
    target behind it (C), a threat's target or a second insult completes it; after that insults are hits."""
    whole = 2
    return Transducer({
        (0, "I"): ("P", 1.0, 1), (1, "I"): ("H", 1.0, whole), (whole, "I"): ("H", 1.0, whole),
        (0, "Y"): ("Y", 1.0, whole), (1, "Y"): ("C", 1.0, whole),
        (0, "K"): ("K", 1.0, whole), (1, "K"): ("K", 1.0, whole),
    })


def target(bonus: float = 1.25) -> Transducer:
    return Transducer({
        (0, "Y"): ("O", 1.0, 1), (1, "Y"): ("O", 1.0, 1), (0, "C"): ("C", 1.0, 1),
        (0, "K"): ("H", 1.0, 1), (1, "K"): ("H", 1.0, 1), (1, "H"): ("H", bonus, 1),
    })


def negation(damp: float = 0.5, scope: int = 3) -> Transducer:
    """After N, hits among the next ``scope`` words weigh ``damp``."""
    arcs, default = {(s, "N"): ("O", 1.0, scope) for s in range(scope + 1)}, {}
    for s in range(1, scope + 1):
        arcs[(s, "H")] = ("H", damp, s - 1)
        arcs[(s, "P")] = ("P", damp, s - 1)
        default[s] = s - 1
    return Transducer(arcs, default)


def report(damp: float = 0.6) -> Transducer:
    return Transducer({(0, "R"): ("O", 1.0, 1), (1, "R"): ("O", 1.0, 1), (1, "H"): ("H", damp, 1), (1, "P"): ("P", damp, 1)})


def compose(*parts: Transducer) -> dict:
    """The product machine {(state, symbol): (output, factor, next)}, built
    from the states that can be reached; each part reads what the one
    before it wrote, and factors multiply."""
    start = (0,) * len(parts)
    table, todo, number = {}, [start], {start: 0}
    while todo:
        states = todo.pop()
        for symbol in SYMBOLS:
            out, factor, after = symbol, 1.0, []
            for part, state in zip(parts, states):
                out, by, nxt = part.step(state, out)
                factor *= by
                after.append(nxt)
            after = tuple(after)
            if after not in number:
                number[after] = len(number)
                todo.append(after)
            table[(number[states], symbol)] = (out, factor, number[after])
    return table


def grammar() -> dict:
    return compose(threat(), insult(), target(), negation(), report())


# ----------------------------------------------------------------- model
@dataclass(frozen=True)
class ToxicityModel:
    lexicon: dict
    calibration: tuple | None


def terms(word: str) -> list[str]:
    """The word itself and the beginnings that stand for it."""
    return [word] + [word[:k] + "*" for k in STEMS if len(word) > k]


class Reader(dict):
    """word -> (symbol, weight), worked out once per distinct word."""

    LIMIT = 100_000

    def __init__(self, lexicon: dict):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str):
        weight = max((self.lexicon.get(t, 0.0) for t in terms(word)), default=0.0)
        # the grammar's own words keep their part, whatever was learnt
        if word in TARGETS:
            got = ("Y", 0.0)
        elif word in NEGATIONS:
            got = ("N", 0.0)
        elif word in REPORTS:
            got = ("R", 0.0)
        elif word in THREATS and self.lexicon.get(word, 0.0) >= 0:
            got = ("T", max(THREAT_WEIGHT, weight))
        else:
            got = ("I", weight) if weight > 0 else ("O", 0.0)
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = got
        return got


def clause_weights(text: str | None, reader: Reader, machine: dict) -> list[float]:
    """Weights of the clauses of a text that match the grammar."""
    tokens = words_of(text)
    read = [reader[t] for t in tokens]
    at = [i for i, (s, _) in enumerate(read) if s in "IT"]
    found, done = [], -1
    for i in at:
        if i <= done:
            continue
        a = i
        while a > 0 and tokens[a - 1][0] not in STOPS:
            a -= 1
        b = i
        while b < len(tokens) and tokens[b][0] not in STOPS:
            b += 1
        state, total, held, pending = 0, 0.0, 0.0, 0.0
        for symbol, weight in read[a:b]:
            out, factor, state = machine[(state, symbol)]
            if symbol == "T":
                held = weight
            if out == "P":
                total += LONE * factor * weight
                pending = (1 - LONE) * factor * weight
            elif out in "CH":
                total += pending
                pending = 0.0
                if out == "H":
                    total += factor * (weight if symbol == "I" else held)
        if total > 0:
            found.append(total)
        done = b
    return found


def features(text: str | None, reader: Reader, machine: dict) -> tuple[float, float]:
    """(log of the summed clause weights, log of the heaviest); (0, 0) without a match."""
    found = clause_weights(text, reader, machine)
    return log1p(sum(found)), log1p(max(found, default=0.0))


def contexts(text: str) -> set[tuple[str, int]]:
    """Distinct (term, hash of the two neighbouring words) of a text."""
    words = [t for t in words_of(text) if t[0] not in STOPS]
    padded = ["", *words, ""]
    seen = set()
    for i, word in enumerate(words):
        around = crc32(f"{padded[i]} {padded[i + 2]}".encode())
        for term in terms(word):
            seen.add((term, around))
    return seen


def log_likelihood_ratio(t: int, c: int, p0: float) -> float:
    n = t + c
    return t * log(t / (n * p0)) + (c * log(c / (n * (1 - p0))) if c else 0.0)


def fit(documents: DataFrame, labels: DataFrame, toxic: int = 3000, clean: int = 9000,
        mod: int = HOLDOUT_MOD, at: int = HOLDOUT_AT) -> ToxicityModel:
    """Learn from at most ``toxic`` + ``clean`` labelled documents whose
    id's fold is not ``at``.

    A term's evidence is the number of *different contexts* it occurs in,
    not of occurrences, so that a text copied many times counts once.
    Only terms that pass in toxic texts are counted in clean ones; the
    lexicon that reaches the driver is bounded by the sample. Without
    toxic samples the lexicon is empty and all scores are the prior.
    """
    sample = label_sample(documents, labels, "toxic", fold("doc_id", mod) != at, {0: clean, 1: toxic})

    def spread(batches: Iterator) -> Iterator:
        for pdf in batches:
            for i in range(0, len(pdf), FIT_ROWS):
                seen = set().union(*map(contexts, pdf.text[i:i + FIT_ROWS]))
                yield pd.DataFrame(list(seen), columns=["term", "around"])

    seen = (
        sample.where("label = 1").select("text").mapInPandas(spread, "term string, around long").distinct()
    )
    counted = seen.groupBy("term").agg(F.count("*").alias("n"))
    total = seen.where("term not like '%*'").count()
    likely = {r.term: r.n for r in counted.where(F.col("n") >= MIN_CONTEXTS).collect()}

    def recount(batches: Iterator) -> Iterator:
        for pdf in batches:
            counts: Counter = Counter()
            for text in pdf.text:
                for term, _ in contexts(text):
                    if term in likely:
                        counts[term] += 1
                    if term[-1] != "*":
                        counts["*"] += 1
            yield pd.DataFrame(list(counts.items()), columns=["term", "n"])

    clean_counts = {
        r.term: r.n for r in
        sample.where("label = 0").select("text").mapInPandas(recount, "term string, n long")
        .groupBy("term").agg(F.sum("n").alias("n")).collect()
    }
    clean_total = clean_counts.get("*", 0)
    p0 = (total + 1) / (total + clean_total + 2)
    shift = log((clean_total + 1) / (total + 1))
    lexicon = {}
    for term, t in likely.items():
        c = clean_counts.get(term, 0)
        odds = log((t + 0.5) / (c + 0.5)) + shift
        if odds >= MIN_LOG_ODDS and log_likelihood_ratio(t, c, p0) >= MIN_LLR:
            lexicon[term] = odds
        elif term in THREATS and odds < 0:
            lexicon[term] = odds

    machine = grammar()

    def measured(batches: Iterator) -> Iterator:
        reader = Reader(lexicon)
        for pdf in batches:
            rows = [(y, *features(t, reader, machine)) for y, t in zip(pdf.label, pdf.text)]
            yield pd.DataFrame(rows, columns=["y", "total", "best"])

    rows = sorted(
        sample.select("label", "text").mapInPandas(measured, "y int, total double, best double").collect()
    )
    model = logistic_fit([(r.total, r.best) for r in rows], [r.y for r in rows], ridge=0.1) if rows else None
    return ToxicityModel(lexicon, model)


def score(text: Column, model: ToxicityModel) -> Column:
    """struct(score, total) of a text column, per Arrow batch; NULL and
    empty texts match no clause and get the score of that."""
    machine = grammar()

    @F.pandas_udf("score double, total double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        reader = Reader(model.lexicon)
        for texts in batches:
            x = np.array([features(t, reader, machine) for t in texts], dtype=float).reshape(-1, 2)
            p = logistic_predict(model.calibration, x) if model.calibration else np.full(len(x), 0.0)
            yield pd.DataFrame({"score": p, "total": np.expm1(x[:, 0])})

    return scored(text)


def classify(documents: DataFrame, model: ToxicityModel, threshold: float = 0.3) -> DataFrame:
    """One row per document row: doc_id, held_out, score, predicted and the
    summed clause weight. NULL ids stay NULL, repeated rows repeat; other
    columns are not carried, so their names cannot clash."""
    out = documents.select("doc_id", score(F.col("text"), model).alias("s"))
    return out.select(
        "doc_id",
        (fold("doc_id", HOLDOUT_MOD) == HOLDOUT_AT).alias("held_out"),
        F.col("s.score").alias("score"),
        (F.col("s.score") >= threshold).cast("int").alias("predicted"),
        F.col("s.total").alias("clause_weight"),
    )


def keep_clean(documents: DataFrame, model: ToxicityModel, threshold: float = 0.3) -> DataFrame:
    """The rows of ``documents`` that score under ``threshold``, unchanged."""
    name = fresh("_toxicity_score", documents.columns)
    return (
        documents.withColumn(name, score(F.col("text"), model)["score"])
        .where(F.col(name) < threshold).drop(name)
    )
