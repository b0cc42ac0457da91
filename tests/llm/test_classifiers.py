"""Quality, toxicity and language: held-out accuracy on the driver's
documents, and defined results for awkward rows."""

from __future__ import annotations

import random
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from billstar.llm import langid, quality, toxicity
from billstar.llm.common import label_sample, table
from billstar.llm.queries import queries

SF = "/root/testdata/sf0.01"
AWKWARD = [(1, None), (2, ""), (3, "word " * 40_000), (None, "some text here."), (4, "same"), (4, "same"),
           (5, "é中\U0001f600"), (6, "123 456")]


def held_out(spark, key, label):
    got = queries()[key](spark, SF)
    both = got.join(table(spark, SF, "labels"), "doc_id").where("held_out")
    return both.select("score", "predicted", label).collect()


@pytest.mark.parametrize(("key", "label"), [("op1_quality_classifier", "quality"), ("op10_toxicity", "toxic")])
def test_held_out_accuracy(spark, key, label):
    rows = held_out(spark, key, label)
    assert len(rows) > 50
    assert all(0 <= r.score <= 1 for r in rows)
    for k in (0, 1):
        own = [r for r in rows if r[label] == k]
        assert sum(r.predicted == k for r in own) >= 0.9 * len(own)


def test_one_row_per_document(spark):
    n = table(spark, SF, "documents").count()
    for key in ("op1_quality_classifier", "op10_toxicity", "op6_language_id"):
        assert queries()[key](spark, SF).count() == n


def test_language_held_out(spark):
    got = queries()["op6_language_id"](spark, SF).where("held_out")
    rows = got.join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)


def test_fold_is_crc32_of_the_id_as_text(spark):
    rows = queries()["op1_quality_classifier"](spark, SF).select("doc_id", "held_out").limit(200).collect()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


def labelled(spark, documents, label):
    rng = random.Random(5)
    good = ["the cat sat on a mat and ran home", "we walk to the river in the morning light"]
    bad = {"quality": "$$$### buy %%% now !!! &&& ", "toxic": "you worthless {} idiot {} "}[label]
    rows, labels = [], []
    for i in range(120):
        words = " ".join(rng.choice(good).split()[: rng.randint(3, 8)] * 4)
        flag = i % 3 == 0
        # words between the insults, as only different contexts are evidence
        rude = (bad * 6).format(*(rng.choice(good).split()[k % 3] for k in range(12))) if label == "toxic" else bad * 6
        rows.append((i, words + (". " + rude if flag else "")))
        labels.append((i, int(flag) if label == "toxic" else int(not flag)))
    return documents(rows), spark.createDataFrame(labels, f"doc_id long, {label} int")


def test_quality_awkward_rows(spark, documents):
    docs, labels = labelled(spark, documents, "quality")
    model = quality.fit(docs, labels)
    out = quality.classify(documents(AWKWARD, extra="score gain label"), model).collect()
    assert len(out) == len(AWKWARD)
    assert all(r.score is not None and 0 <= r.score <= 1 and r.predicted in (0, 1) for r in out)
    assert len({r.score for r in out if r.doc_id == 4}) == 1
    kept = quality.keep_good(documents(AWKWARD, extra="_quality_score"), model)
    assert kept.columns[-1] == "_quality_score"


def test_toxicity_awkward_rows(spark, documents):
    docs, labels = labelled(spark, documents, "toxic")
    model = toxicity.fit(docs, labels)
    out = toxicity.classify(documents(AWKWARD, extra="score total"), model).collect()
    assert len(out) == len(AWKWARD) and all(r.predicted == 0 for r in out)
    got = toxicity.classify(documents([(1, "hello there. You worthless idiot!")]), model).first()
    assert got.predicted == 1


def test_no_labels_and_empty_tables(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = documents([(1, "a b c")])
    assert quality.classify(docs, quality.fit(docs, none)).first().score == 0.5
    assert toxicity.classify(docs, toxicity.fit(docs, none)).first().score == 0.0
    empty = documents([])
    assert langid.identify(empty, langid.fit(empty)).count() == 0
    assert langid.identify(docs, langid.fit(empty)).first().lang_pred == "und"


def test_label_sample_fills_its_bound_from_the_documents(spark, documents):
    """Labels of absent or textless documents use up no quota, and an id
    that repeats comes once."""
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    docs = documents([(i, f"text {i}") for i in range(360, 400)] + [(i, f"again {i}") for i in range(360, 400)]
                     + [(i, None) for i in range(100)])
    got = label_sample(docs, labels, "toxic", F.lit(True), {0: 15, 1: 50}).collect()
    assert len({r.doc_id for r in got}) == len(got)
    assert sorted(r.label for r in got) == [0] * 15 + [1] * 20
    assert all(r.text == f"again {r.doc_id}" and r.label == r.doc_id % 2 for r in got)


def test_language_awkward_rows(spark, documents):
    en, de = "the quick brown fox and the dog", "der schnelle braune fuchs und die hunde"
    docs = documents([(i, (en, de)[i % 2], ("en", "de")[i % 2]) for i in range(40)])
    model = langid.fit(docs)
    out = {r.doc_id: r for r in langid.identify(documents(AWKWARD + [(9, de)], extra="score"), model).collect()}
    assert out[9].lang_pred == "de" and out[9].score > 0.9 and not out[9].rejected
    assert [out[i].lang_pred for i in (1, 2, 6)] == ["und"] * 3
    assert out[None].lang_pred in ("en", "de")


def test_language_counts_do_not_depend_on_pieces(monkeypatch):
    text = "Abé cd, " * 400
    whole = langid.counts(text)
    monkeypatch.setattr(langid, "PIECE", 1 << 30)
    assert (langid.counts(text) == whole).all()


# --------------------------------------------------------------- grammar
@pytest.fixture(scope="module")
def read():
    reader = toxicity.Reader({"idiot": 2.0, "scum*": 1.0})
    machine = toxicity.grammar()
    return lambda text: toxicity.clause_weights(text, reader, machine)


def test_grammar_lone_insults_are_weak(read):
    lone = toxicity.LONE
    assert read("what an idiot") == [pytest.approx(2.0 * lone)]
    assert read("the word idiot has five letters") == [pytest.approx(2.0 * lone)]
    assert read("scummiest thing. nothing here") == [pytest.approx(lone)]
    assert read("nothing here") == [] and read(None) == [] and read("") == []


def test_grammar_targets_and_second_insults_complete_a_clause(read):
    assert read("you idiot") == [2.5] and read("you are an idiot") == [2.5]
    assert read("an idiot, you") == [pytest.approx(2.0)]
    assert read("idiot scummy") == [pytest.approx(3.0)]
    assert read("idiot. you") == [pytest.approx(2.0 * toxicity.LONE)], "a clause's end closes it"
    assert read("the word idiot has five letters")[0] < 0.25 * read("you idiot")[0]


def test_grammar_negation_report(read):
    assert read("he is not an idiot") == [pytest.approx(2.0 * 1.25 * 0.5)]
    assert read("someone said idiot") == [pytest.approx(2.0 * toxicity.LONE * 0.6)]
    assert read("he said: you idiot") == [pytest.approx(2.0 * 1.25 * 0.6)]
    assert read("it is not so far from here, idiot scummy") == [pytest.approx(3.0)]
    assert read("a. not. you idiot") == [2.5], "a clause's end closes the negation"


def test_grammar_threat_needs_a_target(read):
    weight = toxicity.THREAT_WEIGHT
    assert read("they destroy old houses") == []
    assert read("i will destroy you") == [pytest.approx(weight)]
    assert read("i will never destroy you") != [weight]
    learnt = toxicity.Reader({"destroy": 5.0, "idiot": 2.0})
    weigh = lambda text: toxicity.clause_weights(text, learnt, toxicity.grammar())
    assert weigh("we destroy") == [] and weigh("i will destroy you") == [pytest.approx(5.0)]


@pytest.mark.parametrize(("text", "weight"), [
    ("ich werde dich töten", None), ("je vais détruire, tu", "threat"), ("il a écrit : tu idiot", 2.5 * 0.6),
    ("ella escribió: tú idiot", 2.5 * 0.6), ("ich werde töten dich", "threat"), ("er sagte: du idiot", 2.5 * 0.6),
    ("you I\u0308diot, IDIOT", 2.5 + 2.5)])
def test_grammar_words_are_spelled_with_accents(read, text, weight):
    want = [] if weight is None else [toxicity.THREAT_WEIGHT if weight == "threat" else weight]
    assert read(text) == [pytest.approx(w) for w in want]


def by_rules(symbols):
    """A clause's weight, told by its rules over the whole clause; insults
    weigh 2, threats 3."""
    total, negated, reported, armed, targeted, lone = 0.0, 0, False, False, False, None
    for i, s in enumerate(symbols):
        damp = (0.5 if negated else 1.0) * (0.6 if reported else 1.0)
        hit = None
        if s == "T":
            armed = True
        elif s == "Y":
            hit = 3.0 if armed else None
            armed = False
        elif s == "I":
            before = symbols[:i]
            first = not any(b in "IY" for b in before)
            later = [b for b in symbols[i + 1:] if b in "IY"]
            hit = 2.0 * (1 if not first or later else toxicity.LONE) * (1.25 if targeted and not first else 1.0)
        if hit is not None:
            total += damp * hit
        negated = 3 if s == "N" else max(0, negated - 1)
        reported = reported or s == "R"
        targeted = targeted or s == "Y"
    return total


def test_grammar_equals_its_rules():
    words = {"I": "idiot", "T": "kill", "Y": "you", "N": "not", "R": "said", "O": "house"}
    reader, machine, rng = toxicity.Reader({"idiot": 2.0}), toxicity.grammar(), random.Random(6)
    for _ in range(3000):
        symbols = "".join(rng.choices("ITYNRO", k=rng.randint(1, 9)))
        got = toxicity.clause_weights(" ".join(words[s] for s in symbols), reader, machine)
        assert sum(got) == pytest.approx(by_rules(symbols)), symbols


def test_composition_equals_running_the_parts_in_turn():
    parts = [toxicity.threat(), toxicity.insult(), toxicity.target(), toxicity.negation(), toxicity.report()]
    machine = toxicity.compose(*parts)
    rng = random.Random(2)
    for _ in range(200):
        word = [rng.choice(toxicity.SYMBOLS) for _ in range(rng.randint(0, 12))]
        states, one = [0] * len(parts), 0
        for symbol in word:
            out, factor = symbol, 1.0
            for i, part in enumerate(parts):
                out, by, states[i] = part.step(states[i], out)
                factor *= by
            got, weight, one = machine[(one, symbol)]
            assert (got, weight) == (out, factor)


def test_an_id_that_repeats_fills_no_sample(spark, documents):
    """A third of all rows under one id: one text of it is learnt."""
    rows = [(7, "the cat and the dog " + str(i), "en") for i in range(400)]
    rows += [(i, f"das ist ein haus und der hund {i}", "de") for i in range(1000, 1400)]
    rows += [(i, f"the house of the dog and a cat {i}", "en") for i in range(2000, 2400)]
    model = langid.fit(documents(rows), per_language=10_000)
    assert sorted(model.languages) == ["de", "en"]
    once = langid.fit(documents([(7, min(r[1] for r in rows if r[0] == 7), "en")] + [r for r in rows if r[0] != 7]),
                      per_language=10_000)
    assert (model.idf == once.idf).all() and (model.centroids == once.centroids).all()
