"""Packing: exact ids, gapless full sequences, the round-robin against a
walk over all windows, and awkward rows."""

from __future__ import annotations

import random
from collections import defaultdict
from functools import cache

import numpy as np
import pytest

from billstar.llm import packing
from billstar.llm.packing import Packing
from billstar.llm.queries import RANKS, TOKENIZER

EXOTIC = ["naïve  Ünïcödé  \u0085 x²½ it's ", "日本語 текст  ok", "a <|endoftext|> b", "  \n\n\t x\x1c y ", "'S's 12ab"]


@cache
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER)


def encode(text):
    return library().encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("ranks", [None, RANKS])
def test_ids_are_the_librarys(ranks):
    raw, by_rank = (open(p, "rb").read() if p else None for p in (TOKENIZER, ranks))
    ids_of = packing.Encoder(raw, by_rank, "<u2")
    for text in [*EXOTIC, "", "word word, word."]:
        assert np.frombuffer(ids_of(text), "<u2").tolist() == encode(text)


def check(rows, docs, window):
    """Every id in one piece, sequences full and gapless. Pieces by sequence."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
        assert r.length > 0 and len(r.ids) == 4 * r.length
    texts = defaultdict(list)
    for doc_id, text, *_ in docs:
        texts[doc_id].append(encode(text) + [1])
    assert set(by_doc) == set(texts)
    for doc_id, all_ids in texts.items():
        if len(all_ids) > 1:  # repeated rows: the same ids, once for each row
            assert sum(r.length for r in by_doc[doc_id]) == sum(map(len, all_ids))
            continue
        got = b"".join(bytes(r.ids) for r in sorted(by_doc[doc_id], key=lambda r: r.start))
        assert np.frombuffer(got, "<u4").tolist() == all_ids[0]
        assert {r.doc_tokens for r in by_doc[doc_id]} == {len(all_ids[0])}
    for k, parts in by_sequence.items():
        parts.sort(key=lambda r: r.offset)
        at = 0
        for r in parts:
            assert r.offset == at
            at += r.length
        assert at == window or k == max(by_sequence)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return by_sequence


def some_documents(seed=1, n=160):
    rng = random.Random(seed)
    words = "alpha beta Gamma, delta. epsilon 42 zeta's\n été".split(" ")
    source = lambda i: None if i % 17 == 0 else ("hot" if i % 3 else f"s{i % 5}")
    docs = [(i, " ".join(rng.choices(words, k=rng.choice([0, 1, 5, 40, 300]))), "en", source(i)) for i in range(n)]
    docs += [(1000 + i, t, "en", "hot") for i, t in enumerate(EXOTIC)]
    return docs + [(2000, None, None, None), (2001, "", "en", "alone"), (None, "no id here", "en", "hot"),
                   (2002, "long " * 30_000, "en", "s1"), (2003, "twice", "en", "hot"), (2003, "twice", "en", "hot")]


def test_every_source_has_its_share_of_every_window(spark, documents):
    docs = some_documents()
    p = Packing(window=256, unit=16)
    made = packing.pack(spark, documents(docs, "n ids phases units start").repartition(7), TOKENIZER, RANKS, p)
    rows = made.collect()
    by_sequence = check(rows, docs, 256)
    total = defaultdict(int)
    for r in rows:
        total[r.source] += r.length
    everything = sum(total.values())
    # deficits carry over: up to any window, each source is near its share
    units, levels = sum(n // 16 for n in total.values()), (len(total) - 1).bit_length()
    sent = defaultdict(int)
    for k in range(units // 16):
        for r in by_sequence[k]:
            sent[r.source] += r.length
        for source, n in total.items():
            assert abs(sent[source] / 16 - 16 * (k + 1) * (n // 16) / units) < levels
    assert everything == sum(r.length for r in rows)


def test_pairs_take_turns_by_credit():
    """The closed form against two queues that are walked unit by unit."""
    for left, right in ((5, 3), (1, 9), (7, 7), (10, 1)):
        n, credit, order = left + right, 0, []
        for _ in range(n):
            credit += left
            order.append(0 if credit >= n else 1)
            credit -= n * (credit >= n)
        for side, have in ((0, left), (1, right)):
            path = [(side, left, n)]
            assert [packing.place(path, j) for j in range(have)] == [i for i, s in enumerate(order) if s == side]
            for a in range(n + 1):
                for b in range(a, n + 1):
                    first, end, ahead = packing.share(path, a, b)
                    assert (first, end) == (order[:a].count(side), order[:b].count(side))
                    assert ahead == (order[a:b].count(0) if side else 0)


@pytest.mark.parametrize("weights", [{"x": 3, "y": 1}, {"y": 5.5, "z": 0.5}, {"x": 1}])
def test_weighted_queues_like_a_walk_over_the_windows(spark, documents, weights):
    rng = random.Random(5)
    docs = [(i, "word " * rng.choice([1, 9, 80]), "en", rng.choice(["x", "x", "x", "y", "z", None])) for i in range(200)]
    p = Packing(window=128, unit=8, weights=weights, rest=1)
    rows = packing.pack(spark, documents(docs).repartition(5), TOKENIZER, RANKS, p).collect()
    by_sequence = check(rows, docs, 128)
    name = lambda s: "a" + s if s in weights else "b"
    totals = defaultdict(int)
    for r in rows:
        totals[name(r.source)] += r.length
    units = {q: n // 8 for q, n in sorted(totals.items())}
    relative = {"a" + k: w for k, w in weights.items()} | {"b": 1}
    sent, k, left = defaultdict(int), 0, dict(units)
    for phase in packing.phases(units, relative, 16):
        assert all(n <= left[q] for q, n in phase.items())
        begun, total = dict(sent), sum(phase.values())
        for i in range(total // 16):
            for r in by_sequence[k]:
                sent[name(r.source)] += r.length
            k += 1
            for q, n in phase.items():
                assert abs((sent[q] - begun.get(q, 0)) / 8 - 16 * (i + 1) * n / total) < 2, (k, q)
        left = {q: n - phase.get(q, 0) for q, n in left.items()}
    assert not any(left.values())
    # while all queues last, they stand to each other as their weights
    first = packing.phases(units, relative, 16)[0]
    heavy = max(first, key=first.get)
    for q, n in first.items():
        assert abs(n / first[heavy] - relative[q] / relative[heavy]) < 0.1


def test_many_small_sources(spark, documents):
    docs = [(i, "one two three four five six seven " * (1 + i % 9), "en", f"host{i % 90}") for i in range(270)]
    rows = packing.pack(spark, documents(docs), TOKENIZER, RANKS, Packing(window=64, unit=32)).collect()
    check(rows, docs, 64)


def test_unit_one_and_one_window(spark, documents):
    docs = [(1, "a b c", "en", "x"), (2, None, "en", None)]
    rows = packing.pack(spark, documents(docs), TOKENIZER, None, Packing(unit=1)).collect()
    assert len(check(rows, docs, 2048)) == 1


def test_sequences_hold_their_ids(spark, documents):
    docs = some_documents(2, 40)
    p = Packing(window=64, unit=8)
    made = packing.pack(spark, documents(docs), TOKENIZER, RANKS, p)
    whole = packing.sequences(made).collect()
    assert all(len(r.ids) == 4 * r.tokens and r.tokens <= 64 for r in whole)
    assert sum(r.tokens for r in whole) == sum(len(encode(d[1])) + 1 for d in docs)


def test_empty_table(spark, documents):
    assert packing.pack(spark, documents([]), TOKENIZER, RANKS).collect() == []
    with pytest.raises(ValueError):
        packing.schedule(spark, spark.createDataFrame([("a", 1)], "queue string, tokens long"), Packing(unit=7))
