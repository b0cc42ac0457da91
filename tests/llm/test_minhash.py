"""Circulant MinHash against brute-force Jaccard over all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

from billstar.llm import minhash
from billstar.llm.common import components


def shingles(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(zip(*[words[i:] for i in range(k)])) if len(words) >= k else frozenset([tuple(words)])


def brute(rows, p):
    sets = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            sets[doc_id] = shingles(text, p.words)
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= p.percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def check(spark, df, rows, p):
    got = minhash.link(spark, df, p).collect()
    want = brute(rows, p)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
            assert r.kept == (r.doc_id == r.component_id)


def edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10**6)}"
    return " ".join(out)


@pytest.mark.parametrize("p", [minhash.Params(), minhash.Params(words=5, percent=80, rows=5, bands=32)])
def test_matches_brute_force_with_a_large_group(spark, documents, p):
    rng = random.Random(11)
    base = [f"b{i}" for i in range(150)]
    rows = [(1000 + i, edited(rng, base, rng.randint(0, 7))) for i in range(120)]
    rows += [(i, edited(rng, [f"d{i // 4}_{j}" for j in range(40)], rng.randint(0, 2))) for i in range(120)]
    rows += [(2000 + i, " ".join(base)) for i in range(30)]
    check(spark, documents(rows), rows, p)


def test_awkward_rows(spark, documents):
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "ONE"), (6, "one two"), (7, "one two three"),
            (8, "x y z " * 20_000), (9, "X\u000bY Z " * 20_000), (10, "Éa b c"), (11, "éa b c"),
            (None, "one"), (None, None), (12, "a b c d"), (13, "a b c d"), (13, "a b c d")]
    check(spark, documents(rows, extra="n size c component"), rows, minhash.Params())


def test_keep_one(spark, documents):
    same = "a b c d e f g h i j"
    rows = [(3, same), (2, same), (2, same), (9, "other words in this text here"), (None, same), (None, same)]
    docs = documents(rows, extra="component_id")
    kept = minhash.keep_one(spark, docs, minhash.Params(words=5, percent=80, rows=5, bands=32))
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [2, 9]


def test_keep_one_links_rows_without_an_id(spark, documents):
    same, alone = "a b c d e f g h i j", "no other row has these words at all"
    rows = [(None, same)] * 5 + [(4, same), (6, same), (None, alone), (None, alone), (None, None), (None, None),
                                 (None, alone + " but one"), (8, None), (8, None), (None, "")]
    p = minhash.Params(words=5, percent=60, rows=5, bands=32)
    kept = [(r.doc_id, r.text) for r in minhash.keep_one(spark, documents(rows), p).collect()]
    assert sorted(map(str, kept)) == sorted(map(str, [(4, same), (None, None), (8, None), (None, "")] + [
        k for k in kept if (k[1] or "").startswith(alone)]))
    assert sum((k[1] or "").startswith(alone) for k in kept) == 1


def test_keep_one_keeps_different_texts_of_one_id(spark, documents):
    same = "a b c d e f g h i j"
    rows = [(7, same, "en"), (7, "quite another text without any link", "en"), (7, "a third text under the same id", "en"),
            (7, "a third text under the same id", "de"), (3, same, "en"), (7, None, "en"), (8, "only once here", "en")]
    p = minhash.Params(words=5, percent=80, rows=5, bands=32)
    got = [
        sorted((r.doc_id, r.text or "", r.lang) for r in minhash.keep_one(spark, documents(order), p).collect())
        for order in (rows, rows[::-1])]
    assert got[0] == got[1]
    assert [r[:2] for r in got[0]] == [
        (3, same), (7, ""), (7, "a third text under the same id"), (7, "quite another text without any link"),
        (8, "only once here")]


def test_empty_table(spark, documents):
    assert minhash.link(spark, documents([]), minhash.Params()).count() == 0


def test_signature_estimates_jaccard():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**63, 4000).astype(np.uint64)
    x, y = np.unique(a[:3000]), np.unique(a[1000:])
    same = (minhash.signature(x, 512) == minhash.signature(y, 512)).mean()
    assert abs(same - 0.5) < 0.1


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(60)] + [(500, i) for i in range(200, 300)] + [(7, 7), (40, 41)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in components(spark, spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 200 for i in range(200, 300)}, 500: 200}


def test_star_plan_is_merged_not_broadcast(spark, documents):
    docs = documents([(i, "a b c d") for i in range(4)])
    pairs = spark.createDataFrame([(0, 1, 2, False)], "c long, x long, n long, many boolean")
    plan = minhash.verify(spark, docs, pairs, minhash.Params())._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
