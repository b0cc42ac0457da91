"""Spaced-seed matching: oracle agreement, substitutions, awkward rows."""

from __future__ import annotations

import itertools
import math
import random

import pytest

from billstar.llm import decontaminate as D

RNG = random.Random(8)
ITEM = [f"item{i}" for i in range(24)]
NOISE = [f"noise{i}" for i in range(5000)]


def noise(n):
    return [RNG.choice(NOISE) for _ in range(n)]


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "'x' as doc_id", "1 as at")


def test_verbatim_partial_and_substituted(spark, documents):
    changed = list(ITEM)
    changed[6] = changed[15] = "other"
    spoiled = ["other" if i % 3 == 0 else w for i, w in enumerate(ITEM)]
    docs = documents([
        (1, " ".join(noise(50) + ITEM + noise(50))),
        (2, " ".join(noise(30) + changed)),
        (3, " ".join(ITEM[5:20] + noise(40))),
        (4, " ".join(noise(40) + spoiled + noise(5))),
        (5, " ".join(noise(200))),
        (6, ", ".join(ITEM).upper()),
        (7, " ".join(ITEM[:9])),
    ], extra="w h item_id alt")
    got = {r.doc_id: r for r in D.contaminated(spark, docs, bench(spark, [(1, " ".join(ITEM))])).collect()}
    assert sorted(got) == [1, 2, 3, 6]
    assert (got[1].matched, got[1].coverage, got[1]["at"]) == (24, 1.0, 50)
    assert got[2].matched == 22 and got[3].matched == 15


def test_awkward_rows(spark, documents):
    text = " ".join(ITEM)
    rows = [(1, None), (2, ""), (None, text), (None, "clean"), (3, text), (3, text), (4, "la " * 60_000), (5, "x")]
    docs = documents(rows)
    items = [(1, text), (1, text), (2, None), (3, ""), (4, "too short"), (None, text), (5, "la " * 20)]
    got = D.contaminated(spark, docs, bench(spark, items)).collect()
    assert sorted((r.doc_id or 0, r.item_id) for r in got) == [(0, 1), (3, 1), (4, 5)]
    kept = D.remove(spark, docs, bench(spark, items))
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [
        (0, "clean"), (1, ""), (2, ""), (5, "x")]


def test_empty_tables(spark, documents):
    assert D.contaminated(spark, documents([]), bench(spark, [(1, " ".join(ITEM))])).count() == 0
    assert D.contaminated(spark, documents([(1, " ".join(ITEM))]), bench(spark, [])).count() == 0


def test_without_broadcast(spark, documents, monkeypatch):
    monkeypatch.setattr(D, "BROADCAST_ROWS", -1)
    docs = documents([(i, " ".join(noise(20) + (ITEM if i % 2 else []))) for i in range(20)])
    got = D.contaminated(spark, docs, bench(spark, [(1, " ".join(ITEM))])).collect()
    assert sorted(r.doc_id for r in got) == list(range(1, 20, 2))


def accepted(a, b, seeds):
    """The verifier's rule on two token lists, over all diagonals, without masks."""
    stretch = min(len(b), seeds.check)
    need = math.ceil(stretch * (1 - seeds.tolerance))
    for d in range(-len(b) + 1, len(a)):
        same = [a[i] == b[i - d] for i in range(max(d, 0), min(len(a), len(b) + d))]
        if any(sum(same[i:i + stretch]) >= need for i in range(len(same) - stretch + 1)):
            return True
    return False


@pytest.mark.parametrize("n", [11, 12, 13, 14, 15])
def test_masks_hit_every_accepted_substitution(n):
    seeds = D.Seeds()
    masks = seeds.masks + (seeds.short if n < seeds.check else ())
    placed = [{at + i for i, bit in enumerate(m) if bit == "1"} for m in masks for at in range(n - seeds.span + 1)]
    assert [pair for pair in itertools.combinations(range(n), 2) if all(s & set(pair) for s in placed)] == []


def test_substitutions_against_all_alignments(spark, documents):
    """Every pair of substituted tokens, and chance substitutions in longer
    overlaps and in items cut by the document's ends."""
    rng, items, docs = random.Random(31), {}, {}
    for n in (11, 12, 13):
        items[n] = [f"short{n}x{i}" for i in range(n)]
        for pair in itertools.combinations(range(n), 2):
            docs[len(docs)] = noise(4) + ["other" if i in pair else w for i, w in enumerate(items[n])] + noise(4)
    for n in (16, 30):
        items[n] = [f"long{n}x{i}" for i in range(n)]
        for _ in range(60):
            low = rng.randrange(n - 12)
            part = items[n][low:rng.randrange(low + 13, n + 1)]
            docs[len(docs)] = noise(3) + ["other" if rng.random() < 0.18 else w for w in part] + noise(3)
    seeds = D.Seeds()
    want = {(d, n) for d, a in docs.items() for n, b in items.items() if accepted(a, b, seeds)}
    got = D.contaminated(
        spark, documents([(d, " ".join(a)) for d, a in docs.items()]),
        bench(spark, [(n, " ".join(b)) for n, b in items.items()]))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want and len(want) > 200


def test_short_items_match_verbatim(spark, documents):
    docs = documents([
        (1, "say Open, sesame now"), (2, "open the sesame"), (3, "reopen sesame"), (4, "yes"),
        (5, " ".join(noise(20) + ITEM[:9])), (6, " ".join([*ITEM[:4], "other", *ITEM[5:9]])), (7, None), (8, "")])
    items = [(1, "open sesame"), (2, "Yes!"), (3, " ".join(ITEM[:9])), (4, ""), (5, None)]
    each = D.Seeds(least=1)
    got = D.contaminated(spark, docs, bench(spark, items), each).collect()
    assert sorted((r.doc_id, r.item_id, r.matched, r["at"], r.coverage) for r in got) == [
        (1, 1, 2, 1, 1.0), (4, 2, 1, 0, 1.0), (5, 3, 9, 20, 1.0)]
    kept = D.remove(spark, docs, bench(spark, items), each).collect()
    assert sorted(r.doc_id for r in kept) == [2, 3, 6, 7, 8]


def test_a_word_alone_is_no_benchmark_item(spark, documents):
    docs = documents([(i, f"The {w} went home. The end of the day") for i, w in enumerate(["cat", "dog", "cow"])]
                     + [(9, "we say: the end of the day")])
    items = bench(spark, [(1, "The"), (2, "the end of"), (3, "END of the Day!"), (4, "a cow went home"), (None, "dog")])
    assert sorted(r.text for r in D.unsearched(items).collect()) == ["The", "dog", "the end of"]
    assert {r.item_id for r in D.contaminated(spark, docs, items).collect()} == {3}
    few = bench(spark, [(1, "The"), (2, "the end of"), (4, "a cow went home"), (None, "dog")])
    assert D.remove(spark, docs, few).count() == 4


def test_a_long_repetitive_text(spark, documents):
    """60,000 equal tokens against an item of 300: as many diagonals, each in one pass."""
    docs = documents([(1, "la " * 60_000), (2, "la " * 12), (3, "la " * 13)])
    got = {r.doc_id: (r.matched, r["at"]) for r in D.contaminated(spark, docs, bench(spark, [(1, "la " * 300)])).collect()}
    assert got == {1: (300, 0), 3: (13, 0)}


def test_the_sql_sees_what_masks_could_miss(spark, documents, tmp_path):
    """The SQL tries all alignments: substituted and cut overlaps, and short items."""
    import duckdb

    rng, rows, items = random.Random(12), [], []
    for n in (4, 7, 10, 11, 12, 13, 20, 40):
        words = [f"q{n}x{i % 9}" for i in range(n)]
        items.append((n, " ".join(words)))
        for _ in range(25):
            low = rng.randrange(max(1, n - 12))
            part = ["other" if rng.random() < 0.13 else w for w in words[low:]]
            rows.append((len(rows), " ".join(noise(rng.randint(0, 5)) + part + noise(rng.randint(0, 5)))))
    rows += [(len(rows), None), (len(rows) + 1, ""), (0, "la " * 50), (None, items[-1][1])]
    items += [(50, "la " * 20), (50, "la " * 14), (None, "x y z w"), (60, "one two"), (61, None)]
    documents(rows).write.parquet(str(tmp_path / "d"))
    bench(spark, items).write.parquet(str(tmp_path / "b"))
    for name, f in (("documents", "d"), ("benchmark", "b")):
        duckdb.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM '{tmp_path}/{f}/*.parquet'")
    want = sorted(duckdb.sql(D.oracle()).fetchall())
    got = D.contaminated(spark, documents(rows), bench(spark, items)).where("doc_id is not null").select(
        "doc_id", "item_id", "matched", "item_tokens", "at", "coverage")
    assert sorted(map(tuple, got.collect())) == want and len(want) > 100


def test_items_without_an_id_are_removed(spark, documents):
    docs = documents([(1, " ".join(noise(9) + ITEM)), (2, "clean " * 30), (None, "a brief text here"), (3, " ".join(ITEM[::-1]))])
    items = bench(spark, [(None, " ".join(ITEM)), (None, " ".join(ITEM[::-1])), (None, "a brief text here"), (None, None)])
    assert [r.doc_id for r in D.remove(spark, docs, items).collect()] == [2]
    assert D.contaminated(spark, docs, items).count() == 0


def test_removal_judges_each_text_of_a_repeated_id(spark, documents):
    docs = documents([(1, " ".join(ITEM)), (1, "clean words"), (1, "clean words"), (2, " ".join(ITEM))])
    kept = D.remove(spark, docs, bench(spark, [(1, " ".join(ITEM))])).collect()
    assert [(r.doc_id, r.text) for r in kept] == [(1, "clean words")] * 2
