"""Fair queueing: targets by the reshare rule itself, the mix against a
row-by-row queue, and awkward rows."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest

from billstar.llm import mixing


def reshared(sizes: dict, mix=mixing.Mix()):
    """Targets by giving out and taking back, round after round."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mix.weights[i % len(mix.weights)] for i, s in enumerate(order)}
    left, target, open_ = mix.share * sum(sizes.values()), {}, set(order)
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total >= mix.passes * sizes[s]}
        if not full:
            return target | {s: left * weight[s] / total for s in open_}
        for s in full:
            target[s] = mix.passes * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def brute(rows, mix=mixing.Mix()):
    """(doc_id, text, source) -> words taken, by one ordered walk."""
    sized = [(i, len((t or "").split()), s, hashlib.md5(
        (str(i) if i is not None else (t or "")).encode()).hexdigest()) for i, t, s in rows]
    total = defaultdict(int)
    for _, n, s, _ in sized:
        total[s] += n
    target = reshared(total, mix)
    used, queue = defaultdict(int), []
    for at, row in enumerate(sorted(sized, key=lambda r: (r[3], r[1], r[0] if r[0] is not None else -1))):
        i, n, s, key = row
        row = (*row, at)
        used[s] += n
        for p in range(mix.passes):
            if n and target[s]:
                queue.append(((p * total[s] + used[s]) / target[s], p, key, n, s is None, s or "", i or -1, row))
    taken, sent = defaultdict(int), 0
    for *_, row in sorted(queue, key=lambda q: q[:-1]):
        sent += row[1]
        if sent > sum(target.values()):
            break
        taken[row] += row[1]
    whole = [(*row, at) for at, row in enumerate(sorted(sized, key=lambda r: (r[3], r[1], r[0] if r[0] is not None else -1)))]
    return {row: (total[row[2]], target[row[2]], taken[row]) for row in whole}


def test_matches_a_single_queue(spark, documents):
    rng = random.Random(1)
    names = ["b", "a", "\U0001f600", "\uffff", None, "tiny"]
    rows = []
    for i in range(400):
        s = "b" if i % 3 == 0 else rng.choice(names)
        rows.append((i, " ".join(["w"] * (1 if s == "tiny" else rng.choice([0, 1, 5, 20, 90]))), s))
    docs = documents([(i, t, "en", s) for i, t, s in rows], extra="size key target")
    got = {r.doc_id: r for r in mixing.plan(spark, docs).collect()}
    want = brute(rows)
    for (i, n, s, _, _), (total, target, taken) in want.items():
        r = got[i]
        assert (r["size"], r.source_size, r.taken) == (n, total, taken)
        assert r.target == pytest.approx(target)
    for s in names:
        own = [v for k, v in want.items() if k[2] == s]
        longest = max(k[1] for k in want if k[2] == s)
        assert abs(sum(v[2] for v in own) - own[0][1]) <= longest
    assert got and all(r.taken <= 2 * r["size"] for r in got.values())


def test_awkward_rows_and_rerun(spark, documents):
    rows = [(1, None), (2, ""), (3, "a " * 50_000), (None, "x y"), (None, "x y"), (None, None),
            (4, "one two", "en", None), (5, "p q", "en", "t"), (5, "p q", "en", "t")]
    docs = documents(rows)
    once = sorted(map(str, mixing.plan(spark, docs).collect()))
    assert len(once) == len(rows)
    assert once == sorted(map(str, mixing.plan(spark, docs.repartition(5)).collect()))


def repeated():
    """Three sources of 12,000 words; of c 400 rows repeat one document."""
    rng = random.Random(8)
    rows = []
    for s, n in (("a", 600), ("b", 600), ("c", 200)):
        rows += [(len(rows) + i, " ".join(["w"] * 20), "en", s) for i in range(n)]
    rows += [(9999, " ".join(["x"] * 20), "en", "c")] * 400
    rng.shuffle(rows)
    return rows


def test_repeated_rows_keep_to_the_target(spark, documents, monkeypatch):
    monkeypatch.setattr(mixing, "REPEATS", 37)
    rows = repeated()
    docs = documents(rows)
    got = mixing.plan(spark, docs).collect()
    assert len(got) == len(rows)
    taken, target = defaultdict(int), {}
    for r in got:
        taken[r.sk] += r.taken
        target[r.sk] = r.target
    assert set(target.values()) == {24000.0, 20000.0, 10000.0}
    assert all(abs(taken[s] - target[s]) <= 20 for s in target), taken
    want = brute([(i, t, s) for i, t, _, s in rows])
    assert sorted(r.taken for r in got if r.doc_id == 9999) == sorted(v[2] for k, v in want.items() if k[0] == 9999)
    again = mixing.plan(spark, docs.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    mixed = mixing.mixed(spark, docs).collect()
    assert len(mixed) == sum(r.passes for r in got)
    assert sum(r.doc_id == 9999 for r in mixed) == sum(r.passes for r in got if r.doc_id == 9999)
    assert len({(r.source, r.mix_finish) for r in mixed}) == len(mixed)


def test_the_sql_gives_the_same_rows(spark, documents, tmp_path):
    import duckdb

    rows = repeated() + [(None, "p q"), (None, "p q"), (None, None), (5, ""), (5, "one two three", "en", None),
                         (5, "one two four", "en", None), (6, "\u00a0 x\ty", "en", "\U0001f600")]
    docs = documents(rows)
    docs.write.parquet(str(tmp_path / "d"))
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    want = sorted(map(str, duckdb.sql(mixing.oracle()).fetchall()))
    got = mixing.plan(spark, docs).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert sorted(str(tuple(r)) for r in got) == want


def test_mixed_gives_each_of_different_rows_its_copies(spark, documents):
    """Rows of one id and size with different texts are taken as often as the plan says."""
    rows = [(1, f"w{i} w w", "en", "a") for i in range(6)] * 2 + [(i, "x y z", "en", "b") for i in range(10, 30)]
    docs = documents(rows)
    plan = mixing.plan(spark, docs).collect()
    mixed = mixing.mixed(spark, docs).collect()
    for p in (0, 1):
        assert sum(r.mix_pass == p for r in mixed) == sum(r.passes > p for r in plan)
    assert all(sum(r.text == t and r.mix_pass == p for r in mixed) <= 2 for t in {r[1] for r in rows[:6]} for p in (0, 1))


def test_empty_and_wordless(spark, documents):
    assert mixing.plan(spark, documents([])).count() == 0
    assert [r.taken for r in mixing.plan(spark, documents([(1, ""), (2, None)])).collect()] == [0, 0]
    assert mixing.mixed(spark, documents([(1, "")])).count() == 0


def test_mixed_is_sorted_and_repeats(spark, documents):
    rng = random.Random(3)
    docs = documents([(i, " ".join(["w"] * rng.randint(1, 30)), "en", "ab"[i % 7 == 0]) for i in range(150)])
    plan = {r.doc_id: r for r in mixing.plan(spark, docs).collect()}
    rows = mixing.mixed(spark, docs).collect()
    assert [r.mix_finish for r in rows] == sorted(r.mix_finish for r in rows)
    seen = defaultdict(int)
    for r in rows:
        seen[r.doc_id] += 1
    assert all(seen[i] * r["size"] == r.taken for i, r in plan.items())
    assert rows[0].asDict().keys() == set(docs.columns) | {"mix_pass", "mix_finish"}
