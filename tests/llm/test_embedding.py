"""Subspace pigeonhole join against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

from billstar.llm import embedding

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold):
    clean = {}
    for i, v, label in rows:
        a = np.array([np.nan if x is None else x for x in v], dtype=np.float32).astype(float) if v else np.zeros(1)
        if i is not None and label is not None and np.isfinite(a).all() and a.any():
            clean[i] = (label, a / np.linalg.norm(a / np.abs(a).max()) / np.abs(a).max())
    links = {i: set() for i in clean}
    for i, (la, a) in clean.items():
        for j, (lb, b) in clean.items():
            if i < j and la == lb and len(a) == len(b) and a @ b >= threshold:
                links[i].add(j)
                links[j].add(i)
    out = {}
    for i, _, _ in rows:
        seen, todo = {i}, [i]
        while todo:
            for j in links.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out[i] = (len(links.get(i, ())), None if i is None else min(seen))
    return out


def check(spark, rows, threshold=0.93):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as rid", "2 as a", "3 as copies")
    got, want = embedding.link(spark, df, threshold).collect(), brute(rows, threshold)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_links, r.component_id) == want[r.vec_id]
        assert r.kept == (r.vec_id is None or r.vec_id == r.component_id)


@pytest.mark.parametrize("dim", [3, 16, 64])
def test_matches_all_pairs(spark, dim):
    rng = np.random.default_rng(dim)
    centres = rng.standard_normal((6, dim))
    rows = []
    for i in range(150):
        v = centres[i % 6] + rng.standard_normal(dim) * rng.choice([0.02, 0.15, 0.3, 1.0])
        rows.append((i, [float(x) for x in v * rng.uniform(0.1, 50)], int(i % 2)))
    rows += [(1000 + i, rows[i % 5][1], rows[i % 5][2]) for i in range(60)]
    check(spark, rows)


@pytest.mark.parametrize("axes", [1, 3, 4])
def test_any_number_of_axes_finds_the_same(spark, monkeypatch, axes):
    monkeypatch.setattr(embedding, "axes_for", lambda n: axes)
    rng = np.random.default_rng(axes)
    base = rng.standard_normal((5, 20))
    rows = [(i, [float(x) for x in base[i % 5] + rng.standard_normal(20) * 0.25], 0) for i in range(100)]
    check(spark, rows)


def test_axes_grow_with_the_label():
    got = [embedding.axes_for(n) for n in (0, 10, 4_000, 15_999, 16_000, 64_000, 10**12)]
    assert got == [2, 2, 2, 2, 3, 3, 3]


def test_slices_of_crowded_cells_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(embedding, "CELL", 4)
    rng = np.random.default_rng(5)
    base = rng.standard_normal((4, 20))
    rows = [(i, [float(x) for x in base[i % 4] + rng.standard_normal(20) * 0.25], 0) for i in range(120)]
    check(spark, rows)


def test_candidates_are_the_ring_of_two_blocks(spark):
    """The pairs that leave the join, worked out for all pairs."""
    rng = np.random.default_rng(11)
    base = rng.standard_normal((8, 24))
    v = np.array([base[i % 8] + rng.standard_normal(24) * 0.35 for i in range(120)])
    rows = [(i, [float(x) for x in v[i]], 0) for i in range(120)]
    reps = embedding.distinct_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    sizes = reps.groupBy("label", "dim").count().withColumnRenamed("count", "n")
    parts = embedding.blocks(reps, sizes, 0.93)
    got = {(r.a, r.b) for r in embedding.candidates(parts, embedding.crowded(parts)).collect()}
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    turned = (u @ embedding.rotation(24)).reshape(120, 3, 8)
    share = (2 - 2 * 0.93) / 3
    sure, maybe = set(), set()
    for a in range(120):
        for b in range(a + 1, 120):
            d = ((turned[a] - turned[b]) ** 2).sum(axis=1)
            for found, slack in ((sure, 0), (maybe, 2e-5)):
                if any(d[k] <= share + slack and d[k] + d[(k + 1) % 3] <= 2 * share + 2 * slack for k in range(3)):
                    found.add((a, b))
            assert u[a] @ u[b] < 0.93 or (a, b) in sure
    assert sure <= got <= maybe and len(sure) > 100


def test_rows_of_the_join_stay_bounded_as_a_label_grows(spark, monkeypatch):
    """A model at a hundredth: 500 and 10,000 vectors for 50,000 and 1,000,000."""
    monkeypatch.setattr(embedding, "CELL", embedding.CELL // 100)
    monkeypatch.setattr(embedding, "THIRD_AXIS", embedding.THIRD_AXIS // 100)
    rng = np.random.default_rng(2)

    def rows_each(n):
        rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(rng.standard_normal((n, 64)))]
        reps = embedding.distinct_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
        sizes = reps.groupBy("label", "dim").count().withColumnRenamed("count", "n")
        parts = embedding.blocks(reps, sizes, 0.93).cache()
        cells = embedding.crowded(parts)
        met = embedding.probes(parts, cells).count() + embedding.homes(parts, cells).count()
        parts.unpersist()
        return met / n / 8

    few, many = rows_each(500), rows_each(10_000)
    assert few <= 15 and many <= 6 * few


def test_plan_holds_no_cross_join_and_reads_two_blocks_a_row(spark):
    rows = [(i, [1.0, float(i), 2.0], 0) for i in range(5)]
    reps = embedding.distinct_vectors(spark.createDataFrame(rows, SCHEMA))
    sizes = reps.groupBy("label", "dim").count().withColumnRenamed("count", "n")
    parts = embedding.blocks(reps, sizes, 0.93)
    plan = embedding.candidates(parts, embedding.crowded(parts))._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert embedding.homes(parts, embedding.crowded(parts)).columns == ["cell", "rid", *[f"x{i}" for i in range(8)], "y"]


def test_awkward_rows(spark):
    one = [1.0, 2.0, 3.0]
    rows = [(1, one, 0), (2, one, 0), (3, [2.0, 4.0, 6.0], 0), (4, one, 1), (5, one, None), (6, None, 0), (7, [], 0),
            (8, [0.0, 0.0, 0.0], 0), (9, [1.0, None, 3.0], 0), (10, [1.0, float("nan"), 3.0], 0),
            (11, [float("inf"), 2.0, 3.0], 0), (12, [1.0, 2.0], 0), (None, one, 0), (1, one, 0),
            (13, [1e-30, 2e-30, 3e-30], 0), (14, [1e37, 2e37, 3e37], 0), (15, [-0.0, 1.0, 0.0], 2), (16, [0.0, 1.0, 0.0], 2)]
    check(spark, rows)


def test_empty_table(spark):
    assert embedding.link(spark, spark.createDataFrame([], SCHEMA)).count() == 0


def test_threshold_is_closed(spark):
    rows = [(1, [1.0, 0.0], 0), (2, [3.0, 4.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [r.n_links for r in embedding.link(spark, df, 0.6).collect()] == [1, 1]
    assert [r.n_links for r in embedding.link(spark, df, 0.6000001).collect()] == [0, 0]


def test_rotation_keeps_distances():
    rng = random.Random(0)
    q = embedding.rotation(24)
    v = np.array([rng.gauss(0, 1) for _ in range(24)])
    assert np.linalg.norm(v @ q) == pytest.approx(np.linalg.norm(v))
