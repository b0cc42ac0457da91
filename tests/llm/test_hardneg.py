"""Hard negatives against all pairs."""

from __future__ import annotations

from math import floor, inf, nan

import numpy as np
import pytest

from billstar.llm import hardneg
from billstar.llm.hardneg import Mining

SCHEMA = "vec_id long, embedding array<float>, label int, q string, dim int"


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 9) for i, v, label in rows], SCHEMA)


def brute(rows, anchor, m=Mining()):
    """All pairs, row by row."""
    kept = {}
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not abs(x) < inf for x in v):
            continue
        mine = (label, [floor(m.scale * float(np.float32(x))) for x in v])
        kept[i] = min(kept.get(i, mine), mine)
    out = []
    for a, (label, q) in kept.items():
        if not anchor(a):
            continue
        others = sorted(
            ((-sum(x * y for x, y in zip(q, p)), i, theirs) for i, (theirs, p) in kept.items()
             if i != a and len(p) == len(q)), key=lambda x: x[:2])
        for s, p, _ in [x for x in others if x[2] == label][:m.positives]:
            inside = [(n, i) for n, i, theirs in others if theirs != label and m.low * -s <= 100 * -n <= m.high * -s]
            out += [(a, p, r + 1, i, -s, -n) for r, (n, i) in enumerate(inside[:m.negatives])]
    return sorted(out)


def mined(spark, rows, predicate="vec_id % 10 = 0", m=Mining()):
    return sorted(map(tuple, hardneg.mine(spark, hardneg.usable(table_of(spark, rows), m), predicate, m).collect()))


def vectors(n=400, dim=24, seed=3, labels=4):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(labels, dim))
    label = rng.integers(0, labels, n)
    v = centre[label] * 0.4 + rng.normal(size=(n, dim)) * 0.5
    return [(int(i), [float(np.float32(x)) for x in v[i]], int(label[i])) for i in range(n)]


@pytest.mark.parametrize("sizes", [(32_768, 2_048), (16, 4)])
def test_equals_all_pairs(spark, monkeypatch, sizes):
    monkeypatch.setattr(hardneg, "ROWS", sizes[0])
    monkeypatch.setattr(hardneg, "ANCHORS", sizes[1])
    rows = vectors()
    got = mined(spark, rows)
    assert got == brute(rows, lambda i: i % 10 == 0)
    assert len(got) > 500


def test_the_bounds_drop_rows_before_the_last_dimension():
    rng = np.random.default_rng(1)
    q = rng.integers(-20, 20, size=(5000, 64))
    q[:, :8] *= 40
    block = hardneg.Block(np.arange(5000), q)
    anchor = q[17].copy()
    seen = []

    def shrink(low, high):
        seen.append(len(low))
        return high >= hardneg.certain(low, 5) if len(low) > 5 else None

    at, score = block.scan(anchor, shrink)
    assert seen[-1] < 500 and set(np.argsort(-(q @ anchor))[:5]) <= set(at.tolist())


def test_awkward_rows(spark):
    rows = [
        (0, [1.0, 0.0], 1), (10, [1.0, 0.0], 1), (20, [1.0, 0.5], 2), (30, [0.5, 0.5], 2), (40, None, 1),
        (50, [None, 1.0], 1), (60, [nan, 1.0], 1), (70, [inf, 1.0], 2), (80, [1.0, 1.0], None), (None, [1.0, 1.0], 1),
        (90, [], 1), (100, [1.0, 0.0, 0.0], 1), (110, [0.0, 0.0], 2), (120, [-1.0, -1.0], 3), (0, [1.0, 0.0], 1),
        (130, [0.5, 0.5], 2), (20, [9.0, 9.0], 2), (140, [0.4, 0.1], 3), (150, [0.41, 0.1], 3), (160, [0.4, 0.1], 3)]
    got = mined(spark, rows)
    assert got == brute(rows, lambda i: i % 10 == 0)
    assert any(r[0] == 0 and r[1] == 10 for r in got)
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1)]) == []


def test_ties_and_one_hot_label(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "ROWS", 8)
    rows = [(i, [0.5, 0.25], 0) for i in range(60)] + [(100 + i, [0.25, 0.25], 1 + i % 2) for i in range(40)]
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_scores_beyond_32_bits(spark):
    for scale in (1.0e6, 3.0e5):
        rows = [(i, [scale * (1 + i % 3), -scale * (i % 5), 1.0], i % 2) for i in range(40)]
        assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)
    huge = [(i, [1.0e12, 1.0e12], 0) for i in range(3)] + [(10, [1.0e12, 1.0e12], 1)]
    got = mined(spark, huge, "vec_id = 0")
    assert {r[4] for r in got} <= {(1 << 63) - 1}


def test_the_query_equals_its_sql(spark):
    import duckdb

    from billstar.llm import queries

    sf = "/root/testdata/sf0.001"
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    want = sorted(duckdb.sql(hardneg.oracle()).fetchall())
    assert sorted(map(tuple, queries.op12_hard_negatives(spark, sf).collect())) == want
