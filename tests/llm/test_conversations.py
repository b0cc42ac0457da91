"""Conversation repair against a search over all edits of each conversation."""

from __future__ import annotations

import random
import re
from functools import cache
from hashlib import sha256
from zlib import crc32

import pytest

from billstar.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string, pos string, head string, kind int"
BLANK = " \t\n\x0b\x0c\r"


def table_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        h = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(conv, turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return out


def cheapest(turns):
    """(cost, audit, repaired) over all edit sequences, least cost first, then least audit."""
    def allowed(emitted, new):
        return bool(new) and (emitted + new) in ("s", "u", "su", "ua", "au")

    # more than three insertions in one place only add a pair
    @cache
    def solve(i, emitted):
        return limited_all(i, emitted, 3)

    def limited_all(i, emitted, depth):
        options = []
        if i == len(turns):
            if emitted in ("", "a"):
                options.append((0, "", ()))
        else:
            role, text, fault = turns[i]
            c, a, r = solve(i + 1, emitted)
            options.append((c + 2, "D" + a, r))
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                for new, cost, letter in ((role, 0, "K"), ("user", 1, "R"), ("assistant", 1, "R")):
                    if allowed(emitted, new[:1]):
                        c, a, r = solve(i + 1, new[0])
                        options.append((c + cost + extra, letter + a, ((new, text), *r)))
        if depth:
            for new in ("user", "assistant"):
                if allowed(emitted, new[0]):
                    c, a, r = limited_all(i, new[0], depth - 1)
                    options.append((c + 5, "I" + a, ((new, ""), *r)))
        return min(options, key=lambda x: x[:2], default=(10**9, "", ()))

    return solve(0, "")


def brute(rows, ids):
    out = []
    for conv in ids:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        count = {"blank": 0, "duplicate": 0, "truncated": 0}
        turns, seen = [], set()
        for _, _, role, text in mine:
            tail = text.rstrip(BLANK)
            fault = ("blank" if not tail else "duplicate" if (role, text) in seen
                     else "truncated" if tail[-1] not in ".!?" else None)
            seen.add((role, text))
            if fault:
                count[fault] += 1
            turns.append((role, text, fault))
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        at = [r[1] for r in mine if r[1] is not None]
        gaps = max(at) - min(at) + 1 - len(set(at)) if at else 0
        cost, audit, fixed = cheapest(turns)
        text = "\n".join(f"{a}:{b}" for a, b in fixed)
        out.append((conv, gaps, *count.values(), illegal, cost, audit, sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def compare(spark, rows, ids=None):
    ids = {r[0] for r in rows} if ids is None else ids
    got = conversations.repair(spark, table_of(spark, rows), table_of(spark, [(i, 0, "", "") for i in ids]))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    full = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert sorted(map(tuple, got.collect()), key=str) == brute(full, ids)


def some_rows(seed, n=60, longest=9):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "User", "", None]
    texts = ["Yes.", "No!", "cut off", "  ", "", None, "End? \n", "More.", "Why?", "ü. ", "one more"]
    rows = []
    for conv in range(n):
        for t in range(rng.randint(1, longest)):
            turn = rng.choice([t, t, t, t + 3, None]) if rng.random() < 0.3 else t
            rows.append((conv if conv else None, turn, rng.choice(roles), rng.choice(texts)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_equals_a_search_over_all_edits(spark, seed):
    compare(spark, some_rows(seed))


@pytest.mark.parametrize("size", [1, 2, 5])
def test_long_conversations_in_pieces(spark, monkeypatch, size):
    monkeypatch.setattr(conversations, "PIECE", size)
    compare(spark, some_rows(7, n=25, longest=23))


def test_damage_and_query(spark, tmp_path):
    from billstar.llm import queries

    rng = random.Random(4)
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", rng.choice(["Fine.", "So?", "no end", f"number {t}."]))
            for c in range(80) for t in range(rng.randint(1, 8))] + [(None, None, None, None), (81, None, "system", "Hi.")]
    gone = next(c for c in range(1000, 2000) if crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((gone, 0, "user", "dropped."))
    table_of(spark, rows).write.parquet(str(tmp_path / "conversations.parquet"))
    got = queries.op13_conversation_repair(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == brute(damage(rows), {r[0] for r in rows})
    assert tuple(next(r for r in got if r.conv_id == gone)) == (gone, 0, 0, 0, 0, 0, 0, "", sha256().hexdigest())


def test_repaired_rows_follow_the_grammar(spark):
    rows = some_rows(11, n=30)
    made = conversations.repaired(spark, table_of(spark, rows)).collect()
    by = {}
    for r in made:
        if r.edit != "D":
            by.setdefault(r.conv_id, []).append((r.position, r.role[:1]))
    for turns in by.values():
        turns.sort()
        assert [p for p, _ in turns] == list(range(len(turns)))
        assert re.fullmatch("(s?(ua)+)?", "".join(i for _, i in turns))
    whole = {r.conv_id: r.audit for r in conversations.repair(spark, table_of(spark, rows)).collect()}
    assert sum(map(len, whole.values())) == len(made)


def test_empty_table_and_a_very_long_text(spark):
    assert conversations.repair(spark, table_of(spark, [])).collect() == []
    compare(spark, [(1, 0, "user", "x" * 2_000_000 + " " * 100_000 + ". "), (1, 1, "assistant", ". " * 300_000)])


def test_suffixes_are_solved_once():
    shapes = sorted({"".join(random.Random(i).choices("suaox", k=12)) + "uaua" for i in range(200)}, key=lambda s: s[::-1])
    calls = []
    step = conversations.step
    conversations.step = lambda *a: calls.append(1) or step(*a)
    try:
        assert len(list(conversations.solve((s, -1) for s in shapes))) == len(shapes)
    finally:
        conversations.step = step
    assert len(calls) == len({s[i:] for s in shapes for i in range(len(s))})
