"""Conversation structure repair over a suffix-shared automaton.

A turn is a symbol: its role's initial, and whether it is sound, cut off
or to be deleted (blank, or a repeat). A conversation's symbols are its
signature. What the cheapest edits of a suffix cost, and which they are,
depends on that suffix and on the grammar's state before it alone, so
signatures are sorted by their reverse and read from the end: suffixes that
signatures share are one node, and a node holds, for each grammar state,
the cost to go, the best first edit and the rest of the best audit. Each is computed
once for all conversations that have the signature.

Long conversations are cut into pieces of bounded length. A piece that is
not the last is solved for every cost vector that a continuation can have
(there are few, as costs of states differ by a bounded amount), and a pass
from the last piece to the first picks the right one.

Grammar of roles, by initials: (s?(ua)+)?
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from hashlib import sha256

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from billstar.llm.common import discard, written

#: What separates words, and what may end a turn.
BLANKS, ENDS = "\t\n\x0b\x0c\r ", ".!?"
#: Turns of a signature's piece.
PIECE = 4096
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5

# Grammar states: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a kept turn of this initial leads from a state.
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: Where an inserted or re-roled turn leads, and its role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = ("user", "user", "assistant", "user")
#: Sound turns by initial (o: any other), the same cut off, and deletions.
SYMBOLS = "suaoSUAOx"
NEVER = 1 << 40

Node = tuple  # (cost to go, audit) of each grammar state; an audit is (letter, symbols used, next state, rest)


# ------------------------------------------------------------ the automaton
def _inserts(options: list[dict]) -> Node:
    """Best option of each state, with insertions before it: the cheapest,
    of equal ones the least letter."""
    cost = [min((c for c, _ in o.values()), default=NEVER) for o in options]
    for _ in range(3):
        cost = [min(c, INSERT + cost[NEXT[g]]) for g, c in enumerate(cost)]
    best: list = [None] * 4

    def audit(g: int):
        if best[g] is None:
            plain = [(letter, rest) for letter, (c, rest) in options[g].items() if c == cost[g]]
            if INSERT + cost[NEXT[g]] == cost[g]:
                plain.append(("I", None))
            letter, rest = min(plain, key=lambda x: x[0])
            best[g] = ("I", NEXT[g], audit(NEXT[g])) if letter == "I" else rest
        return best[g]

    return tuple((cost[g], audit(g)) for g in range(4))


def ending(vector: tuple[int, ...] | None = None) -> Node:
    """The node behind the last symbol: of the conversation (None), or of a
    piece whose continuation costs ``vector``. ("", g, None) ends an audit in state g."""
    if vector is None:
        return _inserts([{"": (0, ("", g, None))} if g in (START, ASSISTANT) else {} for g in range(4)])
    return tuple((c, ("", g, None)) for g, c in enumerate(vector))


def step(symbol: str, after: Node) -> Node:
    """The node of ``symbol`` followed by ``after``."""
    options = []
    extra = CUT_OFF if symbol.isupper() else 0
    for g in range(4):
        o = {"D": (DELETE + after[g][0], ("D", g, after[g][1]))}
        if symbol != "x":
            to = KEPT.get((g, symbol.lower()))
            if to is not None:
                o["K"] = (KEEP + extra + after[to][0], ("K", to, after[to][1]))
            o["R"] = (REROLE + extra + after[NEXT[g]][0], ("R", NEXT[g], after[NEXT[g]][1]))
        options.append(o)
    return _inserts(options)


def vector_of(node: Node) -> tuple[tuple[int, ...], int]:
    """Costs to go less the smallest, and the smallest."""
    least = min(c for c, _ in node)
    return tuple(c - least for c, _ in node), least


@cache
def vectors() -> tuple[tuple[int, ...], ...]:
    """All cost vectors that suffixes can have; the first is the end's."""
    found = {vector_of(ending())[0]: None}
    todo = list(found)
    for v in todo:
        for symbol in SYMBOLS:
            w = vector_of(step(symbol, ending(v)))[0]
            if w not in found:
                found[w] = None
                todo.append(w)
    return tuple(found)


def spelled(audit) -> tuple[str, int]:
    """The letters of an audit and the state it ends in."""
    letters = []
    while True:
        letter, g, rest = audit
        if rest is None:
            return "".join(letters), g
        letters.append(letter)
        audit = rest


def solve(shapes: Iterator[tuple[str, int]]) -> Iterator[tuple[list[dict], int, int]]:
    """For each (signature, end), sorted by end and reversed signature: the
    audit and exit state of each entry state, the vector before it and the
    cost it adds. ``end`` is a place in :func:`vectors`, or -1 at the end
    of a conversation. Only the path of the current signature is held."""
    number = {v: i for i, v in enumerate(vectors())}
    path: list[Node] = []
    last, at = "", None
    for signature, end in shapes:
        turned = signature[::-1]
        if end != at:
            path, last, at = [ending(None if end < 0 else vectors()[end])], "", end
        shared = 0
        for x, y in zip(last, turned):
            if x != y:
                break
            shared += 1
        del path[shared + 1:]
        for symbol in turned[shared:]:
            path.append(step(symbol, path[-1]))
        last = turned
        vector, least = vector_of(path[-1])
        audits = [dict(zip(("audit", "state"), spelled(a))) for _, a in path[-1]]
        yield audits, number[vector], least


# ------------------------------------------------------------- in Spark
def damaged(conversations: DataFrame) -> DataFrame:
    """The registered query's damage by crc32 of ``conv_id:turn``: (conv_id,
    turn, role, text), NULL roles and texts as one space."""
    name = "concat(coalesce(cast(conv_id as string), ' '), ':', coalesce(cast(turn as string), ' '))"
    d = conversations.selectExpr(
        "conv_id", "turn", "coalesce(role, ' ') as role", "coalesce(text, ' ') as text", f"crc32({name}) % 20 as h")
    d = d.where("h <> 0").selectExpr(
        "conv_id", "turn", "if(h = 4, 'user', role) as role",
        f"case h when 1 then '' when 2 then translate(text, '{ENDS}', '') else text end as text",
        "explode(sequence(1, if(h = 3, 2, 1))) as copy")
    return d.drop("copy")


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with their place in the
    conversation (pos), its piece, symbol and faults. One exchange."""
    rows = rows.selectExpr(
        "conv_id", "cast(turn as bigint) as turn", "coalesce(role, ' ') as role", "coalesce(text, ' ') as text")
    rows = rows.withColumn("tail", F.rtrim("text", F.lit(BLANKS))).selectExpr(
        "*", "tail = '' as blank", f"not contains('{ENDS}', substring(tail, -1, 1)) as open",
        "substring(role, 1, 1) as initial").drop("tail")
    rows = rows.repartition("conv_id")
    same = Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    rows = rows.withColumn("nth", F.row_number().over(same))
    inside = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text", "nth")
    rows = rows.withColumns({
        "pos": F.row_number().over(inside) - 1,
        "before": F.lag("initial").over(inside), "turn_before": F.lag("turn").over(inside)})
    plain = "if(initial in ('s', 'u', 'a'), initial, 'o')"
    return rows.selectExpr(
        "conv_id", "cast(pos as bigint) as pos", f"cast(pos div {PIECE} as bigint) as piece", "turn", "role", "text",
        "blank", "not blank and nth > 1 as duplicate", "not blank and nth = 1 and open as truncated",
        "pos > 0 and concat(before, initial) not in ('su', 'ua', 'au') as illegal",
        "turn is not null and not (turn <=> turn_before) as new_turn",
        f"case when blank or nth > 1 then 'x' when open then upper({plain}) else {plain} end as symbol")


def _solved(spark: SparkSession, pieces: DataFrame) -> DataFrame:
    """(signature, end, audits, vector, cost) for each distinct signature of
    ``pieces`` (signature, last) and each end it can have."""
    ends = F.when(F.col("last"), F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.lit(len(vectors()) - 1)))
    shapes = pieces.select("signature", F.explode(ends).alias("end")).distinct().withColumn(
        "turned", F.reverse("signature"))
    shapes = shapes.repartitionByRange("end", "turned").sortWithinPartitions("end", "turned")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def read():
            for pdf in batches:
                for pair in zip(pdf.signature, pdf.end):
                    keys.append(pair)
                    yield pair

        keys: list = []
        out: list = []
        for solved in solve(read()):
            out.append((*keys.pop(0), *solved))
            if len(out) == 1024:
                yield pd.DataFrame(out, columns=names)
                out = []
        yield pd.DataFrame(out, columns=names)

    names = ["signature", "end", "audits", "vector", "cost"]
    return written(spark, shapes.select("signature", "end").mapInPandas(
        run, "signature string, end int, audits array<struct<audit:string,state:int>>, vector int, cost long"), "solved")


def _chained(pieces: DataFrame, solved: DataFrame) -> DataFrame:
    """(conv_id, piece, audits, cost): the solution of every piece for the
    end that its successors give it. ``cost`` is what the piece adds; the
    first piece's also has the start's share of its vector."""
    last = pieces.where("last and piece = 0").join(solved.where("end = -1"), "signature").selectExpr(
        "conv_id", "piece", "audits", "cost", "vector")
    options = solved.groupBy("signature").agg(
        F.map_from_entries(F.collect_list(F.struct("end", "vector"))).alias("before"))
    long = pieces.where("not last or piece > 0").join(options, "signature")
    long = long.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("piece"))
    schema = long.selectExpr("conv_id", "piece", "signature", "0 as end").schema
    arrow = to_arrow_schema(schema)

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = -1
        for batch in batches:
            ends = []
            for final, before in zip(batch.column("last").to_pylist(), batch.column("before").to_pylist()):
                end = -1 if final else vector
                ends.append(end)
                vector = dict(before)[end]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("conv_id", "piece", "signature")], pa.array(ends, pa.int32())], schema=arrow)

    picked = long.mapInArrow(back, schema).join(solved, ["signature", "end"]).selectExpr(
        "conv_id", "piece", "audits", "cost", "vector")
    start = F.element_at(F.array(*[F.lit(v[START]) for v in vectors()]), F.col("vector") + 1)
    return last.unionByName(picked).withColumn(
        "cost", F.col("cost") + F.when(F.col("piece") == 0, start).otherwise(0)).drop("vector")


def _walk(batches: Iterator[pa.RecordBatch]):
    """Events of sorted conversations: ("open", head), ("turn", letter,
    role, text), ("close", conv_id). Only the current letters are held."""
    now, opened, state, letters = None, False, START, iter(())

    def inserted():
        nonlocal state, held
        while held == "I":
            yield "turn", "I", ROLE[state], ""
            state = NEXT[state]
            held = next(letters, None)

    held = None
    for batch in batches:
        for row in batch.to_pylist():
            if not opened or row["conv_id"] != now:
                if opened:
                    yield from inserted()
                    yield "close", now
                now, opened, state, letters, held = row["conv_id"], True, START, iter(()), None
            if row["kind"] == 0:
                yield "open", row["head"]
            elif row["kind"] == 1:
                yield from inserted()
                letters = iter(row["audits"][state]["audit"])
                held = next(letters, None)
            else:
                yield from inserted()
                if held == "D":
                    yield "turn", "D", row["role"], row["text"]
                elif held == "R":
                    yield "turn", "R", ROLE[state], row["text"]
                    state = NEXT[state]
                else:
                    yield "turn", "K", row["role"], row["text"]
                    state = KEPT[state, row["role"][:1]]
                held = next(letters, None)
    if opened:
        yield from inserted()
        yield "close", now


def _events(spark: SparkSession, rows: DataFrame, ids: DataFrame | None) -> DataFrame:
    """Heads (counts and cost), solved pieces and turns of every
    conversation, each conversation in one partition and in order."""
    marked = written(spark, faults(rows), "turns")
    ends = marked.groupBy("conv_id").agg(
        F.max("pos").alias("top"), F.min("turn").alias("low"), F.max("turn").alias("high"),
        F.count_if("new_turn").alias("turns"),
        *[F.count_if(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])
    pieces = marked.groupBy("conv_id", "piece").agg(
        F.array_sort(F.collect_list(F.struct("pos", "symbol"))).alias("s"), F.max("pos").alias("end"))
    pieces = pieces.join(ends.selectExpr("conv_id as c", "top"), F.expr("conv_id <=> c")).selectExpr(
        "conv_id", "piece", "array_join(transform(s, x -> x.symbol), '') as signature", "end = top as last")
    pieces = written(spark, pieces, "signatures")
    chained = written(spark, _chained(pieces, _solved(spark, pieces)), "audits")
    discard(pieces)
    costs = chained.groupBy("conv_id").agg(F.sum("cost").alias("cost"))
    wide = "cast({} as decimal(38,0))".format
    heads = ends.join(costs.withColumnRenamed("conv_id", "c"), F.expr("conv_id <=> c")).selectExpr(
        "conv_id", f"""named_struct(
            'gaps', coalesce(cast({wide('high')} - {wide('low')} + 1 - turns as bigint), 0L), 'blank', blank,
            'duplicate', duplicate, 'truncated', truncated, 'illegal', illegal, 'cost', cost) as head""")
    if ids is not None:
        heads = ids.select(F.col("conv_id").alias("i")).distinct().join(heads, F.expr("i <=> conv_id"), "left").selectExpr(
            "i as conv_id", """coalesce(head, named_struct('gaps', 0L, 'blank', 0L, 'duplicate', 0L,
                                                           'truncated', 0L, 'illegal', 0L, 'cost', 0L)) as head""")
    events = heads.withColumns({"pos": F.lit(-1).cast("long"), "kind": F.lit(0)}).unionByName(
        chained.selectExpr("conv_id", f"piece * {PIECE} as pos", "1 as kind", "audits"), allowMissingColumns=True
    ).unionByName(marked.selectExpr("conv_id", "pos", "2 as kind", "role", "text"), allowMissingColumns=True)
    return events.repartition("conv_id").sortWithinPartitions("conv_id", "pos", "kind")


def repaired(spark: SparkSession, rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """The repaired conversations: conv_id, position (from 0 in the repaired
    conversation; NULL for a deleted turn), edit (K, R, D or I), role, text."""
    events = _events(spark, rows, ids)
    schema = events.selectExpr("conv_id", "cast(null as bigint) as position", "'' as edit", "role", "text").schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, position, out = _Ids(), 0, []
        for event in _walk(held.seen(batches)):
            if event[0] == "open":
                position = 0
            elif event[0] == "turn":
                deleted = event[1] == "D"
                out.append((held.now, None if deleted else position, *event[1:]))
                position += not deleted
            if len(out) == 1024:
                yield _batch(out, arrow)
                out = []
        yield _batch(out, arrow)

    return events.mapInArrow(run, schema)


def repair(spark: SparkSession, rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``rows`` (and of ``ids``): conv_id, gaps,
    blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    A conversation's rows go by turn (NULL turns first), rows of one turn
    by role and text. NULL roles and texts are one space; a NULL conv_id
    is a conversation of its own; an empty role has no legal initial. Each row counts
    under its first fault: blank, duplicate (role and text seen earlier),
    truncated. Of equally cheap edits the ASCII-least audit is taken. A
    conversation of ``ids`` without rows has zeros, an empty audit and the
    hash of nothing; an empty table gives no row. Other columns are not read.

    Turns are never gathered: a conversation of any length streams through
    its task in sorted order, as the hash of its text must be taken in order.
    """
    events = _events(spark, rows, ids)
    schema = events.selectExpr("conv_id", "head.*", "'' as audit", "'' as repaired_sha256").schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, letters, digest, first, out = None, [], None, True, []
        for event in _walk(batches):
            if event[0] == "open":
                head, letters, digest, first = event[1], [], sha256(), True
            elif event[0] == "turn":
                _, edit, role, text = event
                letters.append(edit)
                if edit != "D":
                    digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                    first = False
            else:
                out.append((event[1], *head.values(), "".join(letters), digest.hexdigest()))
                if len(out) == 1024:
                    yield _batch(out, arrow)
                    out = []
        yield _batch(out, arrow)

    return events.mapInArrow(run, schema)


class _Ids:
    """Remembers the conversation of the rows that pass."""

    now = None

    def seen(self, batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i in range(len(batch)):
                one = batch.slice(i, 1)
                self.now = one.column("conv_id")[0].as_py()
                yield one


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
