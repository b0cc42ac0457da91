"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of its documents' tokens, cut into units of
``unit`` tokens that may run over document ends. Queues take turns in
pairs, as the leaves of a binary tree: at a node, each side's credit grows
by its share of every unit that the node sends, the side with a whole unit of
credit sends, and what is left, always less than one unit, is the deficit
that the next unit starts from. As all units are equal, a side's credit
after i units is a product, so the units that a window takes from a queue,
and their place in it, follow from the totals on the queue's path alone: no
task walks the windows, and deficits carry over partitions as they do over
windows. A queue stays within one unit a level of its exact share.

A document's place in its queue is the sum of the partitions before its
own and of the documents before it in the partition. Token ids are written
once; after that only sums per (partition, queue) are exchanged.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from billstar.llm.common import discard, written
from billstar.llm.lengths import PATTERN

#: Stands for a NULL source; other queues start with "a".
NO_SOURCE = "b"
#: Hash buckets of the running sums over queues.
QUEUE_BUCKETS = 1024
#: Rows handed on at once.
ROWS = 512


@dataclass(frozen=True)
class Packing:
    window: int = 2048
    #: Tokens that a queue sends at a time; divides ``window``.
    unit: int = 16
    #: The id that closes a document.
    end_id: int = 1
    #: Relative targets by source; None targets each source's own share of
    #: the tokens, which no queue outlasts. Sources that are not named, and
    #: NULL, form one queue of weight ``rest``. When a queue runs out, the
    #: others share its place by weight.
    weights: dict[str, float] | None = None
    rest: float = 1.0


# ------------------------------------------------------------- token ids
# Characters of the vocabulary's word classes below U+02B0, and the general
# punctuation that is in none of them.
_BLANK, _LETTER, _DIGIT = "\t-\r \x85\xa0", "A-Za-zªµºÀ-ÖØ-öø-ʯ", "0-9²³¹¼-¾"
_OTHER_TEXT = re.compile(r"[^\x00-ʯ‐-‧]")
_PIECES = re.compile(
    rf" ?[{_LETTER}]+|'(?:s|t|re|ve|m|ll|d)| ?[{_DIGIT}]+| ?[^{_BLANK}{_LETTER}{_DIGIT}]+"
    rf"|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+")
_ENCODERS: dict[str, Encoder] = {}


class Encoder:
    """Ids of texts under a vocabulary file of ``tokenizers``, as packed
    little-endian integers.

    A text is cut into the vocabulary's pieces and each distinct piece is
    encoded once, by the ranks if there are any. That cut is spelled out
    for the scripts above; a text with other characters, or one that holds
    a special token's string, is encoded whole by the library. ``LIMIT``
    bounds the memory of pieces, not what is encoded.
    """

    LIMIT = 600_000

    def __init__(self, vocabulary: bytes, ranks: bytes | None, dtype: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary.decode())
        self.dtype = dtype
        self.piece = self.whole
        if ranks:
            import tiktoken

            by_rank = tiktoken.Encoding("ranks", pat_str=PATTERN, special_tokens={}, mergeable_ranks={
                base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())})
            self.piece = lambda p: np.array(by_rank.encode_ordinary(p), dtype=dtype).tobytes()
        marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.marks = re.compile("|".join(map(re.escape, marks))) if marks else None
        self.known: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()

    def __call__(self, text: str) -> bytes:
        if _OTHER_TEXT.search(text) or (self.marks and self.marks.search(text)):
            return self.whole(text)
        known = self.known
        if len(known) > self.LIMIT:
            known.clear()
        pieces = _PIECES.findall(text)
        try:
            return b"".join(map(known.__getitem__, pieces))
        except KeyError:
            for p in pieces:
                if p not in known:
                    known[p] = self.piece(p)
        return b"".join(map(known.__getitem__, pieces))


def encoder(vocabulary: bytes, ranks: bytes | None, dtype: str) -> Encoder:
    """One encoder for each vocabulary and Python worker."""
    name = sha256(vocabulary).hexdigest() + dtype
    if name not in _ENCODERS:
        _ENCODERS[name] = Encoder(vocabulary, ranks, dtype)
    return _ENCODERS[name]


def queue_of(source: Column, packing: Packing) -> Column:
    named = source.cast("string")
    if packing.weights is None:
        return F.coalesce(F.concat(F.lit("a"), named), F.lit(NO_SOURCE))
    return F.when(named.isin(list(packing.weights)), F.concat(F.lit("a"), named)).otherwise(F.lit(NO_SOURCE))


def tokenized(
    spark: SparkSession, documents: DataFrame, vocabulary: str, ranks: str | None, packing: Packing
) -> DataFrame:
    """(doc_id, source, queue, part, before, n, ids): the ids of each
    document with the closing id, and the tokens its queue has earlier in
    the same partition. NULL texts are empty: one closing id."""
    from tokenizers import Tokenizer

    raw, by_rank = (open(p, "rb").read() if p else None for p in (vocabulary, ranks))
    dtype = "<u2" if max(Tokenizer.from_str(raw.decode()).get_vocab_size(), packing.end_id + 1) <= 1 << 16 else "<u4"
    shipped = spark.sparkContext.broadcast((raw, by_rank))
    last = np.array([packing.end_id], dtype=dtype).tobytes()
    width = int(dtype[-1])
    docs = documents.select("doc_id", "source", queue_of(F.col("source"), packing).alias("queue"), "text")
    out = docs.drop("text").selectExpr(
        "*", "0 as part", "0L as before", "0L as n", "cast('' as binary) as ids").schema
    arrow = to_arrow_schema(out)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ids_of, part = encoder(*shipped.value, dtype), TaskContext.get().partitionId()
        sent: dict[str, int] = {}
        for whole in batches:
            for i in range(0, len(whole), ROWS):
                batch = whole.slice(i, ROWS)
                queues = batch.column("queue").to_pylist()
                ids = [(ids_of(t) if t else b"") + last for t in batch.column("text").to_pylist()]
                n = [len(b) // width for b in ids]
                before = []
                for q, k in zip(queues, n):
                    at = sent.get(q, 0)
                    before.append(at)
                    sent[q] = at + k
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("source"), batch.column("queue"),
                     pa.array([part] * len(n), pa.int32()), pa.array(before, pa.int64()),
                     pa.array(n, pa.int64()), pa.array(ids, pa.binary())], schema=arrow)

    made = written(spark, docs.mapInArrow(encode, out), "ids")
    made.width = width
    return made


# -------------------------------------------------------------- schedule
def phases(units: dict[str, int], weights: dict[str, float], per_window: int) -> list[dict[str, int]]:
    """The units that each queue sends while the set of queues that still
    have some stays the same, phase by phase. All phases but the last fill
    whole windows; queues and weights are few, as ``weights`` is a parameter."""
    left, out = {q: n for q, n in units.items() if n}, []
    share = {q: Fraction(weights[q]).limit_denominator(10**9) for q in left}
    while left:
        for until in sorted({Fraction(left[q]) / share[q] if share[q] else Fraction(1 << 100) for q in left}):
            now = {q: min(left[q], int(until * share[q])) for q in left}
            if sum(now.values()) >= per_window:
                break
        else:
            now = dict(left)
        total = sum(now.values())
        if total < sum(left.values()):
            cut, run, fit = total // per_window * per_window, 0, {}
            for q, n in now.items():
                fit[q] = cut * (run + n) // total - cut * run // total
                run += n
            now = fit
        out.append({q: n for q, n in now.items() if n})
        left = {q: n - now.get(q, 0) for q, n in left.items() if n > now.get(q, 0)}
    return out


def _before(df: DataFrame, *values: str) -> DataFrame:
    """``df`` with, for each value v, v_before: the sum of v over all
    queues ahead. Bucket by bucket, so no task holds all queues."""
    df = df.withColumn("bucket", F.pmod(F.xxhash64("queue"), F.lit(QUEUE_BUCKETS)))
    ahead = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy("bucket").agg(*[F.sum(v).alias(v) for v in values]).select(
        "bucket", *[F.coalesce(F.sum(v).over(ahead), F.lit(0)).alias(f"{v}_base") for v in values])
    inside = Window.partitionBy("bucket").orderBy("queue").rowsBetween(Window.unboundedPreceding, -1)
    out = df.join(sums, "bucket").withColumns({
        f"{v}_before": F.col(f"{v}_base") + F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values})
    return out.drop("bucket", *[f"{v}_base" for v in values])


def schedule(spark: SparkSession, totals: DataFrame, packing: Packing) -> DataFrame:
    """One row per queue of ``totals`` (queue, tokens): its phases (first
    and end unit, first window, and the queue's path from the tree's root:
    side, units of the left side, units of the node), the units it has,
    and where its last, incomplete unit goes: behind all whole units, queue
    by queue."""
    if packing.window % packing.unit:
        raise ValueError("unit must divide window")
    per_window = packing.window // packing.unit
    t = totals.selectExpr("queue", f"tokens div {packing.unit} as units", f"tokens % {packing.unit} as odd", "1L as one")
    t = written(spark, _before(t, "odd", "one").withColumnRenamed("one_before", "leaf"), "queues")
    sums = t.agg(F.sum("units").alias("units"), F.count("*").alias("n")).first()
    everything, levels = int(sums.units or 0), max(0, sums.n - 1).bit_length()
    if packing.weights is None:
        spans = t.selectExpr("queue", "leaf", "0 as phase", "0L as lo", "units as hi", "0L as window")
    else:
        have = dict(sorted((r.queue, r.units) for r in t.select("queue", "units").collect()))
        weights = {"a" + k: w for k, w in packing.weights.items()} | {NO_SOURCE: packing.rest}
        rows, sent, window = [], dict.fromkeys(have, 0), 0
        for i, phase in enumerate(phases(have, weights, per_window)):
            for q, n in phase.items():
                rows.append((q, i, sent[q], sent[q] + n, window))
                sent[q] += n
            window += sum(phase.values()) // per_window
        spans = spark.createDataFrame(rows, "queue string, phase int, lo long, hi long, window long")
        spans = spans.join(t.select("queue", "leaf"), "queue")
    spans = spans.where("hi > lo")

    # totals of the tree's nodes: level d has the leaves' first d bits
    each = spans.select("*", F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("d")).withColumn(
        "node", F.expr(f"shiftright(leaf, {levels} - d)"))
    nodes = each.groupBy("phase", "d", "node").agg(F.sum(F.col("hi") - F.col("lo")).alias("n"))
    left = nodes.where("d > 0 and node % 2 = 0").selectExpr("phase", "d - 1 as d", "node div 2 as node", "n as l")
    split = nodes.join(left, ["phase", "d", "node"], "left").selectExpr(
        "phase", "d", "node", "n", "coalesce(l, 0L) as l")
    paths = each.join(split, ["phase", "d", "node"]).selectExpr(
        "queue", "phase", "lo", "hi", "window", "d", f"shiftright(leaf, {levels} - d - 1) & 1 as side", "l", "n")
    inner = F.expr(f"if(d < {levels} and l > 0 and l < n, struct(d, side, l, n), null)")
    paths = paths.groupBy("queue", "phase", "lo", "hi", "window").agg(
        F.array_sort(F.collect_list(inner)).alias("path"), F.max("n").alias("total"))
    paths = paths.groupBy("queue").agg(
        F.array_sort(F.collect_list(F.struct("phase", "lo", "hi", "window", "total", "path"))).alias("phases"))
    return t.join(paths, "queue", "left").selectExpr(
        "queue", "phases", "units", f"{everything}L * {packing.unit} + odd_before as odd_at")


def place(path, j: int) -> int:
    """The place among all units of the root of a leaf's unit ``j``."""
    for side, left, n in reversed(path):
        j = j * n // (n - left) if side else -(-(j + 1) * n // left) - 1
    return j


def share(path, first: int, end: int) -> tuple[int, int, int]:
    """Of the root's units ``first`` to ``end``: the leaf's first and end
    unit, and how many units of leaves on its left are among them."""
    ahead = 0
    for side, left, n in path:
        a, b = first * left // n, end * left // n
        if side:
            ahead += b - a
            first, end = first - a, end - b
        else:
            first, end = a, b
    return first, end, ahead


def pieces(plan, start: int, n: int, unit: int, window: int) -> Iterator[tuple[int, int, int, int]]:
    """(start in the document, length, sequence, offset) of a document
    that takes tokens ``start`` to ``start + n`` of its queue. ``plan`` is
    (phases, units, odd_at), a phase (lo, hi, first window, total, path)."""
    phases, units, odd_at = plan
    per_window, c, end = window // unit, start, start + n
    for lo, hi, base, total, path in phases:
        while c < min(end, hi * unit):
            k = place(path, c // unit - lo) // per_window
            first, stop, ahead = share(path, per_window * k, min(per_window * (k + 1), total))
            upto = min(end, (lo + stop) * unit)
            yield c - start, upto - c, base + k, ahead * unit + c - (lo + first) * unit
            c = upto
    at = odd_at + c - units * unit
    while c < end:
        length = min(end - c, window - at % window)
        yield c - start, length, at // window, at % window
        c, at = c + length, at + length


def pack(
    spark: SparkSession, documents: DataFrame, vocabulary: str, ranks: str | None = None, packing: Packing = Packing()
) -> DataFrame:
    """Pack all documents into sequences of ``window`` tokens. The
    vocabulary is a file of ``tokenizers``; ``ranks``, if given, is the same
    vocabulary as tiktoken ranks, which encodes single words faster.

    One row per piece: doc_id, source, start (the document's ids before
    it), length, doc_tokens (the document's ids and the closing one),
    sequence_id, offset in the sequence, and ids (little-endian unsigned
    32-bit). Sequences are numbered from 0 and full but for the last; the
    pieces of one fill it without a gap. Up to any full sequence each source
    has its target share to within one unit for each level of the tree over
    sources (their number's logarithm), until queues run out.

    Each document row is packed on its own, repeated rows and NULL ids too;
    a NULL or empty text is the closing id alone; an empty table gives no
    row. A document of any length is cut freely. Only doc_id, text and
    source are read.
    """
    ids = tokenized(spark, documents, vocabulary, ranks, packing)
    width, unit, window = ids.width, packing.unit, packing.window
    sums = written(spark, ids.groupBy("queue", "part").agg(F.sum("n").alias("tokens")), "queue-parts")
    plan = schedule(spark, sums.groupBy("queue").agg(F.sum("tokens").alias("tokens")), packing)
    ahead = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sums.select("queue", "part", F.coalesce(F.sum("tokens").over(ahead), F.lit(0)).alias("base"))
    placed = written(spark, parts.join(plan, "queue"), "places")
    met = ids.join(placed, ["queue", "part"]).select(
        "doc_id", "source", "n", "ids", (F.col("base") + F.col("before")).alias("at"), "phases", "units", "odd_at")
    out = met.selectExpr(
        "doc_id", "source", "0L as start", "0L as length", "n as doc_tokens", "0L as sequence_id",
        "0L as offset", "ids").schema
    arrow = to_arrow_schema(out)
    dtype = f"<u{width}"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, len(whole), ROWS):
                batch = whole.slice(i, ROWS)
                row, start, length, tokens, seq, off, data = [], [], [], [], [], [], []
                columns = [batch.column(c).to_pylist() for c in ("n", "ids", "at", "phases", "units", "odd_at")]
                for r, (n, raw, at, steps, units, odd_at) in enumerate(zip(*columns)):
                    wide = np.frombuffer(raw, dtype=dtype).astype("<u4").tobytes()
                    plan = ([(p["lo"], p["hi"], p["window"], p["total"],
                              [(x["side"], x["l"], x["n"]) for x in p["path"]]) for p in steps or ()], units, odd_at)
                    for a, k, w, o in pieces(plan, at, n, unit, window):
                        row.append(r)
                        start.append(a)
                        length.append(k)
                        tokens.append(n)
                        seq.append(w)
                        off.append(o)
                        data.append(wide[4 * a:4 * (a + k)])
                take = pa.array(row, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(take), batch.column("source").take(take),
                     *[pa.array(x, pa.int64()) for x in (start, length, tokens, seq, off)],
                     pa.array(data, pa.binary())], schema=arrow)

    packed = met.mapInArrow(cut, out)
    discard(sums)
    return packed


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, tokens, ids): whole sequences, at most ``window`` ids each."""
    rows = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("tokens"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return rows.selectExpr(
        "sequence_id", "tokens", "aggregate(parts, cast('' as binary), (s, p) -> concat(s, p.ids)) as ids")
