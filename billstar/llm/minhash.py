"""Near-duplicate documents by circulant MinHash and exact Jaccard.

A document's set holds its distinct word shingles. Two permutations of the
32-bit universe make the whole signature: shingles are permuted once, and
coordinate k is the least value of the second permutation after a circular
shift by k steps. Runs of coordinates are hashed to bands; documents that
share a band are candidates, and links are confirmed on the full sets.

Groups of any size stay cheap without dropping a pair:

1. equal sets collapse to one representative;
2. every bucket compares its members with one centre only (a star);
3. only members that the stars left in different components are compared
   further. Set sizes and a bit sketch of the signature rule out most of
   those pairs. Around centres with many leaves the star has also noted
   how each leaf differs from the centre, and these differences give the
   exact intersection of any two leaves inside the join, without a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billstar.llm.common import components, discard, fresh, quoted, written

SKETCH_BITS = 128
#: Words that one block of a star compares, and the number of leaves from
#: which a star also reports how its leaves differ from it.
BLOCK_WORDS, MANY_LEAVES = 50_000, 8


@dataclass(frozen=True)
class Params:
    """Shingles of ``words`` words; linked from ``percent`` % Jaccard. The
    defaults miss a pair at the threshold with probability 2e-6."""

    words: int = 3
    percent: int = 85
    rows: int = 6
    bands: int = 28

    @property
    def max_hamming(self) -> int:
        """Sketch bits that pairs at the threshold differ in, plus six
        standard deviations."""
        p = (1 - self.percent / 100) / 2
        return ceil(SKETCH_BITS * p + 6 * sqrt(SKETCH_BITS * p * (1 - p)))


# ------------------------------------------------------------- set hashing
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


class WordHash(dict):
    """word -> 64-bit hash, worked out once per distinct word."""

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = h = xxh64_intdigest(word)
        return h


def shingle_set(text: str | None, k: int, hashes: WordHash) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct k-word shingles of a text; with
    fewer words the whole sequence is one, without words there are none.
    Words are runs of non-blank bytes, A-Z lower-cased."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    k = min(k, len(h))
    n = len(h) - k + 1
    s = h[:n].copy()
    for i in range(1, k):
        s = mix64(s) * _M1 + h[i:i + n]
    return np.unique(mix64(s))


def _sigma(s: np.ndarray) -> np.ndarray:
    return ((s * _M1) >> np.uint64(32)).astype(np.uint32)


def _pi(x: np.ndarray) -> np.ndarray:
    x = x * np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    return x


#: One step of the circular shift.
STEP = np.uint32(0x9E3779B1)


def signature(s: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` circulant MinHash coordinates of a non-empty set."""
    first = _sigma(s)
    shifts = np.arange(size, dtype=np.uint32) * STEP
    low = np.full(size, 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(first), 2048):
        part = _pi(first[i:i + 2048, None] + shifts[None, :])
        np.minimum(low, part.min(axis=0), out=low)
    return low


def band_keys(low: np.ndarray, p: Params) -> np.ndarray:
    grid = low[: p.rows * p.bands].reshape(p.bands, p.rows).astype(np.uint64)
    key = np.arange(p.bands, dtype=np.uint64)
    for i in range(p.rows):
        key = mix64(key * _M1 + grid[:, i])
    return key.view(np.int64)


def sketch(low: np.ndarray) -> tuple[int, int]:
    """One bit of each of the first SKETCH_BITS coordinates, as two longs."""
    bits = (_pi(low[:SKETCH_BITS].copy()) >> np.uint32(31)).astype(np.uint8)
    a, b = np.packbits(bits).view(np.int64)
    return int(a), int(b)


def signatures(documents: DataFrame, p: Params) -> DataFrame:
    """One row per document row: doc_id, n (set size), the set's
    fingerprint f1, f2, its band keys and sketch (both empty for n = 0)."""
    size = max(p.rows * p.bands, SKETCH_BITS)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHash()
        for pdf in batches:
            rows = []
            for doc_id, text in zip(pdf.doc_id, pdf.text):
                s = shingle_set(text, p.words, hashes)
                if not len(s):
                    rows.append((doc_id, 0, 0, 0, None, 0, 0))
                    continue
                low = signature(s, size)
                f1, f2 = s.sum(dtype=np.uint64), mix64(s + _M3).sum(dtype=np.uint64)
                rows.append((doc_id, len(s), int(f1.view(np.int64)), int(f2.view(np.int64)),
                             band_keys(low, p), *sketch(low)))
            out = pd.DataFrame(rows, columns=["doc_id", "n", "f1", "f2", "bands", "s1", "s2"])
            out["doc_id"] = out.doc_id.astype("Int64")
            yield out

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
        sign, "doc_id long, n long, f1 long, f2 long, bands array<long>, s1 long, s2 long"
    )


# ------------------------------------------------------------ verification
def verify(spark: SparkSession, documents: DataFrame, pairs: DataFrame, p: Params) -> DataFrame:
    """Compare the full sets of ``pairs(c, x, n, many)`` and return
    (c, x, linked, shared, size, delta): the size of the intersection and
    of c's set and, where ``many`` and no longer than x's set, the hashes
    that only one of the two sets has.

    The texts are shuffled to their centre c. A centre with many words to
    compare has its leaves dealt over several blocks, each with a copy of
    the centre; in a block the centre comes first and the leaves stream
    past it, so a task holds two sets at a time. The plan grows with the
    data, so it is merged with the texts, never broadcast.
    """
    blocks = pairs.groupBy("c").agg(
        F.ceil(F.sum("n") / BLOCK_WORDS).cast("int").alias("blocks"))
    leaves = pairs.join(blocks, "c").select(
        F.col("x").alias("doc"), "c", F.expr("pmod(xxhash64(x), blocks)").cast("int").alias("block"),
        F.lit(1).alias("role"), "many")
    centres = blocks.select(
        F.col("c").alias("doc"), "c", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"),
        F.lit(0).alias("role"), F.lit(False).alias("many"))
    plan = written(spark, leaves.union(centres), "stars")
    texts = documents.select(F.col("doc_id").cast("long").alias("doc"), "text").where("doc is not null")
    dealt = texts.join(plan.hint("merge"), "doc")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(parts, "c", "block").sortWithinPartitions("c", "block", "role", "doc")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, key, centres = WordHash(), None, []
        for pdf in batches:
            rows = []
            for doc, text, c, block, role, many in zip(
                    pdf.doc, pdf.text, pdf.c, pdf.block, pdf.role, pdf.many):
                s = shingle_set(text, p.words, hashes)
                if (c, block) != key:
                    key, centres = (c, block), []
                if role == 0:
                    centres.append(s)
                    continue
                for own in centres:
                    found = np.isin(s, own, assume_unique=True)
                    shared = int(found.sum())
                    linked = 100 * shared >= p.percent * (len(s) + len(own) - shared) and shared > 0
                    delta = None
                    if many and len(s) + len(own) - 2 * shared <= len(s):
                        lacks = own[~np.isin(own, s, assume_unique=True)]
                        delta = np.concatenate([s[~found], lacks]).view(np.int64)
                    rows.append((c, doc, linked, shared, len(own), delta))
            yield pd.DataFrame(rows, columns=["c", "x", "linked", "shared", "size", "delta"])

    return dealt.mapInPandas(
        compare, "c long, x long, linked boolean, shared long, size long, delta array<long>")


def _possible(p: Params, a: str, b: str) -> str:
    """SQL: sizes and sketches of sides a and b allow a link."""
    return (
        f"100 * least({a}.n, {b}.n) >= {p.percent} * greatest({a}.n, {b}.n) and "
        f"bit_count({a}.s1 ^ {b}.s1) + bit_count({a}.s2 ^ {b}.s2) <= {p.max_hamming}"
    )


def link(spark: SparkSession, documents: DataFrame, p: Params = Params()) -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id, kept.

    component_id is the smallest doc_id that links reach; a row is kept if
    that is its own. NULL ids are linked with nothing: component_id NULL,
    kept. Rows that repeat a doc_id are one document. Documents without words
    are linked with nothing. Other columns of ``documents`` are not read.
    """
    sig = written(spark, signatures(documents, p), "signatures")
    key = ["n", "f1", "f2"]
    reps = sig.where("n > 0 and doc_id is not null").groupBy(*key).agg(
        F.min("doc_id").alias("rid"), F.first("s1").alias("s1"), F.first("s2").alias("s2"),
        F.first("bands").alias("bands"))
    reps = written(spark, reps, "representatives")

    rows = reps.select("rid", "n", "s1", "s2", F.explode("bands").alias("bk"))
    shared = rows.groupBy("bk").agg(F.count("*").alias("size")).where("size > 1")
    rows = written(spark, rows.join(shared, "bk"), "buckets")

    # the centre: the member that shares the most buckets, as the least
    # edited of a group of copies does
    degree = rows.groupBy("rid").agg(F.count("*").alias("degree"))
    centres = rows.select("bk", "rid", "n", "s1", "s2").join(degree, "rid").groupBy("bk").agg(
        F.max_by(F.struct("rid", "n", "s1", "s2"), F.struct("degree", -F.col("rid"))).alias("top")
    ).select("bk", F.col("top.rid").alias("c"), F.struct("top.n", "top.s1", "top.s2").alias("t"))
    centred = written(spark, rows.join(centres, "bk"), "centred")
    discard(rows)
    rows = centred
    pairs = rows.alias("a").where("rid <> c and " + _possible(p, "a", "t")).select(
        "c", F.col("rid").alias("x"), "n").distinct()
    pairs = written(spark, pairs, "pairs")
    many = pairs.groupBy("c").agg((F.count("*") >= MANY_LEAVES).alias("many"))
    star = written(spark, verify(spark, documents, pairs.join(many, "c"), p), "compared")
    links = star.where("linked").select(F.col("c").alias("u"), F.col("x").alias("v"))
    joined = components(spark, links)

    # how leaves differ from the centre of a large star, and how much of
    # that any other leaf can share
    deltas = star.where("delta is not null").select("c", "x", "shared", F.col("size").alias("nc"), "delta")
    common = (
        deltas.select("c", "x", F.explode("delta").alias("h"))
        .groupBy("c", "h").agg(F.count("*").alias("leaves"), F.min("x").alias("x"))
        .where("leaves = 1").groupBy("c", "x").agg(F.count("*").alias("lone"))
    )
    deltas = deltas.join(common, ["c", "x"], "left").select(
        "c", F.col("x").alias("rid"), "shared", "nc", "delta",
        (F.size("delta") - F.coalesce("lone", F.lit(0))).alias("most"))

    rest = (
        rows.drop("t", "size").join(joined.withColumnRenamed("node", "rid"), "rid", "left")
        .withColumn("component", F.coalesce("component", "rid"))
    )
    split = rest.groupBy("bk").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("bk")
    rest = written(spark, rest.join(split, "bk").join(deltas, ["c", "rid"], "left"), "rest")
    met = "a.bk = b.bk and a.rid < b.rid and a.component <> b.component and " + _possible(p, "a", "b")
    # |x & y| = |x & c| + |y & c| - |c| + |delta x & delta y|
    shared = "(a.shared + b.shared - a.nc + {})"
    enough = f"100 * {shared} >= {p.percent} * (a.n + b.n - {shared})"
    exact = " and ".join(
        [enough.format(d, d) for d in ("least(a.most, b.most)", "size(array_intersect(a.delta, b.delta))")])
    a, b = rest.alias("a"), rest.alias("b")
    more = a.join(b, F.expr(f"{met} and (a.delta is null or b.delta is null or ({exact}))")).selectExpr(
        "a.rid as c", "b.rid as x", "b.n as n", "a.delta is not null and b.delta is not null as known")
    more = more.groupBy("c", "x", "n").agg(F.max("known").alias("known"))
    done = pairs.select("c", "x").union(pairs.selectExpr("x", "c"))
    more = written(spark, more.join(done, ["c", "x"], "left_anti").withColumn("many", F.lit(False)), "more")
    late = verify(spark, documents, more.where("not known"), p).where("linked")
    links = links.unionByName(more.where("known").selectExpr("c as u", "x as v")).unionByName(
        late.select(F.col("c").alias("u"), F.col("x").alias("v")))
    joined = components(spark, links).withColumnRenamed("node", "rid")

    found = reps.select(*key, "rid").join(joined, "rid", "left").select(
        *key, F.coalesce("component", "rid").alias("component"))
    out = sig.select("doc_id", *key).join(found, key, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_one(spark: SparkSession, documents: DataFrame, p: Params) -> DataFrame:
    """``documents`` with one row for each group of near-duplicates: that
    of the smallest doc_id (NULL last), then of the lowest hash of its text.
    A document is a (doc_id, text), told apart by the text's md5: of rows
    equal in both the one with the lowest hash of its columns stays, while
    different texts under one doc_id, or without one, are linked and kept
    each on its own."""
    rid, digest, name = (fresh(n, documents.columns) for n in ("_rid", "_digest", "_doc"))
    texts = documents.select("doc_id", F.xxhash64("text").alias("h")).groupBy("doc_id").agg(
        F.min("h").alias("lo"), F.max("h").alias("hi"))
    if texts.where("doc_id is null or lo <> hi").isEmpty():
        own = documents.withColumn(rid, F.col("doc_id"))
        kept = link(spark, own, p).where("kept").select(F.col("doc_id").alias(rid)).distinct()
    else:
        # each distinct (doc_id, text) gets a number of its own, fixed by writing it
        names = written(spark, documents.select(
            F.col("doc_id").alias(name), F.md5("text").alias(digest)).distinct().withColumn(
                rid, F.monotonically_increasing_id()), "names")
        own = documents.join(
            names, F.col("doc_id").eqNullSafe(F.col(name)) & F.md5("text").eqNullSafe(F.col(digest))).drop(name, digest)
        linked = link(spark, own.select(F.col(rid).alias("doc_id"), "text"), p)
        groups = linked.select(F.col("doc_id").alias(rid), "component_id").distinct()
        first = F.struct(F.col(name).isNull(), name, digest, rid)
        kept = groups.join(names, rid).groupBy("component_id").agg(F.min(first).alias("first")).select(
            F.col(f"first.{rid}").alias(rid))
    columns = quoted(documents.columns)
    plain = [c for c, f in zip(columns, documents.schema) if "map<" not in f.dataType.simpleString()]
    rows = own.join(kept, rid, "left_semi").groupBy(rid).agg(
        F.min_by(F.struct(*columns), F.xxhash64(*plain)).alias("row"))
    return rows.select("row.*")


def oracle(p: Params = Params()) -> str:
    """The same rows as :func:`link` in DuckDB SQL over a view documents,
    from the shingles that documents share."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    shingle = " || ' ' || ".join(f"w[i + {k}]" for k in range(p.words))
    return rf"""
        WITH RECURSIVE d AS (
            SELECT DISTINCT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        sets AS (
            SELECT doc_id, w, list_distinct(CASE
                WHEN len(w) = 0 THEN [] WHEN len(w) < {p.words} THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - {p.words} + 2), lambda i: {shingle}) END) AS g
            FROM d),
        shingles AS (SELECT doc_id, len(g) AS n, unnest(g) AS h FROM sets WHERE doc_id IS NOT NULL),
        link AS (
            SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.h = b.h AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n
            HAVING 100 * count(*) >= {p.percent} * (a.n + b.n - count(*))),
        reach AS (
            SELECT doc_id AS x, doc_id AS y FROM d WHERE doc_id IS NOT NULL
            UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x),
        low AS (SELECT x, min(y) AS component FROM reach GROUP BY x)
        SELECT documents.doc_id, len(g)::BIGINT AS n_shingles, component AS component_id,
               coalesce(documents.doc_id = component, TRUE) AS kept
        FROM documents JOIN sets ON documents.doc_id IS NOT DISTINCT FROM sets.doc_id
             AND regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x20\x09-\x0D]+') = w
             LEFT JOIN low ON documents.doc_id = low.x"""
