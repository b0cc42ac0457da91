"""Benchmark decontamination with spaced seeds, in DataFrame functions only.

A seed is a fixed mask over SPAN successive tokens; the hash of a window
takes only the tokens under the mask's ones, so substitutions under its zeros do
not disturb it. Window hashes of documents meet those of benchmark items
in an equi-join. Each (document, item, diagonal) that a seed hits is then
verified on the tokens: some stretch of CHECK aligned tokens (the whole
item, if shorter) must agree but for TOLERANCE of its tokens. Items
of fewer than SPAN tokens are hashed whole and must occur verbatim, as
tokens; those of fewer than LEAST say too little to tell a copy from a
common phrase and are not searched (``unsearched`` lists them).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billstar.llm.common import fresh, written

TOKENS = r"[\p{L}\p{N}]+"
#: Benchmark window hashes up to which they are broadcast (24 bytes each);
#: beyond it both sides are shuffled on the hash.
BROADCAST_ROWS = 1_000_000


@dataclass(frozen=True)
class Seeds:
    """``masks`` hit every overlap of CHECK tokens with at most TOLERANCE of
    them substituted, wherever those lie; ``short``, together with ``masks``,
    does so for items of SPAN to CHECK - 1 tokens, and is used where the
    benchmark has such items. The tests try all substitutions."""

    masks: tuple[str, ...] = ("11101001011", "11010110011", "10110011101", "10011111001")
    short: tuple[str, ...] = ("01101110100", "00011101110", "01110011010", "10001010111", "11100100101")
    check: int = 13
    tolerance: float = 0.2
    #: Tokens that an item needs to be searched.
    least: int = 4

    @property
    def span(self) -> int:
        return max(map(len, self.masks + self.short))


def tokens(text: str) -> Column:
    """Hashes of the lower-cased runs of letters and digits of a column;
    none for a NULL text."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(TOKENS), F.lit(0))
    return F.transform(words, lambda w: F.xxhash64(w))


def windows(df: DataFrame, keys: list[str], seeds: Seeds, masks: tuple[str, ...]) -> DataFrame:
    """(keys, at, h): a row for each window of the token array ``w`` and
    each of the masks, numbered from 0. The second generator keeps the hash expressions to one copy
    (a filter on them would make another), so that the generated method
    stays small enough for the JIT."""
    count = f"size(w) - {seeds.span - 1}"
    spread = df.where(f"{count} > 0").select(*keys, "w", F.explode(F.expr(f"sequence(0, {count} - 1)")).alias("at"))
    under = [
        f"xxhash64({k}L, " + ", ".join(f"w[at + {i}]" for i, bit in enumerate(mask) if bit == "1") + ")"
        for k, mask in enumerate(masks)
    ]
    return spread.select(*keys, "at", F.explode(F.expr(f"array({', '.join(under)})")).alias("h"))


def sequences(df: DataFrame, keys: list[str], lengths: list[int]) -> DataFrame:
    """(keys, at, h): a row for each run of ``n`` tokens of the array ``w``,
    for each n of the lengths."""
    runs = df.select(*keys, "w", F.explode(F.array(*map(F.lit, lengths))).alias("n")).where("size(w) >= n")
    runs = runs.select(*keys, "w", "n", F.explode(F.expr("sequence(0, size(w) - n)")).alias("at"))
    return runs.select(*keys, "at", F.expr("xxhash64('whole', n, slice(w, at + 1, n))").alias("h"))


def unsearched(benchmark: DataFrame, seeds: Seeds = Seeds()) -> DataFrame:
    """The rows of ``benchmark`` with fewer than ``least`` tokens, which
    are not searched."""
    return benchmark.where(F.size(tokens("text")) < seeds.least)


def contaminated(
    spark: SparkSession, documents: DataFrame, benchmark: DataFrame, seeds: Seeds = Seeds()
) -> DataFrame:
    """(doc_id, alt, item_id, matched, item_tokens, coverage, at): a row
    for each document and identified item that overlap, with the best
    diagonal's agreeing tokens and the smallest token offset of one.

    ``alt`` is 0, or a hash of the text where doc_id is NULL, so that rows
    without an id are told apart by text. Empty and NULL texts match nothing;
    repeated rows count once; other columns of either table are not read.
    Items without an item_id cannot be named in a row and are left out here;
    :func:`remove` searches them too.
    """
    alt = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.lit(0))
    return _overlaps(spark, documents, benchmark.where("item_id is not null"), seeds, alt).drop("item_alt")


def _overlaps(
    spark: SparkSession, documents: DataFrame, benchmark: DataFrame, seeds: Seeds, alt: Column
) -> DataFrame:
    """The rows of :func:`contaminated` for all items and documents told
    apart by (doc_id, alt), with ``item_alt``: 0, or a hash of the item's
    text where item_id is NULL."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), alt.alias("alt"), "text")
    item = ["item_id", "item_alt"]
    items = benchmark.select(
        "item_id", F.when(F.col("item_id").isNull(), F.xxhash64("text")).otherwise(F.lit(0)).alias("item_alt"),
        tokens("text").alias("w")).distinct()
    items = written(spark, items, "items")
    probes, masks = windows(items, item, seeds, seeds.masks), seeds.masks
    low = items.where(f"size(w) between {seeds.span} and {seeds.check - 1}")
    if not low.isEmpty():
        masks = seeds.masks + seeds.short
        probes = probes.union(windows(low, item, seeds, masks))
    brief = items.where(f"size(w) between {seeds.least} and {seeds.span - 1}")
    lengths = sorted(r.n for r in brief.selectExpr("size(w) as n").distinct().collect())
    if lengths:
        whole = brief.select(*item, F.lit(0).alias("at"), F.expr("xxhash64('whole', size(w), w)").alias("h"))
        probes = probes.union(whole)
    probes = written(spark, probes.withColumnRenamed("at", "q").distinct(), "probes")
    if probes.count() <= BROADCAST_ROWS:
        probes = F.broadcast(probes)
    split = docs.select("doc_id", "alt", tokens("text").alias("w"))
    spread = windows(split, ["doc_id", "alt"], seeds, masks)
    if lengths:
        spread = spread.union(sequences(split, ["doc_id", "alt"], lengths))
    hits = spread.join(probes, "h").select(
        "doc_id", "alt", *item, (F.col("at") - F.col("q")).alias("diagonal")).distinct()
    hits = written(
        spark, hits.groupBy("doc_id", "alt", *item).agg(F.collect_list("diagonal").alias("diagonals")),
        "hits")

    # only documents with a hit are read again, and only their own diagonals
    met = docs.join(
        hits, docs.doc_id.eqNullSafe(hits.doc_id) & docs.alt.eqNullSafe(hits.alt)
    ).select(hits.doc_id, hits.alt, *item, "diagonals", tokens("text").alias("a"))
    text = items.select(F.col("item_id").alias("i"), F.col("item_alt").alias("j"), F.col("w").alias("b"))
    met = met.join(text, F.expr("item_id <=> i and item_alt <=> j"))
    # one diagonal after another inside the row, each in one pass that holds
    # only the matches of the current stretch, of the whole and of the best stretch
    def match(i: str) -> str:
        return f"if({i} >= greatest(d, 0) and a[{i}] = b[{i} - d], 1, 0)"

    now = f"s.now + {match('i')} - {match('i - stretch')}"
    # a diagonal may stem from another text of the same id, and miss this one
    there = "filter(diagonals, d -> least(size(a), size(b) + d) > greatest(d, 0))"
    aligned = f"""filter(transform({there}, d -> aggregate(
        sequence(greatest(d, 0), least(size(a), size(b) + d) - 1),
        named_struct('at', greatest(d, 0), 'now', 0, 'same', 0, 'best', 0),
        (s, i) -> named_struct(
            'at', s.at, 'now', {now}, 'same', s.same + {match('i')},
            'best', if(i - greatest(d, 0) + 1 >= stretch, greatest(s.best, {now}), s.best)))), m -> m.best >= need)"""
    met = met.withColumn("stretch", F.expr(f"least(size(b), {seeds.check})")).withColumn("need", F.expr(
        f"if(size(b) < {seeds.span}, size(b), cast(ceil(stretch * (1 - {seeds.tolerance}D)) as int))"))
    met = met.selectExpr(
        "doc_id", "alt", *item, "size(b) as item_tokens", f"{aligned} as met").where("size(met) > 0")
    met = met.selectExpr(
        "doc_id", "alt", *item, "item_tokens", "array_max(transform(met, m -> m.same)) as matched",
        "array_min(transform(met, m -> m.at)) as at")
    return met.groupBy("doc_id", "alt", *item).agg(
        F.max("matched").alias("matched"), F.max("item_tokens").alias("item_tokens"), F.min("at").alias("at"),
    ).withColumn("coverage", F.col("matched") / F.col("item_tokens"))


def remove(
    spark: SparkSession, documents: DataFrame, benchmark: DataFrame, seeds: Seeds = Seeds()
) -> DataFrame:
    """The rows of ``documents`` that overlap with no benchmark item, whether
    or not it has an id, unchanged. Rows that share a doc_id are judged each
    by its own text."""
    own, other = (fresh(n, documents.columns) for n in ("_id", "_alt"))
    found = written(
        spark, _overlaps(spark, documents, benchmark, seeds, F.xxhash64("text")).select(
            F.col("doc_id").alias(own), F.col("alt").alias(other)).distinct(), "contaminated")
    return documents.join(
        found, F.col("doc_id").eqNullSafe(F.col(own)) & F.xxhash64("text").eqNullSafe(F.col(other)), "left_anti")


def oracle(seeds: Seeds = Seeds()) -> str:
    """The same rows in DuckDB SQL over views documents and benchmark, by
    the rule over all alignments: pairs of equal tokens, counted along each
    diagonal and in each stretch of it, without any mask."""
    words = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')"
    return f"""
        WITH d AS (SELECT DISTINCT doc_id, {words} AS w FROM documents WHERE doc_id IS NOT NULL),
        b AS (
            SELECT item_id, w, least(len(w), {seeds.check}) AS stretch, CASE WHEN len(w) < {seeds.span} THEN len(w)
                   ELSE ceil(least(len(w), {seeds.check}) * (1 - {seeds.tolerance})) END AS need
            FROM (SELECT DISTINCT item_id, {words} AS w FROM benchmark WHERE item_id IS NOT NULL)
            WHERE len(w) >= {seeds.least}),
        dt AS (SELECT doc_id, w AS whole, len(w) AS n, unnest(w) AS t, generate_subscripts(w, 1) AS i FROM d),
        bt AS (SELECT *, unnest(w) AS t, generate_subscripts(w, 1) AS j FROM b),
        equal AS (
            SELECT doc_id, item_id, whole, w, n, len(w) AS item_tokens, stretch, need, i, i - j AS diagonal
            FROM dt JOIN bt USING (t)),
        counted AS (
            SELECT *, count(*) OVER along AS same, count(*) OVER (along ORDER BY i
                       RANGE BETWEEN CURRENT ROW AND stretch - 1 FOLLOWING) AS near
            FROM equal WINDOW along AS (PARTITION BY doc_id, item_id, whole, w, diagonal))
        SELECT doc_id, item_id, max(same)::BIGINT AS matched, max(item_tokens)::BIGINT AS item_tokens,
               min(greatest(diagonal, 0))::BIGINT AS at, max(same) / max(item_tokens) AS coverage
        FROM counted
        WHERE near >= need AND least(n, item_tokens + diagonal) - greatest(diagonal, 0) >= stretch
        GROUP BY doc_id, item_id"""
