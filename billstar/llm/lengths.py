"""Token counts as an exact length histogram.

Texts are encoded whole; only their lengths are kept, aggregated map-side
to one row per distinct length. Running and suffix sums over that
histogram answer totals, quantiles and the total after truncation at
any context limit without touching the documents again.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from billstar.llm.common import written

#: How byte-level BPE cuts a text before merging: a fixed value of the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Lengths of a block of the two-level sums.
BLOCK = 1024


def encoded_length(spark: SparkSession, text: Column, vocabulary: str, pattern: str = PATTERN) -> Column:
    """Tokens of a text under the ranks of a tiktoken vocabulary file (a
    path the driver can read; about 1 MB, broadcast). Strings of special
    tokens count as ordinary text; NULL and empty texts have 0 tokens."""
    with open(vocabulary, "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import tiktoken

        encoding = tiktoken.Encoding(
            "vocabulary", pat_str=pattern, special_tokens={}, mergeable_ranks={
                base64.b64decode(token): int(rank)
                for token, rank in map(bytes.split, ranks.value.splitlines()) })
        for texts in batches:
            yield pd.Series([len(encoding.encode_ordinary(t)) if t else 0 for t in texts], dtype="int64")

    return count(text)


def histogram(lengths: DataFrame, column: str = "n_tokens") -> DataFrame:
    """One row per distinct length: n_tokens, documents with it,
    documents_le / tokens_le up to it, documents_ge / tokens_ge from it
    on, truncated_total (the tokens left when every text is cut to it) and
    quantile (the share of documents up to it). An empty table gives no row.

    The counts are written once, so each text is encoded once. The sums run
    per block of lengths, over the block totals and inside each block, so no
    task holds all distinct lengths.
    """
    counts = lengths.groupBy(F.col(column).alias("n_tokens")).agg(F.count("*").alias("documents"))
    return _summed(written(lengths.sparkSession, counts, "lengths"))


def _summed(h: DataFrame) -> DataFrame:
    """The running and suffix sums of (n_tokens, documents), one row a length."""
    h = h.withColumn("tokens", F.col("n_tokens") * F.col("documents"))
    h = h.withColumn("block", F.floor(F.col("n_tokens") / BLOCK))
    blocks = h.groupBy("block").agg(F.sum("documents").alias("d"), F.sum("tokens").alias("t"))
    below = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("d").over(below), F.lit(0)).alias("d_below"),
        F.coalesce(F.sum("t").over(below), F.lit(0)).alias("t_below"),
        F.sum("d").over(everything).alias("d_all"), F.sum("t").over(everything).alias("t_all"))
    upto = Window.partitionBy("block").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    h = h.join(blocks, "block").select(
        "*", (F.col("d_below") + F.sum("documents").over(upto)).alias("documents_le"),
        (F.col("t_below") + F.sum("tokens").over(upto)).alias("tokens_le"))
    return h.selectExpr(
        "n_tokens", "documents", "documents_le", "tokens_le",
        "d_all - documents_le + documents as documents_ge", "t_all - tokens_le + tokens as tokens_ge",
        "tokens_le - tokens + n_tokens * (d_all - documents_le + documents) as truncated_total",
        "documents_le / nullif(d_all, 0) as quantile")


def truncated_totals(hist: DataFrame, limits: DataFrame) -> DataFrame:
    """(context, total): for each row of ``limits`` the tokens left when texts
    are cut to its ``context``. Limits enter the sums as lengths that no
    document has. One under 0 counts as 0; a NULL limit gives a NULL total."""
    asked = limits.select(F.col("context").cast("long").alias("context"))
    steps = hist.select("n_tokens", "documents").union(
        asked.where("context is not null").select(F.greatest("context", F.lit(0)), F.lit(0).cast("long")))
    totals = _summed(steps.groupBy("n_tokens").agg(F.sum("documents").alias("documents"))).select(
        "n_tokens", F.col("truncated_total").alias("total"))
    at = F.when(F.col("context").isNotNull(), F.greatest("context", F.lit(0)))
    return asked.join(totals, at == totals.n_tokens, "left").select("context", "total")


def quantiles(hist: DataFrame, shares: list[float]) -> DataFrame:
    """(share, n_tokens): the least length that at least the share of documents do not exceed."""
    picks = [
        F.min(F.when(F.col("quantile") >= q, F.col("n_tokens"))).alias(f"q{i}") for i, q in enumerate(shares)
    ]
    pairs = ", ".join(f"{q}D, q{i}" for i, q in enumerate(shares))
    return hist.agg(*picks).selectExpr(f"stack({len(shares)}, {pairs}) as (share, n_tokens)")
