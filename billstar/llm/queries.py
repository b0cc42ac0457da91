"""Registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billstar.llm.common import table

QueryFn = Callable[[SparkSession, str], DataFrame]

#: Vocabulary of the token counts; a parameter of the operator.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The vocabulary of the packing, and the same vocabulary as ranks.
TOKENIZER, RANKS = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The capture date of the pages, which the table does not have.
WARC_DATE = "2024-01-01T00:00:00Z"
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from billstar.llm import quality

    docs = table(spark, sf_dir, "documents")
    return quality.classify(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from billstar.llm import embedding

    return embedding.link(spark, table(spark, sf_dir, "embeddings"), threshold=0.93)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps by doc_id and item_id. Rows without a doc_id, or items without
    an item_id, cannot be named and are left out, as in the SQL;
    ``decontaminate.remove`` takes both into account."""
    from billstar.llm import decontaminate

    found = decontaminate.contaminated(
        spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.where("doc_id is not null").selectExpr(
        "doc_id", "item_id", "cast(matched as bigint) as matched",
        "cast(item_tokens as bigint) as item_tokens", "cast(at as bigint) as at", "coverage")


def op4_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from billstar.llm import warc

    made = warc.derive(warc.responses(table(spark, sf_dir, "pages"), WARC_DATE), keep=["page_id"])
    return made.selectExpr(
        "page_id", "record_type", "record_id", "headers['WARC-Refers-To'] as refers_to",
        "headers['WARC-Target-URI'] as target_uri", "headers['WARC-Date'] as warc_date",
        "headers['Content-Type'] as content_type", "cast(headers['Content-Length'] as bigint) as content_length",
        "headers['WARC-Block-Digest'] as block_digest", "block")


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from billstar.llm import minhash

    return minhash.link(spark, table(spark, sf_dir, "documents"), minhash.Params(words=3, percent=85))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from billstar.llm import langid

    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from billstar.llm import lengths

    docs = table(spark, sf_dir, "documents")
    counted = docs.select(lengths.encoded_length(spark, docs.text, VOCABULARY).alias("n_tokens"))
    return lengths.histogram(counted)


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from billstar.llm import urlrules

    return urlrules.judge(spark, table(spark, sf_dir, "pages"), urlrules.rule_table(spark, URL_RULES))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from billstar.llm import mixing

    return mixing.plan(spark, table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from billstar.llm import toxicity

    docs = table(spark, sf_dir, "documents")
    return toxicity.classify(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from billstar.llm import packing

    made = packing.pack(spark, table(spark, sf_dir, "documents"), TOKENIZER, RANKS)
    return made.selectExpr(
        "doc_id", "start", "length", "crc32(ids) as ids_crc32", "doc_tokens", "sequence_id", "offset")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from billstar.llm import hardneg

    rows = hardneg.usable(table(spark, sf_dir, "embeddings").withColumn(
        "label", F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)")))
    return hardneg.mine(spark, rows, "vec_id % 100 = 0")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from billstar.llm import conversations

    rows = table(spark, sf_dir, "conversations")
    return conversations.repair(spark, conversations.damaged(rows), rows)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, sf_dir)


def queries() -> dict[str, QueryFn]:
    return {
        "op1_quality_classifier": op1_quality_classifier,
        "op2_embedding_dedup": op2_embedding_dedup,
        "op3_decontamination": op3_decontamination,
        "op4_warc_derivatives": op4_warc_derivatives,
        "op5_minhash_dedup": op5_minhash_dedup,
        "op6_language_id": op6_language_id,
        "op7_token_counts": op7_token_counts,
        "op8_url_filters": op8_url_filters,
        "op9_mixing": op9_mixing,
        "op10_toxicity": op10_toxicity,
        "op11_packing": op11_packing,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_conversation_repair": op13_conversation_repair,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    from billstar.llm import decontaminate, embedding, hardneg, minhash, mixing, urlrules

    return {
        "op2_embedding_dedup": embedding.oracle(),
        "op3_decontamination": decontaminate.oracle(),
        "op5_minhash_dedup": minhash.oracle(minhash.Params(words=3, percent=85)),
        "op8_url_filters": urlrules.oracle(URL_RULES),
        "op9_mixing": mixing.oracle(),
        "op12_hard_negatives": hardneg.oracle(),
    }
