"""The corpus pipeline: quality, toxicity, near-duplicates, decontamination
and the source mix, each on all that the stage before it kept.

``run`` writes each stage's result as Parquet under the shared checkpoint
folder and reads it again, so a lost executor costs one stage's tasks only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from billstar.llm import decontaminate, minhash, mixing, quality, toxicity
from billstar.llm.common import table, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier scores 0.5 or more. It is
    fitted on labelled rows of ``docs``."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the clause grammar scores under 0.3."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 0.8 Jaccard of five-word shingles."""
    return minhash.keep_one(spark, docs, minhash.Params(words=5, percent=80, rows=5, bands=32))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item."""
    return decontaminate.remove(spark, docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a row for each time a document is taken, with
    the pass and the virtual finish time it is ordered by."""
    return mixing.mixed(spark, docs)


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_dedup", dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: Not expressible in SQL: the first two stages are fitted models. The
#: tests hold the stages against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. The files of the last stage are
    range-sorted by mix_finish."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
