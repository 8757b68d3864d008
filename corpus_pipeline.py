"""The training-data pipeline: each stage is one corpus operator over all that the stage before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strataflow.llm import decontaminate, langid, mixing, sharding, simhash, workload
from strataflow.session import clear_stages, stage, stage_area

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# Where stages keep tables on their way, and where run() keeps their results.
SCRATCH, RESULTS = "pipeline", "pipeline-results-{}"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that could be learned; null texts, texts without letters, noise and other languages go."""
    return langid.in_a_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the smallest doc_id."""
    return simhash.without_near_duplicates(docs, width=workload.SHINGLE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminated(docs, workload.table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(
        docs, weights=workload.WEIGHTS, share_percent=workload.SHARE_PERCENT, most=workload.MOST_COPIES, seed=workload.SEED
    )


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document of the mix with its shard and its slot there.

    Columns of the input that are named like one that is added here, in any case, stay under a free name: ``_size``.
    """
    taken = {c.lower() for c in (*docs.columns, *SHARD_COLUMNS)}
    for name in docs.columns:
        if name.lower() in SHARD_COLUMNS:
            free = f"_{name}"
            while free.lower() in taken:
                free = f"_{free}"
            taken.add(free.lower())
            docs = docs.withColumnRenamed(name, free)
    return sharding.assign(docs, workload.SHARDS, keep=[c for c in docs.columns if c != "doc_id"])


SHARD_COLUMNS = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def _with_scratch(apply: Stage) -> Stage:
    """A stage that first removes what the stage before kept on its way: its result is written by now."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        clear_stages(spark, SCRATCH)
        with stage_area(SCRATCH):
            return apply(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("language", _with_scratch(language)),
    ("near_duplicates", _with_scratch(near_duplicates)),
    ("decontamination", _with_scratch(decontamination)),
    ("mixture", _with_scratch(mixture)),
    ("shards", _with_scratch(shards)),
]

# Code lengths under byte context trees and links between fingerprints are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next; a result goes once the next one is written."""
    docs = workload.table(spark, sf_dir, "documents")
    for number, (_, apply) in enumerate(STAGES[:-1]):
        made = apply(spark, docs, sf_dir)
        area = RESULTS.format(number % 2)
        clear_stages(spark, area)
        with stage_area(area):
            docs = stage(made)
    return STAGES[-1][1](spark, docs, sf_dir)
