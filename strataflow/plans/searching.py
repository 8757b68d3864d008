"""Search job: boolean searches over the answers that may be found, and what they hit."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.operators.answerindex import index_answers, search_indexed
from strataflow.operators.search import hit_counts, search, searchable_answers


@dataclass(frozen=True)
class Found:
    hits: DataFrame
    counts: DataFrame


def run_searches(
    fingerprints: DataFrame, answers: DataFrame, questions: DataFrame, stored: DataFrame, queries: dict[int, object]
) -> Found:
    """``queries`` maps a search id to its tree of ``Match``, ``All``, ``Any`` and ``Not``."""
    hits = search(fingerprints, searchable_answers(answers, questions, stored), queries)
    return Found(hits=hits, counts=hit_counts(hits))


def run_indexed_searches(spark: SparkSession, fingerprints: DataFrame, index: str, queries: dict[int, object]) -> Found:
    """The same searches over an index that :func:`maintain_index` keeps."""
    hits = search_indexed(spark, fingerprints, index, queries)
    return Found(hits=hits, counts=hit_counts(hits))


def maintain_index(answers: DataFrame, questions: DataFrame, stored: DataFrame, index: str, batch_id: int) -> None:
    """Add a batch of answers to an index: those that may be found, and empty ones for those that may not."""
    open_ = searchable_answers(answers, questions, stored).select("fingerprint", "question", "value")
    closed = answers.join(open_.select("fingerprint", "question"), ["fingerprint", "question"], "left_anti")
    index_answers(open_.unionByName(closed.select("fingerprint", "question", F.lit(None).cast("string").alias("value"))), index, batch_id)
