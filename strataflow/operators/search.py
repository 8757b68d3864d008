"""Boolean search over answers, several searches in one pass."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.operators.answers import QUESTION


@dataclass(frozen=True)
class Match:
    """An answer predicate; text compares without case, ``contains`` looks inside."""

    question: str
    op: str
    value: object

    def column(self) -> Column:
        value = F.col("value")
        if self.op == "contains":
            hit = F.contains(F.lower(value), F.lit(str(self.value).lower()))
        elif self.op == "equals":
            hit = F.lower(value) == F.lit(str(self.value).lower())
        elif self.op == "at_least":
            hit = value.try_cast("double") >= F.lit(float(self.value))
        elif self.op == "at_most":
            hit = value.try_cast("double") <= F.lit(float(self.value))
        else:
            raise ValueError(f"unknown operator: {self.op}")
        return (F.col("question") == self.question) & F.coalesce(hit, F.lit(False))


@dataclass(frozen=True)
class All:
    parts: tuple


@dataclass(frozen=True)
class Any:
    parts: tuple


@dataclass(frozen=True)
class Not:
    part: object


def matches_of(node) -> list[Match]:
    if isinstance(node, Match):
        return [node]
    if isinstance(node, Not):
        return matches_of(node.part)
    return [m for part in node.parts for m in matches_of(part)]


def _combine(node, flags: dict[Match, Column]) -> Column:
    if isinstance(node, Match):
        return flags[node]
    if isinstance(node, Not):
        return ~_combine(node.part, flags)
    parts = [_combine(part, flags) for part in node.parts]
    return reduce(lambda a, b: a & b if isinstance(node, All) else a | b, parts)


def searchable_answers(answers: DataFrame, questions: DataFrame, stored: DataFrame) -> DataFrame:
    """Answers that may be found: searchable questions in question sets open to indexing."""
    placed = answers.join(questions.where("searchable").select(*QUESTION, "question_set"), QUESTION)
    closed = stored.where(~F.coalesce("indexable", F.lit(True))).select("fingerprint", "question_set")
    return placed.join(closed, ["fingerprint", "question_set"], "left_anti")


def search(fingerprints: DataFrame, answers: DataFrame, queries: dict[int, object]) -> DataFrame:
    """Hits ``(search_id, fingerprint)`` of all queries.

    Each predicate becomes a flag per fingerprint, from one aggregation of the answers of
    the questions in use; the boolean structure is evaluated on the flags.
    """
    predicates = list(dict.fromkeys(m for q in queries.values() for m in matches_of(q)))
    used = answers.where(F.col("question").isin(*sorted({m.question for m in predicates})))
    return combined_hits(fingerprints, used, queries, {m: F.max(m.column()) for m in predicates})


def combined_hits(fingerprints: DataFrame, answers: DataFrame, queries: dict[int, object], flags: dict[Match, Column]) -> DataFrame:
    """Hits of all queries from the aggregated flags of their predicates."""
    names = {m: f"_match_{i}" for i, m in enumerate(flags)}
    flagged = answers.groupBy("fingerprint").agg(*[flags[m].alias(n) for m, n in names.items()])
    joined = fingerprints.select("fingerprint").join(flagged, "fingerprint", "left")
    told = {m: F.coalesce(F.col(n), F.lit(False)) for m, n in names.items()}
    hits = F.array_compact(
        F.array(*[F.when(_combine(q, told), F.lit(i).cast("int")) for i, q in queries.items()])
    )
    return joined.select("fingerprint", F.explode(hits).alias("search_id"))


def hit_counts(hits: DataFrame) -> DataFrame:
    """How often each fingerprint showed up in searches."""
    return hits.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("hits"))


def view_counts(views: DataFrame, approximate: bool = False) -> DataFrame:
    """Views and distinct viewers of each fingerprint."""
    viewers = F.approx_count_distinct("user_id") if approximate else F.count_distinct("user_id")
    return views.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("views"), viewers.alias("unique_views"))
