"""Versioned answers: submissions by token, current answers, change log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.operators.ordered import hot_keys, with_previous, with_running
from strataflow.operators.stats import latest_record


def open_submissions(saves: DataFrame, key: str = "fingerprint", position: str = "seq") -> DataFrame:
    """Number submissions: a save whose token is absent or differs from the current one opens a new one."""
    hot = hot_keys(saves, [key])  # looked for once, for both scans
    tagged = with_previous(saves, [key], position, {"_last_token": "token"}, hot=hot)
    opens = F.col("token").isNull() | ~F.col("token").eqNullSafe(F.col("_last_token"))
    numbered = with_running(tagged, [key], position, {"submission": ("sum", opens.cast("long"))}, hot=hot)
    return numbered.drop("_last_token")


def last_writes(saves: DataFrame, position: str = "seq") -> DataFrame:
    """Last value per fingerprint, submission and question; an emptied answer has a NULL value."""
    keys = ["fingerprint", "submission", "question"]
    newest = latest_record(saves.select(*keys, position, "value"), keys, [position])
    return newest.withColumn("value", F.when(F.trim("value") != "", F.col("value")))


def current_answers(writes: DataFrame) -> DataFrame:
    """Answer of each question after all submissions; emptied answers are gone."""
    keys = ["fingerprint", "question"]
    newest = latest_record(writes.select(*keys, "submission", "value"), keys, ["submission"])
    return newest.where(F.col("value").isNotNull())


def answer_changes(writes: DataFrame) -> DataFrame:
    """Previous and new value of each question a submission changed; NULL stands for empty."""
    ordered = with_previous(writes, ["fingerprint", "question"], "submission", {"previous": "value"})
    return ordered.where(~F.col("previous").eqNullSafe(F.col("value"))).select(
        "fingerprint", "submission", "question", "previous", F.col("value").alias("next")
    )


def upsert_answers(
    current: DataFrame, changes: DataFrame, keys: Sequence[str] = ("fingerprint", "question"), sequence: str = "seq"
) -> DataFrame:
    """Put single answers: the last change of a question replaces its answer, an empty one removes it.

    Changes are in the order of ``sequence``; where that is equal or absent the greatest value counts, so the result
    never depends on the order of the rows.
    """
    keys, number = list(keys), F.col(sequence) if sequence in changes.columns else F.lit(0)
    stacked = current.select(*keys, "value", F.lit(None).cast("long").alias("_seq"), F.lit(0).alias("_rank")).unionByName(
        changes.select(*keys, "value", number.cast("long").alias("_seq"), F.lit(1).alias("_rank"))
    )
    newest = latest_record(stacked, keys, ["_rank", "_seq", "value"])
    return newest.where(F.trim("value") != "").drop("_rank", "_seq")


def notifications(changes: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Changed fingerprints for each subscriber; changes are counted before the join."""
    changed = changes.groupBy("fingerprint").agg(
        F.count(F.lit(1)).alias("changes"), F.max("submission").alias("last_submission")
    )
    return subscriptions.select("user_id", "fingerprint").distinct().join(changed, "fingerprint")
