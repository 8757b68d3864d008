"""Submission job: saved values to current answers, change log and notifications."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from strataflow.operators.submissions import (
    answer_changes,
    current_answers,
    last_writes,
    notifications,
    open_submissions,
)
from strataflow.session import cut_lineage


@dataclass(frozen=True)
class History:
    writes: DataFrame
    current: DataFrame
    changes: DataFrame
    notices: DataFrame


def submissions(saves: DataFrame, subscriptions: DataFrame) -> History:
    """``saves``: fingerprint, seq, question, value, token; the merged writes are kept in the shared folder."""
    writes = cut_lineage(last_writes(open_submissions(saves)))
    changes = answer_changes(writes)
    return History(
        writes=writes,
        current=current_answers(writes),
        changes=changes,
        notices=notifications(changes, subscriptions),
    )
