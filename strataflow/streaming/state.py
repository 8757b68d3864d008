"""Streams with state: uploads that close at their announced count, databases that fall silent."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from strataflow.operators.stats import HEARTBEAT_HOURS

LIVENESS_SCHEMA = "database_id int, state string, since timestamp"


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of each upload in a part of a batch, so that an upload with many rows sends few numbers."""
    for pdf in batches:
        found = pdf.groupby("upload_id", as_index=False).agg(seen=("time", "size"), time=("time", "max"))
        yield found.assign(expected=-1)[["upload_id", "time", "seen", "expected"]]


def _closing(patience_ms: int):
    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, expected, last = state.get if state.exists else (0, -1, 0)
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame({"upload_id": [key[0]], "seen": [seen], "expected": [expected], "state": ["expired"]})
            return
        for pdf in batches:
            seen += int(pdf["seen"].sum())
            expected = max(expected, int(pdf["expected"].max()))
            last = max(last, int(pdf["millis"].max()))
        if 0 <= expected <= seen:
            if state.exists:
                state.remove()
            yield pd.DataFrame({"upload_id": [key[0]], "seen": [seen], "expected": [expected], "state": ["closed"]})
        else:
            state.update((seen, expected, last))
            state.setTimeoutTimestamp(max(last + patience_ms, state.getCurrentWatermarkMs() + 1))

    return update


def closing_uploads(
    rows: DataFrame, announced: DataFrame, patience_hours: float = 24, lateness: str = "1 hour"
) -> DataFrame:
    """Uploads as they close: ``upload_id, seen, expected, state``, each once.

    ``rows`` needs ``upload_id`` and ``time``, ``announced`` also ``rows``. An upload closes when its
    announced rows have arrived and is forgotten then; once the stream's time passes its
    last row or message by ``patience_hours``, it is reported as expired and forgotten too, so state doesn't grow.
    """
    numbers = "upload_id long, time timestamp, seen long, expected long"
    seen = rows.select("upload_id", "time").mapInPandas(_counted, numbers)
    told = announced.select(
        "upload_id", "time", F.lit(0).cast("long").alias("seen"), F.col("rows").cast("long").alias("expected")
    )
    both = seen.unionByName(told).withWatermark("time", lateness)
    timed = both.select("upload_id", "time", "seen", "expected", F.unix_millis("time").alias("millis"))
    return timed.groupBy("upload_id").applyInPandasWithState(
        _closing(int(patience_hours * 3_600_000)),
        "upload_id long, seen long, expected long, state string",
        "seen long, expected long, last long",
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )


def _liveness(period_ms: int):
    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        database_id = key[0]
        last = state.get[0] if state.exists else None
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame(
                {"database_id": [database_id], "state": ["silent"], "since": [pd.Timestamp(last + period_ms, unit="ms")]}
            )
            return
        newest = max(int(pdf["millis"].max()) for pdf in batches)
        first = last is None
        last = newest if first else max(last, newest)
        state.update((last,))
        state.setTimeoutTimestamp(max(last + period_ms, state.getCurrentWatermarkMs() + 1))
        if first:
            yield pd.DataFrame(
                {"database_id": [database_id], "state": ["active"], "since": [pd.Timestamp(newest, unit="ms")]}
            )

    return update


def liveness(beats: DataFrame, period_hours: float = HEARTBEAT_HOURS, lateness: str = "1 hour") -> DataFrame:
    """Changes of each database between active and silent, from a stream of heartbeats.

    A database is silent once the stream's time passes its last beat by the period. Beats
    are few: one per database and period, or on request.
    """
    timed = beats.withWatermark("time", lateness).select(
        "database_id", "time", F.unix_millis("time").alias("millis")
    )
    return timed.groupBy("database_id").applyInPandasWithState(
        _liveness(int(period_hours * 3_600_000)),
        LIVENESS_SCHEMA,
        "last long",
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
