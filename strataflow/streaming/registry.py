"""The registry as state of a stream: management messages folded as they arrive.

Every entity keeps the latest message that set its status and the latest that set its fields, each with its
place in the order, so messages may come late and in any batch. A stopped entity is forgotten once the stream's time
has passed its last message by a while. A query may begin with a snapshot; messages that the snapshot holds need not be read again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from strataflow.operators.stats import latest_record
from strataflow.schema import ACTIVE, EDIT, STOPPED
from strataflow.sources.sinks import append_batch

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FORGOTTEN = "FORGOTTEN"
PARTS = ("status", "fields")
CHANGES = "entity long, version long, status string, status_seq long, fields_seq long, fields string"


class Fold(StatefulProcessor):
    """State of one entity: for each part its text and the place of the message that set it."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.parts = handle.getMapState("parts", "part string", "seq long, text string")
        self.version = handle.getValueState("version", "n long")

    def _set(self, part: str, seq: int, text: str | None) -> None:
        known = self.parts.getValue((part,)) if self.parts.containsKey((part,)) else None
        if known is None or seq > known[0]:
            self.parts.updateValue((part,), (seq, text))

    def _shown(self, key: int) -> Row:
        values = [self.parts.getValue((p,)) if self.parts.containsKey((p,)) else (None, None) for p in PARTS]
        version = (self.version.get()[0] if self.version.exists() else 0) + 1
        self.version.update((version,))
        (status_seq, status), (fields_seq, fields) = values
        return Row(
            entity=key, version=version, status=status or STOPPED, status_seq=status_seq, fields_seq=fields_seq, fields=fields
        )

    def _timed(self, row: Row, last: int, watermark: int) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if row.status != ACTIVE:
            self.handle.registerTimer(max(last + self.keep_ms, watermark + 1))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last = 0
        for row in rows:
            last = max(last, row.millis)
            if row.action != EDIT:
                self._set("status", row.seq, row.action)
            if row.action != STOPPED:
                self._set("fields", row.seq, row.fields)
        shown = self._shown(key[0])
        self._timed(shown, last, timerValues.getCurrentWatermarkInMs())
        yield shown

    def handleInitialState(self, key, initialState, timerValues) -> None:
        for part, seq, text in (("status", initialState.status_seq, initialState.status), ("fields", initialState.fields_seq, initialState.fields)):
            if seq is not None:
                self._set(part, seq, text)
        self.version.update((initialState.version,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        version = self.version.get()[0] + 1
        self.parts.clear()
        self.version.clear()
        yield Row(entity=key[0], version=version, status=FORGOTTEN, status_seq=None, fields_seq=None, fields=None)

    def close(self) -> None:
        pass


def messages_of(events: DataFrame, key: str, fields: Sequence[str], seq: str = "seq") -> DataFrame:
    """``entity, seq, time, action, fields`` of management messages."""
    return events.select(
        F.col(key).cast("long").alias("entity"), F.col(seq).cast("long").alias("seq"), F.col("time").cast("timestamp").alias("time"),
        "action", F.to_json(F.struct(*fields)).alias("fields"),
    )


def snapshot_of(changes: DataFrame) -> DataFrame:
    """The newest row of every entity that is not forgotten: what a later query can begin with."""
    order = [c for c in ("batch_id", "version") if c in changes.columns]  # a forgotten entity counts anew
    newest = latest_record(changes, ["entity"], order).where(F.col("status") != FORGOTTEN)
    return newest.select(*[c.split()[0] for c in CHANGES.split(", ")])


def fold_registry(
    messages: DataFrame, path: str, checkpoint: str, snapshot: DataFrame | None = None,
    keep_hours: float = 24 * 365,
    lateness: str = "30 days", poll: str | None = None,
) -> StreamingQuery:
    """Fold a stream of messages; the changed entities of every batch are appended to a table of changes.

    A message counts as long as it is not older than the newest one by more than ``lateness``.
    """
    spark = messages.sparkSession
    grouped = None if snapshot is None else snapshot.groupBy("entity")
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)  # the store that this kind of state needs; kept by the query that is started
    try:
        timed = messages.withWatermark("time", lateness).withColumn("millis", F.unix_millis("time"))
        changed = timed.groupBy("entity").transformWithState(
            Fold(int(keep_hours * 3_600_000)), CHANGES, "Update", "EventTime", initialState=grouped
        )
        writer = changed.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
        writer = writer.foreachBatch(lambda rows, batch_id: append_batch(rows, path, batch_id))
        return (writer.trigger(processingTime=poll) if poll else writer.trigger(availableNow=True)).start()
    finally:
        spark.conf.unset(STATE_STORE) if before is None else spark.conf.set(STATE_STORE, before)


def registry_at(spark: SparkSession, path: str, key: str, ddl: str) -> DataFrame:
    """Entities as the batch fold gives them: key, status and fields."""
    current = snapshot_of(spark.read.schema(f"{CHANGES}, batch_id long").parquet(path))
    return current.select(F.col("entity").alias(key), "status", _fields(F.col("fields"), ddl).alias("_fields")).select(key, "status", "_fields.*")


def _fields(text: Column, ddl: str) -> Column:
    return F.from_json(text, ddl)
