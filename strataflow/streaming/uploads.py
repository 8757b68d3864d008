"""Streams of catalogue rows: continuous filters, uploads by micro-batch, several sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from strataflow.functions.predicates import compile_predicate
from strataflow.operators.fanout import FilterSpec, specs_from_registry
from strataflow.operators.ordered import with_offset
from strataflow.operators.uploads import unknown_uploads
from strataflow.plans.filtering import run_filters
from strataflow.schema import check_columns
from strataflow.session import stage
from strataflow.sources.delimited import PLACE, good_rows, malformed_rows, typed_lines
from strataflow.sources.lines import EARLIEST, stream_lines
from strataflow.sources.manifest import start_of
from strataflow.sources.sinks import append_batch


def _triggered(writer: DataStreamWriter, poll: str | None) -> DataStreamWriter:
    """Poll for new files, or take what is there and stop."""
    return writer.trigger(processingTime=poll) if poll else writer.trigger(availableNow=True)


def stream_since(spark: SparkSession, path: str, schema: T.StructType, since: str | None = None) -> DataFrame:
    """Parquet files as a stream: all of them, or those changed after ``since``."""
    rows = spark.readStream.schema(schema).parquet(path)
    if since is None:
        return rows
    return rows.where(F.col("_metadata.file_modification_time") > F.lit(since).cast("timestamp"))


def continuous_filter(
    rows: DataFrame, spec: FilterSpec, path: str, checkpoint: str, keep: tuple[str, ...] = (), poll: str | None = None
) -> StreamingQuery:
    """Select and filter without state, from a stream to a table."""
    picked = rows.where(compile_predicate(spec.text)).select(*keep, *check_columns(list(spec.selections)))
    writer = picked.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return _triggered(writer, poll).format("parquet").start(path)


def with_registered(rows: DataFrame, databases: DataFrame) -> DataFrame:
    """Stream-static join: rows of registered databases with their community."""
    return rows.join(databases.select("database_identifier", "community_id"), "database_identifier")


def process_uploads(
    spark: SparkSession,
    manifest: str,
    lake: str,
    checkpoint: str,
    load_registry: Callable[[], tuple[DataFrame, DataFrame]],
    poll: str | None = None,
    load_announced: Callable[[], DataFrame] | None = None,
    since: str | int = EARLIEST,
) -> StreamingQuery:
    """Run the active filters over each batch of arriving files.

    Files arrive as batches of a manifest, see :func:`register_files`; a file lies in one batch, so an
    upload is a group of the batch. ``since`` is where a new query starts: ``earliest``, ``latest`` or after a batch of
    the manifest. ``load_registry``
    returns the current ``databases`` and ``filters`` and is called per batch: filters
    started, stopped or edited meanwhile take effect with the next files. ``load_announced``
    returns ``upload_id, rows`` as the sources told them; other uploads announce what they
    hold. Files of databases that nobody registered are listed in ``unknown_uploads`` and go no
    further. Slices go on after those of earlier batches. Progress is committed after all
    sinks are written, and each sink overwrites its own batch, so a replayed batch changes
    nothing.
    """

    def batch(rows: DataFrame, batch_id: int) -> None:
        databases, filters = load_registry()
        specs = specs_from_registry(filters)
        rows = stage(typed_lines(rows))
        held = rows.groupBy("upload_id", "database_identifier").agg(F.count(F.lit(1)).alias("held"))
        append_batch(unknown_uploads(held, databases), f"{lake}/unknown_uploads", batch_id)
        rows = unknown_uploads_out(rows, databases)
        good = with_offset(good_rows(rows), ["upload_id"], "byte")
        good = stage(good.drop("file_path", "file_time", *PLACE))
        append_batch(good, f"{lake}/results", batch_id)
        append_batch(malformed_rows(rows), f"{lake}/quarantine", batch_id)
        announced = _told(unknown_uploads_out(held, databases), load_announced)
        append_batch(announced, f"{lake}/uploads", batch_id)
        if specs:
            filtered = run_filters(good, announced, databases, specs, _output_before(spark, lake, batch_id))
            append_batch(filtered.output, f"{lake}/filtered", batch_id)
            append_batch(filtered.checked, f"{lake}/counts", batch_id)
            append_batch(filtered.slices, f"{lake}/slices", batch_id)
            append_batch(filtered.ready, f"{lake}/data_ready", batch_id)

    start = start_of(spark, manifest, f"{checkpoint.rstrip('/')}-start", since)
    writer = stream_lines(spark, manifest, start).writeStream.foreachBatch(batch)
    return _triggered(writer.option("checkpointLocation", checkpoint), poll).start()


def unknown_uploads_out(rows: DataFrame, databases: DataFrame) -> DataFrame:
    """Rows of registered databases."""
    return rows.join(databases.select("database_identifier"), "database_identifier", "left_semi")


def _told(held: DataFrame, load_announced: Callable[[], DataFrame] | None) -> DataFrame:
    if load_announced is None:
        return held.withColumnRenamed("held", "rows")
    told = load_announced().select("upload_id", F.col("rows").cast("long").alias("rows"))
    return held.join(told, "upload_id", "left").withColumn("rows", F.coalesce("rows", "held")).drop("held")


def _output_before(spark: SparkSession, lake: str, batch_id: int) -> DataFrame | None:
    """Rows in each filter's output after the earlier batches."""
    if batch_id == 0:
        return None
    try:
        slices = spark.read.parquet(f"{lake}/slices")
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    earlier = slices.where(F.col("batch_id") < batch_id)
    return earlier.groupBy("filter_id").agg(F.sum("count").alias("rows"))


def to_several(rows: DataFrame, sinks: dict[str, Callable[[DataFrame], DataFrame]], root: str, checkpoint: str, poll: str | None = None) -> StreamingQuery:
    """Write several projections of one stream, reading it once."""

    def batch(part: DataFrame, batch_id: int) -> None:
        part = part.persist()
        try:
            for name, project in sinks.items():
                append_batch(project(part), f"{root}/{name}", batch_id)
        finally:
            part.unpersist()

    writer = rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return _triggered(writer, poll).start()
