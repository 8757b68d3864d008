"""Ingest job: new catalogue files to results, uploads and quarantine."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.operators.ordered import with_offset
from strataflow.operators.uploads import known_uploads, unknown_uploads
from strataflow.session import stage
from strataflow.sources.delimited import PLACE, good_rows, malformed_rows, transformed, typed_lines
from strataflow.sources.manifest import (
    IDENTITY,
    clean_files,
    lines_of,
    list_files,
    pending_files,
    read_manifest,
    unseen_files,
    with_identity,
)

RESULTS, QUARANTINE, UPLOADS, UNKNOWN, MANIFEST = "results", "quarantine", "uploads", "unknown_uploads", "manifest"


@dataclass(frozen=True)
class Ingested:
    batch_id: int
    files: int


def ingest(
    spark: SparkSession,
    inbox: str,
    lake: str,
    databases: DataFrame,
    steps: Sequence[Callable[[DataFrame], DataFrame]] = (),
    cleanup: str | None = None,
    announced: DataFrame | None = None,
    files_per_batch: int = 100_000,
) -> Ingested:
    """Load all files of ``inbox/<database_identifier>/`` that were not loaded before, the oldest first.

    Rows get their ``offset`` in the upload. ``announced`` (``database_identifier, name, rows``) is what
    the sources say they sent; without it an upload announces what its file holds. Files are
    listed once and taken in batches, and their lines are read once, for identity and rows. Each table gets a folder per batch and the manifest is
    written last: a run that fails is repeated under the same batch and overwrites what it
    left behind.
    """
    total = 0
    # Listed once: later batches take what the earlier ones left.
    listed = stage(unseen_files(list_files(spark, inbox), read_manifest(spark, f"{lake}/{MANIFEST}")))
    while True:
        batch_id, taken, loaded = _ingest_batch(
            spark, listed, lake, databases, steps, cleanup, announced, files_per_batch
        )
        total += loaded
        if taken < files_per_batch:
            return Ingested(batch_id, total)


def _ingest_batch(
    spark: SparkSession,
    listed: DataFrame,
    lake: str,
    databases: DataFrame,
    steps: Sequence[Callable[[DataFrame], DataFrame]],
    cleanup: str | None,
    announced: DataFrame | None,
    most: int,
) -> tuple[int, int, int]:
    """Load the next files; returns the batch, the files taken and the files that were new."""
    manifest = read_manifest(spark, f"{lake}/{MANIFEST}")
    batch_id = (manifest.agg(F.max("batch_id")).first()[0] or 0) + 1
    next_files = stage(unseen_files(listed, manifest).orderBy("file_time", "file_path").limit(most))
    lines = lines_of(spark, next_files)
    named = with_identity(next_files, lines)
    named.write.mode("overwrite").parquet(f"{lake}/pending/{batch_id}")
    taken = spark.read.parquet(f"{lake}/pending/{batch_id}")
    files = stage(pending_files(taken, manifest).dropDuplicates(IDENTITY))
    count, new = taken.count(), files.count()

    def folder(table: str) -> str:
        return f"{lake}/{table}/batch_id={batch_id}"

    if new:
        origin = files.select("file_path", "upload_id")
        rows = stage(typed_lines(lines.drop("upload_id")).join(origin, "file_path"))
        good = with_offset(good_rows(rows), ["upload_id"], "byte")
        good = transformed(good.drop("file_path", "file_time", *PLACE), steps)
        good.write.mode("overwrite").partitionBy("database_identifier").parquet(folder(RESULTS))
        malformed_rows(rows).write.mode("overwrite").parquet(folder(QUARANTINE))

        loaded = spark.read.parquet(folder(RESULTS)).groupBy("upload_id").agg(F.count(F.lit(1)).alias("loaded"))
        rejected = spark.read.parquet(folder(QUARANTINE)).groupBy("upload_id").agg(F.count(F.lit(1)).alias("rejected"))
        counted = files.join(loaded, "upload_id", "left").join(rejected, "upload_id", "left").select(
            "database_identifier",
            "name",
            "upload_id",
            F.col("file_time").alias("time"),
            F.coalesce("loaded", F.lit(0)).alias("loaded"),
            F.coalesce("rejected", F.lit(0)).alias("rejected"),
        )
        counted = _announced(counted, announced)
        known_uploads(counted, databases).write.mode("overwrite").parquet(folder(UPLOADS))
        unknown_uploads(counted, databases).write.mode("overwrite").parquet(folder(UNKNOWN))
    if count:
        taken.write.mode("overwrite").parquet(folder(MANIFEST))
    if cleanup and count:
        # Files whose content was loaded before go as well.
        gone = taken.withColumn("failed", F.lit(False))
        if new:
            failed = counted.select("upload_id", ((F.col("loaded") == 0) & (F.col("rejected") > 0)).alias("failed"))
            gone = taken.join(failed, "upload_id", "left")
        clean_files(spark, gone, cleanup)
    return (batch_id if count else batch_id - 1), count, new


def _announced(counted: DataFrame, announced: DataFrame | None) -> DataFrame:
    """Add ``rows``: what was announced for the file, else what it holds."""
    held = F.col("loaded") + F.col("rejected")
    if announced is None:
        return counted.withColumn("rows", held)
    told = announced.select("database_identifier", "name", F.col("rows").cast("long").alias("rows"))
    return counted.join(told, ["database_identifier", "name"], "left").withColumn("rows", F.coalesce("rows", held))


def read_table(spark: SparkSession, lake: str, table: str) -> DataFrame:
    """A table of the lake, its finished batches only."""
    finished = read_manifest(spark, f"{lake}/{MANIFEST}").select("batch_id").distinct()
    return spark.read.parquet(f"{lake}/{table}").join(finished, "batch_id", "left_semi")
