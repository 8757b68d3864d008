"""File identity by name and content, and what happens to files after loading."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.session import stage, stage_path
from strataflow.sources.delimited import GLOB, database_of
from strataflow.sources.identity import content_digests
from strataflow.sources.lines import LATEST, byte_ranges, read_lines

MANIFEST_SCHEMA = (
    "database_identifier string, name string, content_id string, upload_id long, file_path string, "
    "file_time timestamp, length long, batch_id long"
)

RANGES_SCHEMA = (
    "file_path string, file_time timestamp, length long, database_identifier string, name string, upload_id long, "
    "start long, stop long, content_id string, batch_id long"
)
LISTING_SCHEMA = "file_path string, file_time timestamp, length long, database_identifier string, name string"
SEEN, IDENTITY = ["file_path", "file_time", "length"], ["database_identifier", "name", "content_id"]


def list_files(spark: SparkSession, inbox: str) -> DataFrame:
    """Files of every database folder below ``inbox``; contents are not read."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", GLOB).load(f"{inbox}/*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LISTING_SCHEMA)
    path = F.col("_metadata.file_path")
    return files.select(
        path.alias("file_path"),
        F.col("modificationTime").alias("file_time"),
        "length",
        database_of(path).alias("database_identifier"),
        F.element_at(F.split(path, "/"), -1).alias("name"),
    )


def lines_of(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Lines of listed files, stored: identity and rows come from this one read."""
    return stage(read_lines(spark, stage_path(byte_ranges(files))))


def with_identity(files: DataFrame, lines: DataFrame) -> DataFrame:
    """Add ``content_id`` and ``upload_id``; files that changed while they were read are left for the next listing."""
    named = files.drop("upload_id").join(content_digests(lines), "file_path", "left")
    named = named.where(F.col("content_id").isNotNull() | (F.col("length") == 0))
    named = named.withColumn("content_id", F.coalesce("content_id", F.lit("lines:0")))
    return named.withColumn("upload_id", F.xxhash64(*IDENTITY))


def identified(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Add the identity of each file's content and its ``upload_id``."""
    return with_identity(files, lines_of(spark, files))


def register_files(spark: SparkSession, files: DataFrame, manifest: str) -> int:
    """Append identified files that are new to a manifest as its next batch, for a stream; returns how many.

    An entry is a range of bytes of a file. Names and contents stay in the tasks.
    """
    known = read_ranges(spark, manifest)
    batch_id = (known.agg(F.max("batch_id")).first()[0] or 0) + 1
    new = stage(files.dropDuplicates(IDENTITY).join(known.select(*IDENTITY), IDENTITY, "left_anti"))
    count = new.count()
    if count:
        ranges = byte_ranges(new).join(new.select("file_path", "content_id"), "file_path")
        ranges.write.mode("overwrite").parquet(f"{manifest}/batch_id={batch_id}")
    return count


def start_of(spark: SparkSession, manifest: str, progress: str, since: str | int) -> str | int:
    """Where a query starts. ``latest`` is looked up once and kept: a query that found nothing yet starts there again."""
    if since != LATEST:
        return since
    kept = _stored(spark, progress, "batch long")
    if kept.isEmpty():
        newest = read_ranges(spark, manifest).agg(F.coalesce(F.max("batch_id"), F.lit(0)).cast("long").alias("batch"))
        newest.write.mode("overwrite").parquet(progress)
        kept = _stored(spark, progress, "batch long")
    return kept.first()["batch"]


def read_ranges(spark: SparkSession, manifest: str) -> DataFrame:
    """Entries of the batches registered so far."""
    return _stored(spark, manifest, RANGES_SCHEMA)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Files loaded so far; empty before the first load."""
    return _stored(spark, path, MANIFEST_SCHEMA)


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not file_system.exists(hadoop_path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def unseen_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files of another path, time or length than any loaded one: only these are worth reading."""
    return files.join(manifest.select(*SEEN), SEEN, "left_anti")


def pending_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Identified files whose name and content were not loaded before."""
    return files.join(manifest.select(*IDENTITY), IDENTITY, "left_anti")


def clean_files(spark: SparkSession, files: DataFrame, policy: str = "move") -> int:
    """Move loaded files to ``succeed`` or ``failed`` beside them, or delete them, in the tasks; returns how many.

    A file that changed since it was read stays: it is a new upload. A repeated task finds the file gone.
    """
    if policy not in ("move", "delete"):
        raise ValueError(f"unknown cleanup policy: {policy}")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for batch in batches:
            for row in batch.to_pylist():
                done += _clean(row, policy)
        yield pa.RecordBatch.from_pydict({"done": pa.array([done])})

    listed = files.select("file_path", F.unix_millis("file_time").alias("millis"), "upload_id", "failed")
    return listed.mapInArrow(clean, "done long").agg(F.sum("done")).first()[0] or 0


def _clean(row: dict, policy: str) -> bool:
    system, path = fs.FileSystem.from_uri(row["file_path"])
    info = system.get_file_info(path)
    if info.type != fs.FileType.File or abs(info.mtime_ns / 1e6 - row["millis"]) >= 1000:
        return False
    if policy == "delete":
        system.delete_file(path)
        return True
    folder = f"{path.rpartition('/')[0]}/{'failed' if row['failed'] else 'succeed'}"
    system.create_dir(folder)
    system.move(path, f"{folder}/{row['upload_id']}-{info.base_name}")
    return True
