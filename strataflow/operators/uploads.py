"""Uploads: notifications, registration, row checks, slices of a filter's output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.operators.ordered import with_offset
from strataflow.schema import COMPLETED

# Offsets are joined to slices by blocks of this many rows.
SLICE_BLOCK = 100_000


def upload_notifications(status: DataFrame, keep: Sequence[str] = ("database_identifier", "database_id")) -> DataFrame:
    """Finished files as notifications; the header line is not a row."""
    return status.where(F.col("status") == COMPLETED).select(
        *keep,
        F.col("offset.timestamp").alias("time"),
        (F.col("offset.rows") - 1).alias("rows"),
    )


def with_source(rows: DataFrame, database_id: int, identifier: str) -> DataFrame:
    """Tag rows of one database with its constants."""
    return rows.withColumns(
        {"database_id": F.lit(database_id), "database_identifier": F.lit(identifier)}
    )


def known_uploads(uploads: DataFrame, databases: DataFrame) -> DataFrame:
    """Uploads of registered databases with their community."""
    registered = databases.select("database_identifier", "community_id")
    return uploads.join(registered, "database_identifier")


def unknown_uploads(uploads: DataFrame, databases: DataFrame) -> DataFrame:
    """Uploads nobody registered, kept for inspection."""
    return uploads.join(databases.select("database_identifier"), "database_identifier", "left_anti")


def row_check(uploads: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Announced against counted rows per upload."""
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("counted"))
    return uploads.join(counted, list(keys), "left").withColumns(
        {
            "counted": F.coalesce("counted", F.lit(0)).cast("long"),
            "complete": F.coalesce("counted", F.lit(0)) == F.col("rows"),
        }
    )


def rows_of_database(rows: DataFrame, identifier: str, renames: dict[str, str] | None = None) -> DataFrame:
    """One database's rows; a partition filter where the table is partitioned by database."""
    return rows.where(F.col("database_identifier") == identifier).withColumnsRenamed(renames or {})


def slice_rows(output: DataFrame, filter_id: int, upload_id: int) -> DataFrame:
    """One upload's part of a filter's output."""
    return output.where((F.col("filter_id") == filter_id) & (F.col("upload_id") == upload_id))


def slice_join(
    rows: DataFrame,
    slices: DataFrame,
    keys: Sequence[str],
    offset: str = "offset",
    block: int = SLICE_BLOCK,
) -> DataFrame:
    """Rows whose offset lies in ``[last_offset + 1 - count, last_offset]`` of a slice of the same key.

    Both sides meet on (key, block of offsets): a row sees only the slices that touch its
    block, and a key with many rows is spread over many blocks.
    """
    low = F.col("last_offset") + 1 - F.col("count")
    spans = slices.where(F.col("count") > 0).withColumn(
        "_block", F.explode(F.sequence(F.floor(low / F.lit(block)), F.floor(F.col("last_offset") / F.lit(block))))
    )
    blocked = rows.withColumn("_block", F.floor(F.col(offset) / F.lit(block)))
    return (
        blocked.join(spans, [*keys, "_block"])
        .where((F.col(offset) >= low) & (F.col(offset) <= F.col("last_offset")))
        .drop("_block")
    )


def assign_offsets(rows: DataFrame, keys: Sequence[str], position: str, ties: Sequence[str] = ()) -> DataFrame:
    return with_offset(rows, keys, position, "offset", ties)


def union_sources(*streams: DataFrame) -> DataFrame:
    """One system table from the tables of each source."""
    first, *others = streams
    for other in others:
        first = first.unionByName(other)
    return first
