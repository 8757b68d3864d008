"""Recording job: system messages to statistics tables, and the reports on them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.operators.stats import delivery_stats, last_active, latest_record, upload_stats
from strataflow.sources.sinks import append_batch


@dataclass(frozen=True)
class Report:
    databases: DataFrame
    uploads: DataFrame
    deliveries: DataFrame
    latest_uploads: DataFrame


def record(tables: dict[str, DataFrame], root: str, batch_id: int) -> None:
    """Append one batch of each table; a replay leaves the tables as they are."""
    for name, rows in tables.items():
        append_batch(rows, f"{root}/{name}", batch_id)


def log_deliveries(responses: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Delivery records of responses; a failed request has code zero and the error text."""
    return responses.select(
        *keys,
        "application_id",
        "time",
        F.when(F.col("error").isNull(), F.col("status_code")).otherwise(F.lit(0)).cast("int").alias("response_code"),
        F.coalesce("error", "content").alias("response_data"),
    )


def report(
    databases: DataFrame, uploads: DataFrame, beats: DataFrame, deliveries: DataFrame, now: Column
) -> Report:
    return Report(
        databases=last_active(databases, beats, now),
        uploads=upload_stats(uploads),
        deliveries=delivery_stats(deliveries),
        latest_uploads=latest_record(uploads, ["database_id"], ["time"]),
    )
