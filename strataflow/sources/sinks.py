"""Sinks: delimited result files, append-only statistics tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.operators.access import exportable_answers
from strataflow.operators.fanout import FilterSpec
from strataflow.schema import check_columns


def write_delimited(rows: DataFrame, path: str, selections: list[str], partition_by: tuple[str, ...] = ()) -> None:
    """Header, columns in selection or canonical order, NULL as empty field, quoting where needed."""
    (
        rows.select(*partition_by, *check_columns(selections))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if partition_by else "static")
        .partitionBy(*partition_by)
        .option("header", True)
        .option("nullValue", "")
        .option("emptyValue", "")
        .csv(path)
    )


def write_slices(output: DataFrame, specs: Sequence[FilterSpec], root: str) -> None:
    """Files of filters that select the same columns, one folder per filter and upload."""
    rows = output.where(F.col("filter_id").isin([s.filter_id for s in specs]))
    write_delimited(rows, root, list(specs[0].selections), ("filter_id", "upload_id"))


def append_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Append a micro-batch once: a replay of the batch replaces its own folder."""
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def append_jdbc(rows: DataFrame, url: str, table: str, properties: dict[str, str] | None = None) -> None:
    """Insert-only append to an existing table of a relational database."""
    rows.write.jdbc(url, table, mode="append", properties=properties or {})


def write_by_database(rows: DataFrame, path: str) -> None:
    """Rows of every database in one table; a reader of one database prunes the others."""
    rows.write.mode("append").partitionBy("database_identifier").parquet(path)



def export_answers(answers: DataFrame, questions: DataFrame, stored: DataFrame, path: str) -> None:
    """Answers that may leave, as delimited files; ``stored`` holds the permissions that differ from the default."""
    allowed = exportable_answers(answers, questions, stored).select("fingerprint", "question", "value")
    allowed.write.mode("overwrite").option("header", True).option("escape", '"').option("nullValue", "").csv(path)
