"""Typed scan of delimited catalogue files, good rows apart from malformed ones."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.schema import CATALOGUE_COLUMNS, CATALOGUE_SCHEMA

CORRUPT = "malformed"
GLOB = "*.csv"
PLACE = ("file_block", "file_row", "byte")


def scan_schema(schema: T.StructType = CATALOGUE_SCHEMA) -> T.StructType:
    fields = [T.StructField(f.name, f.dataType) for f in schema]
    return T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])


def _options(reader, separator: str):
    return (
        reader.schema(scan_schema())
        .option("header", True)
        .option("sep", separator)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", False)
        .option("pathGlobFilter", GLOB)
    )


def typed_lines(lines: DataFrame, header: bool = True, separator: str = ",") -> DataFrame:
    """Typed rows of lines that were read with their place; malformed rows keep their text in ``malformed``."""
    text = F.col("value").cast("string")
    own = lines.where(F.trim(text) != "")
    if header:
        own = own.where(F.col("byte") > 0)
    options = {
        "sep": separator, "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true",
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
    }
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in scan_schema())
    cells = F.from_csv(text, ddl, options)
    return own.withColumn("value", cells).select("value.*", *[c for c in lines.columns if c != "value"])


def with_origin(rows: DataFrame) -> DataFrame:
    """Add the file, its time and the database, which is the folder the file lies in."""
    return rows.select(
        *rows.columns,
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_modification_time").alias("file_time"),
    ).withColumn("database_identifier", database_of(F.col("file_path")))


def database_of(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -2)


def with_place(rows: DataFrame) -> DataFrame:
    """Add ``file_block`` and ``file_row``, which order the rows of a file; for rows that are written next."""
    return rows.select(
        *rows.columns, F.col("_metadata.file_block_start").alias("file_block"), F.monotonically_increasing_id().alias("file_row")
    )


def read_delimited(spark: SparkSession, paths: str | Sequence[str], separator: str = ",") -> DataFrame:
    """Rows of the files with their origin and place; malformed rows keep their text in ``malformed``."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return with_origin(with_place(_options(spark.read, separator).csv(paths)))


def stream_delimited(spark: SparkSession, path: str, separator: str = ",", files_per_batch: int = 1000) -> DataFrame:
    """The same rows as a stream of arriving files; a file never spans two batches."""
    reader = _options(spark.readStream, separator).option("maxFilesPerTrigger", files_per_batch)
    rows = reader.csv(path)
    # Rows are numbered in each batch, a stream has no numbers of its own.
    return with_origin(rows.select(*rows.columns, F.col("_metadata.file_block_start").alias("file_block")))


def _is_good() -> Column:
    required = [F.col(f.name).isNotNull() for f in CATALOGUE_SCHEMA if not f.nullable]
    return F.col(CORRUPT).isNull() & reduce(lambda a, b: a & b, required)


def good_rows(rows: DataFrame) -> DataFrame:
    return rows.where(_is_good()).drop(CORRUPT)


def malformed_rows(rows: DataFrame) -> DataFrame:
    """Rows to quarantine: their file and their text."""
    text = F.coalesce(CORRUPT, F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in CATALOGUE_COLUMNS]))
    origin = [c for c in rows.columns if c not in (*CATALOGUE_COLUMNS, CORRUPT, *PLACE)]
    return rows.where(~_is_good()).select(*origin, text.alias("line"))


def transformed(rows: DataFrame, steps: Sequence[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Apply a chain of ingest steps."""
    return reduce(lambda df, step: df.transform(step), steps, rows)
