"""Declared schemas: one place drives parsing, validation and output order."""

from __future__ import annotations

from pyspark.sql import types as T

STRATA = ["stratum_1", "stratum_2", "stratum_3", "stratum_4", "stratum_5"]

# Percentile columns of a catalogue row and their fractions.
PERCENTILES = {
    "median_value": 0.5,
    "p10_value": 0.1,
    "p25_value": 0.25,
    "p75_value": 0.75,
    "p90_value": 0.9,
}

STATISTICS = ["min_value", "max_value", "avg_value", "stdev_value", *PERCENTILES]

# Canonical order of the sixteen columns of a catalogue row.
CATALOGUE_COLUMNS = ["analysis_id", *STRATA, "count_value", *STATISTICS]

CATALOGUE_SCHEMA = T.StructType(
    [T.StructField("analysis_id", T.LongType(), False)]
    + [T.StructField(name, T.StringType()) for name in STRATA]
    + [T.StructField("count_value", T.LongType(), False)]
    + [T.StructField(name, T.DoubleType()) for name in STATISTICS]
)

STRING_COLUMNS = frozenset(STRATA)

# Rows that account for a profiling run carry this offset plus the analysis id.
RUN_ACCOUNTING_BASE = 2_000_000

ACTIVE = "ACTIVE"
STOPPED = "STOPPED"
EDIT = "EDIT"
COMPLETED = "COMPLETED"

FILE_STATUS_SCHEMA = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField(
            "offset",
            T.StructType(
                [
                    T.StructField("rows", T.LongType()),
                    T.StructField("timestamp", T.TimestampType()),
                ]
            ),
        ),
    ]
)

UPLOAD_SCHEMA = T.StructType(
    [
        T.StructField("database_identifier", T.StringType()),
        T.StructField("database_id", T.IntegerType()),
        T.StructField("time", T.TimestampType()),
        T.StructField("rows", T.IntegerType()),
    ]
)

HEALTH_CHECK_SCHEMA = T.StructType(
    [
        T.StructField("database_id", T.IntegerType()),
        T.StructField("time", T.TimestampType()),
        T.StructField("reason", T.StringType()),
    ]
)

DELIVERY_SCHEMA = T.StructType(
    [
        T.StructField("application_id", T.IntegerType()),
        T.StructField("time", T.TimestampType()),
        T.StructField("response_code", T.IntegerType()),
        T.StructField("response_data", T.StringType()),
    ]
)

DATA_READY_SCHEMA = T.StructType(
    [
        T.StructField("filter_worker_id", T.IntegerType()),
        T.StructField("filter_id", T.IntegerType()),
        T.StructField("database_identifier", T.StringType()),
        T.StructField("last_offset", T.LongType()),
        T.StructField("count", T.LongType()),
    ]
)

FILTER_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("action", T.StringType()),
        T.StructField("filter_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("filter", T.StringType()),
        T.StructField("communities", T.ArrayType(T.LongType())),
        T.StructField("selections", T.ArrayType(T.StringType())),
    ]
)

APPLICATION_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("action", T.StringType()),
        T.StructField("filter_id", T.LongType()),
        T.StructField("application_id", T.LongType()),
        T.StructField("community", T.StringType()),
        T.StructField("request_template", T.StringType()),
    ]
)

DATA_REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("filter_worker_id", T.IntegerType()),
        T.StructField("database_identifier", T.StringType()),
        T.StructField("rows", T.IntegerType()),
    ]
)

# Columns of a questionnaire sheet, all text.
SHEET_COLUMNS = [
    "type",
    "text",
    "level",
    "data_type",
    "description",
    "slug",
    "dependencies",
    "constraints",
    "tooltip",
    "search",
]


def check_columns(selections: list[str]) -> list[str]:
    """Return the selection in its own order, or every column when there is none."""
    unknown = [c for c in selections if c not in CATALOGUE_COLUMNS]
    if unknown:
        raise ValueError(f"columns outside the catalogue schema: {unknown}")
    return list(dict.fromkeys(selections)) or list(CATALOGUE_COLUMNS)
