"""Messages with a declared schema: JSON, and Avro where Spark's module for it is installed."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def stream_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.readStream.schema(schema).json(path)


def decode_json(messages: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Typed columns of JSON texts; times are milliseconds since the epoch or ISO texts."""
    wire = T.StructType([T.StructField(f.name, _wire_type(f.dataType)) for f in schema])
    others = [c for c in messages.columns if c != column]
    parsed = messages.select(*others, F.from_json(F.col(column).cast("string"), wire).alias("_m"))
    return parsed.select(*others, *[_typed(F.col("_m")[f.name], f.dataType).alias(f.name) for f in schema])


def _wire_type(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.TimestampType):
        return T.StringType()
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _wire_type(f.dataType)) for f in kind])
    return kind


def _typed(column, kind: T.DataType):
    if isinstance(kind, T.TimestampType):
        return F.coalesce(F.timestamp_millis(column.try_cast("long")), column.try_cast("timestamp"))
    if isinstance(kind, T.StructType):
        return F.struct(*[_typed(column[f.name], f.dataType).alias(f.name) for f in kind])
    return column


def encode_json(rows: DataFrame, column: str = "value") -> DataFrame:
    """Rows as JSON texts; times become milliseconds since the epoch."""
    values = [
        (F.unix_millis(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)).alias(f.name)
        for f in rows.schema
    ]
    return rows.select(F.to_json(F.struct(*values)).alias(column))


def decode_avro(messages: DataFrame, schema: str, column: str = "value", header_bytes: int = 0) -> DataFrame:
    """Typed columns of Avro records; ``header_bytes`` skips a schema id in front of each."""
    from pyspark.sql.avro.functions import from_avro

    body = F.expr(f"substring({column}, {header_bytes + 1})") if header_bytes else F.col(column)
    try:
        return messages.select(from_avro(body, schema).alias("_m")).select("_m.*")
    except (AnalysisException, TypeError) as error:
        raise RuntimeError("Avro needs the spark-avro module on the class path") from error


def encode_avro(rows: DataFrame, schema: str, column: str = "value") -> DataFrame:
    from pyspark.sql.avro.functions import to_avro

    try:
        return rows.select(to_avro(F.struct(*rows.columns), schema).alias(column))
    except (AnalysisException, TypeError) as error:
        raise RuntimeError("Avro needs the spark-avro module on the class path") from error


def reencode(messages: DataFrame, schema: T.StructType, path: str, column: str = "value") -> None:
    """JSON texts to a columnar table."""
    decode_json(messages, schema, column).write.mode("append").parquet(path)
