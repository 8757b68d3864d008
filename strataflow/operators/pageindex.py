"""Pages of a listing from rows stored by ranges of its order.

The rows are dealt out by ranges of the order and sorted there; how many rows come before each range is kept beside
them. A page, or any slice of places, opens the ranges it lies in and no others, however far down it is.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANGE_ROWS = 100_000


@dataclass(frozen=True)
class PageIndex:
    spark: SparkSession
    path: str
    schema: T.StructType
    order: tuple[tuple[str, bool], ...]

    def ranges(self) -> DataFrame:
        """``range, start, rows``: places before each range, and rows in it."""
        return self.spark.read.schema("range int, start long, rows long").parquet(f"{self.path}/counts")

    def between(self, first: int, last: int) -> DataFrame:
        """Rows at the places from ``first`` to before ``last``, with their ``place``, counted from 0."""
        met = F.col("start").between(first - F.col("rows") + 1, last - 1)
        # As many as the slice crosses: for a page one or two.
        opened = self.ranges().where(met).orderBy("start").collect() if last > first else []
        kept = T.StructType([*self.schema.fields, T.StructField("range", T.IntegerType())])
        rows = self.spark.read.schema(kept).parquet(f"{self.path}/rows").where(F.col("range").isin([r["range"] for r in opened]))
        # Numbered within each range that was opened, of which a range is the unit that was stored.
        within = F.row_number().over(Window.partitionBy("range").orderBy(*_columns(self.order))) - 1
        start = F.create_map(*[F.lit(x) for r in opened for x in (r["range"], r["start"])]) if opened else F.lit(None)
        placed = rows.withColumn("place", (start[F.col("range")] + within).cast("long") if opened else F.lit(0).cast("long"))
        return placed.where(F.col("place").between(first, last - 1)).drop("range")

    def page(self, number: int, size: int) -> DataFrame:
        """One page, in order."""
        if number < 1 or size < 1:
            raise ValueError("pages and page sizes start at 1")
        return self.between((number - 1) * size, number * size).orderBy("place")


def _columns(order: Sequence[tuple[str, bool]]) -> list[Column]:
    return [F.col(name).desc_nulls_last() if down else F.col(name).asc_nulls_first() for name, down in order]


def build_pages(rows: DataFrame, order: Sequence[tuple[str, bool]], path: str, range_rows: int = RANGE_ROWS) -> PageIndex:
    """Store rows for paging by ``(column, descending)``; the order should end in a unique column."""
    order, spark = tuple(order), rows.sparkSession
    parts = max(1, -(-rows.count() // range_rows))
    dealt = rows.repartitionByRange(parts, *_columns(order)).sortWithinPartitions(*_columns(order))
    dealt.withColumn("range", F.spark_partition_id()).write.mode("overwrite").partitionBy("range").parquet(f"{path}/rows")
    stored = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("range", T.IntegerType())])).parquet(f"{path}/rows")
    counts = stored.groupBy("range").agg(F.count(F.lit(1)).alias("rows"))
    # One row per range.
    before = F.sum("rows").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    counts.select("range", F.coalesce(before, F.lit(0)).alias("start"), "rows").write.mode("overwrite").parquet(f"{path}/counts")
    return PageIndex(spark, path, rows.schema, order)
