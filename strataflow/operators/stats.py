"""Statistics of uploads, heartbeats and deliveries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.operators.ordered import with_previous

# Fixed value: hours between two periodic heartbeats.
HEARTBEAT_HOURS = 336

FAILED_CODE = 0


def last_active(databases: DataFrame, beats: DataFrame, now: Column, period_hours: float = HEARTBEAT_HOURS) -> DataFrame:
    """Latest heartbeat of each database; silent databases are listed too. ``time`` is a local time."""
    latest = beats.groupBy("database_id").agg(F.max("time").alias("last_time"))
    age = F.timestamp_diff("SECOND", F.col("last_time"), now)
    return databases.join(latest, "database_id", "left").withColumns(
        {
            "age_seconds": age,
            "active": F.coalesce(age <= F.lit(int(period_hours * 3600)), F.lit(False)),
        }
    )


def beats_by_reason(beats: DataFrame) -> DataFrame:
    return beats.groupBy("database_id", "reason").agg(F.count(F.lit(1)).alias("beats"))


def unanswered_requests(
    requests: DataFrame, beats: DataFrame, key: str, time: str, bound: int
) -> DataFrame:
    """Requests without a beat in ``(time, time + bound]``; ``time`` is an integer on both sides.

    With blocks as long as the bound, the window covers the rest of the request's block
    and the start of the next: the latest beat of the one and the earliest of the other
    decide, so no request meets more than two aggregated rows.
    """
    blocks = beats.groupBy(key, F.floor(F.col(time) / F.lit(bound)).alias("_block")).agg(
        F.min(time).alias("_first"), F.max(time).alias("_last")
    )
    here = blocks.select(key, "_block", "_last")
    after = blocks.select(key, (F.col("_block") - 1).alias("_block"), "_first")
    edges = here.join(after, [key, "_block"], "full")
    placed = requests.withColumn("_block", F.floor(F.col(time) / F.lit(bound)))
    answered = (F.col("_last") > F.col(time)) | (F.col("_first") <= F.col(time) + F.lit(bound))
    return (
        placed.join(edges, [key, "_block"], "left")
        .where(~F.coalesce(answered, F.lit(False)))
        .drop("_block", "_first", "_last")
    )


def upload_stats(uploads: DataFrame, key: str = "database_id") -> DataFrame:
    return uploads.groupBy(key).agg(
        F.count(F.lit(1)).alias("uploads"),
        F.sum(F.col("rows").cast("long")).alias("total_rows"),
        F.min("time").alias("first_time"),
        F.max("time").alias("last_time"),
    )


def upload_intervals(uploads: DataFrame, keys: Sequence[str], position: str, ties: Sequence[str] = ()) -> DataFrame:
    """Time since the previous upload, in the unit of ``position``."""
    gaps = with_previous(uploads, keys, position, {"_previous": position}, ties)
    return gaps.withColumn("gap", F.col(position) - F.col("_previous")).drop("_previous")


def code_class(code: Column) -> Column:
    """Class of a response code; zero marks a request that could not be made."""
    return F.when(code == FAILED_CODE, "failed").otherwise(F.concat((code / F.lit(100)).cast("int"), F.lit("xx")))


def delivery_stats(deliveries: DataFrame, key: str = "application_id") -> DataFrame:
    code = F.col("response_code")
    failed = F.count_if(code == FAILED_CODE)
    total = F.count(F.lit(1))
    return deliveries.groupBy(key).agg(
        total.alias("deliveries"),
        F.count_if(code.between(200, 299)).alias("accepted"),
        F.count_if(code.between(400, 499)).alias("rejected"),
        F.count_if(code.between(500, 599)).alias("broken"),
        failed.alias("failed"),
        F.round(failed / total, 4).alias("failed_share"),
    )


def latest_record(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row of each entity, as an aggregation: nothing is sorted."""
    others = [c for c in rows.columns if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_row"))
    return newest.select(*keys, "_row.*")


def newest_first(rows: DataFrame, time: str = "time", tie: str = "id") -> DataFrame:
    return rows.orderBy(F.desc(time), F.desc(tie))


def ordered_by(rows: DataFrame, column: str, descending: bool = False) -> DataFrame:
    """Ordering on any field of the table, and on nothing else."""
    if column not in rows.columns:
        raise ValueError(f"cannot order by {column}")
    return rows.orderBy(F.desc(column) if descending else F.asc(column))


def page(rows: DataFrame, order: Sequence[Column], number: int, size: int) -> DataFrame:
    """One page of a listing; the order should end in a unique column."""
    if number < 1 or size < 1:
        raise ValueError("pages and page sizes start at 1")
    return rows.orderBy(*order).offset((number - 1) * size).limit(size)
