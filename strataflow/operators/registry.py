"""Registry of communities, databases, filters and applications as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.schema import ACTIVE, EDIT, STOPPED


def latest_state(events: DataFrame, key: str, order: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Fold ordered management messages to one row per entity.

    A status message sets the status, an edit keeps it; a stop carries no fields, so each
    field comes from the latest message that has them. The fold is an aggregation, so the
    order of the input does not matter and an entity with many messages needs no sort.
    """
    when = F.struct(*order)
    sets_status = F.col("action") != EDIT
    sets_fields = F.col("action") != STOPPED
    state = events.groupBy(key).agg(
        F.max_by("action", F.when(sets_status, when)).alias("status"),
        F.max_by(F.struct(*fields), F.when(sets_fields, when)).alias("_fields"),
    )
    return state.select(key, F.coalesce("status", F.lit(STOPPED)).alias("status"), "_fields.*")


def active_only(entities: DataFrame) -> DataFrame:
    return entities.where(F.col("status") == ACTIVE)


def cascade(filters: DataFrame, applications: DataFrame) -> DataFrame:
    """Status of each filter as its applications imply it: active while one of them is."""
    alive = active_only(applications).select("filter_id").distinct().withColumn("_alive", F.lit(True))
    return (
        filters.join(alive, "filter_id", "left")
        .withColumn("derived_status", F.when(F.col("_alive"), ACTIVE).otherwise(STOPPED))
        .drop("_alive")
    )


def stop_filters(applications: DataFrame, stopped: DataFrame) -> DataFrame:
    """Applications after the given filters are stopped."""
    marks = stopped.select("filter_id").distinct().withColumn("_stopped", F.lit(True))
    return (
        applications.join(marks, "filter_id", "left")
        .withColumn("status", F.when(F.col("_stopped"), STOPPED).otherwise(F.col("status")))
        .drop("_stopped")
    )


def start_applications(filters: DataFrame, started: DataFrame) -> DataFrame:
    """Filters after the given applications are started."""
    marks = started.select("filter_id").distinct().withColumn("_started", F.lit(True))
    return (
        filters.join(marks, "filter_id", "left")
        .withColumn("status", F.when(F.col("_started"), ACTIVE).otherwise(F.col("status")))
        .drop("_started")
    )


def idle_filters(filters: DataFrame, applications: DataFrame) -> DataFrame:
    """Active filters without an active application: these are to be stopped."""
    return active_only(filters).join(active_only(applications).select("filter_id"), "filter_id", "left_anti")


def selection_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows to delete and rows to create so that ``old`` becomes ``new``."""
    keys = list(keys)
    old, new = old.select(*keys).distinct(), new.select(*keys).distinct()
    removed = old.join(new, keys, "left_anti").withColumn("change", F.lit("delete"))
    added = new.join(old, keys, "left_anti").withColumn("change", F.lit("create"))
    return removed.unionByName(added)


def list_entities(
    entities: DataFrame,
    equals: dict[str, object] | None = None,
    contains: dict[str, object] | None = None,
) -> DataFrame:
    """Listing with equality filters; ``contains`` tests membership of an array column."""
    for column, value in (equals or {}).items():
        entities = entities.where(F.col(column) == F.lit(value))
    for column, value in (contains or {}).items():
        entities = entities.where(F.array_contains(column, F.lit(value)))
    return entities


def expand_reference(rows: DataFrame, key: str, referenced: DataFrame, columns: dict[str, str]) -> DataFrame:
    """N:1 expansion: add columns of the referenced entity, keep rows without one."""
    picked = referenced.select(F.col(key), *[F.col(c).alias(n) for c, n in columns.items()])
    return rows.join(picked, key, "left")


def expand_many(parents: DataFrame, key: str, children: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """1:N expansion as rows ``(parent, kind, child)``; a parent without children keeps one row.

    Rows rather than lists: the uploads of one database have no bound.
    """
    listed = None
    for kind, (table, child) in children.items():
        part = table.select(F.col(key), F.lit(kind).alias("kind"), child.cast("string").alias("child"))
        listed = part if listed is None else listed.unionByName(part)
    childless = parents.join(listed.select(key).distinct(), key, "left_anti")
    absent = F.lit(None).cast("string")
    # An inner join, as a parent with very many children can be split there.
    return parents.join(listed, key).unionByName(childless.withColumns({"kind": absent, "child": absent}))
