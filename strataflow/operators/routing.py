"""From slices of filtered rows to requests for the subscribed applications."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from itertools import batched

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.functions.templates import Template, cell_name, parse_template
from strataflow.schema import ACTIVE


@dataclass(frozen=True)
class Application:
    """A subscriber: its filter, community and request template."""

    application_id: int
    filter_id: int
    community_id: int
    template: str


# Applications written into one plan; more are taken in groups.
APPLICATIONS_PER_PLAN = 200


def applications_from_registry(applications: DataFrame) -> list[Application]:
    """Active applications; their templates become plan text."""
    columns = ["application_id", "filter_id", "community_id", "request_template"]
    active = applications.where(F.col("status") == ACTIVE).select(*columns).orderBy("application_id")
    return [
        Application(r.application_id, r.filter_id, r.community_id, r.request_template) for r in active.toLocalIterator()
    ]


def ready_applications(ready: DataFrame, applications: DataFrame, strict_community: bool = True) -> DataFrame:
    """Slices with the active applications of their filter.

    ``strict_community`` keeps data within the application's community; without it every
    application of the filter is served.
    """
    subscribers = applications.where(F.col("status") == ACTIVE).select(
        "application_id", "filter_id", F.col("community_id").alias("application_community")
    )
    joined = ready.join(subscribers, "filter_id")
    if strict_community:
        joined = joined.where(F.col("application_community") == F.col("community_id"))
    return joined


def first_values(output: DataFrame, keys: list[str], column: str, order: Column) -> DataFrame:
    """First value of a filtered column per slice, as an aggregation."""
    return output.groupBy(*keys).agg(F.min_by(column, order).alias("first_value"))


def _cells(output: DataFrame, keys: list[str], order: str, cells: set[tuple[str, int]]) -> DataFrame:
    """Cells of each slice that templates mention, one row per slice."""
    if all(place == 0 for _, place in cells):
        picked = [F.min_by(c, F.col(order)).alias(cell_name(c, 0)) for c, _ in sorted(cells)]
        return output.groupBy(*keys).agg(*picked)
    # The limit on the place applies before the shuffle: a task sends a few rows per slice.
    first = Window.partitionBy(*keys).orderBy(order)
    placed = output.select(*keys, order, *sorted({c for c, _ in cells})).withColumn("_place", F.row_number().over(first))
    placed = placed.where(F.col("_place") <= 1 + max(place for _, place in cells))
    picked = [
        F.max(F.when(F.col("_place") == place + 1, F.col(c))).alias(cell_name(c, place)) for c, place in sorted(cells)
    ]
    return placed.groupBy(*keys).agg(*picked)


def build_requests(
    ready: DataFrame,
    output: DataFrame,
    applications: Iterable[Application],
    keys: tuple[str, str] = ("filter_id", "upload_id"),
    order: str = "offset",
    file_root: str = "results",
    strict_community: bool = True,
) -> DataFrame:
    """One request per application and slice: method, url, body, options, file.

    ``ready`` needs the keys, ``database_identifier``, ``community_id`` and
    ``community_name``; ``output`` the keys, the order column and the filtered columns.
    Files are named, never loaded: the path is where the result sink writes the slice.
    """
    applications = list(applications)
    templates: dict[int, Template] = {a.application_id: parse_template(a.template) for a in applications}
    cells = set().union(*(t.cells for t in templates.values())) if templates else set()
    if cells:
        ready = ready.join(_cells(output, list(keys), order, cells), list(keys), "left")

    path = F.concat_ws("/", F.lit(file_root), *[F.concat(F.lit(f"{k}="), F.col(k).cast("string")) for k in keys])
    parts = [
        _requests(ready, group, templates, keys, path, strict_community)
        for group in batched(applications, APPLICATIONS_PER_PLAN)
    ]
    return reduce(DataFrame.unionByName, parts)


def _requests(
    ready: DataFrame,
    applications: Iterable[Application],
    templates: dict[int, Template],
    keys: tuple[str, str],
    path: Column,
    strict_community: bool,
) -> DataFrame:
    requests = []
    for app in applications:
        template = templates[app.application_id]
        served = F.col("filter_id") == app.filter_id
        if strict_community:
            served = served & (F.col("community_id") == app.community_id)
        columns = template.columns()
        record = F.struct(
            F.lit(app.application_id).cast("long").alias("application_id"),
            *[c.alias(n) for n, c in columns.items()],
            F.when(F.lit(template.uses_file), path).alias("file_path"),
        )
        requests.append(F.when(served, record))
    return ready.select(*keys, F.inline(F.array_compact(F.array(*requests))))
