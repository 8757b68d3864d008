"""Delivery job: from ready slices to a table of requests and the files they name."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame

from strataflow.operators.fanout import FilterSpec
from strataflow.operators.registry import expand_reference
from strataflow.operators.routing import Application, build_requests
from strataflow.schema import check_columns
from strataflow.sources.sinks import write_slices


def route(
    ready: DataFrame,
    output: DataFrame,
    communities: DataFrame,
    applications: Sequence[Application],
    file_root: str = "results",
    strict_community: bool = True,
) -> DataFrame:
    """One request per (application, slice)."""
    named = expand_reference(ready, "community_id", communities, {"community_name": "community_name"})
    return build_requests(
        named, output, applications, file_root=file_root, strict_community=strict_community
    )


def write_result_files(output: DataFrame, specs: Sequence[FilterSpec], file_root: str) -> None:
    """Write the delimited file of each slice where the requests expect it.

    Filters that select the same columns are written together, in one pass over the output.
    """
    by_columns: dict[tuple[str, ...], list[FilterSpec]] = {}
    for spec in specs:
        by_columns.setdefault(tuple(check_columns(list(spec.selections))), []).append(spec)
    for group in by_columns.values():
        write_slices(output, group, file_root)


def with_pandas(
    output: DataFrame, build: Callable[[pd.DataFrame], pd.DataFrame], schema: str, keys: Sequence[str]
) -> DataFrame:
    """Let user code see all rows of a slice as pandas; see :func:`in_batches` for slices beyond a task."""
    return output.groupBy(*keys).applyInPandas(build, schema)


def in_batches(output: DataFrame, build: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Let user code see the rows as pandas, a batch at a time; for slices of any size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield build(batch)

    return output.mapInPandas(run, schema)
