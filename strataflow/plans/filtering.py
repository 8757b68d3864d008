"""Filter job: every active filter over every upload, with counts and the slices that are ready."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.operators.fanout import (
    FilterSpec,
    all_filters_done,
    belonging,
    completeness,
    count_matches,
    data_ready,
    fan_out,
    with_empty_uploads,
)
from strataflow.session import cut_lineage

KEYS = ["upload_id", "database_identifier"]


@dataclass(frozen=True)
class Filtered:
    """Results of a run. The counts are stored, as all but the output rest on them; the rest is lazy."""

    output: DataFrame
    counts: DataFrame
    checked: DataFrame
    done: DataFrame
    slices: DataFrame
    ready: DataFrame


def run_filters(
    rows: DataFrame,
    announced: DataFrame,
    databases: DataFrame,
    specs: Sequence[FilterSpec],
    before: DataFrame | None = None,
) -> Filtered:
    """``rows`` carry ``upload_id``, ``database_identifier`` and the catalogue columns.

    Slices are ready for delivery when the upload is complete for the filter and the
    filter's communities hold the database's community. ``before`` is the output so far, see
    :func:`data_ready`.
    """
    specs = list(specs)
    counted = count_matches(rows, KEYS, specs)
    counts = cut_lineage(with_empty_uploads(counted, announced, KEYS, specs))
    checked = completeness(counts, announced, KEYS)
    gate = belonging(databases.select("database_identifier", "community_id"), specs)
    slices = data_ready(counts, "upload_id", "database_identifier", before)
    finished = checked.where(F.col("complete") & F.col("filter_id").isNotNull()).select("filter_id", "upload_id")
    ready = (
        slices.join(gate, ["database_identifier", "filter_id"])
        .join(finished, ["filter_id", "upload_id"], "left_semi")
    )
    return Filtered(
        output=fan_out(rows, specs),
        counts=counts,
        checked=checked,
        done=all_filters_done(checked, KEYS, len(specs)),
        slices=slices,
        ready=ready,
    )
