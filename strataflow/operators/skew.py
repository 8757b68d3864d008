"""Checks of size: groups too big for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.session import cut_lineage


def hot_groups(
    df: DataFrame, keys: Sequence[str], measures: dict[str, Column], limit: int
) -> DataFrame | None:
    """Groups of more than ``limit`` rows with ``group_rows`` and the measures; None if there are none.

    This runs one aggregation with map-side combine over the keys and the measured
    columns. At most (rows / limit) groups can be hot, so the result may be broadcast. It
    is kept in the shared folder: every later use sees the same groups.
    """
    sizes = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("group_rows"), *[column.alias(name) for name, column in measures.items()]
    )
    hot = sizes.where(F.col("group_rows") > limit)
    return None if hot.isEmpty() else cut_lineage(hot)
