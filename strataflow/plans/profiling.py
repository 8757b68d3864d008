"""Profile job: analyses over fact tables, one table of catalogue rows."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.operators.profile import (
    as_catalogue_rows,
    count_profile,
    distribution_profile,
)
from strataflow.schema import RUN_ACCOUNTING_BASE
from strataflow.session import local_table

# Fixed value: the count of an accounting row.
ACCOUNTING_COUNT = 6


@dataclass(frozen=True)
class Analysis:
    """One analysis: distinct entities if ``entity`` is set, else the distribution of ``value``."""

    analysis_id: int
    table: str
    strata: tuple[str, ...] = ()
    entity: str | None = None
    value: str | None = None

    def rows(self, tables: dict[str, DataFrame], by: Sequence[str], approximate: bool = False) -> DataFrame:
        facts = tables[self.table]
        if self.entity:
            return count_profile(facts, self.analysis_id, by, self.entity, self.strata)
        return distribution_profile(facts, self.analysis_id, by, self.value, self.strata, approximate)


def profile(
    tables: dict[str, DataFrame],
    analyses: Sequence[Analysis],
    by: Sequence[str],
    allowed: DataFrame | None = None,
    approximate: bool = False,
) -> DataFrame:
    """Catalogue rows of all analyses; of those in ``allowed`` (``analysis_id``) where it is given.

    What may not be published is not computed.
    """
    if allowed is not None:
        wanted = allowed.where(F.col("analysis_id").isin([a.analysis_id for a in analyses])).select("analysis_id").distinct()
        permitted = {r.analysis_id for r in wanted.collect()}
        # At least one analysis gives the columns of an empty result.
        rows = [a.rows(tables, by, approximate) for a in analyses if a.analysis_id in permitted]
        return reduce(DataFrame.unionByName, rows) if rows else analyses[0].rows(tables, by, approximate).where("false")
    return reduce(DataFrame.unionByName, [a.rows(tables, by, approximate) for a in analyses])


def write_profile(
    tables: dict[str, DataFrame], analyses: Sequence[Analysis], by: Sequence[str], path: str
) -> dict[int, float]:
    """Write each analysis with an accounting row of its elapsed time; returns the times."""
    elapsed = {}
    for analysis in analyses:
        started = time.monotonic()
        analysis.rows(tables, by).write.mode("overwrite").parquet(f"{path}/rows/analysis={analysis.analysis_id}")
        elapsed[analysis.analysis_id] = time.monotonic() - started
    spark = next(iter(tables.values())).sparkSession
    log = local_table(
        spark,
        [(RUN_ACCOUNTING_BASE + a, f"{s:.6f} secs", ACCOUNTING_COUNT) for a, s in elapsed.items()],
        "analysis_id long, elapsed string, count_value long",
    )
    as_catalogue_rows(log, [], None, ["elapsed"]).write.mode("overwrite").parquet(f"{path}/accounting")
    return elapsed
