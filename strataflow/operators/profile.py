"""Profiles of fact tables in the shape of catalogue rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.operators.quantiles import distribution
from strataflow.schema import CATALOGUE_COLUMNS, CATALOGUE_SCHEMA, RUN_ACCOUNTING_BASE, STRATA


def as_catalogue_rows(df: DataFrame, by: Sequence[str], analysis_id: int | None, strata: Sequence[str]) -> DataFrame:
    """Shape grouped results: strata as text in order, everything absent as NULL."""
    types = {f.name: f.dataType for f in CATALOGUE_SCHEMA}
    named = dict(zip(STRATA, strata))

    def value(column: str):
        if column == "analysis_id" and analysis_id is not None:
            return F.lit(analysis_id).cast("long")
        if column in STRATA:
            return F.col(named[column]).cast("string") if column in named else F.lit(None).cast("string")
        return F.col(column).cast(types[column]) if column in df.columns else F.lit(None).cast(types[column])

    return df.select(*by, *[value(c).alias(c) for c in CATALOGUE_COLUMNS])


def count_profile(
    facts: DataFrame, analysis_id: int, by: Sequence[str], entity: str, strata: Sequence[str] = ()
) -> DataFrame:
    """Distinct entities per database and stratum."""
    counted = facts.groupBy(*dict.fromkeys([*by, *strata])).agg(F.count_distinct(entity).alias("count_value"))
    return as_catalogue_rows(counted, by, analysis_id, strata)


def distribution_profile(
    facts: DataFrame,
    analysis_id: int,
    by: Sequence[str],
    value: str,
    strata: Sequence[str] = (),
    approximate: bool = False,
) -> DataFrame:
    """Distribution of a numeric fact per database and stratum."""
    stats = distribution(facts, list(dict.fromkeys([*by, *strata])), value, approximate=approximate)
    return as_catalogue_rows(stats, by, analysis_id, strata)


def multi_strata_profile(
    facts: DataFrame, by: Sequence[str], value: str, analyses: dict[int, Sequence[str]]
) -> DataFrame:
    """Several stratifications of one fact in one pass: ``{analysis_id: strata}``.

    Every row is repeated once per stratification before the aggregation, as grouping
    sets do, so that totals and strata come from the same scan.
    """
    tagged = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(analysis_id).cast("long").alias("analysis_id"),
                    *[
                        (F.col(strata[i]).cast("string") if i < len(strata) else F.lit(None).cast("string")).alias(s)
                        for i, s in enumerate(STRATA)
                    ],
                )
                for analysis_id, strata in analyses.items()
            ]
        )
    )
    keys = [*by, "analysis_id", *STRATA]
    rows = facts.select(*by, F.col(value).alias("_value"), tagged.alias("_set")).select(*by, "_value", "_set.*")
    return as_catalogue_rows(distribution(rows, keys, "_value"), by, None, STRATA)


def strata_consistency(results: DataFrame, by: Sequence[str], total_id: int, strata_id: int) -> DataFrame:
    """Totals next to the sum and count-weighted mean of their strata."""
    wanted = results.where(F.col("analysis_id").isin(total_id, strata_id))
    total, part = F.col("analysis_id") == total_id, F.col("analysis_id") == strata_id
    weighted = F.sum(F.when(part, F.col("avg_value") * F.col("count_value")))
    strata_count = F.sum(F.when(part, F.col("count_value")))
    return wanted.groupBy(*by).agg(
        F.max(F.when(total, F.col("count_value"))).alias("total_count"),
        strata_count.alias("strata_count"),
        F.max(F.when(total, F.col("avg_value"))).alias("total_avg"),
        (weighted / strata_count).alias("strata_avg"),
    ).withColumn("count_difference", F.col("total_count") - F.col("strata_count"))


def run_log(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Elapsed seconds of each analysis, from the accounting rows of a profiling run."""
    seconds = F.regexp_extract("stratum_1", r"^([0-9.]+) secs", 1)
    return results.where(
        (F.col("analysis_id") >= RUN_ACCOUNTING_BASE) & F.col("stratum_1").rlike(r"^[0-9.]+ secs")
    ).select(
        *by,
        (F.col("analysis_id") - RUN_ACCOUNTING_BASE).alias("analysis_id"),
        seconds.cast("double").alias("elapsed_seconds"),
    )


def without_run_log(results: DataFrame) -> DataFrame:
    return results.where(F.col("analysis_id") < RUN_ACCOUNTING_BASE)


def permitted_analyses(results: DataFrame, allowed: DataFrame) -> DataFrame:
    """Rows of analyses the owner allows to publish."""
    return results.join(allowed.select("analysis_id"), "analysis_id", "left_semi")


def to_standard_concepts(facts: DataFrame, code: str, vocabulary: DataFrame) -> DataFrame:
    """Standard concept of each local code; ``vocabulary`` has ``code, concept_id, concept_name``."""
    return facts.join(vocabulary, facts[code] == vocabulary["code"], "left").drop("code")
