"""Distribution statistics per group, exact and safe for groups of any size."""

from __future__ import annotations

import sys
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.schema import PERCENTILES
from strataflow.session import cut_lineage
from strataflow.session import hot_rows as configured_hot_rows

# Log-linear histogram: twenty octaves between the extremes, this many steps in each.
OCTAVES = 20
STEPS = 512


def _moments(value: Column) -> dict[str, Column]:
    return {
        "count_value": F.count(value),
        "min_value": F.min(value),
        "max_value": F.max(value),
        "avg_value": F.avg(value),
        "stdev_value": F.stddev_samp(value),
    }


LARGEST = sys.float_info.max


def _cell(value: Column, low: Column, high: Column) -> Column:
    """Histogram cell of a value; never falls as the value rises, so cells keep the order.

    Infinities and NaN have cells of their own beside the finite ones. The lowest and the
    highest finite value never share a cell, so an interval shrinks with every step.
    """
    bottom, top = F.greatest(low, F.lit(-LARGEST)), F.least(high, F.lit(LARGEST))
    width = top - bottom
    # Half of each term where the width itself would overflow.
    share = F.when(width <= F.lit(LARGEST), F.try_divide(value - bottom, width)).otherwise(
        F.try_divide(value / 2 - bottom / 2, top / 2 - bottom / 2)
    )
    finite = F.floor(
        F.log2(F.lit(1.0) + F.least(F.greatest(F.coalesce(share, F.lit(0.0)), F.lit(0.0)), F.lit(1.0)) * F.lit(float(2**OCTAVES)))
        * F.lit(float(STEPS))
    )
    last = OCTAVES * STEPS + 1
    return (
        F.when(value < F.lit(-LARGEST), F.lit(-1).cast("long"))
        .when(F.isnan(value), F.lit(last + 2).cast("long"))
        .when(value > F.lit(LARGEST), F.lit(last + 1).cast("long"))
        .otherwise(finite)
    )


def _rank(fraction: float, count: Column) -> Column:
    """Rank of a discrete percentile, in whole numbers: a tenth of thirty rows is the third."""
    part = Fraction(str(fraction))
    scaled = count * F.lit(part.numerator) + F.lit(part.denominator - 1)
    whole = (scaled - F.pmod(scaled, F.lit(part.denominator))) / F.lit(part.denominator)
    return F.greatest(F.lit(1), whole.cast("long"))


def _weighed_moments() -> dict[str, Column]:
    """Moments from values with their numbers; squares are about the mean, which stands beside each value."""
    n, off = F.sum("_n"), F.col("_v") - F.col("_mean")
    return {
        "count_value": n,
        "min_value": F.min("_v"),
        "max_value": F.max("_v"),
        "avg_value": F.any_value("_mean"),
        "stdev_value": F.when(n > 1, F.sqrt(F.sum(off * off * F.col("_n")) / (n - 1))),
    }


def _small_groups(values: DataFrame, keys: list[str], fractions: dict[str, float]) -> DataFrame:
    """Moments and percentiles of groups whose values fit a task, from one pass over the counted values."""
    group = Window.partitionBy(*keys).orderBy("_v")
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = group.rowsBetween(Window.unboundedPreceding, 0)
    mean = F.sum(F.col("_v") * F.col("_n")).over(whole) / F.sum("_n").over(whole)
    placed = values.select(
        *keys, "_v", "_n", F.sum("_n").over(upto).alias("_upto"), F.sum("_n").over(whole).alias("_total"), mean.alias("_mean")
    )

    def holds(fraction: float) -> Column:
        rank = _rank(fraction, F.col("_total"))
        return (F.col("_upto") >= rank) & (F.col("_upto") - F.col("_n") < rank)

    cuts = [F.max(F.when(holds(p), F.col("_v"))).alias(n) for n, p in fractions.items()]
    return placed.groupBy(*keys).agg(*[m.alias(c) for c, m in _weighed_moments().items()], *cuts)


def _large_groups(
    values: DataFrame, hot: DataFrame, keys: list[str], fractions: dict[str, float], limit: int
) -> DataFrame:
    """The same for groups with too many values for one task."""
    own = values.join(hot.select(*keys), keys, "left_semi")
    means = own.groupBy(*keys).agg((F.sum(F.col("_v") * F.col("_n")) / F.sum("_n")).alias("_mean"))
    moments = own.join(cut_lineage(means), keys).groupBy(*keys).agg(*[m.alias(c) for c, m in _weighed_moments().items()])
    moments = cut_lineage(moments)
    return moments.join(_large_group_percentiles(own, moments, keys, fractions, limit), keys)


def _large_group_percentiles(
    values: DataFrame, hot: DataFrame, keys: list[str], fractions: dict[str, float], limit: int
) -> DataFrame:
    """Percentiles of groups too big for one task, from their counted values.

    Each wanted rank is followed through histograms: the cell that holds it becomes the
    next interval, until an interval has few rows; only those are ordered. A histogram is
    an aggregation with map-side combine, a step narrows an interval by thousands of
    cells, and the intervals, one per hot group and percentile, are stored between steps.
    """
    wanted = [
        F.struct(F.lit(n).alias("_name"), _rank(p, F.col("count_value")).alias("_rank")) for n, p in fractions.items()
    ]
    sought = hot.select(
        *keys,
        F.col("min_value").alias("_low"),
        F.col("max_value").alias("_high"),
        F.col("count_value").alias("_n"),
        F.inline(F.array(*wanted)),
    )
    span = [*keys, "_low", "_high"]

    def within(intervals: DataFrame) -> DataFrame:
        # A few rows per hot group; their size is known where they were stored.
        return values.join(intervals.select(*span).distinct(), keys).where(F.col("_v").between(F.col("_low"), F.col("_high")))

    def follow(steps: DataFrame, order: str) -> DataFrame:
        upto = Window.partitionBy(*span).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        reached = steps.withColumn("_upto", F.sum("_step_n").over(upto)).join(sought, span)
        before = F.col("_upto") - F.col("_step_n")
        return reached.where((F.col("_upto") >= F.col("_rank")) & (before < F.col("_rank"))).withColumn(
            "_rank", F.col("_rank") - before
        )

    while not sought.where((F.col("_n") > limit) & (F.col("_low") < F.col("_high"))).isEmpty():
        cells = within(sought).groupBy(*span, _cell(F.col("_v"), F.col("_low"), F.col("_high")).alias("_cell")).agg(
            F.sum("_n").alias("_step_n"), F.min("_v").alias("_from"), F.max("_v").alias("_to")
        )
        sought = cut_lineage(
            follow(cells, "_cell").select(
                *keys, F.col("_from").alias("_low"), F.col("_to").alias("_high"), F.col("_step_n").alias("_n"), "_name", "_rank"
            )
        )
    found = within(sought).groupBy(*span, "_v").agg(F.sum("_n").alias("_step_n"))
    return follow(found, "_v").groupBy(*keys).pivot("_name", list(fractions)).agg(F.max("_v"))


def distribution(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    fractions: dict[str, float] = PERCENTILES,
    limit: int | None = None,
    approximate: bool = False,
) -> DataFrame:
    """Count, extremes, mean, deviation and discrete percentiles of ``value`` per group.

    The facts are read once: equal values are counted before the shuffle and stored, the rest comes from there.
    ``approximate`` swaps the exact percentiles for mergeable sketches.
    """
    limit = limit or configured_hot_rows(df.sparkSession)
    # The keys as one struct: groups with NULL in a key join like any other.
    key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("_all"))
    rows = df.select(key.alias("_key"), F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    moments = [m.alias(c) for c, m in _moments(F.col("_v")).items()]
    if approximate:
        sketches = [F.percentile_approx("_v", p, 10_000).alias(n) for n, p in fractions.items()]
        found = rows.groupBy("_key").agg(*moments, *sketches)
    else:
        values = cut_lineage(rows.groupBy("_key", "_v").agg(F.count(F.lit(1)).alias("_n")))
        hot = values.groupBy("_key").agg(F.count(F.lit(1)).alias("_values")).where(F.col("_values") > limit)
        if hot.isEmpty():
            found = _small_groups(values, ["_key"], fractions)
        else:
            hot = cut_lineage(hot)
            others = values.join(hot.select("_key"), "_key", "left_anti")
            found = _small_groups(others, ["_key"], fractions).unionByName(
                _large_groups(values, hot, ["_key"], fractions, limit)
            )
    columns = [F.col(f"_key.{k}").alias(k) for k in keys]
    return found.select(*columns, *_moments(F.col("_v")), *fractions)
