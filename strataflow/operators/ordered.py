"""Ordered scans per key (lag, running totals, carry-down, offsets) that survive a hot key.

A plain window sorts all rows of a key in one task. When some keys have more than
``limit`` rows, their rows are dealt out by ranges of (key, order) and written; ties of the order are
cut like any rows. Each range is scanned on its own, and the state at its start comes from a
summary with one row per range. Without hot keys the scan is an ordinary window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.operators.skew import hot_groups
from strataflow.session import hot_rows as configured_hot_rows
from strataflow.session import stage

RANGE, PLACE = "_range", "_place"
SEARCH = "search"
# Places of written rows: the range above, the row within it below.
ROW_BITS = 33


def in_ranges(df: DataFrame, order: Sequence[str], ranges: int) -> DataFrame:
    """Rows in ranges of the order, with the number of the range and a place that follows the order.

    Rows that are equal in the order are told apart by their place in the input.
    """
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    sorted_rows = tied.repartitionByRange(ranges, *order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    placed = stage(sorted_rows.withColumn(PLACE, F.monotonically_increasing_id()))
    return placed.withColumn(RANGE, F.shiftright(PLACE, ROW_BITS))


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    columns: dict[str, str],
    ties: Sequence[str] = (),
    limit: int | None = None,
    hot: DataFrame | None | str = SEARCH,
) -> DataFrame:
    """Add the value of the preceding row of the key; ``columns`` maps new name to source column.

    ``position`` is an integer column that leads the order, ``ties`` follow it.
    """
    steps = {name: ("previous", F.col(source)) for name, source in columns.items()}
    return with_running(df, keys, position, steps, ties, limit, hot=hot)


def hot_keys(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> DataFrame | None:
    """Keys with more rows than one task should order, for several scans over the same keys."""
    keyed = df.select(_key_of(keys).alias("_key"))
    return hot_groups(keyed, ["_key"], {}, limit or configured_hot_rows(df.sparkSession))


def _key_of(keys: Sequence[str]) -> Column:
    return F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))


def with_running(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    columns: dict[str, tuple[str, Column]],
    ties: Sequence[str] = (),
    limit: int | None = None,
    hot: DataFrame | None | str = SEARCH,
) -> DataFrame:
    """Add running values up to the current row: ``{name: (kind, column)}``.

    Kinds: ``sum``, ``max``, ``last`` (latest value that is not NULL) and ``previous``
    (value of the row before, NULL or not). ``hot`` is what :func:`hot_keys` found for these
    keys, or for the first of them with none hot; by default it is looked for here.
    """
    limit = limit or configured_hot_rows(df.sparkSession)
    names = df.columns
    hot = hot_keys(df, keys, limit) if isinstance(hot, str) else hot
    df = df.withColumn("_key", _key_of(keys))
    order = [position, *ties]
    if hot is None:
        values = _local_values(Window.partitionBy("_key").orderBy(*order), columns)
        return df.withColumns({n: _unwrap(columns[n][0], v) for n, v in values.items()}).drop("_key")

    # The columns are taken before the split, as their texts may not know the columns added here.
    df = df.withColumns({f"_in_{name}": column for name, (_, column) in columns.items()})
    inputs = {name: (kind, F.col(f"_in_{name}")) for name, (kind, _) in columns.items()}
    cold = df.join(hot.select("_key"), "_key", "left_anti")
    plain = _local_values(Window.partitionBy("_key").orderBy(*order), inputs)
    cold = cold.withColumns({n: _unwrap(inputs[n][0], v) for n, v in plain.items()}).select(*names, *columns)

    ranges = -(-hot.agg(F.sum("group_rows")).first()[0] // limit)
    rows = in_ranges(df.join(hot.select("_key"), "_key", "left_semi"), ["_key", *order], ranges)
    # One row per range and key: both are bounded by rows / limit.
    ends = rows.groupBy("_key", RANGE).agg(*_range_ends(inputs, [PLACE]))
    rows = rows.join(ends.select("_key", RANGE, *_carries(inputs, ["_key"])), ["_key", RANGE])
    local = _local_values(Window.partitionBy("_key", RANGE).orderBy(PLACE), inputs)
    rows = rows.withColumns({n: _combined(inputs[n][0], value, F.col(f"_carry_{n}")) for n, value in local.items()})
    return cold.unionByName(rows.select(*names, *columns))


def _local_values(window, columns: dict[str, tuple[str, Column]]) -> dict[str, Column]:
    so_far = window.rowsBetween(Window.unboundedPreceding, 0)
    values = {}
    for name, (kind, column) in columns.items():
        if kind == "sum":
            values[name] = F.coalesce(F.sum(column).over(so_far), F.lit(0))
        elif kind == "max":
            values[name] = F.max(column).over(so_far)
        elif kind == "last":
            values[name] = F.last(column, ignorenulls=True).over(so_far)
        elif kind == "previous":
            values[name] = F.lag(F.struct(column.alias("value"))).over(window)
        else:
            raise ValueError(f"unknown running kind: {kind}")
    return values


def _unwrap(kind: str, value: Column) -> Column:
    return value.getField("value") if kind == "previous" else value


def _range_ends(columns: dict[str, tuple[str, Column]], order: list[str]) -> list[Column]:
    ends = []
    for name, (kind, column) in columns.items():
        if kind == "sum":
            end = F.sum(column)
        elif kind == "max":
            end = F.max(column)
        elif kind == "last":
            end = F.max_by(column, F.when(column.isNotNull(), F.struct(*order)))
        else:
            end = F.max_by(F.struct(column.alias("value")), F.struct(*order))
        ends.append(end.alias(f"_end_{name}"))
    return ends


def _carries(columns: dict[str, tuple[str, Column]], keys: list[str]) -> list[Column]:
    by_range = Window.partitionBy(*keys).orderBy(RANGE)
    earlier = by_range.rowsBetween(Window.unboundedPreceding, -1)
    carries = []
    for name, (kind, _) in columns.items():
        end = F.col(f"_end_{name}")
        if kind == "sum":
            carry = F.coalesce(F.sum(end).over(earlier), F.lit(0))
        elif kind == "max":
            carry = F.max(end).over(earlier)
        elif kind == "last":
            carry = F.last(end, ignorenulls=True).over(earlier)
        else:
            carry = F.lag(end).over(by_range)
        carries.append(carry.alias(f"_carry_{name}"))
    return carries


def _combined(kind: str, local: Column, carry: Column) -> Column:
    if kind == "sum":
        return local + F.coalesce(carry, F.lit(0))
    if kind == "max":
        return F.greatest(local, carry)
    return _unwrap(kind, F.coalesce(local, carry))


def with_offset(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    name: str = "offset",
    ties: Sequence[str] = (),
    limit: int | None = None,
) -> DataFrame:
    """Add the zero-based place of each row within its key."""
    counted = with_running(df, keys, position, {name: ("sum", F.lit(1).cast("long"))}, ties, limit)
    return counted.withColumn(name, F.col(name) - 1)
