"""Helpers of the corpus operators: words, free column names, exact places in a total order."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import Any

import numpy as np
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataflow.session import stage

# ASCII white space: what bytes.split() splits on, and the complement of a word.
SPACES = r"[\x20\x09-\x0D]+"
# Place of a row in the written table: partition above, row within it below.
ROW_BITS = 33
BLOCK_BYTES = 1 << 20


def words(text: Column) -> Column:
    """Words of a text in order; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of the table has."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def ordered_stage(df: DataFrame, order: Sequence[Column | str], place: str) -> DataFrame:
    """The rows written in the given total order, with their place in it.

    Rows are dealt out by ranges of the order. Equal rows are told apart by their place in
    the input, so that a crowd of repeats is cut as well. ``place`` grows with the order:
    its upper bits number the ranges, the lower 33 bits the rows of a range.
    """
    (tie,) = fresh(df, "tie")
    keys = [*order, F.col(tie)]
    ranged = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*keys)
    ranged = ranged.sortWithinPartitions(*keys).drop(tie)
    return stage(ranged.withColumn(place, F.monotonically_increasing_id()))


def unit_starts(placed: DataFrame, group: str, place: str, total: Column, names: Sequence[str]) -> DataFrame:
    """For each group and range: the first place, and the total of the group in earlier ranges.

    A row for each range and group that meet, so at most ranges + groups rows.
    """
    unit, first, start = names
    units = placed.groupBy(group, F.shiftright(place, ROW_BITS).alias(unit)).agg(
        F.min(place).alias(first), total.alias(start)
    )
    before = Window.partitionBy(group).orderBy(unit).rowsBetween(Window.unboundedPreceding, -1)
    # Written, so that its size is known where the rows are joined to it: they need no shuffle.
    return stage(units.withColumn(start, F.coalesce(F.sum(start).over(before), F.lit(0).cast("long"))))


def join_units(placed: DataFrame, units: DataFrame, group: str, place: str, unit: str) -> DataFrame:
    """Rows beside the figures of their group and range; null is a group of its own."""
    (other,) = fresh(placed, f"{group}_of_unit")
    units = units.withColumnRenamed(group, other)
    here = placed.withColumn(unit, F.shiftright(place, ROW_BITS))
    on = F.col(group).eqNullSafe(F.col(other)) & (here[unit] == units[unit])
    return here.join(units, on).drop(units[unit]).drop(other)


def word_pieces(data: bytes, block: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """Words of a text in order, in lists of bounded size; a word is never cut."""
    rest = b""
    for at in range(0, len(data), block):
        piece = rest + data[at : at + block]
        found, rest = piece.split(), b""
        if found and at + block < len(data) and not piece[-1:].isspace():
            rest = found.pop()
        if found:
            yield found
    if rest:
        yield [rest]


def shipped(spark: SparkSession, value: Any) -> Broadcast:
    """A value of bounded size for all tasks; its classes travel with it."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def unpacked(sent: Broadcast) -> Any:
    return cloudpickle.loads(sent.value)


class Best:
    """The k best rows of each query of a block so far, best first; equal scores by id, unknown ids last."""

    NONE = -(1 << 62)

    def __init__(self, n: int, k: int):
        self.scores = np.full((n, k), self.NONE)
        self.ids = np.zeros((n, k), dtype=np.int64)
        self.known = np.zeros((n, k), dtype=bool)

    def there(self) -> np.ndarray:
        return self.scores != self.NONE

    def least(self, query: int) -> float:
        """The k-th best score."""
        last = self.scores[query, -1]
        return -np.inf if last == self.NONE else float(last)

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        k = self.scores.shape[1]
        scores = np.append(self.scores[query], scores)
        ids, known = np.append(self.ids[query], ids), np.append(self.known[query], known)
        first = np.lexsort((ids, ~known, -scores))[:k]
        self.scores[query], self.ids[query], self.known[query] = scores[first], ids[first], known[first]


def passes(blocks: DataFrame, number: str, size: Column, most: int) -> Iterator[list[int]]:
    """Numbers of the blocks of each pass, a block beyond ``most`` bytes at most; read one after another."""
    held, numbers = 0, []
    for row in blocks.select(F.col(number).alias("number"), size.alias("size")).toLocalIterator():
        numbers.append(row["number"])
        held += row["size"]
        if held >= most:
            yield numbers
            held, numbers = 0, []
    if numbers:
        yield numbers


@contextmanager
def rows_per_batch(spark: SparkSession, most: int) -> Iterator[None]:
    """Jobs started meanwhile send at most so many rows at once to Python: for rows that are large blocks."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)
