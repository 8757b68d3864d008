"""Queries and items that meet in tiles of bounded size, strips of queries against slabs of items.

Both sides lie in cells around the same centres. Cells that follow each other share a strip or a slab until it is
full, a crowded cell is cut into several. A strip meets the slabs in which one of its queries wants a cell, and
a tile gives a few rows per query, so neither what is sent nor what comes back grows with the number of cells.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.session import local_table, stage

# Queries whose cells are looked up at once, and tasks that share the tiles.
LOOKED_UP, MOST_TASKS = 1024, 10_000


def chained(centres: np.ndarray) -> list[int]:
    """Centres in an order in which each is followed by the nearest that is left."""
    left, order = np.ones(len(centres), dtype=bool), [0]
    left[0] = False
    for _ in range(len(centres) - 1):
        far = ((centres - centres[order[-1]]) ** 2).sum(1)
        order.append(int(np.where(left, far, np.inf).argmin()))
        left[order[-1]] = False
    return order


def dealt(sizes: dict[int, int], order: list[int], most: int) -> list[tuple[int, int, int]]:
    """``cell, first group, groups``: groups of about ``most`` rows; small cells share one, large ones get several."""
    found, group, held = [], 0, 0
    for cell in order:
        n = sizes.get(cell, 0)
        if held and held + n > most:
            group, held = group + 1, 0
        parts = -(-n // most) or 1
        found.append((cell, group, parts))
        group, held = (group + parts, 0) if parts > 1 else (group, held + n)
    return found


def _grouped(rows: DataFrame, size: Column, key: str, order: list[int], most: int, name: str) -> tuple[DataFrame, list]:
    sizes = {r["cell"]: r["n"] for r in rows.groupBy("cell").agg(F.sum(size).alias("n")).collect()}
    groups = dealt(sizes, order, most)
    table = local_table(rows.sparkSession, groups, "cell int, _first int, _parts int")
    own = (F.col("_first") + F.pmod(F.xxhash64(key), F.col("_parts"))).cast("int")
    return rows.join(F.broadcast(table), "cell").withColumn(name, own).drop("_first", "_parts"), groups


def tiles(
    queries: DataFrame,
    items: DataFrame,
    order: list[int],
    most: tuple[int, int],
    wanted: Callable[[pa.Array], np.ndarray],
    visit: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str,
    size: Column | None = None,
    key: str = "id",
) -> DataFrame:
    """What ``visit`` gives for each tile of the stored ``queries`` (``cell, id, vector``) and ``items`` (``cell`` and more).

    ``wanted`` tells the cells that each of some vectors needs; ``size`` is how many items a row of ``items`` holds.
    """
    size = F.lit(1) if size is None else size
    asked, _ = _grouped(queries, F.lit(1), "id", order, most[0], "strip")
    held, slabs = _grouped(items, size, key, order, most[1], "slab")
    last = max(first + parts for _, first, parts in slabs)

    def needs(batches):
        told = np.zeros((len(slabs), last), dtype=bool)
        for cell, first, parts in slabs:
            told[cell, first : first + parts] = True
        for batch in batches:
            strip, found = batch.column("strip").to_numpy(), set()
            for at in range(0, batch.num_rows, LOOKED_UP):
                cells = wanted(batch.column("vector").slice(at, LOOKED_UP))
                own = strip[at : at + LOOKED_UP]
                for s in np.unique(own).tolist():
                    found |= {(s, int(b)) for b in np.nonzero(told[cells[own == s].any(0)].any(0))[0]}
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int32()) for x in zip(*sorted(found))], ["strip", "slab"])

    pairs = stage(asked.select("strip", "vector").mapInArrow(needs, "strip int, slab int").distinct())
    tasks = max(1, min(MOST_TASKS, pairs.count()))
    left = asked.drop("cell").join(F.broadcast(pairs), "strip").repartition(tasks, "strip", "slab")
    right = held.join(F.broadcast(pairs), "slab").repartition(tasks, "strip", "slab")
    return left.groupBy("strip", "slab").cogroup(right.groupBy("strip", "slab")).applyInArrow(visit, schema)
