"""Most similar items by cosine, exact, and the staged retrieval built on them.

This is the exact form, for sets of items that may be compared with all others in blocks. The
bound skips cells where vectors form groups; on vectors without groups it skips nothing, and the
work grows with queries times items.

Items and queries are placed in cells around a bounded set of pivots. For a query, the distances to
the pivots, the radius and the size of each cell give a bound on the distance of its k-th
neighbour; cells that lie wholly beyond it are skipped. The others are met in tiles, a strip of queries
against a slab of items; in a tile, small matrix products in single precision tell the few pairs that are compared in
double precision, and k items per query are kept, so what a query sends on grows with the slabs and not with the cells.
Equal vectors are searched once, so a large group of copies costs what one item costs. Null vectors have no neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.operators.grid import chained, tiles
from strataflow.session import cut_lineage, local_table, stage

MOST_PIVOTS = 1024
# Items of one product; a strip has four times as many queries, a slab sixteen times as many items.
BLOCK_ROWS = 4096
QUERY_ROWS = 1024
# Pairs that are compared in double precision at once, and pairs for each wanted one that are held at most.
PAIRS, CROWD = 1 << 15, 4
SLACK = 1e-6
# Decimals that are compared, so that copies tie exactly wherever they are multiplied.
DIGITS = 12

FOUND = pa.schema([("query_id", pa.int64()), ("item_id", pa.int64()), ("similarity", pa.float64())])


def _matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    if not len(vectors):
        return np.zeros((0, 1))
    matrix = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(norms == 0, 1.0, norms)


def _distances(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * unit @ pivots.T, 0.0))


def _place(pivots: np.ndarray):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                far = _distances(_matrix(batch.column("vector")), pivots)
                cell = far.argmin(axis=1)
                columns = [pa.array(cell.astype(np.int32)), *batch.columns, pa.array(far[np.arange(len(far)), cell])]
                yield pa.RecordBatch.from_arrays(columns, ["cell", *batch.schema.names, "far"])

    return place


def _wanted(pivots: np.ndarray, radius: np.ndarray, size: np.ndarray, k: int):
    """Cells that can hold one of the k nearest items of each query."""

    def wanted(vectors: pa.Array) -> np.ndarray:
        far = _distances(_matrix(vectors), pivots)
        reach = far + radius
        order = np.argsort(reach, axis=1)
        held = np.cumsum(size[order], axis=1)
        enough = np.minimum((held < k).sum(axis=1), len(size) - 1)
        bound = np.take_along_axis(reach, order, axis=1)[np.arange(len(far)), enough]
        # Not farther: a vector that is no number wants all cells.
        return ~(far - radius > bound[:, None] + SLACK) & (size > 0)

    return wanted


def _exact(rows: np.ndarray, items: np.ndarray, row: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Similarity of each pair, -2 where one of the vectors is no number."""
    parts = [
        np.einsum("nd,nd->n", rows[row[at : at + PAIRS]], items[place[at : at + PAIRS]])
        for at in range(0, len(row), PAIRS)
    ]
    value = np.round(np.concatenate(parts), DIGITS) if parts else np.zeros(0)
    return np.where(np.isfinite(value), value, -2.0)


def _best(rows: np.ndarray, items: np.ndarray, small: np.ndarray, ids: np.ndarray, k: int, block: int):
    """Row, place and similarity of the k most similar items of each row, the lower id first; what is no number comes last.

    ``small`` has the items in single precision. Products in single precision pass over what is too far from being among
    the k best, by more than their error; the others are compared in double precision.
    """
    row, place, near = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
    edge = np.full(len(rows), -np.inf)
    # Twice what a product of unit vectors in single precision may be off, and what may tie once it is rounded.
    slack = 2 * (rows.shape[1] + 4) * float(np.finfo(np.float32).eps) + 10.0 ** (1 - DIGITS)
    asked = rows.astype(np.float32)
    odd_rows, odd = (~np.isfinite(m).all(axis=1) for m in (asked, small))
    any_odd = odd_rows.any() or odd.any()
    room = np.empty(len(rows) * min(block, len(items)), dtype=np.float32)

    def kept(value: np.ndarray, rank: np.ndarray, own: np.ndarray, limit: float) -> None:
        full = rank == k - 1
        edge[own[full]] = np.maximum(edge[own[full]], value[full] - limit)

    for start in range(0, len(items), block):
        part = small[start : start + block]
        likeness = np.matmul(asked, part.T, out=room[: len(rows) * len(part)].reshape(len(rows), -1))
        if any_odd:
            likeness[odd_rows] = likeness[:, odd[start : start + block]] = -2.0
        first = likeness[:, : max(k, block // 4)]
        if first.shape[1] >= k and np.isinf(edge).any():
            edge = np.maximum(edge, np.partition(first, -k, axis=1)[:, -k] - slack)
        r, c = np.divmod(np.flatnonzero(likeness >= edge.astype(np.float32)[:, None]), len(part))
        row, place, near = np.concatenate([row, r]), np.concatenate([place, start + c]), np.concatenate([near, likeness[r, c]])
        # Rows apart, in a row the nearest first.
        order = np.argsort(8.0 * row - near)
        row, place, near = row[order], place[order], near[order]
        kept(near, np.arange(len(row)) - np.searchsorted(row, row), row, slack)
        there = near >= edge[row]
        row, place, near = row[there], place[there], near[there]
        if len(row) > CROWD * k * len(rows) or start + block >= len(items):
            # A crowd of like items, or the end.
            near = _exact(rows, items, row, place)
            order = np.lexsort((ids[place], -near, row))
            row, place, near = row[order], place[order], near[order]
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            kept(near, rank, row, slack)
            row, place, near = (x[rank < k] for x in (row, place, near))
    return row, place, np.where(near == -2.0, np.nan, near)


def _nearest(k: int, block: int, wanted):
    def nearest(queries: pa.Table, items: pa.Table) -> pa.Table:
        parts = [FOUND.empty_table()]
        if queries.num_rows and items.num_rows:
            rows, unit = _matrix(queries.column("vector")), _matrix(items.column("vector"))
            small = unit.astype(np.float32)
            own, ids, cell = (c.to_numpy() for c in (queries.column("id"), items.column("id"), items.column("cell")))
            vectors = queries.column("vector").combine_chunks()
            for at in range(0, len(rows), QUERY_ROWS):
                there = np.nonzero(wanted(vectors.slice(at, QUERY_ROWS)).any(axis=0)[cell])[0]
                there = slice(None) if len(there) == len(ids) else there
                met = ids[there]
                row, place, value = _best(rows[at : at + QUERY_ROWS], unit[there], small[there], met, k, block)
                parts.append(pa.table([own[at + row], met[place], value], schema=FOUND))
        return pa.concat_tables(parts)

    return nearest


def top_neighbours(
    queries: DataFrame, items: DataFrame, k: int, vector: str = "vector", block: int = BLOCK_ROWS
) -> DataFrame:
    """The ``k`` most similar other items of each query as ``(query_id, item_id, similarity, place)``.

    Both sides need ``id`` and the vector column; ties go to the lower id. Copies are
    searched once: equal queries share their result, and of equal items only the k + 1
    with the lowest ids can be in anybody's list.
    """
    items, queries = (
        d.select(F.col("id").cast("long").alias("id"), F.col(vector).alias("vector")).where("id IS NOT NULL AND vector IS NOT NULL")
        for d in (items, queries)
    )
    copy = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    few = cut_lineage(items.withColumn("_copy", copy).where(F.col("_copy") <= k + 1).drop("_copy"))
    asked = cut_lineage(queries.groupBy("vector").agg(F.min("id").alias("id")).select("id", "vector"))

    found = _search(asked, few, k + 1, block)
    near = F.sort_array(F.collect_list(F.struct((-F.col("similarity")).alias("less"), "item_id")))
    listed = found.groupBy("query_id").agg(F.slice(near, 1, k + 1).alias("_near")).withColumnRenamed("query_id", "id")
    shared = asked.join(listed, "id").select("vector", "_near")
    others = F.slice(F.filter("_near", lambda n: n["item_id"] != F.col("id")), 1, k)
    return queries.join(shared, "vector").select(F.col("id").alias("query_id"), F.posexplode(others)).select(
        "query_id",
        F.col("col.item_id").alias("item_id"),
        (-F.col("col.less")).alias("similarity"),
        (F.col("pos") + 1).alias("place"),
    )


def _search(queries: DataFrame, items: DataFrame, k: int, block: int) -> DataFrame:
    """The ``k`` nearest items of each query, which may be among them, from each slab of items."""
    total = items.count()
    schema = "query_id long, item_id long, similarity double"
    if not total:
        return items.sparkSession.createDataFrame([], schema)
    pivots = 1 if total <= block else min(MOST_PIVOTS, int(total**0.5))
    centres = _matrix(items.orderBy(F.xxhash64("id"), "id").limit(pivots).select("vector").toArrow().column("vector"))
    # A pivot that is no number would be nearest to everything.
    centres = np.nan_to_num(centres, nan=0.0, posinf=0.0, neginf=0.0)
    ddl = f"cell int, {items.schema.simpleString()[7:-1]}, far double"
    placed = stage(items.mapInArrow(_place(centres), ddl))
    asked = stage(queries.mapInArrow(_place(centres), f"cell int, {queries.schema.simpleString()[7:-1]}, far double").drop("far"))
    radius, size = np.zeros(len(centres)), np.zeros(len(centres), dtype=np.int64)
    for c in placed.groupBy("cell").agg(F.max("far").alias("radius"), F.count(F.lit(1)).alias("n")).collect():
        radius[c.cell], size[c.cell] = c.radius, c.n
    wanted = _wanted(centres, radius, size, k)
    return tiles(
        asked, placed.drop("far"), chained(centres), (4 * block, 16 * block), wanted, _nearest(k, block, wanted), schema
    )


def similar_funnel(
    items: DataFrame, base: Column, stages: Sequence[tuple[int, Sequence[Column]]], vector: str = "vector"
) -> DataFrame:
    """Staged retrieval: from a base set to the neighbours of what each stage keeps.

    ``stages`` lists how many neighbours to fetch and the filters applied to the result, in
    order. Returns ``(stage, step, items)`` with the retrieved and the kept items of every stage.
    """
    spark = items.sparkSession
    kept = items.where(base)
    counts = [(0, "retrieved", kept.count())]
    for number, (k, filters) in enumerate(stages, 1):
        near = top_neighbours(kept, items, k, vector)
        found = near.select(F.col("item_id").alias("id")).distinct()
        kept = cut_lineage(items.join(found, "id", "left_semi"))
        counts.append((number, "retrieved", kept.count()))
        for place, condition in enumerate(filters, 1):
            kept = kept.where(condition)
            counts.append((number, f"filter_{place}", kept.count()))
    return local_table(spark, counts, "stage int, step string, items long")
