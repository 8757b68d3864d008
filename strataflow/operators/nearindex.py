"""Approximate neighbours by cosine: coarse cells, residual codes, exact order of the few that remain.

Unit vectors are placed in the nearest of about sqrt(items) cells; what is left of them is coded part by part with
a codebook. A query opens a few cells, estimates the distance of every item in them from its codes, and
the best estimates are compared exactly. Cells and codebooks are fitted on a sample of bounded size, taken by a
hash of the id; how many cells a query opens, and how many estimates it keeps, are the smallest numbers that reach
the wanted recall on that sample. Every item is indexed. A cell is stored in blocks that hold codes and vectors;
strips of queries meet slabs of blocks with a cell that one of them opens, and there the items of a cell meet the queries
that open it. The best estimates of a slab are compared there and then, so that only the k best of each slab leave it,
and no vector travels for each pair.

Where vectors form groups, a query opens a number of cells that does not grow, and its work grows with the square root
of the items. Vectors without groups make it open a share of all cells; then codes save only on each comparison.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflow.operators.grid import chained, tiles
from strataflow.session import stage

SAMPLE, MOST_CELLS, ENTRIES, PART_DIMS = 32_768, 2048, 256, 4
ITEM_ROWS, QUERY_ROWS, SALTS = 4096, 512, 16
# Queries of a strip, items of a slab, and pairs that are compared exactly at once.
STRIP_ROWS, SLAB_ROWS, PAIRS = 16_384, 32_768, 1 << 16
WANTED_RECALL, TRIED_QUERIES = 0.975, 256
# Every so many items one is looked at to tell which estimates of a query may be among the best.
STEP = 16
# Items of a cell that queries meet at once, and estimates that a block of queries holds at most.
CELL_ROWS, CROWD = 2048, 1 << 20

ITEM_BLOCK = "cell int, ids array<long>, codes binary, vectors binary"
FOUND = pa.schema([("query_id", pa.int64()), ("item_id", pa.int64()), ("similarity", pa.float64())])


def _rows(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def _units(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norms == 0, 1, norms)


def unit_rows(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return _units(_rows(vectors).astype(np.float32))


def _squares(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (rows**2).sum(1)[:, None] - 2 * rows @ centres.T + (centres**2).sum(1)[None, :]


def _means(rows: np.ndarray, n: int, rounds: int = 8) -> np.ndarray:
    """Centres by Lloyd's rounds from the first rows; a centre without rows stays."""
    centres = rows[:n].copy()
    for _ in range(rounds):
        own = _squares(rows, centres).argmin(1)
        counts = np.bincount(own, minlength=n)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, rows)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


@dataclass(frozen=True)
class Codes:
    """Cells, and a codebook for each part of what is left of a vector."""

    cells: np.ndarray
    books: list[np.ndarray]

    def encode(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cell = _squares(rows, self.cells).argmin(1)
        rest = rows - self.cells[cell]
        parts = np.split(rest, np.cumsum([b.shape[1] for b in self.books])[:-1], axis=1)
        return cell, np.stack([_squares(p, b).argmin(1) for p, b in zip(parts, self.books)], axis=1).astype(np.uint8)

    def decoded(self, cell: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """What the codes of items in their cells stand for."""
        return self.cells[cell] + np.concatenate([b[codes[:, i]] for i, b in enumerate(self.books)], axis=1)

    def opened(self, queries: np.ndarray, probes: int) -> np.ndarray:
        """Whether each query opens each cell."""
        probes = min(probes, len(self.cells))
        found = np.zeros((len(queries), len(self.cells)), dtype=bool)
        np.put_along_axis(found, np.argpartition(_squares(queries, self.cells), probes - 1, axis=1)[:, :probes], True, axis=1)
        return found


def fit_codes(sample: np.ndarray, cells: int) -> Codes:
    cells = max(1, min(cells, len(sample) // 4 or 1))
    centres = _means(sample, cells)
    rest = sample - centres[_squares(sample, centres).argmin(1)]
    parts = np.array_split(rest, -(-sample.shape[1] // PART_DIMS), axis=1)
    return Codes(centres, [_means(p, min(ENTRIES, len(p))) for p in parts])


def tuned(codes: Codes, sample: np.ndarray, k: int, wanted: float = WANTED_RECALL) -> tuple[int, int]:
    """Cells to open and estimates to keep, the fewest that reach the recall on the sample."""
    queries = sample[:TRIED_QUERIES]
    k = min(k, len(sample))
    best = np.argsort(-(queries @ sample.T), axis=1, kind="stable")[:, :k]
    cell, coded = codes.encode(sample)
    estimated = _squares(queries, codes.decoded(cell, coded))
    order = np.argsort(_squares(queries, codes.cells), axis=1)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(order.shape[1])[None, :], axis=1)
    far = rank[:, cell]  # how many cells a query opens before it comes to an item's

    def least(recall, most: int, start: int) -> int:
        n = start
        while n < most and recall(n) < wanted:
            n = min(most, n + max(1, n // 4))
        return n

    probes = least(lambda p: (np.take_along_axis(far, best, 1) < p).mean(), len(codes.cells), 1)
    place = np.argsort(np.argsort(estimated, axis=1), axis=1)
    kept = least(lambda r: (np.take_along_axis(place, best, 1) < r).mean(), len(sample), 2 * k)
    return probes, kept


@dataclass(frozen=True)
class NearIndex:
    codes: Codes
    blocks: DataFrame
    kind: np.dtype
    probes: int
    kept: int
    k: int


def _packed(rows: DataFrame, most: int) -> DataFrame:
    """Rows (cell, id, code, vector) as blocks of one cell each; a large cell has blocks in several tasks."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids, codes, vectors = None, [], [], []

        def block() -> pa.RecordBatch:
            columns = [pa.array([held], pa.int32()), pa.array([ids], pa.list_(pa.int64()))]
            columns += [pa.array([b"".join(parts)], pa.binary()) for parts in (codes, vectors)]
            return pa.RecordBatch.from_arrays(columns, ["cell", "ids", "codes", "vectors"])

        for batch in batches:
            for cell, key, code, vector in zip(*(batch.column(c).to_pylist() for c in ("cell", "id", "code", "vector"))):
                if ids and (cell != held or len(ids) == most):
                    yield block()
                    ids, codes, vectors = [], [], []
                held = cell
                ids.append(key)
                codes.append(code)
                vectors.append(vector)
        if ids:
            yield block()

    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS))
    return rows.repartition("cell", salt).sortWithinPartitions("cell").mapInArrow(pack, ITEM_BLOCK)


def build_index(items: DataFrame, k: int, vector: str = "vector", wanted: float = WANTED_RECALL) -> NearIndex:
    """Index of ``id`` and vector; vectors have one length, null ones are left out."""
    rows = items.select(F.col("id").cast("long").alias("id"), F.col(vector).alias("vector")).where("vector IS NOT NULL AND id IS NOT NULL")
    total = rows.count()
    sample = unit_rows(rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").toArrow().column("vector")) if total else np.zeros((1, 1), np.float32)
    codes = fit_codes(sample, min(MOST_CELLS, int(total**0.5) or 1))
    probes, kept = tuned(codes, sample, k + 1, wanted)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                plain = _rows(batch.column("vector"))
                cell, coded = codes.encode(_units(plain.astype(np.float32)))
                parts = [pa.array([r.tobytes() for r in rows], pa.binary()) for rows in (coded, plain)]
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), batch.column("id"), *parts], ["cell", "id", "code", "vector"])

    coded = rows.mapInArrow(encode, "cell int, id long, code binary, vector binary")
    kind = np.dtype(np.float32 if "float" in rows.schema["vector"].dataType.simpleString() else np.float64)
    return NearIndex(codes, stage(_packed(coded, ITEM_ROWS)), kind, probes, kept, k)


def _nearest_estimates(
    asked: np.ndarray, told: np.ndarray, opened: np.ndarray, cell: np.ndarray, key: np.ndarray, ids: np.ndarray, n: int
) -> tuple[np.ndarray, np.ndarray]:
    """For each query the places of the n other items in the cells it opens that score highest, and which of them are there.

    Items lie by cell; only queries that open a cell meet its items. A score is a product of ``asked`` and ``told``.
    """
    edge = np.full(len(asked), -np.inf, dtype=np.float32)
    rank = 3 * n // (2 * STEP) + 8
    if len(told) >= 2 * STEP * rank:
        some = np.where(opened[:, cell[::STEP]], asked @ told[::STEP].T, np.float32(-np.inf))
        edge = np.partition(some, -rank, axis=1)[:, -rank]
    sampled = edge != -np.inf

    def held(parts: list) -> list[np.ndarray]:
        return [np.concatenate(x) for x in zip((np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.float32)), *parts)]

    found, size = [], 0
    ends = np.append(np.nonzero(np.diff(cell))[0] + 1, len(cell))
    for first, last in zip(np.append(0, ends[:-1]).tolist(), ends.tolist()):
        own = np.nonzero(opened[:, cell[first]])[0].astype(np.int32)
        for start in range(first, last if len(own) else first, CELL_ROWS):
            score = asked[own] @ told[start : min(last, start + CELL_ROWS)].T
            row, place = np.divmod(np.flatnonzero(score >= edge[own, None]).astype(np.int32), score.shape[1])
            value, row, place = score[row, place], own[row], place + np.int32(start)
            others = key[row] != ids[place]
            found.append((row[others], place[others], value[others]))
            size += len(row)
            if size > CROWD:  # many like items: the n best so far
                row, place, value = held(found)
                order = np.lexsort((-value, row))
                row, place, value = row[order], place[order], value[order]
                at = np.arange(len(row)) - np.searchsorted(row, row)
                edge[row[at == n - 1]] = value[at == n - 1]
                found = [(row[at < n], place[at < n], value[at < n])]
                size = int((at < n).sum())
    row, place, value = held(found)
    # The few that the sample told too little of are looked at whole.
    short = np.nonzero((np.bincount(row, minlength=len(asked)) < n) & sampled)[0]
    if len(short):
        score = np.where(opened[short][:, cell] & (key[short][:, None] != ids[None, :]), asked[short] @ told.T, np.float32(-np.inf))
        least = np.fmax(np.partition(score, -n, axis=1)[:, -n], np.finfo(np.float32).min)
        rest, (again, where) = ~np.isin(row, short), np.nonzero(score >= least[:, None])
        row, place = np.concatenate([row[rest], short[again]]), np.concatenate([place[rest], where])
        value = np.concatenate([value[rest], score[again, where]])
    order = np.argsort(row.astype(np.int16), kind="stable")
    row, place, value = row[order], place[order], value[order]
    counts = np.bincount(row, minlength=len(asked))
    at = np.arange(len(row)) - (np.cumsum(counts) - counts)[row]
    shape = len(asked), max(1, int(counts.max(initial=0)))
    places, values = np.zeros(shape, dtype=np.int32), np.full(shape, -np.inf, dtype=np.float32)
    places[row, at], values[row, at] = place, value
    n = min(n, shape[1])
    best = np.argpartition(values, -n, axis=1)[:, -n:]
    return np.take_along_axis(places, best, 1), np.isfinite(np.take_along_axis(values, best, 1))


def near_neighbours(queries: DataFrame, index: NearIndex, vector: str = "vector") -> DataFrame:
    """``query_id, item_id, similarity, place``: up to k other items of each query, nearly the most similar."""
    if index.blocks.isEmpty():
        return queries.sparkSession.createDataFrame([], "query_id long, item_id long, similarity double, place int")
    codes, probes, kept, k, kind = index.codes, index.probes, index.kept, index.k, index.kind
    asked = queries.select(F.col("id").cast("long").alias("id"), F.col(vector).alias("vector")).where("vector IS NOT NULL AND id IS NOT NULL")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = _squares(unit_rows(batch.column("vector")), codes.cells).argmin(1)
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), *batch.columns], ["cell", *batch.schema.names])

    def scan(asked: pa.Table, held: pa.Table) -> pa.Table:
        parts = [FOUND.empty_table()]
        if not asked.num_rows or not held.num_rows:
            return parts[0]
        own, plain = asked.column("id").to_numpy(), _rows(asked.column("vector"))
        blocks = held.select(["cell", "ids", "codes", "vectors"]).to_pylist()
        ids = np.concatenate([b["ids"] for b in blocks])
        cell = np.repeat([b["cell"] for b in blocks], [len(b["ids"]) for b in blocks])
        coded = np.frombuffer(b"".join(b["codes"] for b in blocks), dtype=np.uint8).reshape(len(ids), -1)
        exact = _units(np.frombuffer(b"".join(b["vectors"] for b in blocks), dtype=kind).reshape(len(ids), -1).astype(np.float64))
        by_cell = np.argsort(cell, kind="stable")
        ids, cell, exact = ids[by_cell], cell[by_cell], exact[by_cell]
        told = codes.decoded(cell, coded[by_cell])
        # A product with a query is then its square less the square of the distance.
        told = np.column_stack([2 * told, -(told**2).sum(1)]).astype(np.float32)
        # Queries of one cell open the same cells.
        order = np.argsort(_squares(unit_rows(asked.column("vector")), codes.cells).argmin(1), kind="stable")
        own, plain = own[order], plain[order]
        for at in range(0, len(own), QUERY_ROWS):
            rows, key = _units(plain[at : at + QUERY_ROWS].astype(np.float64)), own[at : at + QUERY_ROWS]
            small = _units(plain[at : at + QUERY_ROWS].astype(np.float32))
            opened = codes.opened(small, probes)
            if not opened.any(axis=0)[cell].any():
                continue
            small = np.column_stack([small, np.ones(len(small), np.float32)])
            near, able = _nearest_estimates(small, told, opened, cell, key, ids, kept)
            step = max(1, PAIRS // near.shape[1])
            for i in range(0, len(rows), step):
                part = near[i : i + step]
                likeness = np.where(able[i : i + step], np.einsum("qd,qnd->qn", rows[i : i + step], exact[part]), -np.inf)
                last = min(k, likeness.shape[1])
                least = np.partition(likeness, -last, axis=1)[:, -last]
                row, place = np.nonzero((likeness >= least[:, None]) & (likeness > -np.inf))
                found, value = ids[part[row, place]], likeness[row, place]
                best = np.lexsort((found, -value, row))
                row, found, value = row[best], found[best], value[best]
                first = np.arange(len(row)) - np.searchsorted(row, row) < k
                parts.append(pa.table([key[i + row[first]], found[first], value[first]], schema=FOUND))
        return pa.concat_tables(parts)

    placed = stage(asked.mapInArrow(place, f"cell int, {asked.schema.simpleString()[7:-1]}"))
    wanted = lambda vectors: codes.opened(unit_rows(vectors), probes)
    scored = tiles(
        placed, index.blocks, chained(codes.cells), (STRIP_ROWS, SLAB_ROWS), wanted, scan,
        "query_id long, item_id long, similarity double", F.size("ids"), "ids",
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "item_id")
    return scored.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)
