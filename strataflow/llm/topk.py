"""Exact top-k by inner product: no-random-access aggregation over sorted lists.

Items are stored in blocks. A block keeps, for each component, the list of (value, row) in
order of value; a query reads the lists of its components from the end that its sign favours,
all to the same depth. What a row has shown so far, with the last value read from every list
in which it has not been met, bounds its score from above; with the worst value of those
lists, from below. Reading goes deeper until at most a quarter of the block's rows can still reach the
k-th best lower bound, or the k-th best score of the blocks before: on vectors of many like
components, which lists tell apart late, resolving these is cheaper than reading on. Their scores are then
resolved exactly.

Queries are cut into blocks too. A pass takes queries of bounded bytes, and every task reads its
item blocks against them; it keeps k rows for a query over all its blocks, so the k best
of each task meet in the end. One block of items is read first, and the k-th scores found there are known to
every task. Nothing but blocks of queries is broadcast.

Defined cases: vectors that are null or hold null or non-finite components take no part;
components are held within +-2^20, and scores are exact up to 8,192 components; shorter vectors count as ending
in zeros, an empty vector as all zeros; a query's own row and rows of the same id are not its
candidates; null ids are no queries and come last among equal scores; repeated rows are candidates
each, and a repeated query is answered once for each of its rows, with equal query_id; fewer
candidates than k give fewer rows; other columns, whatever their names, are left out; an empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import Best, passes
from strataflow.llm.vectors import finite, in_blocks, integers, matrix, one_row
from strataflow.session import stage

LIMIT = 1 << 20
# Shares of a block: rows that may be left to be resolved, and how far the lists are read at a time.
LEFT, STEPS = 4, 8
# Stored bytes of the queries of one pass over the items.
PASS_BYTES = 16 << 20

ITEM_BLOCK = "n int, width int, ids array<long>, ordered binary, rows binary, cells binary"
QUERY_BLOCK = "n int, width int, ids array<long>, cells binary"
LEAST = "array<struct<query_row:long,score:long>>"
FOUND = "query_block long, query_row long, query_id long, vec_id long, score long"

# Which of eight lists a mask has not met.
_UNMET = 1.0 - np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")


class Lists:
    """The sorted lists of an item block."""

    def __init__(self, n: int, dims: int, width: int, ids: list, ordered: bytes, rows: bytes, cells: bytes):
        self.n, self.dims = n, dims
        self.ids = np.array([0 if i is None else i for i in ids], dtype=np.int64)
        self.known = np.array([i is not None for i in ids], dtype=bool)
        # Whole numbers, held as the doubles that sums are taken in.
        self.values = np.zeros((dims, n))
        self.values[:width] = np.frombuffer(ordered, dtype=np.int32).reshape(width, n)
        self.rows = np.tile(np.arange(n, dtype=np.int64), (dims, 1))
        self.rows[:width] = np.frombuffer(rows, dtype=np.uint16).reshape(width, n)
        # Where in each list a row stands.
        self.place = np.empty((n, dims), dtype=np.uint16)
        np.put_along_axis(self.place, self.rows.T, np.arange(n, dtype=np.uint16)[:, None], axis=0)
        self.cells = matrix(cells, n, width, dims)
        self.groups = -(-dims // 8)

    def read(self, query: np.ndarray, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and parts of the score from depth ``begin`` to ``end``, list by list."""
        up, down = np.nonzero(query > 0)[0], np.nonzero(query < 0)[0]
        near, far = slice(self.n - end, self.n - begin), slice(begin, end)
        rows = np.concatenate([self.rows[up, near], self.rows[down, far]])
        parts = np.concatenate([self.values[up, near], self.values[down, far]])
        return rows.ravel(), (parts * query[np.concatenate([up, down]), None]).ravel()

    def seen(self, query: np.ndarray, end: int) -> np.ndarray:
        """For each row, as bits, the lists in which it stands before a depth."""
        # Places wrap below the first one read, to numbers beyond the depth.
        first = np.where(query > 0, self.n - end, 0).astype(np.uint16)
        return np.packbits(self.place - first < end, axis=1, bitorder="little")

    def at(self, query: np.ndarray, depth: int) -> np.ndarray:
        """What each list gives at a depth."""
        return query * np.where(query > 0, self.values[:, self.n - 1 - depth], self.values[:, depth])

    def unmet(self, seen: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """For each row the sum of a bound over the lists in which it was not met."""
        of_list = np.zeros(self.groups * 8)
        of_list[: self.dims] = bound
        table = of_list.reshape(-1, 8) @ _UNMET.T
        return sum(table[g].take(seen[:, g]) for g in range(self.groups))

    def candidates(self, query: np.ndarray, k: int, least: float, own: np.ndarray) -> np.ndarray:
        """Rows that may be among the k best and score ``least`` at least."""
        if not query.any():
            return np.nonzero(~own)[0]
        met = np.zeros(self.n)
        worst = self.at(query, self.n - 1)
        step = max(1, self.n // STEPS)
        begin, end = 0, step
        while True:
            last = self.at(query, end - 1)
            # As long as rows that were never met can qualify, nothing is decided.
            if end < self.n and last.sum() >= least > -np.inf:
                end = min(self.n, end + step)
                continue
            met += np.bincount(*self.read(query, begin, end), self.n)
            seen = self.seen(query, end)
            upper = met + self.unmet(seen, last)
            able = np.nonzero((upper >= least) & ~own)[0]
            if len(able) > k:
                lower = met[able] + self.unmet(seen[able], worst)
                able = able[upper[able] >= np.partition(lower, -k)[-k]]
            if end == self.n or len(able) <= max(4 * k, self.n // LEFT):
                return able
            begin, end = end, min(self.n, end + step)

    def best(self, query: np.ndarray, k: int, least: float, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows among the k best of the block that score ``least`` at least, and their scores."""
        rows = self.candidates(query, k, least, own)
        scores = self.cells[rows] @ query
        first = np.lexsort((self.ids[rows], ~self.known[rows], -scores))[:k]
        return rows[first], scores[first]


def _item_blocks(scale: int):
    schema = pa.schema(
        [("n", pa.int32()), ("width", pa.int32()), ("ids", pa.list_(pa.int64()))]
        + [(name, pa.binary()) for name in ("ordered", "rows", "cells")]
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in in_blocks(batches, "vector"):
            cells = integers(table.column("vector"), scale, LIMIT).astype(np.int32)
            rows = np.argsort(cells, axis=0, kind="stable").T.astype(np.uint16)
            ordered = np.sort(cells, axis=0).T
            ids = table.column("id").to_pylist()
            parts = [np.ascontiguousarray(p).tobytes() for p in (ordered, rows, cells)]
            yield one_row(schema, [len(ids), cells.shape[1], ids, *parts])

    return pack


def _query_blocks(scale: int):
    schema = pa.schema(
        [("n", pa.int32()), ("width", pa.int32()), ("ids", pa.list_(pa.int64())), ("cells", pa.binary())]
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in in_blocks(batches, "vector"):
            cells = integers(table.column("vector"), scale, LIMIT).astype(np.int32)
            ids = table.column("id").to_pylist()
            yield one_row(schema, [len(ids), cells.shape[1], ids, cells.tobytes()])

    return pack


def _search(k: int):
    schema = pa.schema([(name, pa.int64()) for name in ("query_block", "query_row", "query_id", "vec_id", "score")])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[list, Best]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                dims = max(row["width"], row["query_width"])
                block = Lists(row["n"], dims, row["width"], row["ids"], row["ordered"], row["rows"], row["cells"])
                queries = matrix(row["query_cells"], row["query_n"], row["query_width"], dims)
                own_ids, found = best.setdefault(row["query_block"], (row["query_ids"], Best(row["query_n"], k)))
                least = {s["query_row"]: s["score"] for s in row["query_least"] or []}
                for q, own_id in enumerate(own_ids):
                    own = block.known & (block.ids == own_id)
                    rows, scores = block.best(queries[q], k, max(least.get(q, -np.inf), found.least(q)), own)
                    if len(rows):
                        found.add(q, scores, block.ids[rows], block.known[rows])
        for number, (own_ids, found) in best.items():
            there = found.there()
            place, _ = np.nonzero(there)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(place), number)),
                    pa.array(place),
                    pa.array(np.array(own_ids, dtype=np.int64)[place]),
                    pa.array(found.ids[there], mask=~found.known[there]),
                    pa.array(found.scores[there]),
                ],
                schema=schema,
            )

    return search


def top_k(df: DataFrame, queries: DataFrame, k: int, scale: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best rows for every query row."""
    items, asked = (
        t.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector")).where(finite(F.col("vector")))
        for t in (df, queries)
    )
    blocks = stage(items.mapInArrow(_item_blocks(scale), ITEM_BLOCK))
    query_blocks = stage(
        asked.where(F.col("id").isNotNull())
        .mapInArrow(_query_blocks(scale), QUERY_BLOCK)
        .withColumn("block", F.monotonically_increasing_id())
        .select("block", *[F.col(c).alias(f"query_{c}") for c in ("n", "width", "ids", "cells")])
    )
    found = items.sparkSession.createDataFrame([], FOUND)
    # The k-th best score over one block of items: no query has to find that out in every task.
    first = _met(blocks.limit(1), query_blocks.withColumn("query_least", F.lit(None).cast(LEAST)), k)
    kth = first.groupBy("query_block", "query_row").agg(F.min("score").alias("score"), F.count("*").alias("n"))
    kth = kth.where(F.col("n") == k).groupBy(F.col("query_block").alias("block"))
    kth = kth.agg(F.collect_list(F.struct("query_row", "score")).alias("query_least"))
    query_blocks = stage(query_blocks.join(kth, "block", "left"))
    found = _met(blocks, query_blocks, k)
    order = Window.partitionBy("query_block", "query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _met(blocks: DataFrame, query_blocks: DataFrame, k: int) -> DataFrame:
    """The k best rows of each task for every query, in passes over the items."""
    size = F.octet_length("query_cells") + 32 * F.col("query_n")
    found = blocks.sparkSession.createDataFrame([], FOUND)
    for turn in passes(query_blocks, "block", size, PASS_BYTES):
        here = query_blocks.where(F.col("block").isin(turn)).withColumnRenamed("block", "query_block")
        met = blocks.withColumn("query_block", F.explode(F.array(*[F.lit(b).cast("long") for b in turn])))
        # PASS_BYTES and a block at most.
        found = found.unionAll(stage(met.join(F.broadcast(here), "query_block").mapInArrow(_search(k), FOUND)))
    return found
