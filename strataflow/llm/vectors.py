"""Helpers of the vector operators: which vectors count, whole-number components, blocks of rows.

Components become floor(scale * x), taken in doubles and held within +-2^26 (codes) or +-2^20
(search), so that every later sum fits a long. Shorter vectors count as ending in zeros.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK_ROWS = 4096
# Components of a block, so that blocks of long vectors have fewer rows.
BLOCK_CELLS = 1 << 20


def finite(vector: Column) -> Column:
    """Whether a vector is there, with no null and only finite components."""
    infinite = F.lit(float("inf"))
    odd = F.exists(vector, lambda x: F.coalesce(F.isnan(x) | (F.abs(x) == infinite), F.lit(True)))
    return F.coalesce(~odd, F.lit(False))


def integers(column: pa.Array, scale: int, limit: int) -> np.ndarray:
    """Rows of whole-number components, padded with zeros to the longest."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy()).astype(np.int64)
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    flat = np.clip(flat, -limit, limit).astype(np.int64)
    rows = np.zeros((len(lengths), int(lengths.max(initial=0))), dtype=np.int64)
    rows[np.arange(rows.shape[1]) < lengths[:, None]] = flat
    return rows


def in_blocks(batches: Iterator[pa.RecordBatch], vector: str) -> Iterator[pa.Table]:
    """The rows of a task in tables of bounded size."""
    held: list[pa.RecordBatch] = []
    rows = cells = 0
    for batch in batches:
        lengths = np.diff(batch.column(vector).offsets.to_numpy())
        at = 0
        while at < batch.num_rows:
            room = np.searchsorted(np.cumsum(lengths[at:]), BLOCK_CELLS - cells, "right")
            taken = int(min(BLOCK_ROWS - rows, room, batch.num_rows - at))
            if not taken and not rows:
                taken = 1
            if taken:
                held.append(batch.slice(at, taken))
                rows, cells = rows + taken, cells + int(lengths[at : at + taken].sum())
                at += taken
            if at < batch.num_rows or rows == BLOCK_ROWS:
                yield pa.Table.from_batches(held)
                held, rows, cells = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def one_row(schema: pa.Schema, values: Sequence) -> pa.RecordBatch:
    """A block as a row; numpy arrays become lists, bytes stay."""
    return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(values, schema)], schema=schema)


def matrix(data: bytes, rows: int, width: int, dims: int) -> np.ndarray:
    """A stored block of components, padded with zeros to ``dims`` columns."""
    found = np.zeros((rows, dims), dtype=np.int64)
    found[:, :width] = np.frombuffer(data, dtype=np.int32).reshape(rows, width)
    return found
