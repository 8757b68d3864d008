"""Vector code compression: product codes, assigned by per-dimension value dictionaries.

Vectors are cut into equal parts, and each part is coded by the nearest entry of its codebook.
Components are whole numbers, so a dimension has few distinct values. Blocks of vectors are
stored once in that form: for each dimension the dictionary of its distinct values and the
code of every vector. To assign, the squared difference of every distinct value to every
entry is tabulated; the distance of a part is then the sum of one gathered table row for each of its
dimensions. The tables of a dimension are as large as the dictionary of a block, which a block's rows
bound.

A round sums the components of every entry in the tasks, adds these sums up by (dimension, entry)
and sends the codebooks, whose size is fixed, back to the tasks.

Defined cases: vectors that are null or hold null or non-finite components take no part;
components are held within +-2^26; shorter vectors count as ending in zeros, up to the longest, filled up
to equal parts; a codebook starts with fewer entries if there are fewer vectors; null ids come last among the
smallest, equal ids by their vector; repeated rows are coded each; equal labels have one sum, nulls
together; other columns are left out; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from strataflow.llm.common import shipped, unpacked
from strataflow.llm.vectors import finite, in_blocks, integers, one_row
from strataflow.session import stage

LIMIT = 1 << 26
# Rows whose distances to all entries are held at once.
STEP_ROWS = 1024


class Block:
    """Vectors as codes into the value dictionaries of their dimensions."""

    def __init__(self, n: int, sizes: list[int], values: bytes, codes: bytes):
        self.n, self.width = n, len(sizes)
        self.values = np.split(np.frombuffer(values, dtype=np.int32).astype(np.int64), np.cumsum(sizes)[:-1])
        self.codes = np.frombuffer(codes, dtype=np.uint16).reshape(self.width, n)

    def dimension(self, d: int) -> tuple[np.ndarray, np.ndarray]:
        """Dictionary and codes; a dimension beyond the width of the block is all zeros."""
        if d < self.width:
            return self.values[d], self.codes[d]
        return np.zeros(1, dtype=np.int64), np.zeros(self.n, dtype=np.uint16)

    def assign(self, book: np.ndarray, part: range) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of each vector's part, ties to the lower index, and its squared distance."""
        columns, reach = [], 0
        for d in part:
            values, codes = self.dimension(d)
            table = (values[:, None] - book[None, :, d]) ** 2
            reach += int(table.max())
            columns.append((table, codes))
        kind = np.int32 if reach < 1 << 31 else np.int64
        columns = [(table.astype(kind), codes) for table, codes in columns]
        nearest, distance = np.empty(self.n, dtype=np.int64), np.empty(self.n, dtype=np.int64)
        for at in range(0, self.n, STEP_ROWS):
            rows = slice(at, at + STEP_ROWS)
            total = 0
            for table, codes in columns:
                total = total + table.take(codes[rows], axis=0)
            nearest[rows] = total.argmin(axis=1)
            distance[rows] = total.min(axis=1)
        return nearest, distance

    def sums(self, nearest: np.ndarray, entries: int, d: int) -> np.ndarray:
        """Sum of a dimension's components for each entry."""
        values, codes = self.dimension(d)
        # Exact in doubles: a block has few rows.
        return np.bincount(nearest, values[codes], entries).astype(np.int64)


def _blocks(kept: DataFrame) -> DataFrame:
    """Rows (ids, labels, n, sizes, values, codes): blocks of vectors in dictionary form."""
    label = kept.schema["label"].dataType
    schema = pa.schema(
        [("ids", pa.list_(pa.int64())), ("labels", pa.list_(to_arrow_type(label))), ("n", pa.int32())]
        + [("sizes", pa.list_(pa.int32())), ("values", pa.binary()), ("codes", pa.binary())]
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in in_blocks(batches, "vector"):
            cells = integers(table.column("vector"), 1024, LIMIT)
            found = [np.unique(cells[:, d], return_inverse=True) for d in range(cells.shape[1])]
            values = b"".join(v.astype(np.int32).tobytes() for v, _ in found)
            codes = b"".join(c.astype(np.uint16).tobytes() for _, c in found)
            ids, labels = (table.column(c).to_pylist() for c in ("id", "label"))
            yield one_row(schema, [ids, labels, len(ids), [len(v) for v, _ in found], values, codes])

    shape = f"ids array<long>, labels array<{label.simpleString()}>, n int, sizes array<int>, values binary, codes binary"
    return stage(kept.mapInArrow(pack, shape))


def _totals(parts: int, spark: SparkSession, books: np.ndarray):
    """Task function: sums of the components of every entry, and how many vectors each has."""
    sent = shipped(spark, books)
    schema = pa.schema([(name, pa.int64()) for name in ("dim", "entry", "total", "n")])

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = unpacked(sent)
        entries, dims = book.shape
        total, n = np.zeros((dims, entries), dtype=np.int64), np.zeros((dims, entries), dtype=np.int64)
        for block in _stored(batches):
            for part in cut(dims, parts):
                nearest, _ = block.assign(book, part)
                n[part] += np.bincount(nearest, minlength=entries)
                for d in part:
                    total[d] += block.sums(nearest, entries, d)
        dim, entry = np.nonzero(n)
        columns = [dim, entry, total[dim, entry], n[dim, entry]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    return totals


def _stored(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for row in batch.select(["n", "sizes", "values", "codes"]).to_pylist():
            yield Block(row["n"], row["sizes"], row["values"], row["codes"])


def cut(dims: int, parts: int) -> list[range]:
    """Dimensions of each part."""
    size = dims // parts
    return [range(p * size, (p + 1) * size) for p in range(parts)]


def first_books(kept: DataFrame, dims: int, entries: int) -> np.ndarray:
    """The vectors of the smallest ids, whose parts start the codebooks."""
    smallest = kept.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").toArrow()
    cells = integers(smallest.column("vector"), 1024, LIMIT)
    books = np.zeros((len(cells), dims), dtype=np.int64)
    books[:, : cells.shape[1]] = cells
    return books


def trained(blocks: DataFrame, books: np.ndarray, parts: int, rounds: int) -> np.ndarray:
    """Codebooks after some rounds: every entry becomes the floor of its vectors' mean."""
    spark = blocks.sparkSession
    for _ in range(rounds):
        sums = blocks.mapInArrow(_totals(parts, spark, books), "dim long, entry long, total long, n long")
        # A row for each entry and dimension at most.
        rows = sums.groupBy("dim", "entry").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).toArrow()
        dim, entry, total, n = (rows.column(c).to_numpy() for c in ("dim", "entry", "total", "n"))
        books = books.copy()
        books[entry, dim] = total // n
    return books


def fingerprint(books: np.ndarray, parts: int) -> str:
    """SHA-256 of all components by part, entry and place, in decimals joined by commas."""
    numbers = [str(x) for part in cut(books.shape[1], parts) for x in books[:, part].ravel().tolist()]
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def compressed(
    df: DataFrame,
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """``key, code, error, label_error, codebooks_sha256`` of every vector that takes part."""
    if not 0 < entries <= 256:
        raise ValueError("an index has two hex digits, so a codebook has 1 to 256 entries")
    kept = df.select(
        F.col(key).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector")
    ).where(finite(F.col("vector")))
    blocks = _blocks(kept)
    longest = blocks.agg(F.max(F.size("sizes")).alias("width")).first()["width"] or 0
    dims = max(1, -(-longest // parts)) * parts
    books = trained(blocks, first_books(kept, dims, entries), parts, rounds)
    coded = stage(_coded(blocks, books, parts, kept.schema["label"].dataType))
    # Written, so that its size is known where the rows are joined to it.
    of_label = stage(coded.groupBy("label").agg(F.sum("error").alias("label_error")))
    of_label = of_label.withColumnRenamed("label", "other")
    whole = fingerprint(books, parts)
    joined = coded.join(of_label, F.col("label").eqNullSafe(F.col("other")))
    return joined.select(F.col("id").alias(key), "code", "error", "label_error", F.lit(whole).alias("codebooks_sha256"))


def _coded(blocks: DataFrame, books: np.ndarray, parts: int, label) -> DataFrame:
    """Rows (id, label, code, error)."""
    sent = shipped(blocks.sparkSession, books)
    schema = pa.schema(
        [("id", pa.int64()), ("label", to_arrow_type(label)), ("code", pa.string()), ("error", pa.int64())]
    )

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = unpacked(sent)
        for batch in batches:
            for i, block in enumerate(_stored(iter([batch]))):
                found = [block.assign(book, part) for part in cut(book.shape[1], parts)]
                indexes = np.stack([nearest for nearest, _ in found], axis=1).astype(np.uint8)
                codes = [row.tobytes().hex() for row in indexes]
                error = np.sum([distance for _, distance in found], axis=0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[i].values, batch.column("labels")[i].values, pa.array(codes), pa.array(error)],
                    schema=schema,
                )

    return blocks.mapInArrow(code, f"id long, label {label.simpleString()}, code string, error long")
