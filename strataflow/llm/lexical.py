"""Ranked lexical search: a K2-treap over the grid of terms and documents.

Documents are indexed in blocks of bounded text. A block is a grid: its terms are the rows, most
frequent first, its documents the columns, by their leading term and their length, and a posting is a
cell that holds the impact of its term in its document. The grid is kept as a compressed quadtree: postings
in Morton order, so that every quadrant is a run of postings, and for each level the maxima of those
quadrants that hold more than one; a quadrant with one posting is that posting, whatever
its size.

An item descends the rows of its terms jointly over ranges of documents. The bound of a range is
the weighted sum of the maxima of the quadrants in which its term rows cross the range; ranges are
split best first, some at a time, until none can reach the k-th best score. A range of one
document has its exact score. A task keeps the k best for each item over all its blocks.

Weights, lengths and document counts are taken over all documents; the index holds all terms.

Defined cases: a null text and a text without terms are in no result and do not count as documents;
an item without terms has no result; null ids come last among equal scores; repeated documents
are ranked each; a repeated item is answered for each of its rows; texts of any length are read in
pieces, and a document longer than a block has its own; other columns, whatever their names, are
left out; empty tables give an empty table.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import Best, passes, rows_per_batch, word_pieces
from strataflow.session import stage

# Bytes: A-Z to lower case; what is no letter, digit or part of a character beyond ASCII to a space.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
BLOCK_BYTES, BLOCK_DOCS = 6 << 20, 1 << 14
# Pairs of a range and a term whose bounds are found at once, and ranges split in the first steps.
STEP_PAIRS, FIRST_RANGES, MOST_RANGES = 1 << 18, 32, 1024
# Leaves are one row of 2^LEAF_LEVELS documents: above, quadrants have as many times fewer rows than columns.
LEAF_LEVELS = 4
# Postings of a quadrant that are looked at one by one; pairs that are kept between steps.
FEW, KEPT_PAIRS = 1, 1 << 24
# Items of a block, bytes of a pass, and texts sent to a task at once.
ITEMS, PASS_BYTES, TEXTS = 512, 16 << 20, 512

INDEX = (
    "docs int, ids array<long>, terms array<binary>, counts array<long>, code_bytes int, codes binary, impacts binary, "
    "level_sizes array<int>, starts binary, maxima binary"
)
FOUND = "item_block long, item_row long, item_id long, doc_id long, score long"


def term_pieces(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text in order, in lists of bounded size."""
    return word_pieces(text.translate(_FOLD))


def spread(bits: np.ndarray) -> np.ndarray:
    """Numbers below 2^32 with a zero before each bit."""
    x = bits.astype(np.uint64)
    for shift, mask in (
        (16, 0x0000FFFF0000FFFF),
        (8, 0x00FF00FF00FF00FF),
        (4, 0x0F0F0F0F0F0F0F0F),
        (2, 0x3333333333333333),
        (1, 0x5555555555555555),
    ):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


ROW_BITS = np.uint64(0xAAAAAAAAAAAAAAAA)


def planes(numbers: np.ndarray, width: int) -> bytes:
    """Numbers as byte planes, lowest first: planes of like bytes compress well."""
    return numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def from_planes(data: bytes, width: int) -> np.ndarray:
    found = np.zeros((len(data) // width, 8), dtype=np.uint8)
    found[:, :width] = np.frombuffer(data, dtype=np.uint8).reshape(width, -1).T
    return found.view("<u8").ravel()


def width_of(highest: int) -> int:
    return max(1, -(-int(highest).bit_length() // 8))


def levels_of(docs: int) -> int:
    """Halvings from all documents of a block to one."""
    return max(0, docs - 1).bit_length()


def impact(tf: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a posting is worth before the weight of its term, by occurrences and text length."""
    normed = 100 - 90 + (90 * length * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * normed)


class Builder:
    """Collects the documents of a block."""

    def __init__(self):
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.postings: list[np.ndarray] = []
        self.numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.bytes = 0

    def add(self, key: int | None, text: bytes) -> None:
        length = 0
        for piece in term_pieces(text):
            numbers = np.fromiter(map(self.numbers.__getitem__, piece), np.int64, len(piece))
            self.postings.append(numbers | (len(self.ids) << 40))
            length += len(piece)
        if length:
            self.ids.append(key)
            self.lengths.append(length)
            self.bytes += len(text)

    def full(self) -> bool:
        return self.bytes >= BLOCK_BYTES or len(self.ids) >= BLOCK_DOCS

    def row(self, n_docs: int, n_terms: int) -> list:
        """The block as a row of the index."""
        found, tf = np.unique(np.concatenate(self.postings), return_counts=True)
        doc, term = found >> 40, found & ((1 << 40) - 1)
        lengths = np.array(self.lengths, dtype=np.int64)
        impacts = impact(tf.astype(np.int64), lengths[doc], n_docs, n_terms)
        counts = np.bincount(term, minlength=len(self.numbers))
        by_count = np.argsort(-counts, kind="stable")
        row = np.empty(len(counts), dtype=np.int64)
        row[by_count] = np.arange(len(counts))
        # Documents of one language or kind share their most frequent term.
        leading = np.lexsort((row[term], -tf, doc))
        leading = row[term[leading[np.searchsorted(doc, np.arange(len(lengths)))]]]
        by_kind = np.lexsort((lengths, leading))
        column = np.empty(len(lengths), dtype=np.int64)
        column[by_kind] = np.arange(len(lengths))
        codes = spread(row[term] << LEAF_LEVELS) << np.uint64(1) | spread(column[doc])
        order = np.argsort(codes)
        codes, impacts = codes[order], impacts[order]
        sizes, starts, maxima = [], [], []
        for level in range(1, levels_of(len(lengths)) + 1):
            cells = codes >> np.uint64(2 * level)
            begin = np.nonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))[0]
            several = np.diff(np.append(begin, len(cells))) > 1
            sizes.append(int(several.sum()))
            starts.append(begin[several])
            maxima.append(np.maximum.reduceat(impacts, begin)[several])
        names = np.array(list(self.numbers), dtype=object)[by_count].tolist()
        width = width_of(codes[-1])
        packed = [planes(np.concatenate(x) if x else np.zeros(0), w) for x, w in ((starts, 4), (maxima, 3))]
        ids = [self.ids[i] for i in by_kind]
        return [len(ids), ids, names, counts[by_count], width, planes(codes, width), planes(impacts, 3), sizes, *packed]


def _index(n_docs: int, n_terms: int):
    kinds = [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.int32()]
    kinds += [pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.binary(), pa.binary()]
    schema = pa.schema(list(zip([field.split()[0] for field in INDEX.split(", ")], kinds)))

    def row(block: Builder) -> pa.RecordBatch:
        values = block.row(n_docs, n_terms)
        return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(values, schema)], schema=schema)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Builder()
        for batch in batches:
            for key, text in zip(batch.column("id"), batch.column("text")):
                block.add(key.as_py(), text.as_py())
                if block.full():
                    yield row(block)
                    block = Builder()
        if block.ids:
            yield row(block)

    return build


class Treap:
    """A block of the index, ready for descents."""

    def __init__(self, row: dict, terms: pa.Array):
        self.docs, self.terms = row["docs"], terms
        self.ids = np.array([0 if i is None else i for i in row["ids"]], dtype=np.int64)
        self.known = np.array([i is not None for i in row["ids"]], dtype=bool)
        codes = from_planes(row["codes"], row["code_bytes"])
        self.padded = np.append(codes, np.full(FEW + 1, ~np.uint64(0)))
        self.codes = self.padded[: len(codes)]
        self.impacts = from_planes(row["impacts"], 3).astype(np.int64)
        # Quadrants of all levels in one order: level above, first posting below.
        level = np.repeat(np.arange(1, len(row["level_sizes"]) + 1, dtype=np.int64), row["level_sizes"])
        self.places = (level << 40) | from_planes(row["starts"], 4).astype(np.int64)
        self.maxima = from_planes(row["maxima"], 3).astype(np.int64)
        self.levels = levels_of(self.docs)

    def rows(self, terms: pa.Array) -> np.ndarray:
        """Row of each term, -1 where the block doesn't have it."""
        return pc.fill_null(pc.index_in(terms, value_set=self.terms), -1).to_numpy().astype(np.int64)

    def values(self, rows: np.ndarray, first: np.ndarray, level: np.ndarray, able: np.ndarray) -> np.ndarray:
        """For each term and range the most that the term can be worth there; exact at level 0.

        ``able`` marks the pairs that are worth something in a wider range.
        """
        # Term by term, ranges in order: neighbouring searches end near each other.
        term, place = np.nonzero(able)
        shift = level[place].astype(np.uint64)
        own_row = spread(rows << LEAF_LEVELS)[term] << np.uint64(1)
        cell = shift * np.uint64(2)
        low = ((own_row | spread(first)[place]) >> cell) << cell
        begin = np.searchsorted(self.codes, low)
        found = np.zeros(len(low), dtype=np.int64)
        inside = np.arange(len(low))
        for i in range(FEW + 1):
            # The postings of the quadrant one after another, as long as it has more.
            at = begin[inside] + i
            code = self.padded[at]
            inside, at, code = (x[code >> cell[inside] == low[inside] >> cell[inside]] for x in (inside, at, code))
            if i < FEW:
                own = np.nonzero((code & ROW_BITS) == own_row[inside])[0]
                found[inside[own]] = np.maximum(found[inside[own]], self.impacts[at[own]])
        found[inside] = self.maxima[np.searchsorted(self.places, (level[place[inside]] << 40) | begin[inside])]
        value = np.zeros(able.shape, dtype=np.int64)
        value[term, place] = found
        return value

    def best(self, rows: np.ndarray, weights: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that may be among the k best and score ``least`` at least, and their scores."""
        docs, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        least, step = max(1, least), FIRST_RANGES
        most = max(1, STEP_PAIRS // len(rows))
        # What the terms are worth in each open range is kept if that is small.
        keep = len(rows) * self.docs <= KEPT_PAIRS
        first, level = np.zeros(1, dtype=np.int64), np.full(1, self.levels, dtype=np.int64)
        able = np.ones((len(rows), 1), dtype=bool)
        value = self.values(rows, first, level, able)
        bound = weights @ value
        if not self.levels:
            return (first, bound) if bound[0] >= least else (docs, scores)
        able = value > 0 if keep else able
        while True:
            kept = bound >= least
            first, level, bound, able = first[kept], level[kept], bound[kept], able[:, kept] if keep else able
            if not len(first):
                return docs, scores
            taken = min(step, most)
            step = min(2 * step, MOST_RANGES)
            chosen = np.zeros(len(first), dtype=bool)
            chosen[np.argpartition(-bound, taken)[:taken] if taken < len(bound) else slice(None)] = True
            parent = np.repeat(np.nonzero(chosen)[0], 2)
            child_level = level[parent] - 1
            child = first[parent]
            child[1::2] += np.int64(1) << child_level[1::2]
            inside = child < self.docs
            order = np.argsort(child[inside], kind="stable")
            child, child_level, parent = child[inside][order], child_level[inside][order], parent[inside][order]
            wider = able[:, parent] if keep else np.ones((len(rows), len(child)), dtype=bool)
            value = self.values(rows, child, child_level, wider)
            worth = weights @ value
            single = child_level == 0
            docs, scores = np.append(docs, child[single]), np.append(scores, worth[single])
            if len(scores) >= k:
                least = max(least, int(np.partition(scores, -k)[-k]))
            enough = scores >= least
            docs, scores = docs[enough], scores[enough]
            rest = ~chosen
            first = np.concatenate([first[rest], child[~single]])
            level = np.concatenate([level[rest], child_level[~single]])
            bound = np.concatenate([bound[rest], worth[~single]])
            if keep:
                able = np.concatenate([able[:, rest], value[:, ~single] > 0], axis=1)


def _search(k: int):
    schema = pa.schema([(field.split()[0], pa.int64()) for field in FOUND.split(", ")])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[list, Best]] = {}
        for batch in batches:
            names = [name for name in batch.schema.names if name not in ("terms", "items")]
            for i in range(batch.num_rows):  # blocks are large: one to a batch
                row = {name: batch.column(name)[i].as_py() for name in names}
                treap = Treap(row, batch.column("terms")[i].values)
                items = batch.column("items")[i].values
                if row["item_block"] not in best:
                    numbers = [items.field(name).to_pylist() for name in ("number", "item_id")]
                    best[row["item_block"]] = (numbers, Best(len(items), k))
                found = best[row["item_block"]][1]
                asked = items.field("terms")
                limits, rows = asked.offsets.to_numpy(), treap.rows(asked.values.field("term"))
                weights = asked.values.field("weight").to_numpy()
                for q in range(len(items)):
                    own = np.arange(limits[q], limits[q + 1])
                    own = own[rows[own] >= 0]
                    if not len(own):
                        continue
                    least = max(0, found.scores[q, -1])
                    docs, scores = treap.best(rows[own], weights[own], k, least)
                    if len(docs):
                        found.add(q, scores, treap.ids[docs], treap.known[docs])
        for number, (numbers, found) in best.items():
            there = found.there()
            item, _ = np.nonzero(there)
            columns = [pa.array(np.full(len(item), number))]
            columns += [pa.array(n, type=pa.int64()).take(pa.array(item)) for n in numbers]
            columns += [pa.array(found.ids[there], mask=~found.known[there]), pa.array(found.scores[there])]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return search


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with a term and all terms, for each task."""
    docs = terms = 0
    for batch in batches:
        for text in batch.column("text"):
            length = sum(map(len, term_pieces(text.as_py())))
            docs, terms = docs + (length > 0), terms + length
    yield pa.RecordBatch.from_pydict({"docs": pa.array([docs]), "terms": pa.array([terms])})


def index(df: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, int]:
    """The blocks of the index, and the number of documents in it."""
    texts = df.select(F.col(key).cast("long").alias("id"), F.col(text).cast("binary").alias("text"))
    texts = texts.where(F.col("text").isNotNull())
    counted = texts.select("text").mapInArrow(_counts, "docs long, terms long")
    with rows_per_batch(df.sparkSession, TEXTS):
        sums = counted.agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms")).first()
        # A row is a block of some megabytes.
        return stage(texts.mapInArrow(_index(sums["docs"] or 0, sums["terms"] or 0), INDEX), group_rows=1), sums["docs"] or 0


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different terms of each item."""
    for batch in batches:
        found = [list(dict.fromkeys(t for p in term_pieces(x.as_py()) for t in p)) for x in batch.column("text")]
        terms = pa.array(found, type=pa.list_(pa.binary()))
        yield pa.RecordBatch.from_arrays([batch.column("number"), batch.column("item_id"), terms], ["number", "item_id", "terms"])


def item_blocks(items: DataFrame, blocks: DataFrame, n_docs: int, item: str, text: str) -> DataFrame:
    """Rows (item_block, items, bytes): items with their terms and the weights of these."""
    asked = stage(
        items.select(
            F.monotonically_increasing_id().alias("number"),
            F.col(item).cast("long").alias("item_id"),
            F.col(text).cast("binary").alias("text"),
        )
        .where(F.col("text").isNotNull())
        .mapInArrow(_item_terms, "number long, item_id long, terms array<binary>")
    )
    of_item = asked.select("number", "item_id", F.explode("terms").alias("term"))
    entries = blocks.select(F.explode(F.arrays_zip("terms", "counts")).alias("entry"))
    entries = entries.select(F.col("entry.terms").alias("term"), F.col("entry.counts").alias("count"))
    wanted = stage(of_item.select("term").distinct())
    df = entries.join(wanted, "term").groupBy("term").agg(F.sum("count").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(float(n_docs)) + 2) / (2 * F.col("df") + 1))).alias("weight")
    weighed = of_item.join(stage(df.select("term", weight)), "term").where("weight > 0")
    whole = weighed.groupBy("number", "item_id").agg(
        F.collect_list(F.struct("term", "weight")).alias("terms"), F.sum(F.octet_length("term") + 16).alias("bytes")
    )
    return stage(
        whole.groupBy(F.shiftright("number", ITEMS.bit_length() - 1).alias("item_block")).agg(
            F.collect_list(F.struct("number", "item_id", "terms")).alias("items"), F.sum("bytes").alias("bytes")
        )
    )


def ranked(
    df: DataFrame,
    items: DataFrame,
    k: int = 10,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k documents that score highest for each item."""
    blocks, n_docs = index(df, key, text)
    asked = item_blocks(items, blocks, n_docs, item, item_text)
    found = df.sparkSession.createDataFrame([], FOUND)
    tree = blocks.drop("counts")
    for numbers in passes(asked, "item_block", F.col("bytes"), PASS_BYTES):
        # PASS_BYTES and a block at most.
        here = F.broadcast(asked.where(F.col("item_block").isin(numbers)).drop("bytes"))
        met = tree.withColumn("item_block", F.explode(F.array(*[F.lit(n).cast("long") for n in numbers])))
        with rows_per_batch(df.sparkSession, 1):
            found = found.unionAll(stage(met.join(here, "item_block").mapInArrow(_search(k), FOUND)))
    order = Window.partitionBy("item_block", "item_row").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("item_id", "rank", "doc_id", "score")
