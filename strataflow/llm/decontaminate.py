"""Benchmark decontamination by spaced-seed hashing.

Texts are read as tokens: runs of letters and digits of any script, case folded, and single characters of scripts
that put no spaces between words. Each benchmark item is hashed
at every position under fixed masks that ignore some token positions, so a hash meets its
copy although a token at an ignored position was replaced. The masks go by the length of the
item: whatever tokens of a run of that length are replaced within the share, one mask fits
between them. A long run that has the share holds one of 12 to 23 tokens that has it too, so the masks
of 12 tokens serve all longer items. Documents are hashed in the same
way; where a hash meets one of an item, both are laid side by side at that offset
and the longest run with a share ``MIN_SHARE`` of equal tokens is verified: it must cover
``MIN_OVERLAP`` tokens, or the whole of a shorter item.

The benchmark is a stated query set: it is cut into blocks of at most ``BLOCK_TOKENS`` tokens,
each block is sent to the tasks and meets all documents; a longer item is a block of its
own. Documents are never shuffled.

Defined cases: null and empty texts, and items without a token, meet nothing; items of fewer than five tokens
are met whole and unbroken; texts of any length are read whole, in pieces; of equal overlaps
the one with the smallest document position counts; repeated rows are judged each; empty tables give
no overlap and keep all documents.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import fresh, shipped, unpacked, word_pieces
from strataflow.session import stage

# The masks, from this many tokens of an item on. A one is a compared position, a zero an ignored one.
MASKS = {
    1: ("1",),
    2: ("11",),
    3: ("111",),
    4: ("1111",),
    5: ("1111", "10111", "11011", "11101"),
    6: ("1111", "11011"),
    7: ("11111", "111011", "110111", "11010011"),
    12: ("1111011", "110010111", "1110100011", "1011111"),
}
SPAN = max(len(mask) for masks in MASKS.values() for mask in masks)
LEAST_TOKENS = 1
MIN_OVERLAP, MIN_SHARE = 12, 0.8
BLOCK_TOKENS = 1 << 21
# A run has the share if its equal tokens are at least this many times the replaced ones.
REPLACED = round(MIN_SHARE / (1 - MIN_SHARE))
CELLS = 1 << 18
HITS = 1 << 17
FILTER_BITS = 24

# ASCII letters and digits in lower case, all else spaces; for texts that have no other characters.
_PLAIN = bytes(ord(chr(c).lower()) if c < 128 and chr(c).isalnum() else 32 for c in range(256))
# Scripts without spaces between words (Thai, Lao, Burmese, Khmer, kana, Han).
_SPACELESS = (
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4DBF),
    (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9D), (0x20000, 0x3FFFF),
)
CHUNK_CHARS = 1 << 18
_FACTORS = np.array([xxhash.xxh64_intdigest(str(i).encode()) | 1 for i in range(SPAN)], dtype=np.uint64)


@cache
def kinds() -> np.ndarray:
    """For every character: 0 ends a token, 1 goes on with one, 2 is one by itself."""
    found = np.fromiter((chr(c).isalnum() for c in range(0x110000)), np.uint8, 0x110000)
    for low, high in _SPACELESS:
        found[low : high + 1] = 2
    return found


def spaced(text: str) -> bytes:
    """The tokens of a folded text between spaces."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")
    kind = kinds()[codes]
    codes = np.where(kind == 0, np.uint32(32), codes)
    alone = kind == 2
    if alone.any():
        # Three places for a character by itself, a space before and after it.
        ends = np.cumsum(np.where(alone, 3, 1))
        wide = np.full(ends[-1], 32, dtype="<u4")
        wide[ends - np.where(alone, 2, 1)] = codes
        codes = wide
    return codes.tobytes().decode("utf-32-le").encode()


def words(data: bytes) -> Iterator[list[bytes]]:
    """Tokens of a text in order, in lists of bounded size."""
    if data.isascii():
        return word_pieces(data.translate(_PLAIN))
    text = unicodedata.normalize("NFC", data.decode("utf-8", "replace").casefold())
    return word_pieces(b"".join(spaced(text[at : at + CHUNK_CHARS]) for at in range(0, len(text), CHUNK_CHARS)))


def tokens(data: bytes | None) -> np.ndarray:
    """64-bit hashes of the tokens of a text, in order."""
    pieces = [np.fromiter((xxhash.xxh64_intdigest(w) for w in piece), np.uint64, len(piece)) for piece in words(data or b"")]
    return np.concatenate(pieces) if pieces else np.zeros(0, np.uint64)


def masks_of(length: int) -> tuple[str, ...]:
    """The masks for items of a length."""
    return MASKS[max(least for least in MASKS if least <= length)]


def seeds(found: np.ndarray, mask: str) -> np.ndarray:
    """Hash at every position under a mask."""
    n = len(found) - len(mask) + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    total = np.full(n, np.uint64(xxhash.xxh64_intdigest(mask.encode())))
    for i, compared in enumerate(mask):
        if compared == "1":
            total += found[i : i + n] * _FACTORS[i]
    return total ^ total >> np.uint64(29)


class Block:
    """Hashes of some benchmark items, sorted, with a bit filter before them."""

    def __init__(self, ids: list, items: list[np.ndarray]):
        self.ids, self.items = ids, items
        self.sizes = np.array([len(t) for t in items], np.int64)
        self.starts = self.sizes.cumsum() - self.sizes
        self.flat = np.concatenate([*items, np.zeros(0, np.uint64)])
        self.masks = sorted({mask for t in items if len(t) >= LEAST_TOKENS for mask in masks_of(len(t))})
        hashes, owners, places = [], [], []
        for owner, item in enumerate(items):
            if len(item) < LEAST_TOKENS:
                continue
            for mask in masks_of(len(item)):
                found = seeds(item, mask)
                hashes.append(found)
                owners.append(np.full(len(found), owner))
                places.append(np.arange(len(found)))
        empty = np.zeros(0, np.int64)
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(self.hashes, kind="stable")
        self.hashes = self.hashes[order]
        self.owners = np.concatenate([*owners, empty])[order]
        self.places = np.concatenate([*places, empty])[order]
        self.filter = np.zeros(1 << FILTER_BITS >> 3, dtype=np.uint8)
        np.bitwise_or.at(self.filter, *self._bits(self.hashes))

    @staticmethod
    def _bits(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = hashes >> np.uint64(64 - FILTER_BITS)
        return (at >> np.uint64(3)).astype(np.int64), (np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))

    def meetings(self, found: np.ndarray) -> Iterator[np.ndarray]:
        """Distinct rows (item, offset of the item in the text) at which a hash is shared, in bounded parts."""
        rows, held = [], 0
        for mask in self.masks:
            hashes = seeds(found, mask)
            if not len(hashes):
                continue
            at, bit = self._bits(hashes)
            spots = np.nonzero(self.filter[at] & bit)[0]
            first = np.searchsorted(self.hashes, hashes[spots], "left")
            times = np.searchsorted(self.hashes, hashes[spots], "right") - first
            spots, first, times = (values[times > 0] for values in (spots, first, times))
            sums = times.cumsum()
            low = 0
            while low < len(spots):
                before = sums[low] - times[low]
                high = max(low + 1, int(np.searchsorted(sums, before + HITS, "right")))
                n, f = times[low:high], first[low:high]
                entry = np.repeat(f - np.cumsum(n) + n, n) + np.arange(n.sum())
                rows.append(np.column_stack([self.owners[entry], np.repeat(spots[low:high], n) - self.places[entry]]))
                held, low = held + len(entry), high
                if held >= HITS:
                    yield np.unique(np.concatenate(rows), axis=0)
                    rows, held = [], 0
        if rows:
            yield np.unique(np.concatenate(rows), axis=0)

    def passing(self, found: np.ndarray, meetings: np.ndarray) -> np.ndarray:
        """The meetings at which some run is long enough, and maybe a few more, in order."""
        owners, offsets = meetings.T
        begin = np.maximum(0, -offsets)
        width = np.minimum(self.sizes[owners], len(found) - offsets) - begin
        least = np.minimum(MIN_OVERLAP, self.sizes[owners])
        order = np.lexsort((width, least))
        order = order[width[order] >= least[order]]
        kept = []
        while len(order):
            shortest = least[order[0]]
            rows = order[: max(1, CELLS // width[order[0]])]
            rows = rows[(least[rows] == shortest) & (width[rows] <= 2 * width[rows[0]])]
            order = order[len(rows) :]
            place = np.arange(width[rows].max())
            inside = place < width[rows, None]
            place = np.where(inside, place + begin[rows, None], begin[rows, None])
            equal = self.flat[place + self.starts[owners[rows], None]] == found[place + offsets[rows, None]]
            gain = np.zeros((len(rows), place.shape[1] + 1), np.int64)
            np.where(equal & inside, 1, -REPLACED).cumsum(axis=1, out=gain[:, 1:])
            low = np.minimum.accumulate(gain, axis=1)
            kept.append(rows[(low[:, :-shortest] <= gain[:, shortest:]).any(axis=1)])
        return meetings[np.sort(np.concatenate(kept))] if kept else meetings[:0]

    def runs(self, data: bytes | None) -> Iterator[tuple[int, tuple]]:
        """Every item met with the run at an offset, if it passes."""
        found = tokens(data)
        for meetings in self.meetings(found):
            for owner, offset in self.passing(found, meetings).tolist():
                run = overlap(found, self.items[owner], offset)
                if run is not None:
                    yield owner, run

    def overlaps(self, data: bytes | None) -> Iterator[tuple]:
        """For each item that a text holds: id, first token in text and item, tokens, equal tokens."""
        best: dict[int, tuple] = {}
        for owner, run in self.runs(data):
            if owner not in best or (run[3], -run[0]) > (best[owner][3], -best[owner][0]):
                best[owner] = run
        for owner in sorted(best):
            yield (self.ids[owner], *best[owner])


def overlap(found: np.ndarray, item: np.ndarray, offset: int) -> tuple[int, int, int, int] | None:
    """Longest run at an offset, if one passes: first token in text and item, tokens, equal tokens.

    Of equal lengths the one with more equal tokens counts, then the first. Replaced tokens at its
    ends go as far as the least length allows.
    """
    begin, end = max(0, -offset), min(len(item), len(found) - offset)
    least = min(MIN_OVERLAP, len(item))
    if end - begin < least:
        return None
    equal = item[begin:end] == found[begin + offset : end + offset]
    gain = np.concatenate([[0], np.where(equal, 1, -REPLACED).cumsum()])
    same = np.concatenate([[0], equal.cumsum()])
    # For every end the first start from which the share is met: the minima up to a place only fall.
    starts = np.searchsorted(-np.minimum.accumulate(gain), -gain, "left")
    counts = np.arange(len(gain)) - starts
    if counts.max() < least:
        return None
    longest = np.nonzero(counts == counts.max())[0]
    last = int(longest[(same[longest] - same[starts[longest]]).argmax()])
    first = int(starts[last])
    while last - first > least and not equal[first]:
        first += 1
    while last - first > least and not equal[last - 1]:
        last -= 1
    return begin + first + offset, begin + first, last - first, int(same[last] - same[first])


def blocks(benchmark: DataFrame, item: str, text: str, block_tokens: int) -> Iterator[Block]:
    """The benchmark in blocks of bounded size."""
    sized = stage(
        benchmark.select(F.col(item).alias("id"), F.col(text).cast("binary").alias("data"))
        .where(F.col("data").isNotNull())
        # A token has a byte at least, and bytes bound what is sent.
        .withColumn("bytes", F.octet_length("data").cast("long"))
        .withColumn("part", F.pmod(F.xxhash64("id", "data"), F.lit(1 << 20)))
    )
    least = 8 * block_tokens
    parts = sized.groupBy("part").agg(F.sum("bytes").alias("bytes")).orderBy("part").toLocalIterator()
    start, held = 0, 0
    ranges = []
    for row in parts:
        if held and held + row["bytes"] > least:
            ranges.append((start, row["part"]))
            start, held = row["part"], 0
        held += row["bytes"]
    if held:
        ranges.append((start, 1 << 20))
    for low, high in ranges:
        rows = sized.where(F.col("part").between(low, high - 1)).orderBy("id").select("id", "data").collect()
        yield Block([r["id"] for r in rows], [tokens(bytes(r["data"])) for r in rows])


SPANS = "item_id long, doc_start long, item_start long, n_tokens long, n_equal long"


def contaminated(
    df: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """A row for each document and item it holds: key, item_id, token spans, tokens and equal tokens."""
    rows = df.select(F.col(key), F.col(text).cast("binary").alias("_data"))
    found = None
    for block in blocks(benchmark, item, text, block_tokens):
        spans = _spans(rows, block)
        part = rows.select(key, F.explode(spans).alias("_span")).select(key, "_span.*")
        found = part if found is None else found.union(part)
    if found is None:
        found = rows.select(key, F.from_json(F.lit("{}"), SPANS).alias("_span")).select(key, "_span.*").where("false")
    return found


def _spans(rows: DataFrame, block: Block) -> Column:
    sent = shipped(rows.sparkSession, block)

    @F.pandas_udf(f"array<struct<{SPANS.replace(' long', ':long')}>>")
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = [part.split()[0] for part in SPANS.split(", ")]
        items = unpacked(sent)
        for texts in batches:
            yield pd.Series([[dict(zip(names, o)) for o in items.overlaps(t)] for t in texts], dtype=object)

    return spans(F.col("_data"))


def decontaminated(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    benchmark_text: str = "text",
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """The documents that hold no benchmark item, with the columns they had."""
    kept = df
    (held,) = fresh(df, "held")
    for block in blocks(benchmark, item, benchmark_text, block_tokens):
        kept = kept.withColumn(held, _holds(df, text, block)).where(~F.col(held)).drop(held)
    return kept


def _holds(df: DataFrame, text: str, block: Block) -> Column:
    sent = shipped(df.sparkSession, block)

    @F.pandas_udf("boolean")
    def holds(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        items = unpacked(sent)
        for texts in batches:
            yield pd.Series([next(items.runs(t), None) is not None for t in texts], dtype=bool)

    return holds(F.col(text).cast("binary"))
