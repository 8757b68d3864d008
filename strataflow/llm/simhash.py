"""Near-duplicates by SimHash; fingerprints within a few bits meet by Golay fuzzy hashing.

A fingerprint of 64 bits is cut into three segments. If two fingerprints differ in two bits
at most, some segment is equal in both, and one more differs in one bit at most. A key is
made of such a pair: the index of a Golay codeword near the one segment, and the other
segment as it is; three pairs in a ring cover every way two bits can fall. A fingerprint is
stored under the nearest codeword (three keys) and sought under all codewords within
distance 4 (up to six each), which meets every segment one bit away. Meetings are verified
by their distance.

Equal fingerprints are one fingerprint. Keys under which many fingerprints are stored would
meet in all pairs; their members go an exact way without pairs: each stands under itself
and its 64 one-bit neighbours, two share such a place exactly if they are two bits apart at most,
and each place links its members to the smallest of them.

Defined cases: a null text or one without words has fingerprint zero and is linked like any
other; repeated rows and ties have equal fingerprints; a null key is no candidate for the
smallest key; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm import golay
from strataflow.llm.common import fresh, word_pieces
from strataflow.llm.components import components
from strataflow.session import stage

SEED = 42
MOST_BITS = 2
# Upper ends of the segments, and the pairs (near segment, equal segment).
SEGMENTS = ((0, 22), (22, 21), (43, 21))
PAIRS = ((0, 2), (1, 0), (2, 1))
# Fingerprints stored under one key that may meet in pairs.
CROWD = 256


def text_fingerprint(data: bytes | None, width: int = 3) -> int:
    """SimHash of the word shingles of a text, as a signed 64-bit number."""
    if data is None:
        return 0
    votes, shingles, carried = np.zeros(64, dtype=np.int64), 0, []
    for piece in word_pieces(data.lower()):
        words = carried + piece
        carried = words[len(words) - width + 1 :] if len(words) >= width else words
        if len(words) < width:
            continue
        joined = map(b" ".join, zip(*(words[i:] for i in range(width))))
        found = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in joined), np.uint64, len(words) - width + 1)
        votes += np.unpackbits(found.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        shingles += len(found)
    if not shingles:
        if not carried:
            return 0
        return int(np.array([xxhash.xxh64_intdigest(b" ".join(carried), SEED)], dtype=np.uint64).view(np.int64)[0])
    return int(np.packbits(2 * votes > shingles, bitorder="little").view(np.int64)[0])


def fingerprint(text: Column, width: int = 3) -> Column:
    """Fingerprint of each text; texts are cut into pieces of bounded size in the tasks."""

    @F.pandas_udf("long")
    def of_texts(texts: pd.Series) -> pd.Series:
        return pd.Series([text_fingerprint(t, width) for t in texts], dtype="int64")

    return of_texts(text.cast("binary"))


def _keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (key, fp, stored): the keys of a fingerprint, the nearest ones marked."""
    for pdf in batches:
        fps = pdf["fp"].to_numpy(dtype=np.int64)
        bits = fps.view(np.uint64)
        parts = [(bits >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
        for pair, (near, equal) in enumerate(PAIRS):
            words = golay.codewords(parts[near])
            rows, column = np.nonzero(words >= 0)
            key = pair << 34 | words[rows, column] << 22 | parts[equal][rows]
            yield pd.DataFrame({"key": key, "fp": fps[rows], "stored": column == 0})


def close_links(distinct: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) that join all of ``fp`` within two bits: pairs, or stars in crowded places."""
    entries = stage(distinct.select("fp").mapInPandas(_keys, "key long, fp long, stored boolean"))
    stored = entries.where("stored").select("key", F.col("fp").alias("a"))
    sought = entries.select("key", F.col("fp").alias("b"))
    crowded = stage(stored.groupBy("key").count().where(F.col("count") > crowd).select("key"))
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    if crowded.isEmpty():
        return stored.join(sought, "key").where((F.col("a") != F.col("b")) & (apart <= MOST_BITS)).select("a", "b")
    pairs = (
        stored.join(crowded, "key", "left_anti")
        .join(sought, "key")
        .where((F.col("a") != F.col("b")) & (apart <= MOST_BITS))
        .select("a", "b")
    )
    members = sought.join(crowded, "key", "left_semi").select("b").distinct()
    return pairs.union(_stars(members))


def _stars(members: DataFrame) -> DataFrame:
    """Each fingerprint linked to the smallest one that shares a one-bit neighbour with it."""
    flips = F.transform(
        F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("b").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))
    )
    places = stage(members.select("b", F.explode(F.concat(F.array("b"), flips)).alias("place")))
    heads = places.groupBy("place").agg(F.min("b").alias("a"), F.max("b").alias("last")).where("a < last")
    return places.join(heads.select("place", "a"), "place").where("a < b").select("a", "b").distinct()


def groups(prints: DataFrame, key: str = "doc_id", crowd: int = CROWD) -> DataFrame:
    """``fp`` with ``root`` (a fingerprint) and ``component_id`` (the smallest key) of its group.

    ``prints`` has the key and ``fp`` of every row; it is read several times, so it should
    be a written table.
    """
    distinct = stage(prints.groupBy("fp").agg(F.min(key).alias("first")))
    linked = components(close_links(distinct, crowd)).select(F.col("node").alias("fp"), "root")
    ids = distinct.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = stage(ids)
    smallest = ids.groupBy("root").agg(F.min("first").alias("component_id"))
    return stage(ids.join(smallest, "root").select("fp", "root", "component_id"))


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, crowd: int = CROWD
) -> DataFrame:
    """Every row with its key, ``fingerprint`` (16 hex digits) and ``component_id``."""
    prints = stage(df.select(F.col(key), fingerprint(F.col(text), width).alias("fp")))
    found = groups(prints, key, crowd).select("fp", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(found, "fp").select(key, hexed.alias("fingerprint"), "component_id")


def without_near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, crowd: int = CROWD
) -> DataFrame:
    """One row of each group: the smallest key, null last; the first of equal keys.

    Rows are numbered in the written table, so exactly one stays even among equal rows.
    """
    fp, row, root, kept = fresh(df, "fp", "row", "root", "kept")
    stored = stage(df.withColumn(fp, fingerprint(F.col(text), width)).withColumn(row, F.monotonically_increasing_id()))
    prints = stored.select(F.col(key).alias("key"), F.col(fp).alias("fp"), F.col(row).alias("row"))
    found = groups(prints, "key", crowd).select("fp", "root")
    first = F.min(F.struct(F.col("key").isNull().alias("none"), F.col("key"), F.col("row")))
    kept_rows = prints.join(found, "fp").groupBy("root").agg(first.alias("first"))
    kept_rows = kept_rows.select(F.col("first")["row"].alias(kept))
    return stored.join(kept_rows, F.col(row) == F.col(kept)).select(*df.columns)
