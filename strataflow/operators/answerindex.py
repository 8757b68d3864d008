"""An index over answers, so that searches read lists of fingerprints instead of all answers.

Every answer goes under its trigrams, its whole text and, if it is a number, an order-keeping bin of it. A
list is kept as bitmaps, one for each bucket of fingerprints, and a batch of answers is a folder of its own. The tasks
set the bits of trigrams as they read the texts, in a table of bounded size; no row is made for each trigram.
The lists of a predicate are combined as bitmaps: all trigrams of a searched text, any bin of a range. What is
left are candidates; their answers are read from the buckets they lie in, the latest batch of each
question counts, and the predicate itself decides. So lists may hold answers that were replaced meanwhile.

A searched text of fewer than three characters is looked for in the trigrams and in the short texts that have none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.operators.search import Match, combined_hits, matches_of
from strataflow.session import local_table, stage

GRAM = 3
# Fingerprints of a bitmap, fixed by the bitmap functions, and buckets stored together.
BUCKET, SLAB_BUCKETS = 1 << 15, 1 << 6
# Bitmaps of trigrams that a task holds, rows of a batch it sends, and characters it takes at once.
HELD, SENT, CHARS = 1 << 14, 1 << 11, 1 << 20
# Bits of a code point, and a value that is none, for texts shorter than a trigram.
POINT, NO_POINT = 21, (1 << 21) - 1
# Bins for each doubling of a number; larger ones share the last bin.
BINS, LAST_BIN = 8, 20_000


def _bin(number: Column) -> Column:
    """A whole number that grows with the number; NaN is above all."""
    scaled = F.signum(number) * F.log2(1 + F.least(F.abs(number), F.lit(1e300))) * BINS
    return F.when(F.isnan(number), LAST_BIN).otherwise(F.floor(scaled)).cast("long")


def _keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams of some texts as numbers, and the ends of each text's; a shorter text has one, padded."""
    padded = [t + "\0" * (GRAM - len(t)) if len(t) < GRAM else t for t in texts]
    points = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    lengths = np.array([len(t) for t in padded])
    begins = np.cumsum(lengths) - lengths
    for i, t in enumerate(texts):
        if len(t) < GRAM:
            points[begins[i] + len(t) : begins[i] + GRAM] = NO_POINT
    ends = np.cumsum(lengths - GRAM + 1)
    at = np.arange(ends[-1]) + np.repeat(begins - (ends - (lengths - GRAM + 1)), lengths - GRAM + 1)
    keys = points[at]
    for i in range(1, GRAM):
        keys = keys << POINT | points[at + i]
    return keys, ends


def _gram(key: int) -> str:
    points = [key >> POINT * i & NO_POINT for i in reversed(range(GRAM))]
    return "".join(chr(p) for p in points if p != NO_POINT)


GRAMS = pa.schema([("question", pa.string()), ("bucket", pa.int64()), ("entry", pa.string()), ("bits", pa.binary())])


def _gram_bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bitmaps of trigrams from ``question, bucket, place, text``; one may come in several parts."""
    rows, bits, of = {}, np.zeros((1 << 8, BUCKET // 8), dtype=np.uint8), None

    def sent() -> Iterator[pa.RecordBatch]:
        keys = list(rows)
        for i in range(0, len(keys), SENT):
            own = keys[i : i + SENT]
            columns = [[of[0]] * len(own), [of[1]] * len(own), [_gram(k) for k in own], [bits[j].tobytes() for j in range(i, i + len(own))]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, GRAMS)], schema=GRAMS)

    for batch in batches:
        asked = list(zip(*(batch.column(c).to_pylist() for c in ("question", "bucket", "place", "text"))))
        start = 0
        while start < len(asked):
            # Texts of one list of bitmaps, and no more characters than are taken at once but for a longer text.
            stop, chars = start, 0
            while stop < len(asked) and asked[stop][:2] == asked[start][:2] and (stop == start or chars + len(asked[stop][3]) <= CHARS):
                chars += len(asked[stop][3])
                stop += 1
            part, start = asked[start:stop], stop
            keys, ends = _keys([r[3] for r in part])
            codes, found = pd.factorize(keys)
            spans = list(zip([r[2] for r in part], np.append(0, ends[:-1]).tolist(), ends.tolist()))
            # One pass, unless these texts alone have more trigrams than a task holds.
            for first in range(0, len(found), HELD):
                taken = found[first : first + HELD].tolist()
                if of != part[0][:2] or len(rows) + len(taken) > HELD:
                    yield from sent()
                    rows, of = {}, part[0][:2]
                    bits[:] = 0
                own = np.array([rows.setdefault(k, len(rows)) for k in taken], dtype=np.int64)
                if len(rows) > len(bits):
                    bits = np.concatenate([bits, np.zeros((max(len(bits), len(rows) - len(bits)), bits.shape[1]), dtype=np.uint8)])
                for place, low, high in spans:
                    code = codes[low:high] - first
                    if len(found) > HELD:
                        code = code[(code >= 0) & (code < HELD)]
                    bits[own[code], place >> 3] |= np.uint8(1 << (place & 7))
    yield from sent()


def _members(bits: Column) -> Column:
    """Places of the bits that are set."""

    @F.arrow_udf("array<long>")
    def members(bitmaps: pa.Array) -> pa.Array:
        flat = (np.unpackbits(np.frombuffer(b, dtype=np.uint8), bitorder="little") for b in bitmaps.to_pylist())
        return pa.array([np.nonzero(f)[0] for f in flat], pa.list_(pa.int64()))

    return members(bits)


def _slab(fingerprint: Column) -> Column:
    return F.floor(F.bitmap_bucket_number(fingerprint) / SLAB_BUCKETS)


def _lists(answers: DataFrame) -> DataFrame:
    """Bitmaps ``question, kind, entry, number, bucket, bits`` under which answers are found."""
    text, number = F.lower("value"), F.col("value").try_cast("double")
    none = F.lit(None)
    bucket, place = F.bitmap_bucket_number("fingerprint"), F.bitmap_bit_position("fingerprint")
    # Ranges of fingerprints: a task meets few buckets, so most bits of a bitmap are set before the shuffle.
    near = answers.where(F.col("value").isNotNull()).repartitionByRange("fingerprint")
    texts = near.where(F.col("fingerprint").isNotNull() & F.col("question").isNotNull()).sortWithinPartitions("question", "fingerprint")
    grams = texts.select("question", bucket.alias("bucket"), place.alias("place"), text.alias("text")).mapInArrow(
        _gram_bitmaps, "question string, bucket long, entry string, bits binary"
    )
    grams = grams.groupBy("question", "entry", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    whole = near.select("question", "fingerprint", F.lit("whole").alias("kind"), F.md5(text).alias("entry"), none.cast("long").alias("number"))
    bins = near.where(number.isNotNull()).select("question", "fingerprint", F.lit("bin"), none.cast("string"), _bin(number))
    others = whole.union(bins).groupBy("question", "kind", "entry", "number", bucket.alias("bucket")).agg(
        F.bitmap_construct_agg(place).alias("bits")
    )
    return others.unionByName(grams.select("question", F.lit("gram").alias("kind"), "entry", none.cast("long").alias("number"), "bucket", "bits"))


def index_answers(answers: DataFrame, path: str, batch_id: int) -> None:
    """Add a batch of answers (``fingerprint, question, value``); it replaces earlier answers of its questions.

    An answer that is null or empty takes the earlier one away. A batch written again replaces itself.
    """
    kept = stage(answers.select(F.col("fingerprint").cast("long").alias("fingerprint"), "question", F.col("value").cast("string").alias("value")))
    values = kept.withColumn("slab", _slab(F.col("fingerprint")))
    dealt = values.repartitionByRange("question", "slab", "fingerprint").sortWithinPartitions("question", "slab", "fingerprint")
    dealt.write.mode("overwrite").partitionBy("question", "slab").parquet(f"{path}/values/batch_id={batch_id}")
    lists = _lists(kept)
    ordered = lists.repartitionByRange("question", "kind", "entry", "number").sortWithinPartitions("question", "kind", "entry", "number", "bucket")
    ordered.write.mode("overwrite").partitionBy("question", "kind").parquet(f"{path}/lists/batch_id={batch_id}")


def _table(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return spark.read.schema(ddl).parquet(path)


LISTS = "batch_id long, question string, kind string, entry string, number long, bucket long, bits binary"
VALUES = "batch_id long, question string, slab long, fingerprint long, value string"


def _wanted(lists: DataFrame, number: int, match: Match) -> DataFrame:
    """Bitmaps of one predicate: ``predicate, batch_id, bucket, bits``."""
    own = lists.where(F.col("question") == match.question)
    by = [F.lit(number).alias("predicate"), "batch_id", "bucket"]
    if match.op == "equals":
        hit = (F.col("kind") == "whole") & (F.col("entry") == F.md5(F.lower(F.lit(str(match.value)))))
        return own.where(hit).select(*by, "bits")
    if match.op == "contains":
        text = F.lit(str(match.value).lower())
        own = own.where(F.col("kind") == "gram")
        if len(str(match.value).lower()) < GRAM:
            return own.where(F.contains("entry", text)).groupBy(*by[1:]).agg(F.bitmap_or_agg("bits").alias("bits")).select(by[0], "batch_id", "bucket", "bits")
        searched = str(match.value).lower()
        grams = sorted({searched[i : i + GRAM] for i in range(len(searched) - GRAM + 1)})
        met = own.where(F.col("entry").isin(grams)).groupBy("batch_id", "bucket").agg(
            F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("n")
        )
        return met.where(F.col("n") == len(grams)).select(*by, "bits")
    if match.op in ("at_least", "at_most"):
        edge = _bin(F.lit(float(match.value)))
        # A bin more, as rounding may put equal numbers on either side of an edge.
        inside = F.col("number") >= edge - 1 if match.op == "at_least" else F.col("number") <= edge + 1
        met = own.where((F.col("kind") == "bin") & inside).groupBy("batch_id", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        return met.select(*by, "bits")
    raise ValueError(f"unknown operator: {match.op}")


def candidates(spark: SparkSession, path: str, predicates: list[Match]) -> DataFrame:
    """``predicate, question, fingerprint`` that the lists of all batches can't rule out."""
    lists = _table(spark, f"{path}/lists", LISTS)
    bitmaps = reduce(DataFrame.unionByName, [_wanted(lists, i, m) for i, m in enumerate(predicates)])
    merged = bitmaps.groupBy("predicate", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    places = merged.select("predicate", "bucket", F.explode(_members(F.col("bits"))).alias("place"))
    # Bucket 1 begins with 1, bucket 0 ends with 0 and counts down from there.
    up = (F.col("bucket") - 1) * BUCKET + F.col("place") + 1
    down = F.col("bucket") * BUCKET - F.col("place")
    fingerprint = F.when(F.col("bucket") > 0, up).otherwise(down)
    questions = local_table(spark, [(i, m.question) for i, m in enumerate(predicates)], "predicate int, question string")
    return places.select("predicate", fingerprint.alias("fingerprint")).join(questions, "predicate")


def search_indexed(spark: SparkSession, fingerprints: DataFrame, path: str, queries: dict[int, object]) -> DataFrame:
    """What :func:`strataflow.operators.search.search` finds in the answers of all batches, by ``search_id``."""
    predicates = list(dict.fromkeys(m for q in queries.values() for m in matches_of(q)))
    found = stage(candidates(spark, path, predicates))
    wanted = found.select("question", "fingerprint").distinct().withColumn("slab", _slab(F.col("fingerprint")))
    # Folders without a candidate are not opened; their names are fewer than those the driver lists anyway.
    folders = wanted.groupBy("question").agg(F.collect_set("slab").alias("slabs")).collect()
    opened = [(F.col("question") == r["question"]) & F.col("slab").isin(r["slabs"]) for r in folders]
    values = _table(spark, f"{path}/values", VALUES).where(reduce(lambda a, b: a | b, opened, F.lit(False)))
    own = values.join(stage(wanted), ["question", "slab", "fingerprint"], "left_semi")
    newest = own.groupBy("question", "fingerprint").agg(F.max("batch_id").alias("batch_id"))
    current = stage(own).join(newest, ["question", "fingerprint", "batch_id"], "left_semi").select("question", "fingerprint", "value")
    flags = {m: F.max(m.column()) for m in predicates}
    return combined_hits(fingerprints, current, queries, flags)
