"""Mixing sources to target weights by systematic sampling.

The expected copies of the documents of a source are summed up in order; one random offset
is added per source, and a document is taken once for each whole number that its part of
the running sum crosses. Documents stand in the order of their size, so that long and short
ones are taken evenly and the words taken come near the target.

Expected copies are whole numbers of 2**-24, so sums are exact in any order and reruns
agree. Defined cases: a null text has size 0; null is a source of its own, the last one; a
source without words takes none; repeated rows are documents of their own; an empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import fresh, join_units, ordered_stage, unit_starts, word_count
from strataflow.session import stage

UNIT_BITS = 24
ONE = 1 << UNIT_BITS


def offset(source: Column, seed: int) -> Column:
    """A number from 0 up to one whole, the same in every run."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("\x00"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 6), 16, 10).cast("long")


def source_targets(
    sizes: DataFrame, source: str, weights: Sequence[int], share_percent: int, most: int
) -> DataFrame:
    """Target of each source: its share by weight, at most ``most`` times its size.

    Sources stand in code point order, null last, and take the weights in turn. What a
    source can't take goes to the others by weight, until none is above its limit: all
    free sources then have the same target per weight, the level. Each step is one
    aggregate over the sources and limits one source at least.
    """
    if most * 100 < share_percent:
        raise ValueError("the limits don't leave room for the share")
    names = ["_weight", "_place", "_unit", "_first", "_start"]
    weight, place, unit, first, start = names
    all_rows = sizes.withColumn("_all", F.lit(0))
    placed = ordered_stage(all_rows, [F.col(source).asc_nulls_last()], place)
    units = unit_starts(placed, "_all", place, F.count(F.lit(1)), (unit, first, start))
    rank = F.col(start) + F.col(place) - F.col(first)
    pick = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (rank % len(weights) + 1).cast("int"))
    table = stage(join_units(placed, units, "_all", place, unit).select(source, "source_size", pick.alias(weight)))
    limit = F.col("source_size") * F.lit(most)
    wide, weighed = limit.cast("decimal(38,0)"), F.col(weight).cast("decimal(38,0)")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level = (0, 1)  # words per weight, as a fraction
    while True:
        limited = wide * F.lit(Decimal(level[1])) <= weighed * F.lit(Decimal(level[0]))
        taken, free = table.agg(
            F.coalesce(F.sum(F.when(limited, limit)), F.lit(0).cast("long")),
            F.coalesce(F.sum(F.when(~limited, F.col(weight))), F.lit(0).cast("long")),
        ).first()
        after = (total * share_percent - taken * 100, 100 * free)
        if free == 0 or after == level:
            break
        level = after
    # Products stay exact: numbers of words fit doubles, the division comes last.
    shared = F.col(weight).cast("double") * F.lit(float(level[0])) / F.lit(float(max(level[1], 1)))
    target = F.when(limited, limit.cast("double")).otherwise(shared)
    return table.select(source, "source_size", target.alias("target"))


def systematic_copies(
    df: DataFrame, group: str, expected: Column, order: Sequence[str], seed: int, copies: str
) -> DataFrame:
    """Number of times each row is taken: whole numbers its part of the running sum crosses.

    ``expected``: expected copies in units of 2**-24. Ranges of (group, order) are summed
    by themselves, and the totals of earlier ranges are added.
    """
    share, place, unit, first, start, end = fresh(df, "share", "place", "unit", "first", "start", "end")
    placed = ordered_stage(df.withColumn(share, expected.cast("long")), [group, *order], place)
    units = unit_starts(placed, group, place, F.sum(share), (unit, first, start))
    within = Window.partitionBy(group, unit).orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    joined = join_units(placed, units, group, place, unit)
    summed = joined.withColumn(end, F.sum(share).over(within) + F.col(start) + offset(F.col(group), seed))
    crossed = F.shiftright(end, UNIT_BITS) - F.shiftright(F.col(end) - F.col(share), UNIT_BITS)
    return summed.withColumn(copies, crossed.cast("long")).drop(share, place, unit, first, start, end)


def mix(
    df: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share_percent: int = 150,
    most: int = 2,
    seed: int = 42,
    source: str = "source",
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Every document with its size, source_size, target of its source, copies and words taken.

    Columns: key, size, source_size, target, taken, source, copies.
    """
    # Sizes are taken from the texts once; all that follows reads this narrow table.
    sized = stage(df.select(
        F.col(key).alias("_key"),
        F.col(source).cast("string").alias("_source"),
        word_count(F.col(text)).alias("size"),
        F.crc32(F.col(text).cast("binary")).alias("_check"),
    ))
    sizes = sized.groupBy("_source").agg(F.sum("size").alias("source_size"))
    targets = stage(source_targets(sizes, "_source", weights, share_percent, most))
    named = targets.withColumnRenamed("_source", "_other")
    rows = sized.join(named, F.col("_source").eqNullSafe(F.col("_other"))).drop("_other")
    rate = F.floor(F.col("target") / F.col("source_size") * F.lit(float(ONE)) + F.lit(0.5))
    expected = F.when(F.col("source_size") > 0, rate).otherwise(F.lit(0).cast("long"))
    taken = systematic_copies(rows, "_source", expected, ["size", "_key", "_check"], seed, "copies")
    return taken.select(
        F.col("_key").alias(key),
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        F.col("_source").alias("source"),
        "copies",
    )


def mixed_documents(df: DataFrame, **settings) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with their own columns.

    Texts are written once and shuffled once; the plan of the mix works on sizes alone.
    """
    key, text, source = (settings.pop(k, k if k != "key" else "doc_id") for k in ("key", "text", "source"))
    row, other, copies, size = fresh(df, "row", "row_taken", "copies", "size")
    stored = stage(df.withColumn(row, F.monotonically_increasing_id()))
    # The row's own number takes the place of the key: repeated rows are told apart.
    narrow = stored.select(
        F.struct(F.col(key).alias("key"), F.col(row).alias("row")).alias("id"), F.col(source).alias("source"),
        F.col(text).alias("text"),
    )
    taken = mix(narrow, source="source", key="id", text="text", **settings)
    often = taken.where(F.col("copies") > 0).select(F.col("id")["row"].alias(other), F.col("copies").alias(copies))
    joined = stored.join(often, F.col(row) == F.col(other))
    each = joined.withColumn(size, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))))
    return each.select(*df.columns)
