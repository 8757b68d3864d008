"""Sharding by jump consistent hashing, with built-in functions only.

The key decides the shard: a chain of jumps, each drawn from a 64-bit congruential
generator, names the shard a key sits in for every number of shards. The last jump below n is the
shard among n, so the same chain also tells where a key goes when a shard is appended;
it stays, or it moves into the new shard.

Defined cases: a null key is a key like any other; whole-number keys are used as they are,
other types by their 64-bit hash; a null text has 8 bytes of size and no checksum; repeated
rows keep a slot each; other columns of the input are left out of ``assign`` unless named
in ``keep``; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.llm.common import join_units, ordered_stage, unit_starts

# Multiplier 2862933555777941757 of the generator, in halves of 32 bits.
MULTIPLIER_HIGH, MULTIPLIER_LOW = 0x27BB2EE6, 0x87B0B0FD
LOW_16, LOW_32 = 0xFFFF, 0xFFFFFFFF
# Jumps that one pass over the chain allows for; longer chains take a second pass.
CHAIN = 48


def _times(left: Column, right: int) -> Column:
    """Product of two 32-bit numbers, its lower 32 bits, without overflow."""
    upper = (F.shiftright(left, 16) * F.lit(right)).bitwiseAND(F.lit(LOW_16))
    return (left.bitwiseAND(F.lit(LOW_16)) * F.lit(right) + F.shiftleft(upper, 16)).bitwiseAND(F.lit(LOW_32))


def _state(high: Column, low: Column, jump: Column, shard: Column, grown: Column) -> Column:
    return F.struct(
        high.alias("high"), low.alias("low"), jump.alias("jump"), shard.alias("shard"), grown.alias("grown")
    )


def _advance(state: Column, shards: int) -> Column:
    """One jump of the chain; nothing once it has left the grown number of shards."""
    high, low, jump = state["high"], state["low"], state["jump"]
    lower = low.bitwiseAND(F.lit(LOW_16)) * F.lit(MULTIPLIER_LOW)
    upper = F.shiftright(low, 16) * F.lit(MULTIPLIER_LOW)
    total = lower + F.shiftleft(upper.bitwiseAND(F.lit(LOW_16)), 16) + F.lit(1)
    carry = F.shiftright(total, 32) + F.shiftright(upper, 16)
    next_high = (carry + _times(high, MULTIPLIER_LOW) + _times(low, MULTIPLIER_HIGH)).bitwiseAND(F.lit(LOW_32))
    # The draw is the upper 31 bits of the state; a double holds each step exactly enough.
    draw = F.lit(2147483648.0) / (F.shiftright(next_high, 1) + F.lit(1)).cast("double")
    moved = _state(
        next_high,
        total.bitwiseAND(F.lit(LOW_32)),
        F.floor((jump + F.lit(1)).cast("double") * draw),
        F.when(jump < shards, jump).otherwise(state["shard"]),
        jump,
    )
    return F.when(jump <= shards, moved).otherwise(state)


def _follow(state: Column, shards: int, steps: int) -> Column:
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), state, lambda s, _: _advance(s, shards))


def jump_state(key: Column, shards: int) -> Column:
    """Struct with ``shard`` among n and ``grown`` among n + 1 for a 64-bit key."""
    low = key.bitwiseAND(F.lit(LOW_32))
    high = F.shiftrightunsigned(key, 32)
    zero = F.lit(0).cast("long")
    begin = _state(high, low, zero, zero, zero)
    # A chain visits each shard once at most, and about ln(n) of them as a rule.
    state = _follow(begin, shards, min(shards + 1, CHAIN))
    if shards + 1 > CHAIN:
        state = F.when(state["jump"] <= shards, _follow(state, shards, shards + 1)).otherwise(state)
    return state


def stable_key(df: DataFrame, key: str) -> Column:
    """Whole numbers as they are, other types and nulls by hash."""
    kind = df.schema[key].dataType
    hashed = F.xxhash64(F.col(key))
    if isinstance(kind, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return F.coalesce(F.col(key).cast("long"), hashed)
    return hashed


def assign(
    df: DataFrame, shards: int, key: str = "doc_id", text: str = "text", keep: Sequence[str] = ()
) -> DataFrame:
    """Shard and gapless slot of every row: key, size, text_crc32, law, shard, slot, grown_shard.

    Slots follow the order of key, checksum and size within the shard. Rows are dealt out by
    ranges of (shard, order), so a shard is numbered by many tasks; only a row per range
    and shard is summed up.
    """
    if shards < 1:
        raise ValueError("there must be a shard")
    placed_as, state, unit, first, start = "_place", "_state", "_unit", "_first", "_start"
    kept = [F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)]
    rows = df.select(
        F.col(key),
        (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + F.lit(8)).cast("long").alias("size"),
        F.crc32(F.col(text).cast("binary")).cast("long").alias("text_crc32"),
        jump_state(stable_key(df, key), shards).alias(state),
        *kept,
    ).select(
        F.col(key),
        "size",
        "text_crc32",
        F.col(state)["shard"].cast("int").alias("shard"),
        F.col(state)["grown"].cast("int").alias("grown_shard"),
        *[f"_keep_{i}" for i in range(len(keep))],
    )
    placed = ordered_stage(rows, ["shard", key, "text_crc32", "size"], placed_as)
    units = unit_starts(placed, "shard", placed_as, F.count(F.lit(1)), (unit, first, start))
    joined = join_units(placed, units, "shard", placed_as, unit)
    return joined.select(
        key,
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col(start) + F.col(placed_as) - F.col(first)).alias("slot"),
        "grown_shard",
        *[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)],
    )


def write_shards(assigned: DataFrame, path: str) -> None:
    """One folder per shard; a repeated write replaces it."""
    assigned.write.mode("overwrite").partitionBy("shard").parquet(path)

