"""URL filters: host rules first, then an exact Bloom filter cascade over the known hosts.

Level 1 of the cascade holds the listed keys. Every other key of the universe that level 1
lets through by mistake goes into level 2, every listed key that level 2 lets through into
level 3, and so on until a level makes no mistake. A key of the universe is listed exactly if
the first level that refuses it is an even one, so rows need no join with the list.

Keys are held as two 64-bit hashes. Each level is built in Spark: keys set bits, bits are combined
by word before the shuffle. The list is cut by hash into parts of at most ``PART_KEYS``
listed keys on average, each part has a cascade of its own of bounded size and judges the rows whose key falls
into it; with more than one part the rows are written between passes.

Defined cases: a null url, or one without ``://``, has empty host and path, fits no rule and
is asked for as the empty key; equal urls get equal verdicts; an empty list blocks nothing;
other columns are left out; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import shipped, unpacked
from strataflow.session import stage

ALLOW, BLOCK = "allow", "block"
PART_KEYS = 1 << 22
# Share of false positives: few in the first level, which all keys pass, more in later ones.
FIRST_SHARE, LATER_SHARE = 0.01, 0.1
MOST_LEVELS = 64


@dataclass(frozen=True)
class Rule:
    """A host with its subdomains, and the start of a path."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return _ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (text, verdict) of the longest rule that fits; null if none does."""
    found = F.lit(None).cast("struct<text:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


@dataclass(frozen=True)
class Level:
    """Bits of one Bloom filter."""

    number: int
    size: int
    probes: int
    words: np.ndarray

    @staticmethod
    def shape(keys: int, share: float) -> tuple[int, int]:
        """Bits and probes for so many keys."""
        bits = max(64, math.ceil(-keys * math.log(share) / math.log(2) ** 2))
        return -(-bits // 64) * 64, max(1, round(-math.log2(share)))

    def holds(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        found = np.ones(len(first), dtype=bool)
        for at in places(first, second, self.number, self.size, self.probes):
            found &= (self.words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return found


def _mixed(values: np.ndarray, salt: int) -> np.ndarray:
    mixed = values.view(np.uint64) + np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    mixed = (mixed ^ mixed >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ mixed >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return mixed ^ mixed >> np.uint64(31)


def places(first: np.ndarray, second: np.ndarray, level: int, size: int, probes: int) -> Iterator[np.ndarray]:
    """Bits of each key in a level: every level hashes anew."""
    start, step = _mixed(first, level), _mixed(second, level) | np.uint64(1)
    for i in range(probes):
        yield (start + np.uint64(i) * step) % np.uint64(size)


def key_hashes(key: Column) -> list[Column]:
    return [F.xxhash64(F.lit(1), key), F.xxhash64(F.lit(2), key)]


def _set_bits(level: int, size: int, probes: int):
    def set_bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            first, second = (pdf[c].to_numpy(np.int64) for c in ("first", "second"))
            at = np.unique(np.concatenate(list(places(first, second, level, size, probes))))
            word = (at >> np.uint64(6)).astype(np.int64)
            begins = np.nonzero(np.diff(word, prepend=-1))[0]
            bits = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), begins)
            yield pd.DataFrame({"word": word[begins], "bits": bits.view(np.int64)})

    return set_bits


def _level(keys: DataFrame, count: int, number: int) -> Level:
    share = FIRST_SHARE if number == 1 else LATER_SHARE
    size, probes = Level.shape(count, share)
    words = np.zeros(size // 64, dtype=np.uint64)
    rows = keys.select("first", "second").mapInPandas(_set_bits(number, size, probes), "word long, bits long")
    # At most size / 64 words, which the part bounds.
    found = rows.groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    words[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(np.uint64)
    return Level(number, size, probes, words)


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    sent = shipped(keys.sparkSession, level)

    def passing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked = unpacked(sent)
        for pdf in batches:
            yield pdf[asked.holds(*(pdf[c].to_numpy(np.int64) for c in ("first", "second")))]

    return stage(keys.mapInPandas(passing, keys.schema))


def cascade(listed: DataFrame, others: DataFrame) -> list[Level]:
    """Levels that tell the listed keys from the others; both have the hashes first, second."""
    inside, outside = stage(listed.distinct()), stage(others.distinct())
    levels: list[Level] = []
    held, asked = inside, outside
    while count := held.count():
        if len(levels) == MOST_LEVELS:
            raise ValueError("listed and other keys can't be told apart")
        levels.append(_level(held, count, len(levels) + 1))
        held, asked = _passing(asked, levels[-1]), held
    return levels


def is_listed(levels: Sequence[Level], first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Listed keys are refused first by an even level, or by none after an odd number of levels."""
    answer = np.zeros(len(first), dtype=bool)
    passing = np.arange(len(first))
    for level in levels:
        passing = passing[level.holds(first[passing], second[passing])]
        answer[passing] = level.number % 2 == 1
    return answer


def _member(sent: Broadcast) -> Callable[[Column, Column], Column]:
    @F.pandas_udf("boolean")
    def member(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        levels = unpacked(sent)
        for first, second in batches:
            yield pd.Series(is_listed(levels, first.to_numpy(np.int64), second.to_numpy(np.int64)))

    return member


def with_membership(rows: DataFrame, key: str, universe: DataFrame, name: str, part_keys: int = PART_KEYS) -> DataFrame:
    """Rows with a flag whether their key is listed.

    ``universe`` has every key of the rows with a flag ``listed``; a key that is flagged once is listed.
    """
    first, second = key_hashes(F.col("key"))
    keys = universe.groupBy("key").agg(F.max("listed").alias("listed"))
    keys = stage(keys.select(first.alias("first"), second.alias("second"), "listed"))
    parts = max(1, -(-keys.where("listed").count() // part_keys))
    first, second = key_hashes(F.col(key))
    for part in range(parts):
        here = keys.where(F.pmod("first", F.lit(parts)) == part)
        levels = cascade(here.where("listed").drop("listed"), here.where(~F.col("listed")).drop("listed"))
        answer = _member(shipped(rows.sparkSession, levels))(first, second)
        if parts == 1:
            return rows.withColumn(name, answer)
        own = F.pmod(first, F.lit(parts)) == part
        before = F.col(name) if part else F.lit(False)
        rows = stage(rows.withColumn(name, F.when(own, answer).otherwise(before)))
    return rows


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    is_blocked: Callable[[Column], Column],
    key: str = "page_id",
    url: str = "url",
    part_keys: int = PART_KEYS,
) -> DataFrame:
    """Key, host, path, rule, verdict and ``listed`` of every row.

    The blocklist names hosts: those of the pages for which ``is_blocked`` is true.
    """
    rows = pages.select(F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    universe = rows.select(F.col("host").alias("key"), is_blocked(F.col("host")).alias("listed"))
    flagged = with_membership(rows, "host", universe, "listed", part_keys)
    ruled = flagged.withColumn("_rule", longest_rule(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("listed"), F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return ruled.select(
        key,
        "host",
        "path",
        F.col("_rule")["text"].alias("rule"),
        F.coalesce(F.col("_rule")["verdict"], own).alias("verdict"),
        "listed",
    )
