"""Small inputs with every odd case, and plain versions of the operators."""

from __future__ import annotations

import re
from collections import Counter

import xxhash

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use for columns of their own.
CLASHING = (
    "size row fp root kept held share place unit first start end tie answer key data id copies copy predicted score "
    "shard slot law words lines windows value probability failed listed host _key _data _text _place _state _rule"
).split()

PLAIN = (
    "the small engine reads every table once and writes what it found to the shared folder before the next "
    "step begins so that nothing is lost when a machine goes away during the night"
)
LONG = " ".join(f"word{i % 977}x{i % 13} and then" for i in range(60_000))


def documents(spark, rows):
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows], SCHEMA)


def odd_rows():
    """Nulls in any column, empty and very long texts, ties, repeated rows, odd characters."""
    return [
        (1, PLAIN, "en", "a"),
        (2, PLAIN, "en", "a"),
        (2, PLAIN, "en", "a"),
        (3, None, "en", "a"),
        (4, "", "fr", "b"),
        (5, " \n\t ", "fr", "b"),
        (6, "12 34 !? 56", None, "b"),
        (None, PLAIN + " again and again", "en", None),
        (None, None, None, None),
        (7, LONG, "en", "c"),
        (8, "x" * 200_000, "de", "c"),
        (9, "Ünïcödé 文字 \U0001f600 ﬁn\nnext line\n\nlast", "de", "é"),
        (10, "one", None, ""),
        (11, PLAIN.upper(), "en", "a"),
    ]


def odd_documents(spark):
    return documents(spark, odd_rows())


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(i).alias(name) for i, name in enumerate(CLASHING)])


def jump(key: int, shards: int) -> int:
    """Jump consistent hash as published."""
    key %= 1 << 64
    last, at = -1, 0
    while at < shards:
        last = at
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        at = int((last + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return last


def words_of(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def simhash(text: str | None, width: int = 3) -> int:
    words = words_of(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(links: list[tuple], nodes: list) -> dict:
    """Smallest node that each node reaches."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return {n: find(n) for n in nodes}


def near_links(prints: list[int], most: int = 2) -> list[tuple]:
    return [(a, b) for i, a in enumerate(prints) for b in prints[:i] if (a ^ b).bit_count() <= most]


def measures(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = words_of(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {p for i, w in enumerate(windows) if often[w] > 1 for p in range(i, i + 5)}
    lines = [line for line in (text or "").split("\n") if words_of(line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)
