"""Token counts by offset: whole documents are encoded once, tokens go to sections by their spans.

A text is encoded by a byte-level tokenizer, whose tokens laid end to end are the text again;
the lengths of the tokens give their spans. Sections are stated by their first characters; the
default ones are lines, each with its line break. Spans and sections are joined by
interval inside the task, and a token that crosses a boundary is given by rule:

- ``first``: to the section with its first byte;
- ``most``: to the section with most of its bytes, the first of equals;
- ``split``: to every section it touches, by its share of bytes.

The vocabulary file is a parameter; every node that runs tasks must have it at that path.

The tokenizer's pattern looks ahead in white space and overflows its stack on very long runs of it. Such runs
are cut out first, where the pattern must cut anyway: a run without its last character is one piece if
something follows, and the last character begins the next one.

Defined cases: texts of any length are encoded whole, as are runs of one kind of character; a null text has no section; an empty text has one empty section without tokens;
special tokens are plain text; repeated rows are counted each; other columns are left out;
an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIRST, MOST, SPLIT = "first", "most", "split"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how this vocabulary cuts a text into words before merging bytes.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Fixed value: how patterns with such a cut treat white space, and the characters that are white space to them.
SPACE_CUT = r"|\s+(?!\S)|\s+"
LONG_SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1024,}")
SECTIONS = "array<struct<section:long,start_char:long,end_char:long,n_tokens:double,n_crossing:long>>"


class Encoder:
    """Token spans of a text, in bytes."""

    def __init__(self, vocabulary: str, pattern: str):
        ranks = {}
        for line in Path(vocabulary).read_bytes().splitlines():
            if line:
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        self.lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.one_piece = None
        if pattern.endswith(SPACE_CUT):
            self.one_piece = tiktoken.Encoding("piece", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})

    def tokens(self, text: str) -> Iterator[list[int]]:
        """Tokens of a text, in lists."""
        at = 0
        for run in LONG_SPACES.finditer(text) if self.one_piece else ():
            yield self.encoding.encode_ordinary(text[at : run.start()])
            at = run.end() - (run.end() < len(text))
            yield self.one_piece.encode_ordinary(text[run.start() : at])
        yield self.encoding.encode_ordinary(text[at:])

    def ends(self, text: str) -> np.ndarray:
        """Byte after each token."""
        found = [np.array(tokens, dtype=np.int64) for tokens in self.tokens(text)]
        return self.lengths[np.concatenate(found)].cumsum()


@cache
def encoder(vocabulary: str, pattern: str) -> Encoder:
    return Encoder(vocabulary, pattern)


def line_starts(data: bytes) -> np.ndarray:
    """First byte of each line; a line ends with its line break."""
    breaks = np.nonzero(np.frombuffer(data, dtype=np.uint8) == 10)[0] + 1
    return np.concatenate([[0], breaks[breaks < len(data)]]).astype(np.int64)


def attributed(ends: np.ndarray, starts: np.ndarray, size: int, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens given to each section, and the boundary-crossing tokens that touch it."""
    begins = np.concatenate([[0], ends]).astype(np.int64)[: len(ends)]
    low = np.searchsorted(starts, begins, "right") - 1
    high = np.searchsorted(starts, np.maximum(ends - 1, begins), "right") - 1
    given = np.bincount(low, minlength=len(starts)).astype(np.float64)
    crossing = np.zeros(len(starts), dtype=np.int64)
    limits = np.append(starts, size)
    for token in np.nonzero(high > low)[0]:
        touched = np.arange(low[token], high[token] + 1)
        part = np.minimum(limits[touched + 1], ends[token]) - np.maximum(limits[touched], begins[token])
        crossing[touched] += 1
        if rule == SPLIT:
            given[low[token]] -= 1.0
            given[touched] += part / part.sum()
        elif rule == MOST:
            given[low[token]] -= 1.0
            given[touched[part.argmax()]] += 1.0
    return given, crossing


def char_places(data: bytes, places: np.ndarray) -> np.ndarray:
    """Character at each byte place; places are character boundaries."""
    follows = (np.frombuffer(data, dtype=np.uint8) & 0xC0) == 0x80
    before = np.concatenate([[0], np.cumsum(follows)])
    return places - before[places]


def count_sections(
    text: str, vocabulary: str, pattern: str, rule: str, starts_of: Callable[[bytes], np.ndarray] = line_starts
) -> list[tuple]:
    """Section, first character, character after, tokens and crossing tokens, for each section."""
    data = text.encode()
    starts = starts_of(data)
    ends = encoder(vocabulary, pattern).ends(text)
    given, crossing = attributed(ends, starts, len(data), rule)
    marks = char_places(data, np.append(starts, len(data)))
    return list(zip(range(len(starts)), marks[:-1].tolist(), marks[1:].tolist(), given.tolist(), crossing.tolist()))


def section_tokens(
    df: DataFrame,
    vocabulary: str = VOCABULARY,
    pattern: str = PATTERN,
    rule: str = FIRST,
    key: str = "doc_id",
    text: str = "text",
    starts_of: Callable[[bytes], np.ndarray] = line_starts,
) -> DataFrame:
    """A row for each section of each document: key, section, characters, tokens, crossing tokens."""
    if rule not in (FIRST, MOST, SPLIT):
        raise ValueError(f"unknown rule {rule!r}")
    names = ("section", "start_char", "end_char", "n_tokens", "n_crossing")

    @F.pandas_udf(SECTIONS)
    def sections(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(
                [
                    None if t is None else [dict(zip(names, s)) for s in count_sections(t, vocabulary, pattern, rule, starts_of)]
                    for t in texts
                ],
                dtype=object,
            )

    found = df.select(F.col(key), F.explode(sections(F.col(text))).alias("_section"))
    return found.select(key, "_section.*")
