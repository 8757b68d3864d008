"""Language identification by prediction by partial matching.

For each language, a tree of byte contexts (order 4 down to 0) holds how often each byte
followed each context in a bounded sample of labelled texts. The statistics are frozen. A byte that
was seen after the longest context is coded there; else an escape is coded, whose probability
is the share of distinct followers (method C), and the next shorter context is asked; below
order 0 all 256 bytes are alike. The language with the shortest code for the whole text wins.

Counting, sampling and scoring run in Spark; the tables of a fitted model are bounded by the
sample: ``MOST_TEXTS`` texts and ``SAMPLE_BYTES`` bytes in all per language, of a text longer than ``LONGEST_TEXT`` bytes
a piece of that length at a place its hash tells, and travel as one broadcast.

A text is in none of the languages if the shortest code is longer than the text itself by more than ``SLACK_BITS``: then the
statistics say less than plain bytes do. Noise and languages that were not learned are told by this. It is not
asked as long as some language was learned from less than ``LEAST_LEARNED`` bytes.

Defined cases: a null text or one without letters is ``und`` with score 0; if nothing can be
learned every text is; ties go to the first language in code point order; repeated rows get
equal answers; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import BLOCK_BYTES, fresh, shipped, unpacked
from strataflow.session import stage

ORDER = 4
MOST_TEXTS, LONGEST_TEXT, SAMPLE_BYTES = 1000, 1 << 16, 1 << 21
UNDETERMINED = "und"
SLACK_BITS, LEAST_LEARNED = 64, 1 << 16


def byte_grams(data: bytes, at: int = 0, size: int | None = None) -> np.ndarray:
    """Codes of each byte of a piece with the four before it; zero bytes stand before the text."""
    end = len(data) if size is None else min(len(data), at + size)
    lead = max(0, ORDER - at)
    raw = np.frombuffer(b"\0" * lead + data[at - ORDER + lead : end], dtype=np.uint8).astype(np.uint64)
    n = len(raw) - ORDER
    codes = raw[:n].copy()
    for i in range(1, ORDER + 1):
        codes <<= np.uint64(8)
        codes |= raw[i : i + n]
    return codes


@dataclass(frozen=True)
class Tree:
    """Context statistics of one language: for each order the codes, counts and contexts."""

    grams: list[np.ndarray]
    counts: list[np.ndarray]
    contexts: list[np.ndarray]
    totals: list[np.ndarray]
    followers: list[np.ndarray]

    @classmethod
    def grown(cls, codes: np.ndarray, counts: np.ndarray) -> Tree:
        parts = []
        for order in range(ORDER + 1):
            grams, place = np.unique(codes & np.uint64((1 << 8 * (order + 1)) - 1), return_inverse=True)
            times = np.bincount(place, weights=counts, minlength=len(grams))
            contexts, of_gram = np.unique(grams >> np.uint64(8), return_inverse=True)
            totals = np.bincount(of_gram, weights=times, minlength=len(contexts))
            followers = np.bincount(of_gram, minlength=len(contexts)).astype(np.float64)
            parts.append((grams, times, contexts, totals, followers))
        return cls(*(list(p) for p in zip(*parts)))

    def code_lengths(self, codes: np.ndarray) -> np.ndarray:
        """Bits that the last byte of each code costs after the bytes before it."""
        bits = np.zeros(len(codes))
        left = np.arange(len(codes))
        for order in range(ORDER, -1, -1):
            part = codes[left] & np.uint64((1 << 8 * (order + 1)) - 1)
            context = part >> np.uint64(8)
            at, known = _find(self.contexts[order], context)
            room = self.totals[order][at] + self.followers[order][at]
            spot, seen = _find(self.grams[order], part)
            seen &= known
            with np.errstate(divide="ignore", invalid="ignore"):
                coded = np.log2(room) - np.log2(self.counts[order][spot])
                escaped = np.log2(room) - np.log2(self.followers[order][at])
            bits[left] += np.where(seen, coded, np.where(known, escaped, 0.0))
            left = left[~seen]
            if not len(left):
                return bits
        bits[left] += 8.0
        return bits


def _find(table: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, codes), len(table) - 1)
    return at, table[at] == codes


@dataclass(frozen=True)
class Places:
    """Place of each of many codes, by hash with linear probing; the number of codes if unknown."""

    keys: np.ndarray
    places: np.ndarray
    shift: int

    @classmethod
    def of(cls, codes: np.ndarray) -> Places:
        width = max(8, (4 * len(codes)).bit_length())
        keys = np.full(1 << width, FREE)
        places = np.full(1 << width, len(codes), dtype=np.int32)
        slots, left = _slots(codes, 64 - width), np.arange(len(codes))
        while len(left):
            open_ = left[keys[slots[left]] == FREE]
            taken, first = np.unique(slots[open_], return_index=True)
            keys[taken], places[taken] = codes[open_[first]], open_[first]
            left = left[keys[slots[left]] != codes[left]]
            slots[left] = (slots[left] + 1) & ((1 << width) - 1)
        return cls(keys, places, 64 - width)

    def find(self, codes: np.ndarray) -> np.ndarray:
        slots = _slots(codes, self.shift)
        found = self.keys[slots]
        answer = self.places[slots]
        left = np.nonzero((found != codes) & (found != FREE))[0]
        slots = slots[left]
        while len(left):
            slots = (slots + 1) & (len(self.keys) - 1)
            found = self.keys[slots]
            ended = (found == codes[left]) | (found == FREE)
            answer[left[ended]] = self.places[slots[ended]]
            left, slots = left[~ended], slots[~ended]
        return answer


# No code of five bytes; the multiplier spreads codes over the upper bits.
FREE, SPREAD = np.uint64(1 << 63), np.uint64(0x9E3779B97F4A7C15)


def _slots(codes: np.ndarray, shift: int) -> np.ndarray:
    return (codes * SPREAD >> np.uint64(shift)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """Trees of all languages, and the code lengths of every code seen in any of them."""

    languages: list[str]
    trees: list[Tree]
    places: Places
    bits: np.ndarray
    # Bytes that the language with the least of them was learned from.
    learned: int = 0

    @classmethod
    def of_counts(cls, counts: pd.DataFrame) -> Model:
        languages = sorted(counts["lang"].unique(), key=lambda s: s.encode())
        trees = []
        for language in languages:
            own = counts[counts["lang"] == language]
            trees.append(Tree.grown(own["gram"].to_numpy(np.int64).view(np.uint64), own["times"].to_numpy(np.float64)))
        known = np.unique(counts["gram"].to_numpy(np.int64).view(np.uint64))
        # The last row stands for codes that no tree has seen whole.
        bits = [np.append(t.code_lengths(known), 0.0) for t in trees]
        learned = int(counts.groupby("lang")["times"].sum().min()) if languages else 0
        return cls(languages, trees, Places.of(known), np.column_stack(bits) if bits else np.zeros((1, 0)), learned)

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each whole text under each language."""
        total = np.zeros((len(texts), len(self.languages)))
        rare: list[tuple[int, np.ndarray]] = []
        waiting = 0
        for row, data in enumerate(texts):
            for at in range(0, len(data), BLOCK_BYTES):
                codes = byte_grams(data, at, BLOCK_BYTES)
                place = self.places.find(codes)
                total[row] += np.ones(len(codes)) @ self.bits.take(place, axis=0)
                unseen = codes[place == len(self.bits) - 1]
                if len(unseen):
                    rare.append((row, unseen))
                    waiting += len(unseen)
                if waiting > BLOCK_BYTES:
                    self._add_rare(total, rare)
                    rare, waiting = [], 0
        if rare:
            self._add_rare(total, rare)
        return total

    def _add_rare(self, total: np.ndarray, rare: list[tuple[int, np.ndarray]]) -> None:
        codes, place = np.unique(np.concatenate([c for _, c in rare]), return_inverse=True)
        bits = np.column_stack([t.code_lengths(codes) for t in self.trees])[place]
        starts = np.cumsum([0, *(len(c) for _, c in rare[:-1])])
        np.add.at(total, [row for row, _ in rare], np.add.reduceat(bits, starts, axis=0))

    def predict(self, texts: list[bytes | None]) -> list[tuple[str, float, bool]]:
        """For each text the language with the shortest code, its share of the probability of all, and whether it fits."""
        answers = [(UNDETERMINED, 0.0, False)] * len(texts)
        asked = [i for i, t in enumerate(texts) if t is not None] if self.languages else []
        lengths = self.code_lengths([texts[i] for i in asked])
        for i, bits in zip(asked, lengths):
            share = 1.0 / np.exp2(np.maximum(bits.min() - bits, -1000.0)).sum()
            fits = self.learned < LEAST_LEARNED or bool(bits.min() <= 8 * len(texts[i]) + SLACK_BITS)
            answers[i] = (self.languages[int(bits.argmin())], float(share), fits)
        return answers


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for language, texts in pdf.groupby("lang", sort=False)["data"]:
            grams, times = np.unique(np.concatenate([byte_grams(t) for t in texts]), return_counts=True)
            yield pd.DataFrame({"lang": language, "gram": grams.view(np.int64), "times": times.astype(np.int64)})


def _smallest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of the rows of a task, the ``MOST_TEXTS`` smallest hashes per language."""
    held = None
    for pdf in batches:
        held = pdf if held is None else pd.concat([held, pdf])
        held = held.drop_duplicates(["lang", "hash"]).sort_values("hash").groupby("lang", sort=False).head(MOST_TEXTS)
    if held is not None:
        yield held


def sampled(labelled: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """``lang`` and ``data`` of the sample: per language, the texts that come first by hash.

    Hashes are ranked without their texts, and each task sends a bounded number of them; only the
    texts chosen are read further.
    """
    data = F.col(text).cast("binary")
    rows = labelled.select(F.xxhash64(F.col(key), data).alias("hash"), F.col(lang).alias("lang"), data.alias("data"))
    rows = rows.where(F.col("lang").isNotNull() & (F.octet_length("data") > 0))
    over = F.octet_length("data") - LONGEST_TEXT
    piece = F.substring("data", (F.pmod(F.col("hash"), over + 1) + 1).cast("int"), F.lit(LONGEST_TEXT))
    rows = rows.withColumn("data", F.when(over > 0, piece).otherwise(F.col("data")))
    hashes = rows.select("lang", "hash", F.octet_length("data").alias("bytes"))
    first = hashes.mapInPandas(_smallest, hashes.schema).groupBy("lang", "hash").agg(F.min("bytes").alias("bytes"))
    by_hash = Window.partitionBy("lang").orderBy("hash")
    # The limit on the rank applies in every task before the ranks of all are taken.
    ranked = first.withColumn("rank", F.row_number().over(by_hash)).where(F.col("rank") <= MOST_TEXTS)
    chosen = ranked.withColumn("upto", F.sum("bytes").over(by_hash)).where(F.col("upto") <= SAMPLE_BYTES)
    return rows.join(stage(chosen.select("lang", "hash")), ["lang", "hash"]).select("lang", "data")


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Frozen statistics of a bounded sample of the labelled texts."""
    counts = sampled(labelled, key, text, lang).mapInPandas(_count, "lang string, gram long, times long")
    return Model.of_counts(counts.groupBy("lang", "gram").agg(F.sum("times").alias("times")).toPandas())


def identified(df: DataFrame, model: Model, text: str, predicted: str, score: str, fits: str | None = None) -> DataFrame:
    """All rows with the predicted language, its score and, if it is named, whether the text fits that language."""
    sent = shipped(df.sparkSession, model)

    @F.pandas_udf("lang string, score double, fits boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        frozen = unpacked(sent)
        for texts in batches:
            yield pd.DataFrame(frozen.predict(list(texts)), columns=["lang", "score", "fits"])

    lettered = F.when(has_letter(F.col(text)), F.col(text).cast("binary"))
    (answer,) = fresh(df, "answer")
    told = df.withColumn(answer, predict(lettered))
    told = told.withColumn(predicted, F.col(answer)["lang"]).withColumn(score, F.col(answer)["score"])
    return (told if fits is None else told.withColumn(fits, F.col(answer)["fits"])).drop(answer)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def held_out(key: Column) -> Column:
    """Documents that nothing is learned from: a quarter, by checksum of the key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def predict_all(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Key, held_out, lang_pred and score of every row; learned from rows that are not held out."""
    model = fit(df.where(~held_out(F.col(key))), key, text, lang)
    rows = df.select(F.col(key), F.col(text).alias("_text"), held_out(F.col(key)).alias("held_out"))
    return identified(rows, model, "_text", "lang_pred", "score").drop("_text")


def in_a_language(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Rows in one of the learned languages, with the columns they had.

    Null texts, texts without letters and texts that fit no learned language go.
    """
    model = fit(df.where(~held_out(F.col(key))), key, text, lang)
    predicted, score, fits = fresh(df, "predicted", "score", "fits")
    kept = identified(df, model, text, predicted, score, fits).where((F.col(predicted) != UNDETERMINED) & F.col(fits))
    return kept.select(*df.columns)
