"""Quality rules as a ledger of bits, with built-in functions only.

Every rule is evaluated once per document. The ledger holds the measurements and one bit for
each rule that fails; a policy is a version with a set of rules, so it is a mask, and
applying it is one bitwise comparison. Ablations (what a policy keeps without one of its
rules, what only that rule removes) are sums over the few distinct bit patterns.

Repeated words are found inside the row: windows of five words are hashed, sorted with their
place, and equal neighbours mark the places that repeat. Texts are never exploded or shuffled.

Defined cases: a null text has no words, all measurements are 0 and the rules that ask for a
share of none pass; empty texts likewise; repeated rows are judged each; other columns are
left out; an empty table gives an empty ledger.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import words
from strataflow.session import local_table

WINDOW = 5
SYMBOLS = "[#*$%&|<>]"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def rules() -> dict[str, Column]:
    """Rules in the order of their bits: true for a document that fails. New rules go to the end."""
    n_words, per_word = F.col("n_words"), F.col("word_chars")
    return {
        "few_words": n_words < 10,
        "repeated_words": 100 * F.col("n_repeat_words") > 20 * n_words,
        "many_symbols": 100 * F.col("n_symbols") > 10 * n_words,
        "repeated_lines": 100 * F.col("n_dup_lines") > 30 * F.col("n_lines"),
        "short_words": per_word < 3 * n_words,
        "long_words": per_word > 12 * n_words,
    }


RULE_NAMES = ("few_words", "repeated_words", "many_symbols", "repeated_lines", "short_words", "long_words")
BASE = ("few_words", "repeated_words")
# Policies by version; a version never changes, a new set of rules is a new version.
POLICIES = {1: BASE, 2: (*BASE, "many_symbols"), 3: RULE_NAMES}
# The rules beyond version 2 remove next to nothing but documents labelled good (see ablations).
PRODUCTION = 2


def mask(names: Sequence[str]) -> int:
    return sum(1 << bit for bit, name in enumerate(RULE_NAMES) if name in names)


def measured(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and measurements of every row."""
    full = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(full, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    split = df.select(
        F.col(key),
        words(F.col(text)).alias("words"),
        lines.alias("lines"),
        F.regexp_count(full, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
    )
    hashed = split.select(
        key,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.concat_ws("", "words")).cast("long").alias("word_chars"),
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    # Windows only exist in texts that are long enough: a sequence may not run backwards.
    starts = F.sequence(F.lit(0), F.size("hashes") - WINDOW)
    window = F.transform(starts, lambda i: F.xxhash64(*[F.get("hashes", i + j) for j in range(WINDOW)]))
    windowed = hashed.withColumn("windows", F.when(F.col("n_words") >= WINDOW, window))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("hash"), i.alias("at"))))
    sorted_ = windowed.withColumn("ordered", F.when(repeats, ordered))
    same = F.filter(
        "ordered",
        lambda w, i: (w["hash"] == F.get("ordered", i - 1)["hash"]) | (w["hash"] == F.get("ordered", i + 1)["hash"]),
    )
    places = F.array_sort(F.transform(same, lambda w: w["at"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total")),
        lambda s, at: F.struct(at.alias("last"), (s["total"] + F.least(F.lit(WINDOW), at - s["last"])).alias("total")),
        lambda s: s["total"],
    )
    repeated = F.when(F.col("ordered").isNotNull(), covered).otherwise(F.lit(0)).cast("long")
    return sorted_.withColumn("n_repeat_words", repeated).select(key, *MEASURES)


def ledger(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, measurements and ``failed``, a bit for each rule that the document fails."""
    failed = F.lit(0).cast("long")
    for bit, condition in enumerate(rules().values()):
        failed = failed.bitwiseOR(F.when(condition, F.lit(1 << bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return measured(df, key, text).withColumn("failed", failed)


def passes(failed: Column, names: Sequence[str]) -> Column:
    """Whether a document fails none of the rules."""
    return failed.bitwiseAND(F.lit(mask(names))) == 0


def judged(df: DataFrame, policy: int = PRODUCTION, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The ledger with ``base_failed``, ``kept`` and the ``policy`` applied."""
    kept = passes(F.col("failed"), (*BASE, *POLICIES[policy]))
    return ledger(df, key, text).select(
        "*", (~passes(F.col("failed"), BASE)).alias("base_failed"), kept.alias("kept"), F.lit(policy).alias("policy")
    )


def ablations(entries: DataFrame) -> DataFrame:
    """For each policy and rule: documents, kept, failed by the rule, removed by it alone, kept without it."""
    patterns = entries.groupBy("failed").agg(F.count(F.lit(1)).alias("rows"))
    rows = [(v, name, mask(names), mask([name])) for v, names in POLICIES.items() for name in names]
    table = local_table(entries.sparkSession, rows, "policy int, rule string, rules_mask long, rule_bit long")
    within = F.col("failed").bitwiseAND(F.col("rules_mask"))
    without = within.bitwiseAND(F.bitwise_not("rule_bit"))

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("rows"))), F.lit(0).cast("long"))

    # At most 2 ** rules patterns meet the short list of rules.
    return (
        table.join(F.broadcast(patterns), F.lit(True), "left")
        .groupBy("policy", "rule")
        .agg(
            total(F.lit(True)).alias("documents"),
            total(within == 0).alias("kept"),
            total(within.bitwiseAND(F.col("rule_bit")) != 0).alias("failed_rule"),
            total((within != 0) & (without == 0)).alias("removed_alone"),
            total(without == 0).alias("kept_without"),
        )
    )
