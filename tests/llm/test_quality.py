from __future__ import annotations

import pytest

from strataflow.llm import quality
from tests.llm.helpers import documents, measures, odd_documents, odd_rows, with_clashes

TEXTS = [
    "a b c d e a b c d e",
    "a b c d e f a b c d",
    "x " * 40,
    "one two three four five six seven eight nine ten\n" * 3,
    "same line here\nsame line here\n\n \n\t\nother line",
    "# * $ % & | < > plain words that come after the symbols stand here",
    " lead and trail \x0b\x0c words \r\n with\todd  spaces ",
    "a\u00a0b is one word as no-break spaces do not count",
    "a b c d e x a b c d e y a b c d e",
]


def test_measures_by_brute_force(spark):
    rows = [(i, t, "en", "s") for i, t in enumerate(TEXTS)] + [(100 + i, *r[1:]) for i, r in enumerate(odd_rows())]
    texts = {r[0]: r[1] for r in rows}
    for r in quality.measured(documents(spark, rows)).collect():
        found = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert found == measures(texts[r.doc_id]), texts[r.doc_id]


def test_bits_and_policies(spark):
    entries = quality.judged(with_clashes(odd_documents(spark))).collect()
    assert len(entries) == len(odd_rows())
    assert list(quality.rules()) == list(quality.RULE_NAMES)
    for r in entries:
        few, repeated = r.n_words < 10, 100 * r.n_repeat_words > 20 * r.n_words
        assert (bool(r.failed & 1), bool(r.failed & 2)) == (few, repeated)
        assert r.base_failed == (few or repeated)
        assert r.kept == (r.failed & quality.mask(quality.POLICIES[quality.PRODUCTION]) == 0)
        assert not (r.base_failed and r.kept)
    assert quality.judged(documents(spark, [])).count() == 0


@pytest.mark.parametrize("policy", sorted(quality.POLICIES))
def test_ablations_by_brute_force(spark, policy):
    rows = [(i, t, "en", "s") for i, t in enumerate(TEXTS * 2)]
    entries = quality.ledger(documents(spark, rows))
    failed = [r.failed for r in entries.collect()]
    names = quality.POLICIES[policy]
    whole = quality.mask(names)
    found = {r.rule: r for r in quality.ablations(entries).where(f"policy = {policy}").collect()}
    assert set(found) == set(names)
    for name, r in found.items():
        bit = quality.mask([name])
        assert r.documents == len(failed)
        assert r.kept == sum(f & whole == 0 for f in failed)
        assert r.failed_rule == sum(f & bit != 0 for f in failed)
        assert r.kept_without == sum(f & whole & ~bit == 0 for f in failed)
        assert r.removed_alone == sum(f & whole == bit for f in failed)


def test_ablations_of_nothing(spark):
    rows = quality.ablations(quality.ledger(documents(spark, []))).collect()
    assert rows and all(r.documents == r.kept == 0 for r in rows)
