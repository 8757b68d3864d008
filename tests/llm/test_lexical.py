from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow.parquet as pq
import pytest

from strataflow.llm import lexical, workload
from tests.llm.helpers import documents, odd_documents, odd_rows, with_clashes

ITEMS = "item_id long, text string"


def _terms(text):
    folded = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(workload.TERM, folded)


def _ranked(docs, items, k=10):
    """Every document scored for every item, in whole numbers."""
    found = [(key, Counter(_terms(text))) for key, text, *_ in docs]
    found = [(key, c) for key, c in found if c]
    total, n_docs = sum(sum(c.values()) for _, c in found), len(found)
    df = Counter(t for _, c in found for t in c)
    rows = []
    for item, text in items:
        scored = []
        for key, held in found:
            m = 100 - 90 + (90 * sum(held.values()) * n_docs) // total
            score = 0
            for t in set(_terms(text)) & held.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * held[t]) // (1000 * held[t] + 8 * m))
            if score > 0:
                scored.append((-score, key is None, key or 0, key))
        rows += [(item, i + 1, key, -score) for i, (score, _, _, key) in enumerate(sorted(scored, key=lambda s: s[:3])[:k])]
    return sorted(rows, key=str)


def _rows(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=str)


ASKED = [
    (1, "The small engine: reads every TABLE"),
    (1, "The small engine: reads every TABLE"),
    (2, None),
    (3, ""),
    (4, "?? -- !!"),
    (None, "nothing is lost 文字 ünïcödé"),
    (5, "Ünïcödé word5x5 word12x12 then"),
    (6, "notherefound"),
    (7, "one one one " + "night " * 50_000),
]


@pytest.mark.parametrize(("docs_in_block", "few"), [(1 << 14, 4), (3, 1), (1, 4)])
def test_odd_rows_by_brute_force(spark, monkeypatch, docs_in_block, few):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", docs_in_block)
    monkeypatch.setattr(lexical, "FEW", few)
    items = spark.createDataFrame(ASKED, ITEMS)
    assert _rows(lexical.ranked(odd_documents(spark), items)) == _ranked(odd_rows(), ASKED)


@pytest.mark.parametrize("kept", [1 << 24, 0])
def test_many_documents(spark, monkeypatch, kept):
    """Ties, documents of many lengths, more ranges than one step splits."""
    monkeypatch.setattr(lexical, "KEPT_PAIRS", kept)
    monkeypatch.setattr(lexical, "FIRST_RANGES", 2)
    monkeypatch.setattr(lexical, "ITEMS", 4)
    docs = [(i, " ".join(f"w{(i * j) % 97}" for j in range(1 + i % 41)), "en", "a") for i in range(700)]
    docs += [(i + 900, docs[13][1], "en", "a") for i in range(60)]
    items = [(i, " ".join(f"w{(7 * i + j) % 101}" for j in range(1 + 3 * i))) for i in range(12)]
    found = lexical.ranked(documents(spark, docs).repartition(3), spark.createDataFrame(items, ITEMS), k=7)
    assert _rows(found) == _ranked(docs, items, k=7)


def test_passes_over_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(lexical, "ITEMS", 1)
    monkeypatch.setattr(lexical, "PASS_BYTES", 1)
    items = spark.createDataFrame(ASKED[:6], ITEMS)
    assert _rows(lexical.ranked(odd_documents(spark), items)) == _ranked(odd_rows(), ASKED[:6])


def test_long_text_and_empty_tables(spark):
    docs = [(1, " " * 3_000_000 + "needle" + "x" * 3_000_000, "en", "a"), (2, "needle " * 300_000, "en", "a"), (3, "a needle", "en", "a")]
    items = [(1, "needle"), (2, "needle" + "x" * 3_000_000)]
    asked = spark.createDataFrame(items, ITEMS)
    assert _rows(lexical.ranked(documents(spark, docs), asked)) == _ranked(docs, items)
    none = documents(spark, docs).limit(0)
    assert lexical.ranked(none, asked).count() == 0
    assert lexical.ranked(documents(spark, docs), asked.limit(0)).count() == 0


def test_a_row_group_of_the_index_holds_one_block(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", 1)
    docs = documents(spark, [(i, f"word {i}", "en", "a") for i in range(7)]).coalesce(1)
    blocks, n_docs = lexical.index(docs)
    files = [pq.ParquetFile(name.removeprefix("file://")).metadata for name in blocks.inputFiles()]
    assert n_docs == 7 and sum(m.num_rows for m in files) == 7
    assert all(m.row_group(i).num_rows == 1 for m in files for i in range(m.num_row_groups))


def test_clashing_names(spark):
    items = spark.createDataFrame(ASKED[:6], ITEMS)
    plain = _rows(lexical.ranked(odd_documents(spark), items))
    assert _rows(lexical.ranked(with_clashes(odd_documents(spark)), with_clashes(items))) == plain
