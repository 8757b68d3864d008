"""Searches over the index give what a scan of the current answers gives."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strataflow.operators import answerindex
from strataflow.operators.answerindex import candidates, index_answers, search_indexed
from strataflow.operators.search import All, Any, Match, Not, search

SCHEMA = "fingerprint long, question string, value string"
VALUES = [
    None, "", " ", "a", "AB", "abc", "ABCdef", "xabcx", "İstanbul", "straße", "文字列です", "文", "12", "12.0", "-3.5", "1e3", "0", "-0.0",
    "NaN", "Infinity", "-Infinity", "12abc", "999999999999", "abc abc abc", "\U0001f600\U0001f601x\U0001f602", "a'b\"c\\d", "ab\nc",
]
IDS = [0, 1, 2, 32767, 32768, 32769, 65536, 65537, -1, -32767, -32768, -32769, 10**12, 10**12 + 32768, 2_097_152, 2_097_153]


def _batch(rng, part):
    keys = [(i, q) for i in [*IDS, *range(100, 160)] for q in ("q", "n") if rng.random() < part]
    return [(i, q, rng.choice(VALUES)) for i, q in keys]


def _queries():
    texts = ["abc", "a", "B", "文", "文字", "ß", "i̇st", "", "\U0001f601", "'b\"", "b\nc", "zzz", "abc abc", "c\\d"]
    singles = [Match("q", "contains", t) for t in texts] + [Match("n", "equals", t) for t in ("ABC", "12", "", "straße", "none")]
    singles += [Match("n", op, x) for op in ("at_least", "at_most") for x in (12, 0, -3.5, 1000, float("inf"), float("-inf"), 1e300)]
    trees = [
        All((Match("q", "contains", "a"), Not(Match("n", "at_least", 0)))),
        Any((Not(Match("q", "contains", "abc")), Match("n", "equals", "0"))),
        Not(All((Match("q", "contains", "b"), Match("n", "contains", "1")))),
        Match("unknown", "equals", "x"),
    ]
    return dict(enumerate([*singles, *trees]))


@pytest.mark.parametrize("seed", [1, 2])
def test_index_equals_scan(spark, tmp_path, seed):
    rng = random.Random(seed)
    path, current = str(tmp_path / "index"), {}
    for batch_id, part in enumerate((0.9, 0.4, 0.2)):
        rows = _batch(rng, part)
        current |= {(i, q): v for i, q, v in rows}
        index_answers(spark.createDataFrame(rows, SCHEMA).repartition(3), path, batch_id)
        if batch_id == 1:  # the same batch again
            index_answers(spark.createDataFrame(rows, SCHEMA), path, batch_id)
    fingerprints = spark.createDataFrame([(i,) for i in [*IDS, *range(100, 170)]], "fingerprint long")
    answers = spark.createDataFrame([(i, q, v) for (i, q), v in current.items()], SCHEMA)
    queries = _queries()
    scanned = sorted(search(fingerprints, answers, queries).select("search_id", "fingerprint").collect())
    assert sorted(search_indexed(spark, fingerprints, path, queries).select("search_id", "fingerprint").collect()) == scanned


def test_several_rows_of_a_question(spark, tmp_path):
    path = str(tmp_path / "index")
    rows = [(1, "q", "one"), (1, "q", "two"), (2, "q", "two")]
    index_answers(spark.createDataFrame(rows, SCHEMA), path, 0)
    index_answers(spark.createDataFrame([(2, "q", "one")], SCHEMA), path, 1)
    fingerprints = spark.createDataFrame([(1,), (2,), (3,)], "fingerprint long")
    queries = {1: Match("q", "equals", "two"), 2: Match("q", "contains", "on"), 3: Not(Match("q", "equals", "two"))}
    found = search_indexed(spark, fingerprints, path, queries).select("search_id", "fingerprint").collect()
    assert sorted(map(tuple, found)) == [(1, 1), (2, 1), (2, 2), (3, 2), (3, 3)]


def test_answers_without_candidates_are_not_read(spark, tmp_path):
    path = str(tmp_path / "index")
    rows = spark.range(0, 8_000_000, 1000).select(F.col("id").alias("fingerprint"), F.lit("q").alias("question"), F.concat(F.lit("value "), "id").alias("value"))
    index_answers(rows, path, 0)
    wanted = candidates(spark, path, [Match("q", "contains", "lue 7123000")])
    assert [r.fingerprint for r in wanted.collect()] == [7_123_000]
    # Broken files elsewhere are never opened.
    for file in (tmp_path / "index/values/batch_id=0/question=q/slab=1").glob("*.parquet"):
        file.write_bytes(b"broken")
    fingerprints = rows.select("fingerprint")
    found = search_indexed(spark, fingerprints, path, {5: Match("q", "contains", "lue 7123000")})
    assert [tuple(r) for r in found.collect()] == [(7_123_000, 5)]


@pytest.mark.parametrize("held, chars", [(1 << 14, 1 << 20), (5, 30)])
def test_bitmaps_of_trigrams_in_a_small_table(monkeypatch, held, chars):
    monkeypatch.setattr(answerindex, "HELD", held)
    monkeypatch.setattr(answerindex, "CHARS", chars)
    texts = [v.lower() for v in VALUES if v is not None]
    rows = [(q, b, i * 31 + b, t) for q in ("n", "q") for b in (0, 1, 7) for i, t in enumerate(texts)]
    batches = [pa.RecordBatch.from_pylist([dict(zip(("question", "bucket", "place", "text"), r)) for r in rows[i : i + 50]]) for i in range(0, len(rows), 50)]
    got = set()
    for batch in answerindex._gram_bitmaps(iter(batches)):
        assert batch.num_rows
        for r in batch.to_pylist():
            set_bits = np.nonzero(np.unpackbits(np.frombuffer(r["bits"], dtype=np.uint8), bitorder="little"))[0]
            assert len(r["bits"]) == answerindex.BUCKET // 8
            got |= {(r["question"], r["bucket"], r["entry"], int(p)) for p in set_bits}
    assert got == {(q, b, t[i : i + 3], p) for q, b, p, t in rows for i in range(max(1, len(t) - 2))}
