from __future__ import annotations

import math
import random
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest

from strataflow.llm import langid, workload
from tests.llm.helpers import documents, odd_documents, odd_rows, with_clashes


def _plain_bits(texts, data):
    """Prediction by partial matching, byte by byte."""
    follow = defaultdict(lambda: defaultdict(int))
    for text in texts:
        padded = b"\0" * 4 + text
        for i in range(4, len(padded)):
            for order in range(5):
                follow[padded[i - order : i]][padded[i]] += 1
    bits, padded = 0.0, b"\0" * 4 + data
    for i in range(4, len(padded)):
        for order in range(4, -1, -1):
            seen = follow.get(padded[i - order : i])
            if seen is None:
                continue
            room = sum(seen.values()) + len(seen)
            if padded[i] in seen:
                bits -= math.log2(seen[padded[i]] / room)
                break
            bits -= math.log2(len(seen) / room)
        else:
            bits += 8
    return bits


def _model(texts):
    rows = pd.DataFrame([(lang, t) for lang, ts in texts.items() for t in ts], columns=["lang", "data"])
    counts = pd.concat(langid._count([rows])).groupby(["lang", "gram"], as_index=False).sum()
    return langid.Model.of_counts(counts)


def test_code_lengths_by_brute_force(monkeypatch):
    rng = random.Random(1)
    make = lambda alphabet: bytes(rng.choice(alphabet) for _ in range(300))
    texts = {"x": [make(b"abcd "), make(b"abce ")], "y": [make(b"cdef\xc3\xa9")]}
    asked = [make(b"abcdef z\0"), b"", b"a", make(b"\xff\xfe")]
    model = _model(texts)
    expected = np.array([[_plain_bits(texts[lang], data) for lang in ("x", "y")] for data in asked])
    assert model.languages == ["x", "y"]
    assert np.allclose(model.code_lengths(asked), expected)
    monkeypatch.setattr(langid, "BLOCK_BYTES", 7)
    assert np.allclose(model.code_lengths(asked), expected)


def test_places_find_every_code():
    rng = np.random.default_rng(2)
    codes = np.unique(rng.integers(0, 1 << 40, 3000, dtype=np.uint64))
    places = langid.Places.of(codes)
    assert (places.find(codes) == np.arange(len(codes))).all()
    others = np.setdiff1d(rng.integers(0, 1 << 40, 3000, dtype=np.uint64), codes)
    assert (places.find(others) == len(codes)).all()


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in workload.table(spark, "/root/testdata/sf0.01", "documents").collect()}
    rows = workload.QUERIES["op8_language"](spark, "/root/testdata/sf0.01").collect()
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    held = [r for r in rows if r.held_out]
    assert 150 < len(held) < 350
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_nothing_is_learned_from_held_out_rows(spark):
    """Labels of held-out rows are turned around: the answers stay."""
    from pyspark.sql import functions as F

    df = workload.table(spark, "/root/testdata/sf0.001", "documents")
    turned = df.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    assert sorted(langid.predict_all(turned).collect()) == sorted(langid.predict_all(df).collect())


def test_odd_rows(spark):
    rows = langid.predict_all(with_clashes(odd_documents(spark))).collect()
    assert len(rows) == len(odd_rows())
    und = [r for r in rows if r.lang_pred == "und"]
    assert sorted(str(r.doc_id) for r in und) == sorted(map(str, [3, 4, 5, 6, None])) and all(r.score == 0 for r in und)


@pytest.mark.parametrize("rows", [[], [(1, "some text", None, "s")], [(1, None, "en", "s")]])
def test_nothing_to_learn(spark, rows):
    found = langid.predict_all(documents(spark, rows)).collect()
    assert [(r.doc_id, r.lang_pred, r.score) for r in found] == [(r[0], "und", 0.0) for r in rows]


def test_stage_keeps_columns(spark):
    df = with_clashes(odd_documents(spark))
    kept = langid.in_a_language(df)
    assert kept.columns == df.columns
    assert kept.count() == len(odd_rows()) - 5


FINNISH = "t\u00e4m\u00e4 on pitk\u00e4 teksti jossa kerrotaan kuinka talvi tuli kyl\u00e4\u00e4n ja j\u00e4rvet j\u00e4\u00e4tyiv\u00e4t ".split()
SPANISH = "este es un texto largo sobre la manera en que el invierno lleg\u00f3 al pueblo y los lagos se helaron ".split()


def _long(words, seed, n=15_000):
    rng = random.Random(seed)
    return " ".join(rng.choice(words) for _ in range(n))


def test_a_language_of_long_texts_only_is_learned(spark):
    rows = [(i, _long(FINNISH, i), "fi", "s") for i in range(12)] + [(100 + i, _long(SPANISH, i, 80), "es", "s") for i in range(200)]
    found = {r.doc_id: r.lang_pred for r in langid.predict_all(documents(spark, rows)).collect()}
    assert all(found[i] == ("fi" if i < 100 else "es") for i in found)


def test_stage_rejects_noise_and_other_languages(spark):
    rows = [(i, _long(w, i, 90), lang, "s") for lang, w, first in (("fi", FINNISH, 0), ("es", SPANISH, 1000)) for i in range(first, first + 400)]
    noise = random.Random(1)
    other = [
        "\u65e5\u672c\u8a9e\u306e\u30c6\u30ad\u30b9\u30c8\u3067\u3059\u3002" * 9, "\u041f\u0440\u0438\u0432\u0435\u0442 \u043a\u0430\u043a \u0434\u0435\u043b\u0430 " * 9, "x 0 1 0 1 " * 60, "we went through thick fog with quick brown foxes why not " * 9,
        "".join(noise.choice("qwzxcvbj0123456789") for _ in range(900)),
    ]
    odd = [(5000 + i, t, None, "s") for i, t in enumerate(other)] + [(6000, None, "fi", "s"), (6001, "12 34", "es", "s")]
    few = [(7000, "talvi", None, "s"), (7001, "A.", "es", "s"), (7002, _long(FINNISH, 9, 30) + " 4111 1111 1111 1111 9dd3c0aa", None, "s")]
    kept = {r.doc_id for r in langid.in_a_language(documents(spark, rows + odd + few)).collect()}
    assert kept == {r[0] for r in rows + few}


def test_nothing_is_rejected_by_a_small_sample(spark):
    rows = [(i, "one small text", "en", "s") for i in range(20)] + [(50, "\u65e5\u672c\u8a9e" * 50, None, "s")]
    assert langid.in_a_language(documents(spark, rows)).count() == 21
