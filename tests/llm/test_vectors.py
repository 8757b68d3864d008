"""Product codes and exact top-k on odd vectors, against plain versions."""

from __future__ import annotations

import math

import numpy as np
import pytest

from strataflow.llm import codes, topk, workload
from tests.llm.helpers import SF_DIR, with_clashes

NAN, INF = float("nan"), float("inf")
VECTORS = "vec_id long, embedding array<double>, label int"


def _odd():
    """Nulls, non-finite and large components, short and empty vectors, ties, repeated rows."""
    rng = np.random.default_rng(5)
    rows = [(i, (rng.integers(-3, 4, 8) / 4).tolist(), i % 3) for i in range(0, 400)]
    rows += [(50, rows[50][1], 1), (50, rows[51][1], None), (None, rows[3][1], None), (None, [0.1] * 8, 0)]
    rows += [(1000, None, 1), (1050, [1.0, None], 1), (1100, [NAN, 1.0], 1), (1150, [1.0, INF], 2), (1200, [-INF], 2)]
    rows += [(1250, [], 1), (1300, [0.5, -0.25, 0.125], None), (1350, [-1e-3] * 8, 0), (-50, [3.7, -2.2] * 4, 2)]
    return rows


def _kept(rows, scale, limit):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = max((len(r[1]) for r in kept), default=0)
    whole = [[int(max(-limit, min(limit, math.floor(x * scale)))) for x in r[1]] for r in kept]
    return [(r[0], v + [0] * (width - len(v)), r[2], r[1]) for r, v in zip(kept, whole)]


def _id_order(key):
    return (key is None, key or 0)


def _top(rows, queries, k, scale):
    kept = _kept(rows, scale, topk.LIMIT)
    found = []
    for key, vector, *_ in _kept(queries, scale, topk.LIMIT):
        if key is None:
            continue
        vector = vector + [0] * (8 - len(vector))
        scored = [(-sum(a * b for a, b in zip(vector, v)), *_id_order(i), i) for i, v, *_ in kept if i != key]
        found += [(key, n + 1, i, -score) for n, (score, _, _, i) in enumerate(sorted(scored, key=lambda s: s[:3])[:k])]
    return sorted(found, key=str)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("block", [4096, 16])
@pytest.mark.parametrize("k", [1, 5, 600])
def test_top_k_by_brute_force(spark, monkeypatch, block, k):
    from strataflow.llm import vectors

    monkeypatch.setattr(vectors, "BLOCK_ROWS", block)
    rows = _odd()
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    asked = [r for r in rows if r[0] is None or r[0] % 50 == 0]
    found = topk.top_k(df, spark.createDataFrame(asked, VECTORS), k, 256)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert _rows(found) == _top(rows, asked, k, 256)


def test_top_k_large_components(spark):
    rows = [(i, [1e30, -1e30, float(i)], 0) for i in range(4)]
    df = spark.createDataFrame(rows, VECTORS)
    assert _rows(topk.top_k(df, df.where("vec_id = 0"), 2, 256)) == [(0, 1, 1, 2 << 40), (0, 2, 2, 2 << 40)]


def test_several_passes(spark, monkeypatch):
    monkeypatch.setattr(topk, "PASS_BYTES", 1)
    rows = _odd()
    df = spark.createDataFrame(rows, VECTORS).repartition(4)
    asked = [r for r in rows if r[0] is not None and r[0] % 50 == 0]
    assert _rows(topk.top_k(df, df.where("vec_id % 50 = 0"), 5, 256)) == _top(rows, asked, 5, 256)


def _coded(rows, parts, entries, rounds):
    kept = sorted(_kept(rows, 1024, codes.LIMIT), key=lambda r: (_id_order(r[0]), r[3]))
    width = len(kept[0][1])
    dims = -(-max(width, 1) // parts) * parts
    vectors = np.array([v + [0] * (dims - width) for _, v, *_ in kept], dtype=object)
    books, size = vectors[:entries].copy(), dims // parts
    spans = [slice(p * size, (p + 1) * size) for p in range(parts)]

    def near(v, span):
        return min((sum((a - b) ** 2 for a, b in zip(v[span], e[span])), i) for i, e in enumerate(books))

    for _ in range(rounds):
        nearest = [[near(v, s)[1] for s in spans] for v in vectors]
        old = books.copy()
        for p, s in enumerate(spans):
            for e in range(len(books)):
                own = [v[s] for v, n in zip(vectors, nearest) if n[p] == e]
                if own:
                    old[e, s] = [sum(c) // len(own) for c in zip(*own)]
        books = old
    found = []
    for (key, _, label, _), v in zip(kept, vectors):
        marks = [near(v, s) for s in spans]
        found.append((key, "".join(f"{i:02x}" for _, i in marks), sum(d for d, _ in marks), label))
    totals = {}
    for _, _, error, label in found:
        totals[label] = totals.get(label, 0) + error
    return sorted(((k, c, e, totals[label]) for k, c, e, label in found), key=str)


@pytest.mark.parametrize(("block", "parts", "entries", "rounds"), [(4096, 4, 16, 4), (16, 2, 5, 1), (4096, 3, 256, 0)])
def test_codes_by_brute_force(spark, monkeypatch, block, parts, entries, rounds):
    from strataflow.llm import vectors

    monkeypatch.setattr(vectors, "BLOCK_ROWS", block)
    rows = _odd()[::-1][:120]
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    found = codes.compressed(df, parts, entries, rounds)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert _rows(found.drop("codebooks_sha256")) == _coded(rows, parts, entries, rounds)
    assert found.select("codebooks_sha256").distinct().count() == 1


def test_codes_large_components(spark):
    rows = [(0, [1e30, -1e30, 0.0, 0.0], "a"), (1, [0.0] * 4, "a"), (2, [1e30, 0.0, 0.0, 0.0], "b")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    found = {r.vec_id: r for r in codes.compressed(df, rounds=1).collect()}
    assert [found[i].error for i in range(3)] == [0, 0, 0]
    assert found[0].code == "00000000" and found[2].code == "00010000"


def test_empty_tables_and_clashing_names(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert topk.top_k(empty, empty, 5, 256).count() == 0
    assert codes.compressed(empty).count() == 0
    df = spark.createDataFrame(_odd()[:60], VECTORS)
    assert topk.top_k(df, empty, 5, 256).count() == 0
    more = with_clashes(df)
    assert _rows(topk.top_k(more, more.where("vec_id = 0"), 5, 256)) == _rows(topk.top_k(df, df.where("vec_id = 0"), 5, 256))
    assert _rows(codes.compressed(more, entries=8)) == _rows(codes.compressed(df, entries=8))


def test_given_vectors(spark):
    ids = {r.vec_id for r in workload.table(spark, SF_DIR, "embeddings").select("vec_id").collect()}
    coded = workload.QUERIES["op12_codes"](spark, SF_DIR).collect()
    assert {r.vec_id for r in coded} == ids
    assert workload.QUERIES["op13_topk"](spark, SF_DIR).count() == 5 * sum(i % 50 == 0 for i in ids)
