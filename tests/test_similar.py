"""Neighbours against brute force, with many cells and small blocks."""

from __future__ import annotations

import numpy as np
import pytest

from strataflow.operators import similar
from strataflow.operators.grid import dealt
from strataflow.operators.similar import top_neighbours


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(9, 12))
    near = centres[rng.integers(0, 9, 260)] + rng.normal(scale=0.15, size=(260, 12))
    near[40:130] = near[40] + rng.normal(scale=0.01, size=(90, 12))  # a third in one place
    near[200:245] = near[245]  # copies
    return near


@pytest.mark.parametrize("block, k", [(4096, 4), (40, 7), (100, 300)])
def test_neighbours(spark, vectors, block, k):
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id long, vector array<double>")
    queries = rows.where("id % 3 = 0")
    got: dict = {}
    for r in top_neighbours(queries.repartition(3), rows.repartition(4), k, block=block).collect():
        got.setdefault(r.query_id, {})[r.place] = (r.item_id, r.similarity)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    likeness = unit @ unit.T
    assert set(got) == set(range(0, 260, 3))
    for query, found in got.items():
        others = [i for i in range(260) if i != query]
        best = sorted(others, key=lambda i: -likeness[query, i])[:k]
        assert len(found) == min(k, 259)
        values = [found[p][1] for p in sorted(found)]
        assert np.allclose(values, [likeness[query, i] for i in best])


def test_ties_go_to_lower_ids(spark):
    rows = spark.createDataFrame([(i, [1.0, float(i % 2)]) for i in range(40)], "id long, vector array<double>")
    got: dict = {}
    for r in top_neighbours(rows.repartition(5), rows.repartition(3), 3, block=4).collect():
        got.setdefault(r.query_id, {})[r.place] = r.item_id
    for query, found in got.items():
        want = [i for i in range(query % 2, 40, 2) if i != query][:3]
        assert [found[p] for p in (1, 2, 3)] == want


def test_null_vectors_and_what_is_no_number(spark):
    vectors = [[1.0, 0.0], None, [1.0, 0.1], [0.0, 1.0], [float("nan"), 1.0], [1.0, 0.2], [0.1, 1.0]]
    rows = spark.createDataFrame(list(enumerate(vectors)), "id long, vector array<double>")
    got: dict = {}
    for r in top_neighbours(rows, rows, 2, block=2).collect():
        got.setdefault(r.query_id, {})[r.place] = r.item_id
    assert 1 not in got
    assert got[0] == {1: 2, 2: 5} and got[3] == {1: 6, 2: 5}


def test_rows_of_a_query_do_not_grow_with_the_cells(spark):
    vectors = np.random.default_rng(8).normal(size=(400, 8))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id long, vector array<double>").cache()
    found = similar._search(rows, rows, 3, 25)  # 20 cells in slabs of 200
    per_query = {r.query_id: r["count"] for r in found.groupBy("query_id").count().collect()}
    assert len(per_query) == 400 and max(per_query.values()) <= 3 * 4


def test_cells_are_dealt_to_groups():
    found = dealt({0: 3, 1: 4, 2: 25, 3: 1, 5: 9}, [1, 0, 2, 3, 4, 5], 10)
    assert found == [(1, 0, 1), (0, 0, 1), (2, 1, 3), (3, 4, 1), (4, 4, 1), (5, 4, 1)]


@pytest.mark.parametrize("kind", ["even", "crowd", "odd"])
def test_few_pairs_are_compared_in_double_precision(monkeypatch, kind):
    rng = np.random.default_rng(4)
    items = rng.normal(size=(1500, 16))
    if kind == "crowd":  # nearer to each other than single precision tells
        items[100:900] = items[100] + rng.normal(scale=1e-6, size=(800, 16))
    items /= np.linalg.norm(items, axis=1, keepdims=True)
    if kind == "odd":
        items[[5, 700]] = np.nan
    ids, rows, compared = rng.permutation(1500), items[:200], []
    exact = similar._exact
    monkeypatch.setattr(similar, "_exact", lambda r, i, row, place: compared.append(len(row)) or exact(r, i, row, place))
    row, place, value = similar._best(rows, items, items.astype(np.float32), ids, 6, 128)
    likeness = np.round(np.einsum("qd,nd->qn", rows, items), similar.DIGITS)
    likeness[np.isnan(likeness)] = -2.0
    for q in range(200):
        best = np.lexsort((ids, -likeness[q]))[:6]
        assert place[row == q].tolist() == best.tolist()
        assert np.allclose(value[row == q], np.where(likeness[q, best] == -2, np.nan, likeness[q, best]), equal_nan=True)
    if kind == "even":
        assert sum(compared) < 200 * 1500 / 50
