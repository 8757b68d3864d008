"""The approximate index against the exact neighbours."""

from __future__ import annotations

import numpy as np
import pytest

from strataflow.operators.nearindex import build_index, near_neighbours, tuned, fit_codes
from strataflow.operators.similar import top_neighbours


def _vectors(kind, n):
    rng = np.random.default_rng(3)
    if kind == "grouped":
        centres = rng.normal(size=(60, 16))
        return centres[rng.integers(0, 60, n)] + rng.normal(scale=0.2, size=(n, 16))
    return rng.normal(size=(n, 16))


def _recall(spark, vectors, monkeypatch=None):
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id long, vector array<double>").repartition(4)
    queries = rows.where("id % 7 = 0")
    index = build_index(rows, 20)
    near = {(r.query_id, r.item_id): (r.place, r.similarity) for r in near_neighbours(queries, index).collect()}
    exact = {(r.query_id, r.item_id): r.similarity for r in top_neighbours(queries, rows, 20).collect()}
    for pair in near.keys() & exact.keys():
        assert near[pair][1] == pytest.approx(exact[pair], abs=1e-6)
    places = {}
    for (query, _), (place, _) in near.items():
        places.setdefault(query, []).append(place)
    assert set(places) == {q for q, _ in exact}
    assert all(sorted(p) == list(range(1, 21)) for p in places.values())
    assert not any(q == i for q, i in near)
    return len(near.keys() & exact.keys()) / len(exact), index


@pytest.mark.parametrize("kind", ["grouped", "even"])
def test_recall(spark, kind):
    recall, index = _recall(spark, _vectors(kind, 3000))
    assert recall >= 0.9
    if kind == "grouped":
        assert index.probes * 4 <= len(index.codes.cells)


def test_blocks_of_a_crowded_cell(spark, monkeypatch):
    from strataflow.operators import nearindex

    monkeypatch.setattr(nearindex, "ITEM_ROWS", 50)
    monkeypatch.setattr(nearindex, "QUERY_ROWS", 7)
    vectors = _vectors("grouped", 1500)
    vectors[200:700] = vectors[200] + np.random.default_rng(1).normal(scale=0.01, size=(500, 16))
    recall, index = _recall(spark, vectors)
    assert recall >= 0.9
    assert max(len(r.ids) for r in index.blocks.select("ids").collect()) <= 50


def test_few_and_no_items(spark):
    rows = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(3)], "id long, vector array<double>")
    found = near_neighbours(rows, build_index(rows, 20)).collect()
    assert len(found) == 6 and {r.place for r in found} == {1, 2}
    empty = rows.limit(0)
    assert near_neighbours(rows, build_index(empty, 20)).count() == 0
    odd = rows.unionByName(spark.createDataFrame([(9, None), (None, [1.0, 2.0])], rows.schema))
    assert len(near_neighbours(odd, build_index(odd, 20)).collect()) == 6


def test_numbers_are_fitted_to_the_sample():
    sample = _vectors("grouped", 2000).astype(np.float32)
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    codes = fit_codes(sample, 40)
    low, high = tuned(codes, sample, 10, 0.5), tuned(codes, sample, 10, 0.99)
    assert low[0] <= high[0] <= 40 and low[1] <= high[1]


def test_only_the_best_of_a_slab_leave_it(spark, monkeypatch):
    from strataflow.operators import nearindex

    made, whole = [], nearindex.tiles
    monkeypatch.setattr(nearindex, "SLAB_ROWS", 400)
    monkeypatch.setattr(nearindex, "STRIP_ROWS", 90)
    monkeypatch.setattr(nearindex, "tiles", lambda *a: made.append(whole(*a)) or made[-1])
    recall, index = _recall(spark, _vectors("even", 1200))
    assert recall >= 0.9 and index.kept > 20
    per_query = [r["count"] for r in made[0].groupBy("query_id").count().collect()]
    assert max(per_query) <= 20 * 5


@pytest.mark.parametrize("crowd", [1 << 20, 300])
def test_estimates_of_the_opened_cells(monkeypatch, crowd):
    """The best among the opened cells, though a query meets no item of another cell."""
    from strataflow.operators import nearindex

    monkeypatch.setattr(nearindex, "CROWD", crowd)
    monkeypatch.setattr(nearindex, "CELL_ROWS", 70)
    rng = np.random.default_rng(2)
    asked, told = rng.normal(size=(40, 9)).astype(np.float32), rng.normal(size=(3000, 9)).astype(np.float32)
    told[500:900] = told[500]  # copies
    cell, ids = np.sort(rng.integers(0, 30, 3000)), rng.permutation(3000)
    opened = rng.random((40, 30)) < 0.4
    opened[3] = False
    opened[4] = np.arange(30) == cell[0]  # few items
    key = ids[rng.integers(0, 3000, 40)]
    near, able = nearindex._nearest_estimates(asked, told, opened, cell, key, ids, 25)
    score = asked @ told.T
    score[~opened[:, cell] | (key[:, None] == ids[None, :])] = -np.inf
    for q in range(40):
        best = np.sort(score[q][np.isfinite(score[q])])[::-1][:25]
        found = near[q][able[q]]
        assert len(set(found.tolist())) == len(found)
        assert np.allclose(np.sort(score[q, found])[::-1], best, rtol=1e-5)
