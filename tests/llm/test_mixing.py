from __future__ import annotations

import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from strataflow.llm import mixing, workload
from tests.llm.helpers import documents, odd_documents, odd_rows, with_clashes, words_of


def _targets(sizes):
    """Share by weight; what is above a limit goes to the others by weight, again and again."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target = {s: Fraction(0) for s in order}
    left, free = Fraction(3, 2) * sum(sizes.values()), set(order)
    while left > 0 and free:
        total = sum(weight[s] for s in free)
        for s in free:
            target[s] += left * weight[s] / total
        left = sum((max(target[s] - 2 * sizes[s], 0) for s in order), Fraction(0))
        for s in order:
            target[s] = min(target[s], Fraction(2 * sizes[s]))
        free = {s for s in free if target[s] < 2 * sizes[s]}
    return target


def _check(rows, tolerance=None):
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken in (0, r.size, 2 * r.size)
    expected = _targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - float(expected[r.source])) <= 1e-6 * max(1.0, r.target)
    if tolerance is not None:
        for source in sizes:
            assert abs(taken[source] - target[source]) <= tolerance * target[source], source


def test_query(spark):
    rows = workload.QUERIES["op10_mixing"](spark, "/root/testdata/sf0.01").collect()
    _check(rows, 0.1)
    again = workload.QUERIES["op10_mixing"](spark, "/root/testdata/sf0.01").collect()
    assert sorted(rows) == sorted(again)


@pytest.mark.parametrize("n_sources", [1, 2, 7, 40])
def test_targets_by_brute_force(spark, n_sources):
    rng = random.Random(n_sources)
    names = [f"s{i}" for i in range(n_sources - 1)] + [None]
    rows = [(i, "w " * rng.choice([1, 3, 40]), "en", rng.choice(names[: 1 + i % n_sources])) for i in range(600)]
    _check(mixing.mix(documents(spark, rows)).collect())


def test_hot_source_is_summed_in_ranges(spark):
    """Two thirds of the rows are repeats in one source; ranges and their totals give the plain running sum."""
    rows = [(5 if i % 3 else i, "a b c" if i % 3 else "a b", "en", "hot" if i % 3 else "x") for i in range(6000)]
    found = mixing.mix(documents(spark, rows)).collect()
    _check(found, 0.01)
    per = defaultdict(list)
    for r in found:
        per[r.source].append(r)
    for own in per.values():
        rate = int(own[0].target / own[0].source_size * mixing.ONE + 0.5)
        whole = len(own) * rate / mixing.ONE
        assert abs(sum(r.copies for r in own) - whole) < 1


def test_systematic_copies_with_unequal_shares(spark):
    df = spark.range(0, 999).select("id", (F.col("id") % 4).cast("string").alias("g"), (F.col("id") % 50 / 20).alias("e"))
    rows = mixing.systematic_copies(df, "g", F.round(F.col("e") * mixing.ONE), ["id"], 7, "n").collect()
    for group in "0123":
        own = sorted((r for r in rows if r.g == group), key=lambda r: r.id)
        total = drawn = 0
        for r in own:
            total += round(r.e * mixing.ONE)
            drawn += r.n
            assert r.n in (int(r.e), int(r.e) + 1)
            assert abs(drawn - total / mixing.ONE) <= 1


def test_odd_rows(spark):
    rows = mixing.mix(with_clashes(odd_documents(spark))).collect()
    assert len(rows) == len(odd_rows())
    assert sorted(r.size for r in rows) == sorted(len(words_of(r[1])) for r in odd_rows())
    _check(rows)
    assert mixing.mix(documents(spark, [])).count() == 0
    nothing = mixing.mix(documents(spark, [(1, None, "en", "a"), (2, "", "en", None)])).collect()
    assert [(r.size, r.target, r.taken, r.copies) for r in nothing] == [(0, 0.0, 0, 0)] * 2


def test_documents_of_the_mix(spark):
    df = with_clashes(odd_documents(spark))
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    copies = Counter()
    for r in mixing.mix(df).collect():
        copies[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in mixed.collect()) == +copies


def test_limits_must_leave_room(spark):
    with pytest.raises(ValueError):
        mixing.mix(documents(spark, [(1, "a", "en", "s")]), share_percent=250)
