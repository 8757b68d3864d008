"""Stored states: errors within their bounds, whatever way they were merged."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.operators import sketches
from strataflow.schema import PERCENTILES


def test_rank_error_of_merged_batches(spark, tmp_path):
    rng = np.random.default_rng(7)
    values = np.concatenate([rng.normal(size=150_000), rng.exponential(1000, 150_000), np.full(100_000, 3.0)])
    rng.shuffle(values)
    rows = spark.createDataFrame([(i % 2, i % 7, i // 100_000, float(v)) for i, v in enumerate(values)], "db int, stratum int, batch int, x double")
    for batch in (0, 1, 2, 3, 2):
        states = sketches.quantile_states(rows.where(F.col("batch") == batch).repartition(5), ["db", "stratum"], "x")
        sketches.add_states(states, str(tmp_path), batch)
    stored = sketches.stored_states(spark, str(tmp_path))
    assert stored.count() == 4 * 14
    for keys in (["db"], ["db", "stratum"]):
        made = sketches.distribution_of(sketches.merged_quantiles(stored, keys), keys).collect()
        for r in made:
            own = np.array([v for i, v in enumerate(values) if i % 2 == r.db and (keys == ["db"] or i % 7 == r.stratum)])
            assert (r.count_value, r.min_value, r.max_value) == (len(own), own.min(), own.max())
            assert r.avg_value == pytest.approx(own.mean()) and r.stdev_value == pytest.approx(own.std(ddof=1))
            for name, fraction in PERCENTILES.items():
                low, high = (own < r[name]).mean(), (own <= r[name]).mean()
                assert low - 2 * sketches.RANK_ERROR <= fraction <= high + 2 * sketches.RANK_ERROR


def test_odd_values(spark):
    rows = spark.createDataFrame([(1, None), (1, float("nan")), (2, 5.0), (3, 1e9 + 1), (3, 1e9 + 2), (3, 1e9 + 3)], "db int, x double")
    states = sketches.quantile_states(rows, ["db"], "x")
    made = {r.db: r for r in sketches.distribution_of(sketches.merged_quantiles(states, ["db"]), ["db"]).collect()}
    assert set(made) == {2, 3}
    assert made[2].stdev_value is None and made[2].median_value == 5.0
    assert made[3].stdev_value == pytest.approx(1.0)
    assert sketches.quantile_states(rows.limit(0), ["db"], "x").count() == 0


def test_users_of_periods(spark):
    days = spark.range(300_000).select(
        (F.col("id") % 3).alias("fingerprint"), (F.col("id") % 10).alias("day"), (F.xxhash64("id") % 60_000).alias("user_id")
    ).unionByName(spark.createDataFrame([(9, 1, 5), (9, 2, 5), (9, 2, 6), (8, 1, 1)], "fingerprint long, day long, user_id long"))
    states = sketches.user_states(days, ["fingerprint", "day"])
    first, second = (sketches.merged_users(states.where(c), ["fingerprint"]) for c in ("day < 5", "day >= 2"))
    for made, condition in ((first, "day < 5"), (second, "day >= 2")):
        exact = {r.fingerprint: r.n for r in days.where(condition).groupBy("fingerprint").agg(F.count_distinct("user_id").alias("n")).collect()}
        told = {r.fingerprint: r.unique_views for r in sketches.counted_users(made, ["fingerprint"]).collect()}
        assert told.keys() == exact.keys()
        assert all(abs(told[k] - n) <= max(0.03 * n, 0) for k, n in exact.items())
    users = [days.where(c).select("fingerprint", "user_id").distinct() for c in ("day < 5", "day >= 2")]
    exact = {r.fingerprint: r["count"] for r in users[0].join(users[1], ["fingerprint", "user_id"]).groupBy("fingerprint").count().collect()}
    union = {r.fingerprint: r["count"] for r in users[0].union(users[1]).distinct().groupBy("fingerprint").count().collect()}
    shared = {r.fingerprint: r.shared for r in sketches.shared_users(first, second, ["fingerprint"]).collect()}
    assert shared.pop(8) == 0 and set(shared) == {0, 1, 2, 9} and shared[9] == exact[9] == 2
    assert all(abs(shared[k] - exact[k]) <= 0.03 * union[k] for k in exact)
