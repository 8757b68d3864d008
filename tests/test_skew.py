"""Hot groups: the split scans give what plain windows and aggregates give."""

from __future__ import annotations

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from strataflow.operators.ordered import in_ranges, with_offset, with_previous, with_running
from strataflow.operators.quantiles import distribution
from strataflow.operators.uploads import slice_join

EVENTS = "/root/testdata/sf0.001/events.parquet"
ORDERS = "/root/testdata/sf0.001/orders.parquet"


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one key, which is NULL; ties in the order, NULL values."""
    rng = random.Random(3)
    rows = []
    for i in range(1500):
        key = None if rng.random() < 0.34 else rng.randrange(1, 40)
        rows.append((key, rng.randrange(0, 900) ** 2, i, None if rng.random() < 0.3 else rng.randrange(100)))
    return spark.createDataFrame(rows, "key long, at long, id long, value long").repartition(7)


@pytest.mark.parametrize("limit", [7, 10_000])
def test_running_values(skewed, limit):
    window = Window.partitionBy("key").orderBy("at", "id").rowsBetween(Window.unboundedPreceding, 0)
    pair = F.struct("at", "value")
    got = with_running(
        skewed,
        ["key"],
        "at",
        {
            "total": ("sum", F.col("value")),
            "top": ("max", F.when(F.col("value") > 50, pair)),
            "latest": ("last", F.when(F.col("value") < 20, F.col("value"))),
            "before": ("previous", F.col("value")),
        },
        ["id"],
        limit,
    )
    want = skewed.select(
        "*",
        F.coalesce(F.sum("value").over(window), F.lit(0)).alias("total"),
        F.max(F.when(F.col("value") > 50, pair)).over(window).alias("top"),
        F.last(F.when(F.col("value") < 20, F.col("value")), ignorenulls=True).over(window).alias("latest"),
        F.lag("value").over(Window.partitionBy("key").orderBy("at", "id")).alias("before"),
    )
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


@pytest.mark.parametrize("limit", [60])
def test_offsets_without_keys(skewed, limit):
    got = with_offset(skewed, [], "at", "place", ["id"], limit).orderBy("at", "id").collect()
    assert [r.place for r in got] == list(range(1500))


def test_previous_keeps_null_values(skewed):
    got = with_previous(skewed, ["key"], "at", {"before": "value"}, ["id"], 10)
    want = with_previous(skewed, ["key"], "at", {"before": "value"}, ["id"], 10_000)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


@pytest.mark.parametrize("limit", [40, 10_000])
def test_percentiles(spark, limit):
    orders = spark.read.parquet(ORDERS)
    heavy = F.when(F.col("o_orderkey") % 3 == 0, F.lit(None).cast("long")).otherwise(F.col("o_custkey") % 9).alias("k")
    # Values of very different size, many of them equal.
    value = F.when(F.col("o_orderkey") % 5 == 0, F.lit(7.0)).when(
        F.col("o_orderkey") % 11 == 0, F.col("o_totalprice") * 1e7
    ).otherwise(F.col("o_totalprice") / 1e5 - 1.0)
    rows = orders.select(heavy, value.alias("v"))
    got = distribution(rows, ["k"], "v", limit=limit).orderBy(F.col("k").asc_nulls_first()).collect()
    groups: dict = {}
    for r in rows.collect():
        groups.setdefault(r.k, []).append(r.v)
    shares = {"median_value": (1, 2), "p10_value": (1, 10), "p25_value": (1, 4), "p75_value": (3, 4), "p90_value": (9, 10)}
    want = []
    for k, values in sorted(groups.items(), key=lambda g: -1 if g[0] is None else g[0]):
        values.sort()
        n = len(values)
        picked = {c: values[max(1, -(-n * a // b)) - 1] for c, (a, b) in shares.items()}
        want.append({"k": k, "count_value": n, "min_value": values[0], "max_value": values[-1], **picked})
    names = ["k", "count_value", "min_value", "max_value", "median_value", "p10_value", "p25_value", "p75_value", "p90_value"]
    assert [[r[n] for n in names] for r in got] == [[r[n] for n in names] for r in want]


@pytest.mark.parametrize("outlier", [-1e12, 1e12])
def test_percentiles_of_crowded_values(spark, outlier):
    values = [outlier] + [1.0 + i * 1e-7 for i in range(2000)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    got = distribution(rows, [], "v", limit=200).first()
    values.sort()
    assert got.median_value == values[1000] and got.p10_value == values[200] and got.p90_value == values[1800]


def test_crowded_positions(spark):
    rows = spark.range(3000).select(
        F.lit(1).alias("k"), F.when(F.col("id") < 5, F.col("id") * 10**12).otherwise(F.col("id")).alias("at"), "id"
    )
    got = with_offset(rows.repartition(5), ["k"], "at", "place", ["id"], 50).orderBy("place").collect()
    assert [r.place for r in got] == list(range(3000))
    assert [r["at"] for r in got] == sorted(r["at"] for r in got)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=30))
def test_percentiles_of_any_values(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    got = distribution(rows, [], "v", limit=1).first()
    want = sorted(v + 0.0 for v in values)
    for name, p in {"median_value": 0.5, "p10_value": 0.1, "p90_value": 0.9}.items():
        rank = max(1, -(-int(round(p * 10)) * len(want) // 10))
        if len(values) > 1:
            assert got[name] == want[rank - 1]


@pytest.mark.parametrize("block", [7, 100_000])
def test_slice_join_by_blocks(spark, block):
    rows = spark.range(60).select((F.col("id") % 2).alias("k"), F.floor(F.col("id") / 2).alias("offset"))
    slices = spark.createDataFrame(
        [(0, 4, 5, "a"), (0, 4, 0, "none"), (0, 29, 25, "b"), (1, 9, 10, "c"), (1, 12, 3, "d")],
        "k long, last_offset long, count long, name string",
    )
    got = slice_join(rows, slices, ["k"], block=block)
    want = rows.join(slices, "k").where(
        (F.col("offset") > F.col("last_offset") - F.col("count")) & (F.col("offset") <= F.col("last_offset"))
    )
    assert sorted(map(tuple, got.select("k", "offset", "name").collect())) == sorted(
        map(tuple, want.select("k", "offset", "name").collect())
    )


def test_ties_are_split(spark):
    """Rows crowded at one position are cut by what follows in the order."""
    rows = spark.range(1000).select(F.lit(1).alias("k"), F.lit(5).alias("at"), "id")
    assert in_ranges(rows, ["k", "at", "id"], 20).select("_range").distinct().count() >= 20
    got = with_offset(rows.repartition(5), ["k"], "at", "place", ["id"], 50).orderBy("place").collect()
    assert [(r.place, r.id) for r in got] == [(i, i) for i in range(1000)]


@pytest.mark.parametrize(
    "values",
    [
        [float(i) for i in range(8)] + [math.inf],
        [-math.inf, math.nan, math.inf, 1.0, 2.0, math.nan, -math.inf, 3.0, 4.0],
        [1e308, -1e308, 1.7e308, -1.7e308, 0.0, 5e-324, 1e-320, 2e-320, 1.0],
        [10.0**-i for i in range(0, 300, 7)],
        [math.nan] * 9,
    ],
)
def test_percentiles_of_extreme_values(spark, values):
    got = distribution(spark.createDataFrame([(v,) for v in values], "v double"), [], "v", limit=3).first()
    want = sorted(values, key=lambda v: (math.isnan(v), v))
    for name, (a, b) in {"median_value": (1, 2), "p10_value": (1, 10), "p90_value": (9, 10)}.items():
        assert repr(got[name]) == repr(want[max(1, -(-len(want) * a // b)) - 1])
