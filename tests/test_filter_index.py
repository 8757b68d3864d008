"""The filter index gives what evaluating every filter on every row gives."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strataflow.functions.atoms import LEAST, MOST, Atom, conjunction
from strataflow.operators import fanout, filterindex
from strataflow.operators.fanout import FilterSpec
from strataflow.schema import CATALOGUE_SCHEMA

INF = float("inf")


@pytest.mark.parametrize(
    ("text", "atoms"),
    [
        ("analysis_id = 5", [Atom("analysis_id", 5, 5)]),
        ("5 < analysis_id and analysis_id <= 7.5", [Atom("analysis_id", 6, MOST), Atom("analysis_id", LEAST, 7)]),
        ("analysis_id = 5.5", [Atom("analysis_id", 6, 5)]),
        ("p10_value BETWEEN -1 AND 2 AND stratum_1 = 8507", [Atom("p10_value", -1.0, 2.0), Atom("stratum_1", values=frozenset(["8507"]))]),
        ("stratum_2 in ('a', 'b')", [Atom("stratum_2", values=frozenset("ab"))]),
        ("count_value >= 0", [Atom("count_value", 0, MOST)]),
    ],
)
def test_atoms(text, atoms):
    assert conjunction(text) == atoms


@pytest.mark.parametrize(
    "text",
    [
        None, " ", "analysis_id = 1 or analysis_id = 2", "not analysis_id = 1", "stratum_1 > '5'", "stratum_1 = 'it''s'", "p10_value is null",
        "abs(p10_value) > 1", "analysis_id <> 3", "analysis_id + 1 = 2", "p10_value > p25_value", "stratum_1 like 'a%'", "analysis_id = 1e3",
        "analysis_id = '5'", "analysis_id in (1, null)", "analysis_id between 1 and count_value", "(analysis_id = 1)", "true",
        "analysis_id = 99999999999999999999",
    ],
)
def test_other_texts_are_left_to_evaluation(text):
    assert conjunction(text) is None


def _rows(spark, rng, n=400):
    def number():
        return rng.choice([None, 0.0, -0.0, 1.5, 2.0, 3.0, INF, -INF, float("nan"), rng.uniform(-5, 5)])

    def row(i):
        text = lambda: rng.choice([None, "", "a", "b", "8507", "A"])
        return (i % 3, f"d{i % 2}", rng.randrange(-3, 9), *[text() for _ in range(5)], rng.choice([0, 1, 2, 1 << 60]), *[number() for _ in range(9)])

    schema = "upload_id long, db string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CATALOGUE_SCHEMA)
    return spark.createDataFrame([row(i) for i in range(n)], schema).repartition(3)


def _text(rng):
    def literal():
        return rng.choice(["0", "1", "1.5", "2", "-3", "3.0", str(rng.randrange(-5, 9)), "1152921504606846976"])

    def condition():
        kind = rng.randrange(7)
        number = rng.choice(["analysis_id", "count_value", "p10_value", "avg_value", "min_value"])
        if kind == 0:
            return f"stratum_{rng.randrange(1, 4)} = {rng.choice(["'a'", "''", '8507', "'zz'"])}"
        if kind == 1:
            return f"stratum_1 IN ('a', 'b', {rng.choice(['8507', "'A'"])})"
        if kind == 2:
            return f"{number} BETWEEN {literal()} AND {literal()}"
        if kind == 3:
            return f"{number} IN ({literal()}, {literal()})"
        if kind == 4:
            return f"{literal()} {rng.choice(['<', '<=', '>', '>=', '='])} {number}"
        return f"{number} {rng.choice(['<', '<=', '>', '>=', '=', '=='])} {literal()}"

    if rng.random() < 0.03:
        return rng.choice([None, "p10_value IS NULL", "analysis_id = 1 OR stratum_1 = 'a'"])
    return " AND ".join(condition() for _ in range(rng.randrange(1, 5)))


@pytest.mark.parametrize(("seed", "pairs"), [(1, 1 << 20), (2, 50)])
def test_index_equals_evaluation(spark, monkeypatch, seed, pairs):
    rng = random.Random(seed)
    rows, specs = _rows(spark, rng), [FilterSpec(i, _text(rng)) for i in range(150)]
    keys = ["upload_id", "db"]
    columns = [*keys, "filter_id", "matched", "unmatched", "unknown"]
    plain = sorted(fanout.count_matches(rows, keys, specs).select(columns).collect())
    passed = sorted(fanout.fan_out(rows.select(*keys, *CATALOGUE_SCHEMA.names), specs).groupBy(*keys, "filter_id").count().collect())
    monkeypatch.setattr(fanout, "FILTERS_PER_SCAN", 4)
    monkeypatch.setattr(filterindex, "PAIRS", pairs)
    assert sorted(fanout.count_matches(rows, keys, specs).select(columns).collect()) == plain
    assert sorted(fanout.fan_out(rows, specs).groupBy(*keys, "filter_id").count().collect()) == passed


def test_twenty_thousand_filters_in_one_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    none = {f.name: F.lit(None).cast(f.dataType) for f in CATALOGUE_SCHEMA}
    rows = orders.select(
        F.lit(1).cast("long").alias("upload_id"),
        *[(none | {"analysis_id": F.col("o_custkey"), "count_value": F.col("o_orderkey"), "avg_value": F.col("o_totalprice")})[f.name].alias(f.name) for f in CATALOGUE_SCHEMA],
    )
    texts = [f"analysis_id = {i % 700} AND avg_value > {i * 10} AND count_value < 5000" for i in range(20_000)]
    specs = [FilterSpec(i, t) for i, t in enumerate(texts)]
    made = fanout.fan_out(rows, specs)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    data = rows.select("analysis_id", "count_value", "avg_value").collect()
    expected = sum(r.analysis_id == i % 700 and r.avg_value > i * 10 and r.count_value < 5000 for r in data for i in range(r.analysis_id, 20_000, 700))
    assert made.count() == expected > 0


def test_no_rows_and_null_keys(spark, monkeypatch):
    monkeypatch.setattr(fanout, "FILTERS_PER_SCAN", 1)
    rows, specs = _rows(spark, random.Random(4), 9), [FilterSpec(1, "analysis_id > 2"), FilterSpec(2, "p10_value < 1 AND stratum_1 = 'a'")]
    assert fanout.count_matches(rows.limit(0), ["upload_id"], specs).count() == 0
    assert fanout.fan_out(rows.limit(0), specs).count() == 0
    odd = rows.withColumn("db", F.when(F.col("upload_id") > 0, F.col("db")))
    counted = fanout.count_matches(odd, ["db"], specs).collect()
    assert {r.db for r in counted} == {None, "d0", "d1"} and len(counted) == 6


def test_pairs_come_in_small_lists():
    index = filterindex.FilterIndex(list(range(300)), [conjunction(f"count_value >= {-i} AND analysis_id = 5") for i in range(300)])
    table = pa.table({"analysis_id": pa.array([5] * 4000, pa.int64()), "count_value": pa.array(range(4000), pa.int64())})
    sizes = [len(row) for row, _, matches, _ in index.found(table) if matches.all()]
    assert sum(sizes) == 4000 * 300 and max(sizes) <= (1 << 18) + 300
    rows = pa.StructArray.from_arrays([c.combine_chunks() for c in table.columns], names=table.column_names)
    assert all(sorted(ids) == list(range(300)) for ids in filterindex._matched(index, rows.slice(7, 20)).to_pylist())
