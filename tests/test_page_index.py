"""Pages from stored ranges equal pages of the sorted table, and open few ranges."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from strataflow.operators.pageindex import build_pages
from strataflow.operators.stats import page


@pytest.mark.parametrize("down", [True, False])
def test_pages(spark, tmp_path, down):
    rng = random.Random(2)
    rows = [(i, rng.choice([None, 1, 2, 2, 2, rng.randrange(50)]), rng.choice("ab")) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, v int, s string").repartition(5)
    order = [F.col("v").desc_nulls_last() if down else F.col("v").asc_nulls_first(), F.asc("id")]
    index = build_pages(df, [("v", down), ("id", False)], str(tmp_path), range_rows=170)
    for number, size in ((1, 7), (3, 100), (40, 50), (41, 50), (1, 5000), (2, 5000), (286, 7)):
        wanted = [r.id for r in page(df, order, number, size).collect()]
        got = index.page(number, size).collect()
        assert [r.id for r in got] == wanted
        assert [r.place for r in got] == list(range((number - 1) * size, (number - 1) * size + len(wanted)))
    assert index.between(5, 5).count() == 0
    with pytest.raises(ValueError):
        index.page(0, 5)


def test_a_far_page_opens_two_ranges_at_most(spark, tmp_path):
    df = spark.range(1_000_000).select(F.col("id"), F.xxhash64("id").alias("v"))
    index = build_pages(df, [("v", False), ("id", False)], str(tmp_path), range_rows=20_000)
    far = index.page(10_000, 50)
    scanned = {f.split("/")[-2] for f in far.inputFiles()}
    assert index.ranges().count() >= 40
    got = [r.v for r in far.collect()]
    opened = index.ranges().where(F.col("start").between(499_950 - F.col("rows") + 1, 499_999)).count()
    assert opened <= 2 and len(scanned) >= opened
    assert got == [r.v for r in df.orderBy("v").offset(9_999 * 50).limit(50).collect()]
    # Ranges that the page doesn't lie in may even be broken.
    keep = {f"range={r['range']}" for r in index.ranges().where(F.col("start").between(499_950 - F.col("rows") + 1, 499_999)).collect()}
    for file in (tmp_path / "rows").rglob("*.parquet"):
        if file.parent.name not in keep:
            file.write_bytes(b"broken")
    assert [r.v for r in index.page(10_000, 50).collect()] == got


def test_no_rows(spark, tmp_path):
    index = build_pages(spark.range(0), [("id", False)], str(tmp_path))
    assert index.page(1, 10).count() == 0
