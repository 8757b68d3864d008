from __future__ import annotations

import zlib
from collections import defaultdict

import pytest

from strataflow.llm import sharding, workload
from tests.llm.helpers import SF_DIR, jump, odd_documents, with_clashes


def _check(rows, shards):
    slots = defaultdict(list)
    for row in rows:
        if row.doc_id is not None:
            assert row.shard == jump(row.doc_id, shards)
            assert row.grown_shard == jump(row.doc_id, shards + 1)
        assert row.grown_shard in (row.shard, shards)
        slots[row.shard].append(row.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_query_against_published_hash(spark):
    texts = {r.doc_id: r.text for r in workload.table(spark, SF_DIR, "documents").collect()}
    rows = workload.QUERIES["op1_sharding"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    _check(rows, workload.SHARDS)
    for row in rows:
        data = texts[row.doc_id].encode()
        assert (row.size, row.text_crc32, row.law) == (len(data) + 8, zlib.crc32(data), "key")


def test_slots_follow_the_order_in_every_run(spark):
    runs = [sorted(workload.QUERIES["op1_sharding"](spark, SF_DIR).collect()) for _ in range(2)]
    assert runs[0] == runs[1]
    by_shard = defaultdict(list)
    for row in runs[0]:
        by_shard[row.shard].append((row.slot, row.doc_id))
    assert all([d for _, d in sorted(v)] == sorted(d for _, d in v) for v in by_shard.values())


@pytest.mark.parametrize("shards", [1, 2, 60, 1000])
def test_any_number_of_shards(spark, shards):
    keys = spark.range(0, 3000).selectExpr("id * 7919 - 5000000 AS doc_id", "'t' AS text")
    _check(sharding.assign(keys, shards).collect(), shards)


def test_extreme_keys(spark):
    keys = [0, -1, 2**63 - 1, -(2**63), 1, 2**32, -(2**32)]
    df = spark.createDataFrame([(k, "t") for k in keys], "doc_id long, text string")
    _check(sharding.assign(df, 24).collect(), 24)


def test_odd_rows(spark):
    df = odd_documents(spark)
    rows = sharding.assign(with_clashes(df), 5, keep=("lang", "row")).collect()
    assert len(rows) == df.count()
    _check(rows, 5)
    nothing = [r for r in rows if r.text_crc32 is None]
    assert len(nothing) == 2 and all(r.size == 8 for r in nothing)
    assert len({r.shard for r in rows if r.doc_id is None}) == 1


def test_repeats_are_split_over_ranges(spark):
    df = spark.range(0, 5000).selectExpr("CASE WHEN id % 3 = 0 THEN id ELSE 7 END AS doc_id", "'t' AS text")
    _check(sharding.assign(df, 3).collect(), 3)


def test_text_keys_and_empty_table(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y"), (None, None)], "doc_id string, text string")
    assert sharding.assign(df, 4).count() == 3
    empty = sharding.assign(df.limit(0), 4)
    assert empty.count() == 0 and empty.columns[:7] == [
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard",
    ]


def test_write_shards(spark, tmp_path):
    rows = sharding.assign(odd_documents(spark), 3)
    for _ in range(2):
        sharding.write_shards(rows, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == rows.count()
