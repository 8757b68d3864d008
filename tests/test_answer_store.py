"""Puts by sequence, whatever batch they come in; merges that touch few buckets."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from strataflow.operators.answerstore import AnswerStore
from strataflow.operators.submissions import upsert_answers

PUT = "fingerprint long, question string, value string, sequence long"


def test_two_changes_of_one_question(spark):
    current = spark.createDataFrame([(1, "q", "old"), (2, "q", "kept")], "fingerprint long, question string, value string")
    rows = [(1, "q", "first", 1), (1, "q", "second", 2), (3, "q", "x", 1), (3, "q", "", 2), (4, "q", None, 1), (4, "q", "y", 3)]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        changes = spark.createDataFrame(rows, "fingerprint long, question string, value string, seq long")
        got = {(r.fingerprint, r.value) for r in upsert_answers(current, changes).collect()}
        assert got == {(1, "second"), (2, "kept"), (4, "y")}
    unordered = changes.drop("seq").where("fingerprint = 1")
    assert {r.value for r in upsert_answers(current, unordered).where("fingerprint = 1").collect()} == {"second"}


def test_random_puts(spark, tmp_path):
    rng = random.Random(4)
    store, told, pending = AnswerStore(spark, str(tmp_path / "s"), 4), {}, []
    assert store.current().count() == 0 and store.merge() == 0
    puts = [(rng.randrange(30), rng.choice("ab"), rng.choice(["x", "y", "", None, " "]), i) for i in range(400)]
    rng.shuffle(puts)
    for batch_id in range(6):
        batch = puts[batch_id * 60 : batch_id * 60 + 60]
        for _ in range(rng.randrange(1, 3)):  # a batch written again changes nothing
            store.put(spark.createDataFrame(batch, PUT), batch_id)
        pending += batch
        if rng.random() < 0.5:
            store.merge()
        told = {}
        for fingerprint, question, value, sequence in sorted(pending, key=lambda p: p[3]):
            told[fingerprint, question] = value
        expected = {(f, q, v) for (f, q), v in told.items() if v and v.strip()}
        assert {tuple(r) for r in store.current().collect()} == expected
        some = store.current([3, 7, 99]).collect()
        assert {tuple(r) for r in some} == {e for e in expected if e[0] in (3, 7, 99)}


def test_a_merge_rewrites_touched_buckets_only(spark, tmp_path):
    store = AnswerStore(spark, str(tmp_path / "s"), 16)
    store.put(spark.range(1000).select(F.col("id").alias("fingerprint"), F.lit("q").alias("question"), F.lit("v").alias("value"), F.lit(0).alias("sequence")), 0)
    assert store.merge() == 16
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "s/base").rglob("*.parquet")}
    store.put(spark.createDataFrame([(5, "q", "new", 1)], PUT), 1)
    assert store.merge() == 1
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "s/base").rglob("*.parquet")}
    assert {p: after[p] for p in before} == before and len(after) - len(before) == 1
    # The replay of a merged batch, and a put that came late, change nothing.
    store.put(spark.createDataFrame([(5, "q", "new", 1)], PUT), 1)
    assert store.merge() == 0
    store.put(spark.createDataFrame([(5, "q", "older", 0), (6, "q", "", 0)], PUT), 2)
    assert {r.value for r in store.current([5]).collect()} == {"new"}
    assert store.current().count() == 999 


def test_a_failed_merge_changes_nothing(spark, tmp_path):
    store = AnswerStore(spark, str(tmp_path / "s"), 2)
    store.put(spark.createDataFrame([(1, "q", "a", 1), (2, "q", "b", 1)], PUT), 0)
    store.merge()
    store.put(spark.createDataFrame([(1, "q", "c", 2), (2, "q", "d", 2)], PUT), 1)
    # A base that was written, but not yet declared.
    left = spark.createDataFrame([(1, "q", "broken", 9, 1, 2, 0), (2, "q", "broken", 9, 1, 2, 1)], f"{PUT}, batch_id long, generation long, bucket int")
    left.write.mode("append").partitionBy("generation", "bucket").parquet(str(tmp_path / "s/base"))
    assert sorted(r.value for r in store.current().collect()) == ["c", "d"]
    store.merge()
    assert sorted(r.value for r in store.current().collect()) == ["c", "d"]
