"""The registry as stream state: late messages, restarts, forgotten entities."""

from __future__ import annotations

import datetime

from strataflow.streaming import registry

SCHEMA = "entity long, seq long, time timestamp, action string, fields string"


def _day(n):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(days=n)


def test_messages_in_batches(spark, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def arrive(rows):
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(source)

    def run(**more):
        arriving = spark.readStream.schema(SCHEMA).parquet(source)
        query = registry.fold_registry(arriving, out, progress, keep_hours=24 * 10, lateness="1 day", **more)
        assert query.awaitTermination(90) and query.exception() is None
        current = registry.registry_at(spark, out, "filter_id", "name string")
        return {r.filter_id: (r.status, r.name) for r in current.collect()}

    arrive([(1, 10, _day(0), "ACTIVE", '{"name":"a"}'), (2, 11, _day(0), "ACTIVE", '{"name":"b"}'), (3, 5, _day(0), "EDIT", '{"name":"c"}')])
    assert run() == {1: ("ACTIVE", "a"), 2: ("ACTIVE", "b"), 3: ("STOPPED", "c")}
    # Stopped between two batches; an older edit comes late and changes nothing.
    arrive([(1, 12, _day(1), "STOPPED", None), (2, 9, _day(1), "EDIT", '{"name":"old"}'), (3, 6, _day(1), "ACTIVE", '{"name":"d"}')])
    assert run() == {1: ("STOPPED", "a"), 2: ("ACTIVE", "b"), 3: ("ACTIVE", "d")}
    assert run() == {1: ("STOPPED", "a"), 2: ("ACTIVE", "b"), 3: ("ACTIVE", "d")}
    # Time passes: what is stopped is forgotten, what is active stays.
    arrive([(4, 20, _day(40), "ACTIVE", '{"name":"e"}')])
    assert run() == {2: ("ACTIVE", "b"), 3: ("ACTIVE", "d"), 4: ("ACTIVE", "e")}
    arrive([(1, 30, _day(41), "EDIT", '{"name":"again"}')])
    assert run()[1] == ("STOPPED", "again")


def test_snapshot(spark, tmp_path):
    snapshot = spark.createDataFrame([(1, 7, "ACTIVE", 10, 12, '{"name":"a"}'), (2, 3, "STOPPED", 4, None, None)], registry.CHANGES)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(1, 11, _day(0), "STOPPED", None), (1, 8, _day(0), "EDIT", '{"name":"old"}')], SCHEMA).write.parquet(source)
    arriving = spark.readStream.schema(SCHEMA).parquet(source)
    query = registry.fold_registry(arriving, out, str(tmp_path / "cp"), snapshot)
    assert query.awaitTermination(90) and query.exception() is None
    rows = spark.read.parquet(out).collect()
    assert [(r.entity, r.version, r.status, r.status_seq, r.fields) for r in rows] == [(1, 8, "STOPPED", 11, '{"name":"a"}')]
