"""Streams give what the batch gives, replays change nothing."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from strataflow.operators.fanout import FilterSpec, fan_out
from strataflow.schema import FILE_STATUS_SCHEMA
from strataflow.operators.uploads import upload_notifications
from strataflow.sources.delimited import good_rows, read_delimited
from strataflow.sources.manifest import identified, list_files, register_files
from strataflow.sources.messages import read_json, stream_json
from strataflow.sources.sinks import append_batch
from strataflow.streaming.uploads import (
    continuous_filter,
    process_uploads,
    stream_since,
    to_several,
    with_registered,
)
from strataflow.streaming.state import closing_uploads, liveness
from tests.golden import CATALOGUE_CSV, IDENTIFIER


def run(query):
    assert query.awaitTermination(60)
    assert query.exception() is None


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "inbox" / IDENTIFIER
    folder.mkdir(parents=True)
    (folder / "results.csv").write_text(CATALOGUE_CSV)
    return tmp_path / "inbox"


def registry(spark, statuses):
    databases = spark.createDataFrame([(IDENTIFIER, 1)], "database_identifier string, community_id long")
    filters = spark.createDataFrame(
        [(i, f"f{i}", text, ["count_value"], [1], status) for i, (text, status) in enumerate(statuses, 1)],
        "filter_id long, name string, filter string, selections array<string>, communities array<long>, status string",
    )
    return databases, filters


def test_uploads_stream(spark, inbox, tmp_path):
    manifest, lake, checkpoint = (str(tmp_path / n) for n in ("manifest", "lake", "checkpoint"))
    current = {"filters": [("analysis_id = 0", "ACTIVE"), ("p10_value > 1", "STOPPED")]}

    def step():
        register_files(spark, identified(spark, list_files(spark, str(inbox))), manifest)
        run(process_uploads(spark, manifest, lake, checkpoint, lambda: registry(spark, current["filters"])))

    step()
    assert spark.read.parquet(f"{lake}/results").count() == 8
    assert [r.filter_id for r in spark.read.parquet(f"{lake}/filtered").collect()] == [1]

    # The same name with new content is a new upload; a filter started meanwhile applies.
    (inbox / IDENTIFIER / "results.csv").write_text(CATALOGUE_CSV + "1,,,,,,3,,,,,,5,,,\n")
    current["filters"] = [("analysis_id = 0", "ACTIVE"), ("p10_value > 1", "ACTIVE")]
    step()
    assert spark.read.parquet(f"{lake}/results").count() == 17
    counts = spark.read.parquet(f"{lake}/counts").where("batch_id = 1").orderBy("filter_id").collect()
    assert [(c.matched, c.unmatched, c.unknown, c.complete) for c in counts] == [(1, 8, 0, True), (2, 3, 4, True)]
    ready = spark.read.parquet(f"{lake}/data_ready").where("batch_id = 1")
    assert {(r.filter_id, r["count"]) for r in ready.collect()} == {(1, 1), (2, 2)}
    # Slices go on after those of the first batch, and rows know their place in the upload.
    assert {(r.filter_id, r.last_offset) for r in ready.collect()} == {(1, 1), (2, 1)}
    assert sorted(r.offset for r in spark.read.parquet(f"{lake}/results").where("batch_id = 1").collect()) == list(range(9))

    # Nothing new: nothing happens.
    step()
    assert spark.read.parquet(f"{lake}/results").count() == 17
    assert good_rows(read_delimited(spark, f"{inbox}/*")).count() == 9

    # A database that nobody registered is listed, its rows go no further.
    (inbox / "stranger").mkdir()
    (inbox / "stranger" / "x.csv").write_text(CATALOGUE_CSV)
    step()
    assert spark.read.parquet(f"{lake}/results").count() == 17
    unknown = spark.read.parquet(f"{lake}/unknown_uploads").collect()
    assert [(r.database_identifier, r.held) for r in unknown] == [("stranger", 8)]


def test_continuous_filter_equals_batch(spark, tmp_path):
    source = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    rows = source.select(
        F.col("o_orderkey").alias("analysis_id"), F.col("o_totalprice").alias("p10_value"), F.lit("x").alias("database_identifier")
    )
    rows.repartition(5).write.parquet(str(tmp_path / "in"))
    stream = stream_since(spark, str(tmp_path / "in"), rows.schema)
    spec = FilterSpec(1, "p10_value > 200000", ("p10_value", "analysis_id"))
    databases = spark.createDataFrame([("x", 3)], "database_identifier string, community_id int")
    known = with_registered(stream, databases)
    run(continuous_filter(known, spec, str(tmp_path / "out"), str(tmp_path / "cp"), ("community_id",)))
    got = spark.read.parquet(str(tmp_path / "out"))
    want = fan_out(rows, [FilterSpec(1, "p10_value > 200000")])
    assert got.columns == ["community_id", "p10_value", "analysis_id"]
    assert got.count() == want.count() and got.agg(F.sum("analysis_id")).first() == want.agg(F.sum("analysis_id")).first()
    later = stream_since(spark, str(tmp_path / "in"), rows.schema, since="2999-01-01 00:00:00")
    run(continuous_filter(later, spec, str(tmp_path / "none"), str(tmp_path / "cp2")))
    assert spark.read.schema("analysis_id long").parquet(str(tmp_path / "none")).isEmpty()


def test_status_messages_and_several_sinks(spark, tmp_path):
    folder = tmp_path / "status"
    folder.mkdir()
    (folder / "a.json").write_text(
        '{"status":"COMPLETED","offset":{"rows":9,"timestamp":"2024-01-02T03:04:05Z"}}\n'
        '{"status":"READING","offset":{"rows":4,"timestamp":"2024-01-02T03:04:05Z"}}\n'
    )
    batch = upload_notifications(read_json(spark, str(folder), FILE_STATUS_SCHEMA), keep=())
    assert [(r.rows, r.time) for r in batch.collect()] == [(8, datetime.datetime(2024, 1, 2, 3, 4, 5))]
    stream = stream_json(spark, str(folder), FILE_STATUS_SCHEMA)
    sinks = {"uploads": lambda df: upload_notifications(df, keep=()), "status": lambda df: df.select("status")}
    run(to_several(stream, sinks, str(tmp_path / "out"), str(tmp_path / "cp")))
    assert spark.read.parquet(str(tmp_path / "out/uploads")).count() == 1
    assert spark.read.parquet(str(tmp_path / "out/status")).count() == 2


def test_replayed_batch_changes_nothing(spark, tmp_path):
    rows = spark.range(10)
    for batch_id in (0, 1, 1, 0):
        append_batch(rows, str(tmp_path / "t"), batch_id)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 20


def test_uploads_close_at_their_count(spark, tmp_path):
    data, told = str(tmp_path / "rows"), str(tmp_path / "told")
    checkpoint, closed = str(tmp_path / "cp"), []

    def arrive(path, schema, rows):
        timed = [(*r[:-1], datetime.datetime(2024, 1, 1, r[-1])) for r in rows]
        spark.createDataFrame(timed, f"{schema}, time timestamp").coalesce(1).write.mode("append").parquet(path)

    def step():
        changes = closing_uploads(
            stream_since(spark, data, spark.read.parquet(data).schema),
            stream_since(spark, told, spark.read.parquet(told).schema),
            patience_hours=4,
        )
        writer = changes.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
        run(
            writer.foreachBatch(lambda df, _: closed.extend((r.upload_id, r.seen, r.state) for r in df.collect()))
            .trigger(availableNow=True)
            .start()
        )

    arrive(data, "upload_id long", [(i % 2, 0) for i in range(10)])
    arrive(told, "upload_id long, rows long", [(0, 5, 0), (1, 6, 0), (3, 0, 0)])
    step()
    assert sorted(closed) == [(0, 5, "closed"), (3, 0, "closed")]
    arrive(data, "upload_id long", [(1, 1), (2, 1)])
    step()
    assert closed[2:] == [(1, 6, "closed")]
    # Nothing is told again, and what was never announced is forgotten in time.
    arrive(told, "upload_id long, rows long", [(4, 1, 9)])
    step()
    arrive(told, "upload_id long, rows long", [(5, 1, 9)])
    step()
    assert closed[3:] == [(2, 1, "expired")]


def test_silent_databases_are_noticed(spark, tmp_path):
    beats = str(tmp_path / "beats")

    def beat(*rows):
        data = [(d, datetime.datetime(2024, 1, 1, h)) for d, h in rows]
        spark.createDataFrame(data, "database_id int, time timestamp").coalesce(1).write.mode("append").parquet(beats)

    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def step():
        stream = stream_since(spark, beats, spark.read.parquet(beats).schema)
        writer = liveness(stream, period_hours=4, lateness="1 hour").writeStream.option("checkpointLocation", checkpoint)
        run(writer.outputMode("append").trigger(availableNow=True).format("parquet").start(out))

    beat((1, 0), (2, 0))
    step()
    beat((1, 3))
    step()
    beat((1, 6))
    step()
    got = {(r.database_id, r.state, r.since.hour) for r in spark.read.parquet(out).collect()}
    assert got == {(1, "active", 0), (2, "active", 0), (2, "silent", 4)}
