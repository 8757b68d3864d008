"""Lines by byte ranges, identity of contents, the stream of registered files."""

from __future__ import annotations

import io
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strataflow.session import stage_path
from strataflow.sources import lines as source
from strataflow.sources.identity import content_digests
from strataflow.sources.manifest import clean_files, identified, list_files, read_ranges, register_files


def _plain(data: bytes):
    found, at = [], 0
    for line in data.split(b"\n"):
        found.append((at, line.removesuffix(b"\r")))
        at += len(line) + 1
    return found[:-1] if data.endswith(b"\n") or not data else found


TEXTS = [b"", b"\n", b"a", b"a\n", b"a\n\n\nbb\r\nccc", b"x" * 100, b"\r\n\r\n", b"one\ntwo\n" * 30, "ü文\n".encode() * 9]


@pytest.mark.parametrize("data", TEXTS)
@pytest.mark.parametrize("split", [1, 2, 3, 7, 1000])
@pytest.mark.parametrize("chunk", [1, 5, 4096])
def test_ranges_give_every_line_once(monkeypatch, data, split, chunk):
    monkeypatch.setattr(source, "CHUNK_BYTES", chunk)
    found = []
    for start in range(0, max(1, len(data)), split):
        for begins, lines in source.read_range(io.BytesIO(data), start, min(start + split, len(data))):
            found += zip(begins.tolist(), lines, strict=True)
    assert found == _plain(data)


def _files(tmp_path, contents):
    inbox = tmp_path / "inbox"
    for name, text in contents.items():
        file = inbox / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(text)
    return str(inbox)


def test_identity_knows_the_order_and_not_the_cut(spark, tmp_path):
    rng = random.Random(3)
    lines = [f"{i},{rng.random()}".encode() for i in range(5000)]
    swapped = lines.copy()
    swapped[4998], swapped[4999] = swapped[4999], swapped[4998]
    contents = {
        "a/1.csv": b"\n".join(lines) + b"\n",
        "b/1.csv": b"\r\n".join(lines),
        "c/1.csv": b"\n".join(swapped) + b"\n",
        "d/1.csv": b"\n".join([*lines, b"more"]),
        "e/1.csv": b"",
        "f/1.csv": b"same\nsame\n",
        "g/1.csv": b"same\n\nsame\n",
    }
    files = list_files(spark, _files(tmp_path, contents))
    ids = {r.database_identifier: r.content_id for r in identified(spark, files).collect()}
    # A file without a byte is not listed.
    assert len(set(ids.values())) == len(ids) == 6 and "e" not in ids
    found = []
    for split, leaf, fan_out in ((1 << 20, 64, 4), (1000, 64, 4), (77, 64, 4), (1 << 20, 64, 1024)):
        ranges = stage_path(source.byte_ranges(files, split))
        digests = content_digests(source.read_lines(spark, ranges), leaf, fan_out)
        found.append({r.file_path[-7:]: r.content_id for r in digests.collect()})
    assert found[0] == found[1] == found[2]
    assert all(len(set(f.values())) == len(f) for f in found)
    # A file alone has the identity it has among larger ones.
    small = files.where("database_identifier = 'f'")
    assert identified(spark, small).first().content_id == ids["f"]


def test_changed_files_are_left_for_the_next_listing(spark, tmp_path):
    inbox = _files(tmp_path, {"a/1.csv": b"h\n1\n", "b/1.csv": b"h\n2\n"})
    files = list_files(spark, inbox).cache()
    assert files.count() == 2
    (tmp_path / "inbox/a/1.csv").write_bytes(b"h\n1\nlonger\n")
    assert [r.database_identifier for r in identified(spark, files).collect()] == ["b"]
    files.unpersist()


def test_registered_batches(spark, tmp_path):
    inbox, manifest = _files(tmp_path, {"a/1.csv": b"h\n1\n"}), str(tmp_path / "manifest")
    for expected in (1, 0):
        assert register_files(spark, identified(spark, list_files(spark, inbox)), manifest) == expected
    _files(tmp_path, {"a/1.csv": b"h\n1\n2\n", "b/x y%.csv": b"h\n5\n"})
    assert register_files(spark, identified(spark, list_files(spark, inbox)), manifest) == 2
    assert read_ranges(spark, manifest).groupBy("batch_id").count().orderBy("batch_id").collect() == [(1, 1), (2, 2)]

    def streamed(name, since):
        out = str(tmp_path / name)
        stream = source.stream_lines(spark, manifest, since)
        query = stream.writeStream.option("checkpointLocation", f"{out}-at").trigger(availableNow=True).format("parquet").start(out)
        assert query.awaitTermination(60) is not False
        rows = spark.read.schema(stream.schema).parquet(out)
        return sorted((r.database_identifier, r.byte, bytes(r.value)) for r in rows.collect())

    # The first file was overwritten before anyone read it: its first version gives no lines.
    both = [("a", 0, b"h"), ("a", 2, b"1"), ("a", 4, b"2"), ("b", 0, b"h"), ("b", 2, b"5")]
    assert streamed("all", "earliest") == both
    assert streamed("all", "earliest") == both
    assert streamed("late", 1) == both
    assert streamed("none", "latest") == []


@pytest.mark.parametrize("policy", ["move", "delete"])
def test_cleanup_in_tasks(spark, tmp_path, policy):
    inbox = _files(tmp_path, {f"{d}/{i}.csv": b"h\n1\n" for d in "ab" for i in range(3)})
    files = identified(spark, list_files(spark, inbox)).withColumn("failed", F.col("database_identifier") == "b").cache()
    assert files.count() == 6
    (tmp_path / "inbox/a/0.csv").unlink()
    assert clean_files(spark, files, policy) == 5
    assert clean_files(spark, files, policy) == 0
    assert list_files(spark, inbox).isEmpty()
    kept = sorted(p.parent.name for p in (tmp_path / "inbox").rglob("*-*.csv"))
    assert kept == (["failed"] * 3 + ["succeed"] * 2 if policy == "move" else [])
    files.unpersist()


def test_few_ranges_go_to_a_task_each(tmp_path):
    for n, name in ((5, "few"), (6000, "many")):
        (tmp_path / name).mkdir()
        pq.write_table(pa.table({"file_path": [f"file:/{i}" for i in range(n)]}), tmp_path / name / "part-0.parquet")
    few, many = (source._parts(f"file://{tmp_path}/{name}", 16) for name in ("few", "many"))
    assert [(p.begin, p.end) for p in few] == [(i, i + 1) for i in range(5)]
    assert len(many) == 375 and sum(p.end - p.begin for p in many) == 6000
