"""The published example from file to request."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strataflow.operators.fanout import FilterSpec, count_matches, filter_rows, specs_from_registry
from strataflow.operators.profile import run_log, strata_consistency
from strataflow.operators.routing import applications_from_registry
from strataflow.plans.delivery import route, write_result_files
from strataflow.plans.filtering import run_filters
from strataflow.plans.ingest import QUARANTINE, RESULTS, UNKNOWN, UPLOADS, ingest, read_table
from strataflow.schema import CATALOGUE_COLUMNS, CATALOGUE_SCHEMA
from strataflow.sources.delimited import good_rows, malformed_rows, read_delimited
from strataflow.sources.manifest import MANIFEST_SCHEMA, identified, list_files, pending_files, unseen_files
from strataflow.sources.registry_dump import read_dump
from tests.golden import CATALOGUE_CSV, HEADER, IDENTIFIER, registry_dump


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "inbox" / IDENTIFIER
    folder.mkdir(parents=True)
    (folder / "results.csv").write_text(CATALOGUE_CSV)
    (folder / "notes.txt").write_text("not a catalogue file")
    return tmp_path / "inbox"


@pytest.fixture
def rows(spark, inbox):
    return good_rows(read_delimited(spark, f"{inbox}/*"))


@pytest.fixture
def registry(spark, tmp_path):
    path = tmp_path / "dump.json"
    path.write_text(registry_dump())
    return read_dump(spark, str(path))


def test_scan_is_typed(rows):
    assert rows.count() == 8
    types = dict(rows.dtypes)
    assert [types[f.name] for f in CATALOGUE_SCHEMA] == [f.dataType.simpleString() for f in CATALOGUE_SCHEMA]
    last = rows.where("analysis_id = 105").first()
    assert last.avg_value == 9899.6994022203245090 and last.stratum_1 is None
    assert last.database_identifier == IDENTIFIER


@pytest.mark.parametrize(
    "text, expected",
    [("analysis_id = 0", (1, 7, 0)), (None, (8, 0, 0)), ("p10_value > 1", (1, 3, 4)), ("stratum_1 = 8507", (1, 5, 2))],
)
def test_three_counts(rows, text, expected):
    got = count_matches(rows, ["database_identifier"], [FilterSpec(1, text)]).first()
    assert (got.matched, got.unmatched, got.unknown) == expected


def test_selection_and_canonical_order(rows):
    picked = filter_rows(rows, FilterSpec(1, "analysis_id = 0", ("count_value",)))
    assert picked.columns == ["count_value"] and picked.first().count_value == 1171
    assert filter_rows(rows, FilterSpec(2)).columns == CATALOGUE_COLUMNS


def test_strata_add_up(rows):
    got = strata_consistency(rows, ["database_identifier"], 103, 104).first()
    assert (got.total_count, got.strata_count, got.count_difference) == (1171, 1171, 0)
    assert got.strata_avg == pytest.approx(got.total_avg, abs=1e-9)


def test_run_log(rows):
    log = {r.analysis_id: r.elapsed_seconds for r in run_log(rows).collect()}
    assert log == {0: 0.151157, 103: 0.035455, 104: 0.043305}


def test_malformed_rows_are_kept_apart(spark, tmp_path):
    folder = tmp_path / "db"
    folder.mkdir()
    (folder / "a.csv").write_text(HEADER + "\n 7 , x ,,,,,5,,,,,,,,,\nbad,x,,,,,5,,,,,,,,,\n9,,,,,,,,,,,,,,,\n")
    scanned = read_delimited(spark, str(folder))
    good = good_rows(scanned).collect()
    assert [(r.analysis_id, r.stratum_1, r.count_value) for r in good] == [(7, "x", 5)]
    lines = sorted(r.line for r in malformed_rows(scanned).collect())
    assert lines[1] == "bad,x,,,,,5,,,,,,,,," and lines[0].startswith("9,")
    assert good_rows(scanned).count() == 1


def test_file_identity(spark, inbox):
    files = list_files(spark, str(inbox))
    first = identified(spark, files).first()
    assert files.count() == 1 and first.name == "results.csv" and first.content_id.startswith("lines:9:")
    loaded = spark.createDataFrame(
        [(IDENTIFIER, "results.csv", first.content_id, first.upload_id, first.file_path, first.file_time, first.length, 1)],
        MANIFEST_SCHEMA,
    )
    assert unseen_files(files, loaded).isEmpty()
    # The same lines in another order are another upload, as rows have their place in it.
    header, *lines = CATALOGUE_CSV.splitlines()
    (inbox / IDENTIFIER / "results.csv").write_text("\n".join([header, *reversed(lines)]) + "\n")
    again = identified(spark, list_files(spark, str(inbox)))
    assert pending_files(again, loaded).count() == 1 and again.first().upload_id != first.upload_id
    (inbox / IDENTIFIER / "results.csv").write_text(CATALOGUE_CSV)
    assert pending_files(identified(spark, list_files(spark, str(inbox))), loaded).isEmpty()
    (inbox / IDENTIFIER / "results.csv").write_text(CATALOGUE_CSV + "1,,,,,,3,,,,,,,,,\n")
    assert pending_files(identified(spark, list_files(spark, str(inbox))), loaded).count() == 1


def test_ingest_then_replace_then_repeat(spark, inbox, tmp_path, registry):
    lake = str(tmp_path / "lake")
    assert ingest(spark, str(inbox), lake, registry["databases"]).files == 1
    assert ingest(spark, str(inbox), lake, registry["databases"]).files == 0
    (inbox / IDENTIFIER / "results.csv").write_text(HEADER + "\n0,DEFAULT,,,,,1200,,,,,,,,,\nbad,,,,,,1,,,,,,,,,\n")
    other = inbox / "unregistered"
    other.mkdir()
    (other / "x.csv").write_text(HEADER + "\n0,DEFAULT,,,,,5,,,,,,,,,\n")
    assert ingest(spark, str(inbox), lake, registry["databases"], cleanup="move").files == 2

    assert read_table(spark, lake, RESULTS).count() == 10
    assert read_table(spark, lake, QUARANTINE).count() == 1
    known = read_table(spark, lake, UPLOADS).orderBy("batch_id").collect()
    assert [(u.database_identifier, u.rows, u.loaded, u.community_id) for u in known] == [
        (IDENTIFIER, 8, 8, 1), (IDENTIFIER, 2, 1, 1),
    ]
    assert [u.database_identifier for u in read_table(spark, lake, UNKNOWN).collect()] == ["unregistered"]
    assert len(list((inbox / IDENTIFIER / "succeed").glob("*.csv"))) == 1
    assert not (inbox / IDENTIFIER / "results.csv").exists()
    assert ingest(spark, str(inbox), lake, registry["databases"]).files == 0


def test_nothing_to_ingest(spark, tmp_path, registry):
    (tmp_path / "empty").mkdir()
    assert ingest(spark, str(tmp_path / "empty"), str(tmp_path / "lake"), registry["databases"]).files == 0


def test_delete_after_load(spark, inbox, tmp_path, registry):
    assert ingest(spark, str(inbox), str(tmp_path / "lake"), registry["databases"], cleanup="delete").files == 1
    assert not (inbox / IDENTIFIER / "results.csv").exists() and (inbox / IDENTIFIER / "notes.txt").exists()


def test_ingest_in_several_batches(spark, inbox, tmp_path, registry):
    for i in range(3):
        (inbox / IDENTIFIER / f"more{i}.csv").write_text(HEADER + f"\n0,DEFAULT,,,,,{i},,,,,,,,,\n")
    lake = str(tmp_path / "lake")
    assert ingest(spark, str(inbox), lake, registry["databases"], files_per_batch=3).files == 4
    assert read_table(spark, lake, RESULTS).count() == 11
    assert read_table(spark, lake, UPLOADS).select("batch_id").distinct().count() == 2


def test_file_to_requests(spark, inbox, registry, tmp_path):
    lake = str(tmp_path / "lake")
    ingest(spark, str(tmp_path / "inbox"), lake, registry["databases"])
    uploaded, announced = read_table(spark, lake, RESULTS), read_table(spark, lake, UPLOADS)
    assert [r.offset for r in uploaded.orderBy("offset").collect()] == list(range(8))
    upload_id = announced.first().upload_id
    specs = specs_from_registry(registry["filters"])
    assert [(s.filter_id, s.text, s.selections) for s in specs] == [(1, "analysis_id = 0", ("count_value",)), (2, None, ())]
    filtered = run_filters(uploaded, announced, registry["databases"], specs)
    assert filtered.done.first().done
    root = str(tmp_path / "files")
    requests = route(
        filtered.ready, filtered.output, registry["communities"], applications_from_registry(registry["applications"]), root
    )
    put, post = requests.orderBy("application_id").collect()
    assert (put.method, put.body) == ("POST", '{"series":"people","points":["1171"]}')
    assert put.options == '{"headers":{"X-Channel":"catalogue"}}'
    assert put.url == f"http://counts.example/v2/series?source={IDENTIFIER}" and put.file_path is None
    assert (post.method, post.body, post.file_field) == ("PATCH", None, "table")
    write_result_files(filtered.output, specs, root)
    sent = spark.read.option("header", True).csv(post.file_path)
    assert sent.columns == CATALOGUE_COLUMNS and sent.count() == 8
    count_only = spark.read.option("header", True).csv(f"{root}/filter_id=1/upload_id={upload_id}")
    assert [tuple(r) for r in count_only.collect()] == [("1171",)]


def test_upload_short_of_rows_is_not_delivered(spark, rows, registry):
    uploaded = rows.withColumns({"upload_id": F.lit(5).cast("long"), "offset": F.monotonically_increasing_id()})
    announced = spark.createDataFrame([(5, IDENTIFIER, 9)], "upload_id long, database_identifier string, rows long")
    filtered = run_filters(uploaded, announced, registry["databases"], specs_from_registry(registry["filters"]))
    assert filtered.ready.isEmpty() and not filtered.done.first().done


def test_announced_rows_that_did_not_arrive(spark, inbox, tmp_path, registry):
    lake = str(tmp_path / "lake")
    told = spark.createDataFrame([(IDENTIFIER, "results.csv", 9)], "database_identifier string, name string, rows long")
    ingest(spark, str(inbox), lake, registry["databases"], announced=told)
    uploads = read_table(spark, lake, UPLOADS)
    assert [(u.rows, u.loaded) for u in uploads.collect()] == [(9, 8)]
    specs = specs_from_registry(registry["filters"])
    assert run_filters(read_table(spark, lake, RESULTS), uploads, registry["databases"], specs).ready.isEmpty()


def test_empty_upload_is_complete(spark, rows, registry):
    """An announced upload without rows is done for every filter and ready as an empty slice."""
    uploaded = rows.withColumns({"upload_id": F.lit(5).cast("long"), "offset": F.col("file_row")})
    announced = spark.createDataFrame(
        [(5, IDENTIFIER, 8), (6, IDENTIFIER, 0)], "upload_id long, database_identifier string, rows long"
    )
    filtered = run_filters(uploaded, announced, registry["databases"], specs_from_registry(registry["filters"]))
    assert {(r.upload_id, r.filters_done, r.done) for r in filtered.done.collect()} == {(5, 2, True), (6, 2, True)}
    assert {(r.filter_id, r.upload_id, r["count"]) for r in filtered.ready.collect()} == {(1, 5, 1), (2, 5, 8), (1, 6, 0), (2, 6, 0)}
