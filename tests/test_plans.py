"""Plans: one scan for many filters, pushed filters, pruned columns, small sides broadcast."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from strataflow.operators import fanout, registry, routing, stats, uploads
from strataflow.operators.answers import answer_errors
from workload import catalogue
from workload.base import FILTERS, Tables

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture
def t(spark):
    return Tables(spark, SF_DIR)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text: str) -> int:
    return len(re.findall(r"(?<!Broadcast)Exchange (?:hash|range|Single)", text))


@pytest.mark.parametrize("build", [
    lambda t: fanout.count_matches(t.uploaded, ["upload_id"], FILTERS),
    lambda t: fanout.fan_out(t.uploaded, FILTERS),
])
def test_all_filters_share_one_scan(t, build):
    text = plan(build(t))
    assert text.count("FileScan parquet") == 1
    assert exchanges(text) <= 1 and "partial_count" in text or exchanges(text) == 0


def test_filter_and_columns_reach_the_scan(t):
    rows = t.read("lineitem").withColumnsRenamed({"l_orderkey": "analysis_id", "l_extendedprice": "p10_value"})
    picked = fanout.filter_rows(rows, fanout.FilterSpec(1, "analysis_id = 7 AND p10_value > 10", ("p10_value",)))
    text = plan(picked)
    pushed = text[text.index("PushedFilters") :]
    assert "EqualTo(l_orderkey,7)" in pushed and "GreaterThan(l_ext" in pushed
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in text
    assert exchanges(text) == 0


def test_registry_joins_do_not_shuffle_uploads(t):
    for joined in (
        uploads.known_uploads(t.uploads, t.databases),
        uploads.unknown_uploads(t.uploads, t.databases),
        registry.expand_reference(t.uploads, "database_id", t.databases, {"database_name": "n"}),
    ):
        text = plan(joined)
        assert "BroadcastHashJoin" in text and exchanges(text) == 0


def test_answer_checks_do_not_shuffle_texts(t):
    text = plan(answer_errors(catalogue.document_answers(t), catalogue.questions(t)))
    assert "BroadcastHashJoin" in text and exchanges(text) == 0


def test_latest_row_needs_no_window(t):
    text = plan(stats.latest_record(t.deliveries, ["application_id"], ["time", "event_id"]))
    assert "Window" not in text and "partial_max_by" in text


def test_pages_are_taken_without_a_full_sort(t):
    text = plan(stats.page(t.uploads, [F.desc("time"), F.desc("event_id")], 2, 20))
    assert "TakeOrderedAndProject" in text


def test_cells_of_a_slice_are_limited_before_the_shuffle(t):
    output = fanout.fan_out(t.uploaded, FILTERS)
    text = plan(routing._cells(output, ["filter_id", "upload_id"], "offset", {("count_value", 0), ("analysis_id", 1)}))
    assert "WindowGroupLimit" in text.split("Exchange")[1]
