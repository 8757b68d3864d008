"""The pipeline stage by stage and as a whole, and the registered queries."""

from __future__ import annotations

import math
import re
from collections import Counter

import pytest

import __spark_entry__
import corpus_pipeline
from strataflow.llm import workload
from tests.llm import helpers
from tests.llm.helpers import SF_DIR, groups, jump, near_links
from tests.oracle import connect, difference


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(workload.ORACLES))
def test_query(spark, con, name):
    problem = difference(workload.QUERIES[name](spark, SF_DIR), con, workload.ORACLES[name])
    assert problem is None, problem


def test_registered():
    numbers = sorted(int(m[1]) for n in workload.QUERIES if (m := re.match(r"op(\d+)_", n)))
    assert numbers == list(range(1, 14))
    assert {*workload.QUERIES, "pipeline"} <= set(__spark_entry__.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "mixture", "shards"]


def _plain_stages(rows, items):
    """Documents after the three filtering stages."""
    rows = [r for r in rows if re.search(r"[^\W\d_]", r.text or "")]
    prints = {r.doc_id: helpers.simhash(r.text) for r in rows}
    of = groups(near_links(sorted(set(prints.values()))), sorted(set(prints.values())))
    first = {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        first.setdefault(of[prints[r.doc_id]], r.doc_id)
    rows = [r for r in rows if r.doc_id in set(first.values())]
    plain = lambda t: " " + " ".join(re.findall(r"[a-z0-9\x80-\U0010ffff]+", t.lower())) + " "
    return [r for r in rows if not any(plain(i.text) in plain(r.text) for i in items)]


def test_run_by_brute_force(spark):
    rows = workload.table(spark, SF_DIR, "documents").collect()
    kept = {r.doc_id: r for r in _plain_stages(rows, workload.table(spark, SF_DIR, "benchmark").collect())}
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    times = Counter(r.doc_id for r in found)
    assert set(times) <= set(kept)
    by_source = {}
    for r in kept.values():
        by_source.setdefault(r.source, []).append(r)
    from tests.llm.test_mixing import _targets

    sizes = {s: sum(len(helpers.words_of(r.text)) for r in own) for s, own in by_source.items()}
    targets = _targets(sizes)
    for source, own in by_source.items():
        rate = float(targets[source] / sizes[source])
        assert all(math.floor(rate) <= times[r.doc_id] <= math.ceil(rate) for r in own)
        assert abs(sum(times[r.doc_id] for r in own) - rate * len(own)) < 1.001
    slots = {}
    for r in found:
        assert (r.text, r.source) == (kept[r.doc_id].text, kept[r.doc_id].source)
        assert (r.shard, r.grown_shard) == (jump(r.doc_id, 24), jump(r.doc_id, 25))
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("rows", ["odd", "none"])
@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_on_odd_rows(spark, name, rows):
    df = helpers.with_clashes(helpers.odd_documents(spark))
    df = df if rows == "odd" else df.limit(0)
    found = dict(corpus_pipeline.STAGES)[name](spark, df, SF_DIR)
    assert rows == "odd" or found.count() == 0
    if name != "shards":
        assert found.columns == df.columns
    assert found.count() <= 2 * df.count()
    assert {r.doc_id for r in found.collect()} <= {r[0] for r in helpers.odd_rows()}


def test_clashing_names_are_kept_and_can_be_written(spark, tmp_path):
    df = helpers.documents(spark, [(i, helpers.PLAIN, "en", "a") for i in range(5)])
    df = df.selectExpr("*", "doc_id * 7 as Size", "doc_id as _size", "doc_id + 1 as SLOT")
    dict(corpus_pipeline.STAGES)["shards"](spark, df, SF_DIR).write.parquet(str(tmp_path / "out"))
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert {c.lower() for c in rows.columns} >= {"size", "slot", "_size", "__size", "_slot"}
    assert {(r["_size"], r["__Size"], r["_SLOT"]) for r in rows.collect()} == {(i, 7 * i, i + 1) for i in range(5)}
