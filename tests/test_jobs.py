"""Composite jobs on small inputs, checked against plain Python."""

from __future__ import annotations

import datetime
import json
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from strataflow.operators import answers, questionnaire, registry, search, stats, uploads
from strataflow.operators.submissions import upsert_answers
from strataflow.plans.delivery import in_batches, with_pandas
from strataflow.plans.history import submissions
from strataflow.plans.profiling import Analysis, write_profile
from strataflow.plans.questionnaires import import_questionnaires
from strataflow.plans.searching import run_searches
from strataflow.plans.recording import log_deliveries, record, report
from strataflow.plans.registration import current_registry
from strataflow.plans.validation import validate_answers
from strataflow.operators.profile import run_log
from strataflow.schema import CATALOGUE_COLUMNS, DELIVERY_SCHEMA, HEALTH_CHECK_SCHEMA
from strataflow.sources.sinks import export_answers, write_by_database


def test_change_log_replays_to_current_answers(spark):
    rng = random.Random(11)
    saves = []
    for fp in range(25):
        for seq in range(rng.randrange(1, 14)):
            saves.append((fp, seq, rng.choice("ab"), rng.choice(["", "x", "y", "z"]), rng.choice([None, "t1", "t1", "t2"])))
    frame = spark.createDataFrame(saves, "fingerprint long, seq long, question string, value string, token string")
    subscribers = spark.createDataFrame([(1, 3), (1, 3), (2, 7)], "user_id long, fingerprint long")
    done = submissions(frame.repartition(5), subscribers)

    # Plain merge: a submission ends when the token is absent or another one.
    state, log = {}, []
    for fp in range(25):
        current, token, number, open_changes = {}, object(), 0, {}
        for _, _, question, value, given in sorted(s for s in saves if s[0] == fp):
            if given is None or given != token:
                log += [(fp, number, q, p, n) for q, (p, n) in open_changes.items() if p != n]
                number, open_changes, token = number + 1, {}, given
            before = open_changes.get(question, (current.get(question), None))[0]
            open_changes[question] = (before, value or None)
            current[question] = value or None
        log += [(fp, number, q, p, n) for q, (p, n) in open_changes.items() if p != n]
        state.update({(fp, q): v for q, v in current.items() if v})
    assert {(r.fingerprint, r.question): r.value for r in done.current.collect()} == state
    got = {(r.fingerprint, r.submission, r.question, r.previous, r["next"]) for r in done.changes.collect()}
    assert got == set(log)
    told = {(r.user_id, r.fingerprint): r.changes for r in done.notices.collect()}
    assert told == {(u, f): n for u, f in ((1, 3), (2, 7)) if (n := sum(c[0] == f for c in log))}


def test_latest_state_does_not_depend_on_input_order(spark):
    events = [
        (1, 10, "ACTIVE", "a"), (2, 10, "EDIT", "b"), (3, 11, "ACTIVE", "c"), (4, 11, "STOPPED", None), (5, 12, "STOPPED", None),
        (6, 10, "STOPPED", None), (7, 10, "ACTIVE", "d"),
    ]
    for seed in range(3):
        random.Random(seed).shuffle(events)
        frame = spark.createDataFrame(events, "seq long, filter_id long, action string, filter string")
        got = {r.filter_id: (r.status, r.filter) for r in registry.latest_state(frame, "filter_id", ["seq"], ["filter"]).collect()}
        assert got == {10: ("ACTIVE", "d"), 11: ("STOPPED", "c"), 12: ("STOPPED", None)}


def test_registry_job(spark):
    filters = spark.createDataFrame(
        [(1, "ACTIVE", 1, "count", "analysis_id = 0", [1], ["count_value"]), (2, "ACTIVE", 2, "all", None, [1], None)],
        "seq long, action string, filter_id long, name string, filter string, communities array<long>, selections array<string>",
    )
    apps = spark.createDataFrame(
        [(1, "ACTIVE", 1, 7, "North", "t"), (2, "ACTIVE", 2, 8, "North", "t"), (3, "STOPPED", 2, 8, None, None)],
        "seq long, action string, filter_id long, application_id long, community string, request_template string",
    )
    communities = spark.createDataFrame([(4, "North")], "community_id long, community_name string")
    now = current_registry(filters, apps, communities)
    assert [r.filter_id for r in now.active_filters.collect()] == [1]
    assert [r.filter_id for r in now.to_stop.collect()] == [2]
    served = now.active_applications.collect()
    assert [(r.application_id, r.community_id, r.community_name) for r in served] == [(7, 4, "North")]


def test_recording(spark, tmp_path):
    at = datetime.datetime(2024, 1, 5)
    responses = spark.createDataFrame(
        [(1, at, 200, "ok", None), (1, at, None, None, "no route"), (2, at, 404, "gone", None)],
        "application_id int, time timestamp, status_code int, content string, error string",
    )
    deliveries = log_deliveries(responses)
    assert [f.name for f in deliveries.schema] == DELIVERY_SCHEMA.names
    beats = spark.createDataFrame([(1, at, "Periodic")], HEALTH_CHECK_SCHEMA)
    for batch_id in (0, 0):
        record({"deliveries": deliveries, "beats": beats}, str(tmp_path), batch_id)
    stored = spark.read.parquet(str(tmp_path / "deliveries"))
    uploads = spark.createDataFrame([(1, at, 10), (1, at + datetime.timedelta(days=1), 7)], "database_id int, time timestamp, rows int")
    databases = spark.createDataFrame([(1,), (2,)], "database_id int")
    made = report(databases, uploads, beats, stored, F.lit("2024-01-20 00:00:00").cast("timestamp"))
    assert {r.database_id: (r.age_seconds, r.active) for r in made.databases.collect()} == {1: (15 * 86400, False), 2: (None, False)}
    assert [(r.uploads, r.total_rows) for r in made.uploads.collect()] == [(2, 17)]
    assert [r.rows for r in made.latest_uploads.collect()] == [7]
    got = {r.application_id: (r.deliveries, r.failed, r.rejected) for r in made.deliveries.collect()}
    assert got == {1: (2, 1, 0), 2: (1, 0, 1)}


def test_pages_and_orders(spark):
    rows = spark.range(7).select("id", (F.col("id") % 2).alias("time"))
    got = stats.page(rows, [F.desc("time"), F.asc("id")], 2, 3).collect()
    assert [r.id for r in got] == [0, 2, 4]
    assert [r.id for r in stats.ordered_by(rows, "id", descending=True).take(2)] == [6, 5]
    assert [r.id for r in stats.newest_first(rows).take(2)] == [5, 3]
    with pytest.raises(ValueError):
        stats.ordered_by(rows, "id; drop table x")
    with pytest.raises(ValueError):
        stats.page(rows, [F.asc("id")], 0, 3)


def test_expansion_keeps_parents_without_children(spark):
    parents = spark.createDataFrame([(1, "a"), (2, "b")], "k int, name string")
    children = spark.createDataFrame([(1, 10), (1, 11), (3, 12)], "k int, c int")
    got = registry.expand_many(parents, "k", {"child": (children, F.col("c"))}).collect()
    assert sorted((r.k, r.kind or "", r.child or "") for r in got) == [(1, "child", "10"), (1, "child", "11"), (2, "", "")]


def test_questionnaire_import(spark):
    lines = [
        ("Question", "stray", "1", "short text", "", "stray", None, None, None, "No"),
        ("IntroSection", "Intro", None, None, None, None, None, None, None, None),
        ("Question", "Blood?", "1", "single choice", "help", "blood", None, "required: true", "No", "Yes"),
        ("Choice", "Yes", None, None, None, "yes", None, None, None, None),
        ("ChoiceInfo", "Which?", None, "short text", None, "which", None, None, None, None),
        ("Choice", "No", None, None, None, "no", None, None, None, None),
        ("Question", "Plasma", "2", "integer", "help", "plasma", "blood|yes", "min_value: 3", None, "no"),
        ("Section", "Main", None, None, None, None, None, None, None, None),
        ("Group", "Details", "1", None, None, None, None, None, None, None),
        ("Question", "Date", "2", "datum", "help", "plasma", "nothing|1", None, None, "yes"),
        ("Question", "Deep", "3", "url", "help", "deep", None, None, None, "yes"),
        ("Question", "Back", "zero", "url", "help", "back", None, None, None, "yes"),
        ("Title", "?", None, None, None, None, None, None, None, None),
    ]
    names = "type text level data_type description slug dependencies constraints tooltip search".split()
    sheet = spark.createDataFrame(
        [(1, i, *line) for i, line in enumerate(lines, 1)],
        "sheet_id long, line long, " + ", ".join(f"{n} string" for n in names),
    ).repartition(4)
    made = import_questionnaires(sheet)
    assert [(r.section, r.type) for r in made.sections.orderBy("line").collect()] == [(1, "IntroSection"), (2, "Section")]
    questions = {r.slug + str(r.line): r for r in made.questions.collect()}
    assert questions["plasma7"].parent_line == 3 and questions["plasma7"].implicit_group
    assert questions["plasma10"].parent_line == 9 and not questions["plasma10"].implicit_group
    assert questions["deep11"].parent_line == 10 and questions["blood3"].parent_line is None
    assert [tuple(c) for c in questions["plasma7"].constraints] == [("min_value", "integer", "3")]
    choices = made.choices.orderBy("place").collect()
    assert [(c.question_line, c.place, c.slug) for c in choices] == [(3, 1, "yes"), (3, 2, "no")]
    errors = {r.line: json.loads(r.errors)[str(r.line)] for r in made.report.collect() if r.errors}
    assert errors == {
        1: ["row before the first section"],
        10: ["unknown data type", "depends on an unknown question"],
        12: ["level is not a positive number"],
        13: ["unknown row type"],
    }
    warnings = {r.line: json.loads(r.warnings)[str(r.line)] for r in made.report.collect() if r.warnings}
    assert warnings == {
        1: ["question without help text"], 7: ["slug is used more than once"], 10: ["slug is used more than once"],
    }


def test_validation(spark):
    questions = spark.createDataFrame(
        [(1, "blood", "single choice", "required: true"), (1, "plasma", "integer", "min_value: 3"), (1, "tags", "multiple choice", "")],
        "questionnaire int, question string, type string, constraints string",
    )
    fingerprints = spark.createDataFrame([(5, 1), (6, 1)], "fingerprint long, questionnaire int")
    given = spark.createDataFrame(
        [(5, 1, "blood", "no"), (5, 1, "plasma", "2"), (5, 1, "tags", "a,c"), (6, 1, "plasma", "9"), (6, 2, "blood", "yes")],
        "fingerprint long, questionnaire int, question string, value string",
    )
    choices = spark.createDataFrame(
        [(1, "blood", "yes", 1), (1, "blood", "no", 2), (1, "tags", "a", 3), (1, "tags", "b", 4)],
        "questionnaire int, question string, ident string, choice_key int",
    )
    needs = spark.createDataFrame(
        [(1, "plasma", "blood", "yes")],
        "questionnaire int, question string, requires_question string, requires_choice string",
    )
    made = validate_answers(fingerprints, questions, given, choices, needs)
    assert {(r.fingerprint, r.question, r.code) for r in made.errors.collect()} == {(5, "plasma", "min_value"), (6, "blood", "required")}
    assert [(r.question, r.ident) for r in made.rejected_choices.collect()] == [("tags", "c")]
    assert {r.choice_key for r in made.choices.collect()} == {2, 3, None}
    assert {r.fingerprint for r in made.surplus.collect()} == {5, 6}
    assert {r.integer_value for r in made.typed.where("question = 'plasma'").collect()} == {2, 9}


def test_upsert(spark):
    current = spark.createDataFrame([(1, "a", "x"), (1, "b", "y")], "fingerprint int, question string, value string")
    changes = spark.createDataFrame([(1, "b", ""), (2, "a", "z")], "fingerprint int, question string, value string")
    got = {(r.fingerprint, r.question, r.value) for r in upsert_answers(current, changes).collect()}
    assert got == {(1, "a", "x"), (2, "a", "z")}


def test_pandas_access(spark):
    output = spark.createDataFrame([(1, 5, 3), (1, 5, 4), (2, 5, 7)], "filter_id long, upload_id long, count_value long")

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.groupby(["filter_id", "upload_id"], as_index=False)["count_value"].sum()

    schema = "filter_id long, upload_id long, count_value long"
    got = with_pandas(output, total, schema, ["filter_id", "upload_id"]).collect()
    assert sorted(map(tuple, got)) == [(1, 5, 7), (2, 5, 7)]
    doubled = in_batches(output, lambda pdf: pdf.assign(count_value=pdf.count_value * 2), schema)
    assert sorted(r.count_value for r in doubled.collect()) == [6, 8, 14]


def test_profile_job_writes_rows_and_log(spark, tmp_path):
    facts = spark.createDataFrame([(1, "f", 3.0), (1, "m", 5.0), (2, "f", 1.0)], "database_id int, sex string, age double")
    facts = facts.withColumn("person_id", F.monotonically_increasing_id())
    analyses = [Analysis(0, "persons", entity="person_id"), Analysis(104, "persons", strata=("sex",), value="age")]
    elapsed = write_profile({"persons": facts}, analyses, ["database_id"], str(tmp_path))
    rows = spark.read.parquet(str(tmp_path / "rows")).drop("analysis")
    assert rows.count() == 5 and rows.columns == ["database_id", *CATALOGUE_COLUMNS]
    log = run_log(spark.read.parquet(str(tmp_path / "accounting")))
    assert {r.analysis_id: r.elapsed_seconds for r in log.collect()} == pytest.approx(elapsed, abs=1e-5)


def test_rows_of_one_database_prune_the_others(spark, tmp_path):
    rows = spark.range(20).select((F.col("id") % 4).cast("string").alias("database_identifier"), "id")
    write_by_database(rows, str(tmp_path / "t"))
    one = uploads.rows_of_database(spark.read.parquet(str(tmp_path / "t")), "2", {"id": "row"})
    assert sorted(r.row for r in one.collect()) == [2, 6, 10, 14, 18]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(database_identifier" in plan


def test_export_honours_permissions(spark, tmp_path):
    given = spark.createDataFrame(
        [(1, 1, "a", 'say "hi",\nthere'), (1, 1, "b", "x"), (2, 1, "b", "y")],
        "fingerprint int, questionnaire int, question string, value string",
    )
    questions = spark.createDataFrame(
        [(1, "a", 1), (1, "b", 2), (2, "b", 9)], "questionnaire int, question string, question_set int"
    )
    stored = spark.createDataFrame(
        [(1, 2, True, True, False), (2, 2, False, True, None)],
        "fingerprint int, question_set int, visible boolean, indexable boolean, exportable boolean",
    )
    export_answers(given, questions, stored, str(tmp_path / "out"))
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    got = sorted(map(tuple, reader.csv(str(tmp_path / "out")).collect()))
    assert got == [("1", "a", 'say "hi",\nthere'), ("2", "b", "y")]


def test_source_tags(spark):
    tagged = uploads.with_source(spark.range(2), 7, "ident")
    assert {tuple(r) for r in tagged.collect()} == {(0, 7, "ident"), (1, 7, "ident")}
    both = uploads.union_sources(tagged, uploads.with_source(spark.range(1), 8, "other"))
    assert both.count() == 3


def test_searches(spark):
    given = spark.createDataFrame(
        [(1, 1, "city", "Aveiro"), (1, 1, "size", "12"), (2, 1, "city", "Porto"), (2, 1, "size", "many"), (3, 1, "note", "Aveiro")],
        "fingerprint int, questionnaire int, question string, value string",
    )
    questions = spark.createDataFrame(
        [(1, "city", 1, True), (1, "size", 1, True), (1, "note", 2, False)],
        "questionnaire int, question string, question_set int, searchable boolean",
    )
    stored = spark.createDataFrame([(9, 1, True, False, True)], "fingerprint int, question_set int, visible boolean, indexable boolean, exportable boolean")
    queries = {
        1: search.Match("city", "contains", "AVEI"),
        2: search.Not(search.Match("size", "at_least", 10)),
        3: search.Any((search.Match("note", "equals", "aveiro"), search.All((search.Match("city", "equals", "porto"), search.Not(search.Match("size", "at_most", 3)))))),
    }
    fingerprints = spark.createDataFrame([(1,), (2,), (3,)], "fingerprint int")
    found = run_searches(fingerprints, given, questions, stored, queries)
    assert {(r.search_id, r.fingerprint) for r in found.hits.collect()} == {(1, 1), (2, 2), (2, 3), (3, 2)}
    assert {r.fingerprint: r.hits for r in found.counts.collect()} == {1: 1, 2: 2, 3: 1}


def test_questions_are_known_by_questionnaire_and_slug(spark):
    """Slugs repeat between questionnaires; answers to another one neither complete nor fill this one."""
    questions = spark.createDataFrame(
        [
            (1, 1, "a", "short text", "required: true"),
            (1, 1, "b", "short text", "required: true"),
            (2, 1, "a", "integer", ""),
            (2, 1, "c", "integer", "required: true"),
        ],
        "questionnaire int, question_set int, question string, type string, constraints string",
    )
    fingerprints = spark.createDataFrame([(7, 1), (8, 2)], "fingerprint long, questionnaire int")
    given = spark.createDataFrame(
        [(7, 1, "a", "x"), (7, 2, "c", "1"), (7, 2, "a", "2"), (8, 2, "c", "3"), (8, 2, "a", "4")],
        "fingerprint long, questionnaire int, question string, value string",
    )
    gate = {r.fingerprint: (r.missing_required, r.complete) for r in answers.publishable(fingerprints, questions, given).collect()}
    assert gate == {7: (1, False), 8: (0, True)}
    filled = {(r.fingerprint, r.answered, r.questions) for r in answers.fill_percentage(fingerprints, questions, given).collect()}
    assert filled == {(7, 1, 2), (8, 2, 2)}
    assert answers.type_answers(given, questions).count() == given.count()


def test_levels_of_any_depth(spark):
    lines = [("Section", None), ("Question", 1), ("Question", 10), ("Question", 11), ("Question", 40), ("Question", 12)]
    names = "text data_type description slug dependencies constraints tooltip search".split()
    sheet = spark.createDataFrame(
        [(1, i, kind, None if level is None else str(level), *[None] * len(names)) for i, (kind, level) in enumerate(lines, 1)],
        "sheet_id long, line long, type string, level string, " + ", ".join(f"{n} string" for n in names),
    )
    parents = {r.line: r.parent_line for r in questionnaire.nest_levels(sheet).collect()}
    assert parents == {2: None, 3: 2, 4: 3, 5: 4, 6: 4}
