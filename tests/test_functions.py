"""Predicates, templates, cells and texts."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from strataflow.functions import sheet_cells, text, typed_values
from strataflow.functions.predicates import FilterTextError, compile_predicate
from strataflow.functions.templates import TemplateError, parse_template
from strataflow.operators.answers import answer_errors, missing_answers
from strataflow.schema import UPLOAD_SCHEMA, check_columns
from strataflow.sources.messages import decode_avro, decode_json, encode_json


@pytest.fixture(scope="module")
def row(spark):
    return spark.createDataFrame(
        [(104, "8507", None, 628, 14.5)],
        "analysis_id long, stratum_1 string, stratum_2 string, count_value long, avg_value double",
    )


PREDICATES = [
    ("stratum_1 = 8507", True),
    ("8507 = STRATUM_1", True),
    ("stratum_1 IN (8507, 8532)", True),
    ("stratum_1 not in (1, 2)", True),
    ("stratum_1 BETWEEN 8000 AND 9000 AND analysis_id = 104", True),
    ("stratum_2 = 1", None),
    ("stratum_2 IS NULL AND NOT (count_value > 1000)", True),
    ("lower(stratum_1) LIKE '85%' OR avg_value < 3", True),
    ("CASE WHEN avg_value > 10 THEN true ELSE false END", True),
    ("cast(stratum_1 AS bigint) + 1 = 8508", True),
    ("stratum_1 = 'it''s'", False),
    ("(analysis_id = 1 or analysis_id = 104) and coalesce(stratum_2, 'x') <> 'y'", True),
    ("", True),
    (None, True),
]


def test_predicates(row):
    columns = [compile_predicate(text).alias(f"p{i}") for i, (text, _) in enumerate(PREDICATES)]
    assert list(row.select(*columns).first()) == [expected for _, expected in PREDICATES]


@pytest.mark.parametrize(
    "predicate",
    [
        "exists (select 1)",
        "analysis_id in (select 1)",
        "count(*) > 1",
        "rand() > 0.5",
        "java_method('java.lang.System', 'exit', '0')",
        "reflect('a', 'b')",
        "unknown_column = 1",
        "analysis_id = 0; drop table x",
        "row_number() over (order by analysis_id) = 1",
        "analysis_id = 0 -- ` comment",
        "analysis_id(1) = 2",
    ],
)
def test_rejected_predicates(predicate):
    with pytest.raises(FilterTextError):
        compile_predicate(predicate)


def test_selection_columns():
    assert check_columns(["p10_value", "analysis_id", "p10_value"]) == ["p10_value", "analysis_id"]
    with pytest.raises(ValueError):
        check_columns(["mean_value"])


@pytest.mark.parametrize(
    "template",
    [
        '{"url": "x", "json": __import__("os").system("id")}',
        '{"url": "{{ config }}"}',
        '{"url": "{{ filtered_data["nope"][0] }}"}',
        '{"method": "PUT"}',
        '{"url": "x", "verify": False}',
        '"just text"',
        "{'url': other_file}",
        "{'url': ",
    ],
)
def test_rejected_templates(template):
    with pytest.raises(TemplateError):
        parse_template(template)


def test_template_escapes_json(spark):
    template = parse_template(
        '{"url": "u/{{ community }}", "json": {"a": ["{{ community }}", 1, None], "b": "x\\"y"}, "headers": {"h": "{{database_identifier}}"}}'
    )
    columns = template.columns()
    data = spark.createDataFrame([('q"\n', "id")], "community_name string, database_identifier string")
    got = data.select(*[c.alias(n) for n, c in columns.items()]).first()
    assert got.url == 'u/q"\n'
    assert got.body == '{"a":["q\\"\\n",1,null],"b":"x\\"y"}'
    assert got.options == '{"headers":{"h":"id"}}' and got.method == "POST"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_cells(spark):
    parsed = one(spark, sheet_cells.parse_choices(F.lit("Yes|No {...}| Other{...}")))
    assert [(c.text, c.has_extra) for c in parsed] == [("Yes", False), ("No", True), ("Other", True)]
    table = one(spark, sheet_cells.parse_tabular(F.lit(r"A|B\\r1| r2\\multiple-choice")))
    assert (table.choices, table.rows, table.kind) == (["A", "B"], ["r1", "r2"], "multiple-choice")
    assert tuple(one(spark, sheet_cells.parse_dependency(F.lit("Any_blood|2")))) == ("Any_blood", 2, None)
    assert tuple(one(spark, sheet_cells.parse_dependency(F.lit("Any_blood|yes")))) == ("Any_blood", None, "yes")
    assert tuple(one(spark, sheet_cells.parse_dependency(F.lit("alone")))) == ("alone", None, None)
    checks = one(spark, sheet_cells.parse_constraints(F.lit('name: "va: lue"  flag :true\n n:1 f : 1.5 s: value2')))
    assert [tuple(c) for c in checks] == [
        ("name", "string", "va: lue"), ("flag", "boolean", "true"), ("n", "integer", "1"), ("f", "numeric", "1.5"),
        ("s", "string", "value2"),
    ]
    assert one(spark, sheet_cells.implied_choices(F.lit("choice-yesnodontknow"))) == ["Yes", "No", "Do not Know"]
    assert one(spark, sheet_cells.implied_choices(F.lit("open"))) == []
    assert one(spark, sheet_cells.new_type(F.lit("datepicker"))) == "date"
    assert one(spark, sheet_cells.new_type(F.lit("sameas"))) is None
    assert len(sheet_cells.TYPE_MIGRATION) + len(sheet_cells.REMOVED_TYPES) + 1 == 26
    assert set(sheet_cells.TYPE_MIGRATION.values()) <= set(sheet_cells.QUESTION_TYPES)


CHECKED = [
    ("short text", None, "required: true", ["required"]),
    ("short text", "  ", "required: true", ["required"]),
    ("short text", "", "", []),
    ("short text", "abc", 'min_length: 4 regex: "^b"', ["min_length", "regex"]),
    ("email", "a@b", "", ["email"]),
    ("email", "a.b@c.example", "", []),
    ("url", "https://a.example/x?y=1#z", "", []),
    ("url", "a.example", "", ["url"]),
    ("integer", "1.5", "max_value: 1", ["not_integer", "max_value"]),
    ("numeric", "x", "min_value: 1", ["not_numeric"]),
    ("date", "31/12/1999", "format: dd/MM/yyyy max_date: 01/01/1999", ["max_date"]),
    ("date", "1999-12-31", "format: dd/MM/yyyy", ["format"]),
    ("date", "1999-02-30", "min_date: 2000-01-01", ["format"]),
    ("date", "1999-02-03", "min_date: 2000-01-01", ["min_date"]),
    ("single choice", "x", "min_length: 4", []),
]


def test_answer_checks(spark):
    questions = spark.createDataFrame(
        [(i, f"q{i}", kind, constraints) for i, (kind, _, constraints, _) in enumerate(CHECKED)],
        "questionnaire int, question string, type string, constraints string",
    )
    fingerprints = spark.createDataFrame([(i, i) for i in range(len(CHECKED))], "fingerprint int, questionnaire int")
    given = spark.createDataFrame(
        [(i, i, f"q{i}", value) for i, (_, value, _, _) in enumerate(CHECKED)],
        "fingerprint int, questionnaire int, question string, value string",
    )
    errors = answer_errors(given, questions).unionByName(missing_answers(fingerprints, questions, given))
    want = {(i, i, f"q{i}", code) for i, (_, _, _, codes) in enumerate(CHECKED) for code in codes}
    assert {tuple(r) for r in errors.collect()} == want


def test_typed_columns(spark):
    rows = spark.createDataFrame(
        [("date", "2021-02-30"), ("integer", "12"), ("multiple choice", "a, b,,c"), ("publication", "{}"), ("image", "x")],
        "type string, value string",
    ).withColumn("answer_kind", typed_values.answer_kind(F.col("type")))
    rows = rows.withColumns(typed_values.typed_columns(F.col("value"), F.col("answer_kind")))
    got = {r.type: r for r in rows.collect()}
    assert got["date"].date_value is None and got["date"].answer_kind == "date"
    assert got["integer"].integer_value == 12 and got["integer"].text_value is None
    assert got["multiple choice"].choices_value == ["a", "b", "c"]
    assert got["publication"].json_value == "{}" and got["image"].image_value == b"x"


def test_texts(spark):
    assert one(spark, text.csv_line([F.lit(None).cast("string"), F.lit('a,"b"'), F.lit(3)])) == ',"a,""b""",3'
    assert one(spark, text.html_escape(F.lit("<a href='x'>&</a>\""))) == "&lt;a href=&#x27;x&#x27;&gt;&amp;&lt;/a&gt;&quot;"


def test_messages_round_trip(spark):
    at = datetime.datetime(2024, 1, 2, 3, 4, 5, 678000)
    rows = spark.createDataFrame([("id", 1, at, 9)], UPLOAD_SCHEMA)
    encoded = encode_json(rows)
    assert encoded.first().value == '{"database_identifier":"id","database_id":1,"time":1704164645678,"rows":9}'
    assert decode_json(encoded, UPLOAD_SCHEMA).collect() == rows.collect()


def test_avro_is_optional(spark):
    rows = spark.createDataFrame([(b"x",)], "value binary")
    with pytest.raises(RuntimeError, match="spark-avro"):
        decode_avro(rows, '{"type":"record","name":"r","fields":[{"name":"a","type":"long"}]}', header_bytes=5)


FAILING = [
    ("avg_value / min_value > 1", [None, False]),
    ("avg_value % min_value = 1", [None, False]),
    ("CAST(stratum_1 AS INT) > 5", [None, True]),
    ("stratum_1 = -1", [False, False]),
    ("stratum_1 IN (7, -8)", [False, True]),
    ("stratum_1 > count_value", [None, True]),
    ("stratum_1 + 1 > 7", [None, True]),
    ("abs(stratum_1) = 7", [None, True]),
    ("analysis_id * analysis_id * analysis_id > 3", [True, False]),
    ("analysis_id + count_value > 3", [True, True]),
    ("mod(count_value, 0) = 1", [None, None]),
    ("(avg_value + 1) / CASE WHEN min_value > 0 THEN 2 ELSE 0 END = 0", [None, True]),
    ("count_value BETWEEN -3 AND 4", [False, True]),
    ("avg_value / -min_value < 3", [None, True]),
]


@pytest.mark.parametrize("filter_text, expected", FAILING)
def test_filters_never_fail_on_a_row(spark, filter_text, expected):
    """Rows hostile to a filter are unknown to it; the other rows are judged."""
    rows = spark.createDataFrame(
        [(1, 9223372036854775807, "abc", 5, 0.0, 1.0), (2, 1, "7", 3, 2.0, -1.0)],
        "row int, analysis_id long, stratum_1 string, count_value long, min_value double, avg_value double",
    )
    got = rows.orderBy("row").select(compile_predicate(filter_text).alias("p")).collect()
    assert [r.p for r in got] == expected
