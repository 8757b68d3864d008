"""Typed reading and checking of answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataflow.functions.sheet_cells import constraint_value, parse_constraints

# Which column of an answer holds the value of a question type.
ANSWER_KIND = {
    "short text": "text",
    "long text": "text",
    "email": "text",
    "url": "text",
    "integer": "integer",
    "numeric": "numeric",
    "date": "date",
    "single choice": "choice",
    "multiple choice": "choices",
    "publication": "json",
    "choice tabular": "json",
    "open multiple": "json",
    "image": "image",
}

EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$"
URL = r"^(https?|ftp)://[^\s/?#]+(\.[^\s/?#.]+)+([/?#]\S*)?$"

DATE_FORMAT = "yyyy-MM-dd"
CHOICE_SEPARATOR = ","


def answer_kind(question_type: Column) -> Column:
    mapping = F.create_map(*[F.lit(v) for pair in ANSWER_KIND.items() for v in pair])
    return F.try_element_at(mapping, question_type)


def parse_date(value: Column, pattern: Column) -> Column:
    """Date in the given pattern; the usual pattern needs no formatter."""
    usual = F.when(value.rlike(r"^\d{4}-\d{2}-\d{2}$"), value.try_cast("date"))
    return F.when(F.coalesce(pattern, F.lit(DATE_FORMAT)) == DATE_FORMAT, usual).otherwise(
        F.try_to_timestamp(value, pattern).cast("date")
    )


def typed_columns(value: Column, kind: Column, separator: str = CHOICE_SEPARATOR) -> dict[str, Column]:
    """One typed column per kind of answer; all but one of them are NULL."""

    def when(name: str, column: Column) -> Column:
        return F.when(kind == name, column)

    return {
        "text_value": when("text", value),
        "integer_value": when("integer", value.try_cast("long")),
        "numeric_value": when("numeric", value.try_cast("double")),
        "date_value": when("date", parse_date(value, F.lit(DATE_FORMAT))),
        "choice_value": when("choice", value),
        "choices_value": when("choices", split_choices(value, separator)),
        "json_value": when("json", value),
        "image_value": when("image", value.cast("binary")),
    }


def split_choices(value: Column, separator: str = CHOICE_SEPARATOR) -> Column:
    """Chosen values of a multiple choice answer."""
    return F.filter(F.transform(F.split(value, "\\Q" + separator + "\\E"), lambda c: F.trim(c)), lambda c: c != "")


def join_choices(choices: Column, separator: str = CHOICE_SEPARATOR) -> Column:
    return F.array_join(choices, separator)


def checks_of(cell: Column, question_type: Column) -> Column:
    """Checks of a question as an array of ``(code, argument, pattern)``: declared ones and those of its type."""
    parsed = parse_constraints(F.coalesce(cell, F.lit("")))
    kind = answer_kind(question_type)
    nothing = F.lit(None).cast("string")

    def check(code: str, applies: Column, argument: Column = nothing, pattern: Column = nothing) -> Column:
        record = F.struct(F.lit(code).alias("code"), argument.alias("argument"), pattern.alias("pattern"))
        return F.when(F.coalesce(applies, F.lit(False)), record)

    def declared(name: str, applies: Column, pattern: Column = nothing) -> Column:
        value = constraint_value(parsed, name)
        return check(name, applies & value.isNotNull(), value, pattern)

    text, number, dated = kind == "text", kind.isin("integer", "numeric"), kind == "date"
    pattern = F.coalesce(constraint_value(parsed, "format"), F.lit(DATE_FORMAT))
    return F.array_compact(
        F.array(
            declared("min_length", text),
            declared("max_length", text),
            declared("regex", text),
            check("email", question_type == "email"),
            check("url", question_type == "url"),
            check("not_integer", kind == "integer"),
            check("not_numeric", kind == "numeric"),
            declared("min_value", number),
            declared("max_value", number),
            check("format", dated, pattern, pattern),
            declared("min_date", dated, pattern),
            declared("max_date", dated, pattern),
        )
    )


def is_required(cell: Column) -> Column:
    return F.coalesce(constraint_value(parse_constraints(F.coalesce(cell, F.lit(""))), "required") == "true", F.lit(False))


def fails_check(value: Column) -> Column:
    """Whether an answer fails the check of columns ``code, number, text, date, pattern``."""
    code, number, text, date = (F.col(c) for c in ("code", "number", "text", "date"))
    failed = (
        F.when(code == "min_length", F.length(value) < number)
        .when(code == "max_length", F.length(value) > number)
        .when(code == "min_value", value.try_cast("double") < number)
        .when(code == "max_value", value.try_cast("double") > number)
        .when(code == "regex", ~F.rlike(value, text))
        .when(code == "email", ~value.rlike(EMAIL))
        .when(code == "url", ~value.rlike(URL))
        .when(code == "not_integer", value.try_cast("long").isNull())
        .when(code == "not_numeric", value.try_cast("double").isNull())
    )
    parsed = parse_date(value, F.col("pattern"))
    dated = (
        F.when(code == "format", parsed.isNull())
        .when(code == "min_date", parsed < date)
        .when(code == "max_date", parsed > date)
    )
    # Dates apart: two small conditions compile better than a large one.
    return F.when(F.col("pattern").isNull(), failed).otherwise(dated)
