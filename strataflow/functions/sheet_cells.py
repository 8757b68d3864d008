"""Cells of questionnaire sheets: choices, tables, dependencies, constraints, question types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Question types of the former sheet format and what they became.
TYPE_MIGRATION = {
    "choice": "single choice",
    "choice-freeform": "single choice",
    "choice-multiple": "multiple choice",
    "choice-multiple-freeform": "multiple choice",
    "choice-multiple-freeform-options": "multiple choice",
    "choice-tabular": "choice tabular",
    "choice-yesno": "single choice",
    "choice-yesnodontknow": "single choice",
    "datepicker": "date",
    "email": "email",
    "integer": "integer",
    "numeric": "numeric",
    "open": "short text",
    "open-multiple": "open multiple",
    "open-multiple-composition": "open multiple",
    "open-textfield": "long text",
    "open-upload-image": "image",
    "open-validated": "short text",
    "publication": "publication",
    "url": "url",
}

# Former types without a successor, and the one that became a row type.
REMOVED_TYPES = ("custom", "open-button", "open-location", "sameas", "timeperiod")
GROUP_TYPE = "comment"

# Question types of the current sheet format.
QUESTION_TYPES = (
    "short text", "long text", "single choice", "multiple choice", "integer", "date", "email", "url",
    "numeric", "publication", "image", "choice tabular", "open multiple",
)

# Row types of the current sheet format.
SECTION_ROWS = ("IntroSection", "Section", "CloseSection")
ROW_TYPES = (
    *SECTION_ROWS, "Group", "Question", "Choice", "ChoiceInfo", "TabularChoice", "TabularRow", "Column", "ColumnChoice",
)

# Choices that some former types imply.
IMPLIED_CHOICES = {
    "choice-yesno": ["Yes", "No"],
    "choice-yesnodontknow": ["Yes", "No", "Do not Know"],
}

# Constraint names and the question types they apply to.
CONSTRAINTS = {
    "required": QUESTION_TYPES,
    "min_length": ("short text", "long text"),
    "max_length": ("short text", "long text"),
    "regex": ("short text", "long text"),
    "min_value": ("integer", "numeric"),
    "max_value": ("integer", "numeric"),
    "min_date": ("date",),
    "max_date": ("date",),
    "format": ("date",),
}

_CONSTRAINT = r'(\w+)\s*:\s*("(?:[^"\\]|\\.)*"|\S+)'


def parse_choices(cell: Column) -> Column:
    """Choices between bars; a trailing ``{...}`` asks for an extra text."""
    return F.transform(
        F.split(cell, r"\|"),
        lambda c: F.struct(
            F.trim(F.regexp_replace(c, r"\{\.\.\.\}\s*$", "")).alias("text"),
            c.rlike(r"\{\.\.\.\}\s*$").alias("has_extra"),
        ),
    )


def parse_tabular(cell: Column) -> Column:
    r"""Choices, rows and kind of a table question, parted by ``\\``, items by bars."""
    part = F.split(cell, r"\\\\")
    return F.struct(
        F.transform(F.split(F.get(part, F.lit(0)), r"\|"), lambda c: F.trim(c)).alias("choices"),
        F.transform(F.split(F.get(part, F.lit(1)), r"\|"), lambda c: F.trim(c)).alias("rows"),
        F.trim(F.get(part, F.lit(2))).alias("kind"),
    )


def parse_dependency(cell: Column) -> Column:
    """Question slug and one-based choice index; a text after the bar is a choice identifier."""
    part = F.split(cell, r"\|")
    choice = F.trim(F.get(part, F.lit(1)))
    return F.struct(
        F.trim(F.get(part, F.lit(0))).alias("slug"),
        choice.try_cast("int").alias("choice_index"),
        F.when(choice.try_cast("int").isNull(), choice).alias("choice_ident"),
    )


def _value_kind(raw: Column) -> Column:
    return (
        F.when(raw.startswith('"'), "string")
        .when(raw.isin("true", "false"), "boolean")
        .when(raw.rlike(r"^[+-]?\d+$"), "integer")
        .when(raw.rlike(r"^[+-]?\d*\.\d+$"), "numeric")
        .otherwise("string")
    )


def _unquoted(raw: Column) -> Column:
    inner = F.substring(raw, F.lit(2), F.length(raw) - 2)
    return F.when(raw.startswith('"'), F.regexp_replace(inner, r'\\(.)', "$1")).otherwise(raw)


def parse_constraints(cell: Column) -> Column:
    """Typed checks of a cell as an array of ``(name, kind, value)``."""
    names = F.regexp_extract_all(cell, F.lit(_CONSTRAINT), F.lit(1))
    values = F.regexp_extract_all(cell, F.lit(_CONSTRAINT), F.lit(2))
    return F.transform(
        F.arrays_zip(names.alias("name"), values.alias("raw")),
        lambda p: F.struct(
            p["name"].alias("name"),
            _value_kind(p["raw"]).alias("kind"),
            _unquoted(p["raw"]).alias("value"),
        ),
    )


def constraint_value(parsed: Column, name: str) -> Column:
    """Text of the last check with this name, NULL if there is none."""
    found = F.filter(parsed, lambda p: p["name"] == name)
    return F.when(F.size(found) > 0, F.element_at(found, -1)["value"])


def new_type(old: Column) -> Column:
    """Current question type of a former one; NULL when it has no successor."""
    mapping = F.create_map(*[F.lit(v) for pair in TYPE_MIGRATION.items() for v in pair])
    return F.try_element_at(mapping, old)


def implied_choices(old: Column) -> Column:
    """Choices of the shortcut types; an empty array for all others."""
    expanded = F.when(F.lit(False), F.array().cast("array<string>"))
    for name, choices in IMPLIED_CHOICES.items():
        expanded = expanded.when(old == name, F.array(*[F.lit(c) for c in choices]))
    return expanded.otherwise(F.array().cast("array<string>"))
