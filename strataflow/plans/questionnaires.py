"""Import job: sheet rows to the structure of a questionnaire and a report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.functions.sheet_cells import SECTION_ROWS, parse_constraints, parse_dependency
from strataflow.operators.ordered import with_offset
from strataflow.operators.questionnaire import carry_owners, check_sheet, nest_levels, number_sections, report_as_json


@dataclass(frozen=True)
class Questionnaire:
    sections: DataFrame
    groups: DataFrame
    questions: DataFrame
    choices: DataFrame
    dependencies: DataFrame
    report: DataFrame


def import_questionnaires(sheet: DataFrame) -> Questionnaire:
    """``sheet`` has ``sheet_id``, ``line`` and the sheet columns; rows are in line order."""
    numbered = number_sections(sheet)
    nested = nest_levels(sheet)
    owned = carry_owners(sheet)
    choices = owned.where(F.col("type") == "Choice")
    questions = nested.where(F.col("type") == "Question")
    return Questionnaire(
        sections=numbered.where(F.col("type").isin(*SECTION_ROWS)).select("sheet_id", "section", "line", "type", "text"),
        groups=nested.where(F.col("type") == "Group").select("sheet_id", "section", "line", "parent_line", "text"),
        questions=questions.select(
            "sheet_id",
            "section",
            "line",
            "parent_line",
            "implicit_group",
            "slug",
            "text",
            "data_type",
            parse_constraints(F.coalesce("constraints", F.lit(""))).alias("constraints"),
            (F.lower("search") == "yes").alias("searchable"),
        ),
        choices=with_offset(choices, ["sheet_id", "owner_line"], "line", "place").select(
            "sheet_id", F.col("owner_line").alias("question_line"), (F.col("place") + 1).alias("place"), "slug", "text"
        ),
        dependencies=sheet.where(F.coalesce("dependencies", F.lit("")) != "").select(
            "sheet_id", "line", "slug", parse_dependency(F.col("dependencies")).alias("needs")
        ),
        report=report_as_json(check_sheet(sheet)),
    )
