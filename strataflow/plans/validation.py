"""Validation job: answers against their questions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.operators.answers import (
    QUESTION,
    answer_errors,
    missing_answers,
    resolve_choices,
    surplus_answers,
    type_answers,
    unknown_choices,
)


@dataclass(frozen=True)
class Validated:
    typed: DataFrame
    errors: DataFrame
    choices: DataFrame
    rejected_choices: DataFrame
    surplus: DataFrame


def validate_answers(
    fingerprints: DataFrame,
    questions: DataFrame,
    answers: DataFrame,
    choices: DataFrame,
    dependencies: DataFrame,
) -> Validated:
    """``choices``: questionnaire, question, ident, choice_key; ``dependencies``: questionnaire, question,
    requires_question, requires_choice.
    """
    choice_questions = questions.where(F.col("type").isin("single choice", "multiple choice")).select(*QUESTION)
    chosen = answers.join(choice_questions, QUESTION, "left_semi")
    resolved = resolve_choices(chosen, choices)
    selected = resolved.where("known").select("fingerprint", *QUESTION, F.col("ident").alias("choice"))
    return Validated(
        typed=type_answers(answers, questions),
        errors=answer_errors(answers, questions).unionByName(missing_answers(fingerprints, questions, answers)),
        choices=resolved,
        rejected_choices=unknown_choices(chosen, choices),
        surplus=surplus_answers(answers, dependencies, selected).where("surplus"),
    )
