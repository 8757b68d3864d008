"""Answers of fingerprints: typing, validation, completeness, export.

A question is known by its questionnaire and its slug: slugs repeat between questionnaires.
Answers, questions, choices and dependencies all carry both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions.typed_values import (
    answer_kind,
    checks_of,
    fails_check,
    is_required,
    parse_date,
    split_choices,
    typed_columns,
)

PERMISSIONS = ("visible", "indexable", "exportable")
QUESTION = ["questionnaire", "question"]


def unpivot_answers(rows: DataFrame, fingerprint: str, questionnaire: Column, questions: dict[str, Column]) -> DataFrame:
    """Answers as ``(fingerprint, questionnaire, question, value)``, from one scan of a wide table."""
    pairs = F.array(
        *[
            F.struct(F.lit(slug).alias("question"), value.cast("string").alias("value"))
            for slug, value in questions.items()
        ]
    )
    return rows.select(F.col(fingerprint).alias("fingerprint"), questionnaire.alias("questionnaire"), F.inline(pairs))


def non_empty(answers: DataFrame) -> DataFrame:
    return answers.where(F.trim("value") != "")


def expected_answers(fingerprints: DataFrame, questions: DataFrame, answers: DataFrame) -> DataFrame:
    """A row per fingerprint and question of its questionnaire; unanswered ones have a NULL value."""
    expected = fingerprints.join(questions, "questionnaire")
    return expected.join(answers, ["fingerprint", *QUESTION], "left")


def type_answers(answers: DataFrame, questions: DataFrame) -> DataFrame:
    """Answers with one typed column per kind."""
    kinds = questions.select(*QUESTION, "type", answer_kind(F.col("type")).alias("answer_kind"))
    typed = answers.join(kinds, QUESTION)
    return typed.withColumns(typed_columns(F.col("value"), F.col("answer_kind")))


def question_checks(questions: DataFrame) -> DataFrame:
    """One row per question and check, its argument typed."""
    listed = questions.select(*QUESTION, F.inline(checks_of(F.col("constraints"), F.col("type"))))
    return listed.select(
        *QUESTION,
        "code",
        F.col("argument").try_cast("double").alias("number"),
        F.col("argument").alias("text"),
        F.when(F.col("pattern").isNotNull(), parse_date(F.col("argument"), F.col("pattern"))).alias("date"),
        "pattern",
    )


def answer_errors(answers: DataFrame, questions: DataFrame) -> DataFrame:
    """A row per given answer and failed check.

    The checks of all questions are a small table, so answers are read once and their
    texts stay where they are.
    """
    checked = non_empty(answers).join(question_checks(questions), QUESTION)
    return checked.where(fails_check(F.col("value"))).select("fingerprint", *QUESTION, "code")


def required_questions(questions: DataFrame) -> DataFrame:
    """Questions whose constraints say that they are required."""
    return questions.where(is_required(F.col("constraints"))).select(*QUESTION)


def _given(answers: DataFrame, questions: DataFrame) -> DataFrame:
    """Keys of the answers to some questions; texts stay behind."""
    return non_empty(answers).select("fingerprint", *QUESTION).join(questions, QUESTION, "left_semi")


def missing_answers(fingerprints: DataFrame, questions: DataFrame, answers: DataFrame) -> DataFrame:
    """Required questions of a fingerprint's questionnaire without an answer, from the keys of the answers alone."""
    required = required_questions(questions)
    expected = fingerprints.select("fingerprint", "questionnaire").join(required, "questionnaire")
    missing = expected.join(_given(answers, required), ["fingerprint", *QUESTION], "left_anti")
    return missing.select("fingerprint", *QUESTION, F.lit("required").alias("code"))


def resolve_choices(answers: DataFrame, choices: DataFrame) -> DataFrame:
    """Chosen values as choice keys; ``known`` is false for values that are no choice."""
    chosen = answers.select("fingerprint", *QUESTION, F.explode(split_choices(F.col("value"))).alias("ident"))
    keyed = choices.select(*QUESTION, "ident", "choice_key")
    return chosen.join(keyed, [*QUESTION, "ident"], "left").withColumn("known", F.col("choice_key").isNotNull())


def unknown_choices(answers: DataFrame, choices: DataFrame) -> DataFrame:
    """Chosen values to reject."""
    chosen = answers.select("fingerprint", *QUESTION, F.explode(split_choices(F.col("value"))).alias("ident"))
    return chosen.join(choices.select(*QUESTION, "ident"), [*QUESTION, "ident"], "left_anti")


def surplus_answers(answers: DataFrame, dependencies: DataFrame, selected: DataFrame) -> DataFrame:
    """Answers of dependent questions, marked surplus when the required choice is not selected.

    ``dependencies``: questionnaire, question, requires_question, requires_choice; ``selected``:
    fingerprint, questionnaire, question, choice.
    """
    met = selected.select(
        "fingerprint",
        "questionnaire",
        F.col("question").alias("requires_question"),
        F.col("choice").alias("requires_choice"),
        F.lit(True).alias("_met"),
    ).distinct()
    dependent = answers.join(dependencies, QUESTION)
    return (
        dependent.join(met, ["fingerprint", "questionnaire", "requires_question", "requires_choice"], "left")
        .withColumn("surplus", F.col("_met").isNull())
        .drop("_met")
    )


def fill_percentage(fingerprints: DataFrame, questions: DataFrame, answers: DataFrame) -> DataFrame:
    """Share of answered questions per fingerprint and question set.

    Answers are counted first, so texts are never shuffled and unanswered questions need
    no rows of their own.
    """
    sets = ["questionnaire", "question_set"]
    totals = questions.groupBy(*sets).agg(F.count(F.lit(1)).alias("questions"))
    answered = (
        non_empty(answers)
        .join(questions.select(*QUESTION, "question_set"), QUESTION)
        .groupBy("fingerprint", *sets)
        .agg(F.count_distinct("question").alias("answered"))
    )
    expected = fingerprints.select("fingerprint", "questionnaire").join(totals, "questionnaire")
    filled = expected.join(answered, ["fingerprint", *sets], "left")
    return filled.select(
        "fingerprint",
        "question_set",
        F.coalesce("answered", F.lit(0)).cast("long").alias("answered"),
        "questions",
        F.round(100 * F.coalesce("answered", F.lit(0)) / F.col("questions"), 2).alias("percentage"),
    )


def publishable(fingerprints: DataFrame, questions: DataFrame, answers: DataFrame) -> DataFrame:
    """Whether every required question of a fingerprint's questionnaire is answered."""
    missing = missing_answers(fingerprints, questions, answers)
    counted = missing.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("missing_required"))
    checked = fingerprints.join(counted, "fingerprint", "left")
    checked = checked.withColumn("missing_required", F.coalesce("missing_required", F.lit(0).cast("long")))
    return checked.withColumn("complete", F.col("missing_required") == 0)


def summary_rows(fingerprints: DataFrame, questions: DataFrame, answers: DataFrame) -> DataFrame:
    """Number, name and answer of each question; unanswered questions are listed."""
    listed = expected_answers(fingerprints, questions, answers)
    return listed.select("fingerprint", "question_set", "number", F.col("text").alias("name"), "value")


def summary_wide(answers: DataFrame, slugs: Sequence[str]) -> DataFrame:
    """One row per fingerprint, one column per question."""
    return answers.groupBy("fingerprint").pivot("question", list(slugs)).agg(F.max("value"))


def answer_json(answers: DataFrame) -> DataFrame:
    """Each answer as the object that the read interface returns."""
    body = F.struct("question", F.coalesce("value", F.lit("")).alias("data"))
    return answers.select("fingerprint", "question", F.to_json(body).alias("answer"))


def answers_array(answers: DataFrame) -> DataFrame:
    """All answers of a fingerprint as one JSON array; a questionnaire bounds their number."""
    body = F.struct("question", F.coalesce("value", F.lit("")).alias("data"))
    listed = answers.groupBy("fingerprint").agg(F.sort_array(F.collect_list(body)).alias("_answers"))
    return listed.select("fingerprint", F.to_json("_answers").alias("answers"))
