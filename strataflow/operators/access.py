"""Who may see, search and export what."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.operators.answers import PERMISSIONS, QUESTION

# Access levels of a community, from open to closed.
OPEN, PUBLIC, MODERATED, INVITATION = "open", "public", "moderated", "invitation"

DEFAULTS = {"visible": True, "indexable": True, "exportable": True}


def with_permissions(question_sets: DataFrame, stored: DataFrame, defaults: dict[str, bool] = DEFAULTS) -> DataFrame:
    """Permissions of each fingerprint and question set; only differences are stored."""
    joined = question_sets.join(stored, ["fingerprint", "question_set"], "left")
    return joined.withColumns({p: F.coalesce(F.col(p), F.lit(defaults[p])) for p in PERMISSIONS})


def exportable_answers(answers: DataFrame, questions: DataFrame, stored: DataFrame) -> DataFrame:
    """Answers whose question set may be exported."""
    placed = answers.join(questions.select(*QUESTION, "question_set"), QUESTION)
    hidden = stored.where(~F.coalesce("exportable", F.lit(DEFAULTS["exportable"])))
    return placed.join(hidden.select("fingerprint", "question_set"), ["fingerprint", "question_set"], "left_anti")


def visible_fingerprints(
    fingerprints: DataFrame, communities: DataFrame, memberships: DataFrame, viewer: int
) -> DataFrame:
    """Fingerprints a viewer may open.

    Drafts are for their owners and the community's managers. Open communities admit
    everybody, public ones who accepted the terms, the others approved members.
    """
    mine = memberships.where(F.col("user_id") == viewer).select(
        "community", "role", F.col("accepted").alias("_accepted"), F.col("approved").alias("_approved")
    )
    joined = fingerprints.join(communities, "community").join(mine, "community", "left")
    manager = F.coalesce(F.col("role") == "manager", F.lit(False))
    owner = F.coalesce(F.col("owner") == viewer, F.lit(False))
    admitted = (
        (F.col("access") == OPEN)
        | ((F.col("access") == PUBLIC) & F.coalesce("_accepted", F.lit(False)))
        | (F.col("access").isin(MODERATED, INVITATION) & F.coalesce("_approved", F.lit(False)))
    )
    allowed = owner | manager | (~F.col("draft") & admitted)
    return joined.where(allowed).select(*fingerprints.columns)
