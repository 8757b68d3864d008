"""Publication job: complete drafts are published or wait for a community manager."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.operators.answers import publishable

DRAFT, PENDING, PUBLISHED = "draft", "pending", "published"


def publish(
    fingerprints: DataFrame, communities: DataFrame, questions: DataFrame, answers: DataFrame
) -> DataFrame:
    """State of each fingerprint after its owner asked for publication."""
    checked = publishable(fingerprints, questions, answers)
    joined = checked.join(communities.select("community", "auto_accept"), "community")
    state = (
        F.when(~F.col("draft"), PUBLISHED)
        .when(~F.col("complete"), DRAFT)
        .when(F.col("auto_accept"), PUBLISHED)
        .otherwise(PENDING)
    )
    return joined.withColumn("state", state)
