"""Stored states that stand for facts: quantiles and sets of users that merge without the facts.

Quantile states hold count, extremes, mean and squares beside a sketch whose ranks are off by 0.3% of the
count at most (99% of the time, for one percentile; exact up to a few thousand values). A total is merged from its strata, a new
batch is merged with the old ones. Null and NaN take no part.

User states hold a sketch of a set: exact up to 16,384 users, then with a standard error of 0.8%. The users of
any period are the union of its days, those of two periods the intersection of two unions; the error of
an intersection is that share of the union.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.schema import PERCENTILES
from strataflow.sources.sinks import append_batch

RANK_K, USERS_LOG2 = 1000, 14
# The rank error that the first number gives.
RANK_ERROR = 2.296 / RANK_K**0.9723


def quantile_states(facts: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """A state per group: ``n, low, high, mean, squares, sketch``; tasks sketch their rows before the shuffle."""
    number = F.col(value).cast("double")
    used = facts.select(*keys, F.when(~F.isnan(number), number).alias("_value")).where("_value IS NOT NULL")
    return used.groupBy(*keys).agg(
        F.count("_value").alias("n"),
        F.min("_value").alias("low"),
        F.max("_value").alias("high"),
        F.avg("_value").alias("mean"),
        (F.var_pop("_value") * F.count("_value")).alias("squares"),
        F.kll_sketch_agg_double("_value", RANK_K).alias("sketch"),
    )


def merged_quantiles(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States of wider groups, from those of narrower ones or of several batches."""
    keys = list(keys)
    weighed = F.sum(F.col("mean") * F.col("n")) / F.sum("n")
    merged = states.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        weighed.alias("mean"),
        # Squares about a mean near all of them, so that little is lost when they are moved to the common mean.
        F.collect_list(F.struct("n", "mean", "squares")).alias("_parts"),
        F.kll_merge_agg_double("sketch", RANK_K).alias("sketch"),
    )
    moved = F.aggregate(
        "_parts",
        F.lit(0.0),
        lambda total, p: total + p["squares"] + p["n"] * (p["mean"] - F.col("mean")) * (p["mean"] - F.col("mean")),
    )
    return merged.withColumn("squares", moved).select(*keys, "n", "low", "high", "mean", "squares", "sketch")


def distribution_of(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The columns of a distribution, with percentiles from the sketches."""
    spread = F.when(F.col("n") > 1, F.sqrt(F.col("squares") / (F.col("n") - 1)))
    cuts = [
        F.kll_sketch_get_quantile_double("sketch", F.lit(fraction)).alias(name) for name, fraction in PERCENTILES.items()
    ]
    return states.select(
        *keys,
        F.col("n").alias("count_value"),
        F.col("low").alias("min_value"),
        F.col("high").alias("max_value"),
        F.col("mean").alias("avg_value"),
        spread.alias("stdev_value"),
        *cuts,
    )


def user_states(views: DataFrame, keys: Sequence[str], user: str = "user_id") -> DataFrame:
    """A set of users per group, for instance per fingerprint and day."""
    return views.groupBy(*keys).agg(F.theta_sketch_agg(user, USERS_LOG2).alias("users"))


def merged_users(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    return states.groupBy(*keys).agg(F.theta_union_agg("users", USERS_LOG2).alias("users"))


def counted_users(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    return states.select(*keys, F.theta_sketch_estimate("users").alias("unique_views"))


def shared_users(first: DataFrame, second: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Users in both sets of a group; groups without one of the sets have none."""
    keys = list(keys)
    other = second.select(*keys, F.col("users").alias("_other"))
    both = first.select(*keys, "users").join(other, keys, "full")
    shared = F.theta_sketch_estimate(F.theta_intersection("users", "_other"))
    return both.select(*keys, F.coalesce(shared, F.lit(0)).alias("shared"))


def add_states(states: DataFrame, path: str, batch_id: int) -> None:
    """Store the states of a batch of facts; written again they replace themselves."""
    append_batch(states, path, batch_id)


def stored_states(spark: SparkSession, path: str) -> DataFrame:
    """States of all batches, to be merged."""
    return spark.read.parquet(path).drop("batch_id")
