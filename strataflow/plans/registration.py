"""Registry job: management messages to the current filters and applications."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.operators.registry import active_only, cascade, expand_reference, idle_filters, latest_state


@dataclass(frozen=True)
class Registry:
    filters: DataFrame
    applications: DataFrame
    active_filters: DataFrame
    active_applications: DataFrame
    to_stop: DataFrame


def current_registry(
    filter_events: DataFrame,
    application_events: DataFrame,
    communities: DataFrame,
    order: tuple[str, ...] = ("seq",),
) -> Registry:
    """State after all messages; a filter is active while one of its applications is.

    Messages name the community of an application; it gets its ``community_id`` and
    ``community_name``, which delivery needs. A name that nobody registered has no id.
    """
    filters = latest_state(filter_events, "filter_id", order, ["name", "filter", "communities", "selections"])
    applications = latest_state(
        application_events, "application_id", order, ["filter_id", "community", "request_template"]
    ).withColumnRenamed("community", "community_name")
    applications = expand_reference(applications, "community_name", communities, {"community_id": "community_id"})
    derived = cascade(filters, applications)
    return Registry(
        filters=derived,
        applications=applications,
        active_filters=active_only(derived.withColumn("status", F.col("derived_status"))),
        active_applications=active_only(applications),
        to_stop=idle_filters(filters, applications),
    )
