"""Registry and routing queries: folds, cascades, listings, expansions, requests."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from strataflow.operators import fanout, registry, routing
from strataflow.plans.delivery import route
from strataflow.plans.filtering import run_filters
from strataflow.schema import CATALOGUE_COLUMNS
from strataflow.session import cut_lineage, stage, stage_dir
from strataflow.streaming import registry as registry_stream
from workload.base import APPLICATIONS, FILTERS, VIEWS, query, with_views
from workload.filters import slices
from workload.profiles import profile_results

HALF = 1_705_276_800_000_000  # microseconds of 2024-01-15, the middle of the events

VIEWS["applications"] = """
SELECT application_id,
       coalesce(arg_max(action, event_id) FILTER (WHERE action <> 'EDIT'), 'STOPPED') AS status,
       arg_max(filter_id, event_id) FILTER (WHERE action <> 'STOPPED') AS filter_id,
       arg_max(community_id, event_id) FILTER (WHERE action <> 'STOPPED') AS community_id,
       arg_max(request_template, event_id) FILTER (WHERE action <> 'STOPPED') AS request_template
FROM management WHERE channel = 'click' GROUP BY application_id"""

VIEWS["filters"] = """
SELECT filter_id,
       coalesce(arg_max(action, event_id) FILTER (WHERE action <> 'EDIT'), 'STOPPED') AS status,
       arg_max([community_id, (community_id + 2) % 5], event_id) FILTER (WHERE action <> 'STOPPED') AS communities
FROM management WHERE channel = 'signup' GROUP BY filter_id"""


def applications(t):
    events = t.management.where(F.col("channel") == "click")
    return registry.latest_state(
        events, "application_id", ["event_id"], ["filter_id", "community_id", "request_template"]
    )


def filters(t):
    second = ((F.col("community_id") + 2) % 5).cast("int")
    events = t.management.where(F.col("channel") == "signup").withColumn("communities", F.array("community_id", second))
    return registry.latest_state(events, "filter_id", ["event_id"], ["communities"])


@query("registry_state", with_views("applications") + "SELECT * FROM applications")
def _state(t):
    return applications(t)


@query(
    "registry_lists",
    with_views("filters", "applications")
    + """SELECT 'application' AS kind, application_id AS id FROM applications WHERE status = 'ACTIVE' AND community_id = 1
UNION ALL SELECT 'filter', filter_id FROM filters WHERE status = 'ACTIVE' AND list_contains(communities, 3)""",
)
def _lists(t):
    apps = registry.list_entities(applications(t), {"status": "ACTIVE", "community_id": 1})
    chosen = registry.list_entities(filters(t), {"status": "ACTIVE"}, {"communities": 3})
    return apps.select(F.lit("application").alias("kind"), F.col("application_id").alias("id")).unionByName(
        chosen.select(F.lit("filter").alias("kind"), F.col("filter_id").alias("id"))
    )


@query(
    "registry_cascade",
    with_views("filters", "applications")
    + """SELECT filter_id, status, CASE WHEN EXISTS (SELECT 1 FROM applications a
         WHERE a.filter_id = f.filter_id AND a.status = 'ACTIVE') THEN 'ACTIVE' ELSE 'STOPPED' END AS derived_status
FROM filters f""",
)
def _cascade(t):
    return registry.cascade(filters(t), applications(t)).select("filter_id", "status", "derived_status")


@query(
    "registry_stopped_applications",
    with_views("filters", "applications")
    + """SELECT application_id, filter_id, CASE WHEN EXISTS (SELECT 1 FROM filters f WHERE f.filter_id = a.filter_id
       AND f.status = 'STOPPED') THEN 'STOPPED' ELSE status END AS status FROM applications a""",
)
def _stop_filters(t):
    stopped = filters(t).where(F.col("status") == "STOPPED")
    return registry.stop_filters(applications(t), stopped).select("application_id", "filter_id", "status")


@query(
    "registry_started_filters",
    with_views("filters", "applications")
    + """SELECT filter_id, CASE WHEN EXISTS (SELECT 1 FROM applications a WHERE a.filter_id = f.filter_id
       AND a.status = 'ACTIVE') THEN 'ACTIVE' ELSE status END AS status FROM filters f""",
)
def _start_applications(t):
    started = registry.active_only(applications(t))
    return registry.start_applications(filters(t), started).select("filter_id", "status")


@query(
    "registry_idle_filters",
    with_views("filters", "applications")
    + """SELECT filter_id FROM filters f WHERE status = 'ACTIVE' AND NOT EXISTS (
  SELECT 1 FROM applications a WHERE a.filter_id = f.filter_id AND a.status = 'ACTIVE')""",
)
def _idle(t):
    return registry.idle_filters(filters(t), applications(t)).select("filter_id")


_COLUMN_LIST = "[" + ", ".join(f"'{c}'" for c in CATALOGUE_COLUMNS) + "]"


@query(
    "selection_diff",
    with_views("messages")
    + f""", chosen AS (SELECT user_id AS filter_id, micros < {HALF} AS before,
   ({_COLUMN_LIST})[CAST(json_extract(props, '$.k') AS BIGINT) % 16 + 1] AS "column" FROM messages)
SELECT filter_id, "column", 'delete' AS change FROM (
  SELECT filter_id, "column" FROM chosen WHERE before EXCEPT SELECT filter_id, "column" FROM chosen WHERE NOT before)
UNION ALL SELECT filter_id, "column", 'create' FROM (
  SELECT filter_id, "column" FROM chosen WHERE NOT before EXCEPT SELECT filter_id, "column" FROM chosen WHERE before)""",
)
def _selection_diff(t):
    key = F.get_json_object("props", "$.k").cast("int") % 16
    names = F.array(*[F.lit(c) for c in CATALOGUE_COLUMNS])
    chosen = t.messages.select(F.col("user_id").alias("filter_id"), "micros", F.get(names, key).alias("column"))
    before = F.col("micros") < HALF
    return registry.selection_changes(chosen.where(before), chosen.where(~before), ["filter_id", "column"])


@query(
    "reference_lists",
    with_views("uploads", "databases", "communities")
    + """SELECT u.event_id, u."rows", d.database_name, c.community_name FROM uploads u
LEFT JOIN databases d ON u.database_id = d.database_id
LEFT JOIN communities c ON d.community_id = c.community_id""",
)
def _reference_lists(t):
    rows = t.uploads.select("event_id", "rows", "database_id")
    named = registry.expand_reference(
        rows, "database_id", t.databases, {"database_name": "database_name", "community_id": "community_id"}
    )
    named = registry.expand_reference(named, "community_id", t.communities, {"community_name": "community_name"})
    return named.select("event_id", "rows", "database_name", "community_name")


@query(
    "reference_many",
    with_views("databases", "uploads", "beats", "applications", "communities")
    + """, listed AS (
SELECT c.community_name AS parent, 'database' AS kind, d.database_name AS child
FROM communities c JOIN databases d ON c.community_id = d.community_id
UNION ALL SELECT c.community_name, 'application', a.application_id::VARCHAR
FROM communities c JOIN applications a ON c.community_id = a.community_id
UNION ALL SELECT d.database_name, 'upload', u.event_id::VARCHAR
FROM databases d JOIN uploads u ON d.database_id = u.database_id
UNION ALL SELECT d.database_name, 'health_check', b.event_id::VARCHAR
FROM databases d JOIN beats b ON d.database_id = b.database_id)
SELECT * FROM listed
UNION ALL SELECT d.database_name, NULL, NULL FROM databases d
 WHERE d.database_id NOT IN (SELECT database_id FROM uploads UNION SELECT database_id FROM beats)""",
)
def _reference_many(t):
    communities = registry.expand_many(
        t.communities,
        "community_id",
        {
            "database": (t.databases, F.col("database_name")),
            "application": (applications(t), F.col("application_id")),
        },
    )
    databases = registry.expand_many(
        t.databases.select("database_id", "database_name"),
        "database_id",
        {"upload": (t.uploads, F.col("event_id")), "health_check": (t.beats, F.col("event_id"))},
    )
    return communities.select(F.col("community_name").alias("parent"), "kind", "child").unionByName(
        databases.select(F.col("database_name").alias("parent"), "kind", "child")
    )


VIEWS["ready"] = """
SELECT r.filter_id, r.upload_id, r.database_identifier, r.last_offset, r."count", d.community_id, c.community_name
FROM data_ready r JOIN databases d ON r.database_identifier = d.database_identifier
JOIN communities c ON d.community_id = c.community_id
JOIN gates g ON r.filter_id = g.filter_id AND list_contains(g.gate_communities, d.community_id)
JOIN filter_counts f ON r.filter_id = f.filter_id AND r.upload_id = f.upload_id
JOIN announced a ON a.upload_id = r.upload_id AND f.matched + f.unmatched + f.unknown = a."rows\""""


def ready(t):
    return run_filters(t.uploaded, t.announced, t.databases, FILTERS).ready


@query(
    "ready_slices",
    with_views("ready")
    + 'SELECT filter_id, upload_id, database_identifier, last_offset, "count", community_id FROM ready',
)
def _ready(t):
    return ready(t)


@query(
    "ready_applications",
    with_views("ready", "applications")
    + """SELECT r.filter_id, r.upload_id, a.application_id FROM ready r JOIN applications a
  ON r.filter_id = a.filter_id AND a.status = 'ACTIVE' AND a.community_id = r.community_id""",
)
def _ready_applications(t):
    return routing.ready_applications(ready(t), applications(t)).select("filter_id", "upload_id", "application_id")


@query(
    "ready_applications_any_community",
    with_views("ready", "applications")
    + """SELECT r.filter_id, r.upload_id, a.application_id FROM ready r JOIN applications a
  ON r.filter_id = a.filter_id AND a.status = 'ACTIVE'""",
)
def _ready_any(t):
    served = routing.ready_applications(ready(t), applications(t), strict_community=False)
    return served.select("filter_id", "upload_id", "application_id")


_SELECTED = ", ".join(
    f"({s.filter_id}::BIGINT, {i}::INT, '{c}')"
    for s in FILTERS
    for i, c in enumerate(s.selections or CATALOGUE_COLUMNS)
)


@query(
    "ready_selections",
    with_views("data_ready")
    + f""", selections(filter_id, place, "column") AS (VALUES {_SELECTED})
SELECT r.filter_id, r.upload_id, s.place, s."column" FROM data_ready r JOIN selections s ON r.filter_id = s.filter_id""",
)
def _ready_selections(t):
    return slices(t).select("filter_id", "upload_id").join(fanout.selection_table(FILTERS, t.spark), "filter_id")


@query(
    "first_values",
    with_views("filter_output")
    + """SELECT filter_id, upload_id, arg_min(count_value, "offset") AS first_value
FROM filter_output GROUP BY filter_id, upload_id""",
)
def _first_values(t):
    output = fanout.fan_out(t.uploaded, FILTERS)
    return routing.first_values(output, ["filter_id", "upload_id"], "count_value", F.col("offset"))


@query(
    "request_payloads",
    with_views("ready", "filter_output")
    + """, firsts AS (SELECT filter_id, upload_id, arg_min(count_value, "offset") AS count_0,
   arg_min(p10_value, "offset") AS p10_0 FROM filter_output GROUP BY filter_id, upload_id),
seconds AS (SELECT filter_id, upload_id, analysis_id AS analysis_1 FROM filter_output
   QUALIFY row_number() OVER (PARTITION BY filter_id, upload_id ORDER BY "offset") = 2),
cells AS (SELECT r.*, f.count_0, f.p10_0, s.analysis_1 FROM ready r
   LEFT JOIN firsts f ON r.filter_id = f.filter_id AND r.upload_id = f.upload_id
   LEFT JOIN seconds s ON r.filter_id = s.filter_id AND r.upload_id = s.upload_id)
SELECT filter_id, upload_id, 1::BIGINT AS application_id, 'POST' AS method,
       'http://counts.example/v2/series?source=' || database_identifier AS url,
       '{"series":"people","points":["' || coalesce(count_0::VARCHAR, '') || '"]}' AS body,
       '{"headers":{"X-Channel":"catalogue"}}' AS options,
       NULL::VARCHAR AS file_field, NULL::VARCHAR AS file_path FROM cells WHERE filter_id = 1 AND community_id = 1
UNION ALL
SELECT filter_id, upload_id, 2, 'PATCH', 'http://archive.example/' || community_id || '/deposits',
       NULL, '{"params":{"origin":"' || database_identifier || '"}}', 'table',
       'results/filter_id=' || filter_id || '/upload_id=' || upload_id
FROM cells WHERE filter_id = 2 AND community_id = 0
UNION ALL
SELECT filter_id, upload_id, 3, 'POST', 'http://alerts.example/' || community_id || '/' || community_name,
       '{"first":"' || coalesce(p10_0::VARCHAR, '') || '","second":"' || coalesce(analysis_1::VARCHAR, '') || '"}',
       NULL, NULL, NULL FROM cells WHERE filter_id = 3 AND community_id = 3""",
)
def _request_payloads(t):
    filtered = run_filters(t.uploaded, t.announced, t.databases, FILTERS)
    return route(filtered.ready, filtered.output, t.communities, APPLICATIONS)


@query(
    "request_from_profile",
    with_views("results", "databases", "communities")
    + """, placed AS (SELECT r.*, analysis_id * 1000 + coalesce(ascii(stratum_1), 0) AS place FROM results r),
served AS (SELECT d.*, c.community_name FROM databases d JOIN communities c ON d.community_id = c.community_id
   WHERE d.database_id IN (SELECT database_id FROM results)),
counts AS (SELECT database_id, arg_min(count_value, place) AS count_0 FROM placed WHERE analysis_id = 0 GROUP BY database_id),
high AS (SELECT database_id, p10_value, analysis_id, row_number() OVER (PARTITION BY database_id ORDER BY place) AS n
   FROM placed WHERE p10_value > 20000)
SELECT 1::BIGINT AS filter_id, s.database_id::BIGINT AS upload_id, 1::BIGINT AS application_id, 'POST' AS method,
       'http://counts.example/v2/series?source=' || database_identifier AS url,
       '{"series":"people","points":["' || coalesce(count_0::VARCHAR, '') || '"]}' AS body,
       '{"headers":{"X-Channel":"catalogue"}}' AS options,
       NULL::VARCHAR AS file_field, NULL::VARCHAR AS file_path
FROM served s LEFT JOIN counts c ON s.database_id = c.database_id WHERE community_id = 1
UNION ALL
SELECT 2, database_id, 2, 'PATCH', 'http://archive.example/' || community_id || '/deposits',
       NULL, '{"params":{"origin":"' || database_identifier || '"}}', 'table', 'results/filter_id=2/upload_id=' || database_id
FROM served WHERE community_id = 0
UNION ALL
SELECT 3, s.database_id, 3, 'POST', 'http://alerts.example/' || community_id || '/' || community_name,
       '{"first":"' || coalesce(f.p10_value::VARCHAR, '') || '","second":"' || coalesce(n.analysis_id::VARCHAR, '') || '"}',
       NULL, NULL, NULL
FROM served s LEFT JOIN high f ON s.database_id = f.database_id AND f.n = 1
LEFT JOIN high n ON s.database_id = n.database_id AND n.n = 2 WHERE community_id = 3""",
)
def _request_from_profile(t):
    """Profile every database, run all filters over the catalogue rows, build all requests."""
    names = t.databases.select("database_id", "database_identifier")
    place = F.col("analysis_id") * 1000 + F.coalesce(F.ascii("stratum_1"), F.lit(0))
    # The profile job writes its table once; filtering and routing read that.
    rows = cut_lineage(profile_results(t).join(names, "database_id")).withColumns(
        {"upload_id": F.col("database_id").cast("long"), "offset": place}
    )
    announced = rows.groupBy("upload_id", "database_identifier").agg(F.count(F.lit(1)).alias("rows"))
    filtered = run_filters(rows, announced, t.databases, FILTERS)
    return route(filtered.ready, filtered.output, t.communities, APPLICATIONS)


@query("registry_stream", with_views("applications") + "SELECT * FROM applications")
def _stream(t):
    """Messages folded by a stream that comes in three parts, out of order; a second query begins with what the first one left."""
    events = t.management.where(F.col("channel") == "click")
    fields = ["filter_id", "community_id", "request_template"]
    messages = registry_stream.messages_of(events, "application_id", fields, "event_id")
    root = f"{stage_dir(t.spark, 'jobs')}/registry-{uuid.uuid4().hex}"

    def run(name: str, part: int, snapshot=None) -> None:
        messages.where(F.col("seq") % 3 == part).write.mode("append").parquet(f"{root}/in-{name}")
        for _ in range(2):  # the second time there is nothing new
            arriving = t.spark.readStream.schema(messages.schema).parquet(f"{root}/in-{name}")
            started = registry_stream.fold_registry(arriving, f"{root}/{name}", f"{root}/at-{name}", snapshot)
            started.awaitTermination()
            if started.exception() is not None:
                raise started.exception()

    run("first", 1)
    first = t.spark.read.schema(f"{registry_stream.CHANGES}, batch_id long").parquet(f"{root}/first")
    snapshot = stage(registry_stream.snapshot_of(first))
    run("second", 2, snapshot)
    run("second", 0, snapshot)
    # Entities that the second query heard nothing of are still as the snapshot has them.
    snapshot.withColumn("batch_id", F.lit(-1).cast("long")).drop("batch_id").write.parquet(f"{root}/second/batch_id=-1")
    ddl = "filter_id long, community_id int, request_template string"
    return registry_stream.registry_at(t.spark, f"{root}/second", "application_id", ddl)
