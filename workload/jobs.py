"""Whole jobs on the given tables: files, messages, streams and sinks, each written, read back and compared."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.operators import registry, stats, uploads
from strataflow.operators.fanout import FilterSpec, fan_out, specs_from_registry
from strataflow.operators.routing import applications_from_registry
from strataflow.plans.delivery import in_batches, route, write_result_files
from strataflow.plans.filtering import run_filters
from strataflow.plans.history import submissions
from strataflow.plans.ingest import RESULTS, UPLOADS, ingest, read_table
from strataflow.plans.questionnaires import import_questionnaires
from strataflow.operators.pageindex import build_pages
from strataflow.plans.recording import log_deliveries, record, report
from strataflow.plans.registration import current_registry
from strataflow.plans.validation import validate_answers
from strataflow.schema import CATALOGUE_COLUMNS, DELIVERY_SCHEMA, FILE_STATUS_SCHEMA
from strataflow.session import stage_dir
from strataflow.sources.delimited import good_rows, malformed_rows, read_delimited, transformed
from strataflow.sources.manifest import identified, list_files, register_files
from strataflow.sources.messages import decode_json, encode_json, read_json, reencode
from strataflow.sources.registry_dump import read_dump
from strataflow.sources.sinks import append_batch, write_by_database
from strataflow.streaming.state import closing_uploads, liveness
from strataflow.streaming.uploads import continuous_filter, process_uploads, stream_since, to_several, with_registered
from workload.base import APPLICATIONS, FILTERS, query, with_views
from workload.catalogue import CHOICES, document_answers, fingerprints, questions, saves
from workload.registry import applications as folded_applications
from workload.registry import filters as folded_filters
from workload.sheets import sheet


def folder(t, name: str) -> str:
    """A new folder below the shared one."""
    return f"{stage_dir(t.spark, 'jobs')}/{name}-{uuid.uuid4().hex}"


def finished(streaming) -> None:
    streaming.awaitTermination()
    if streaming.exception() is not None:
        raise streaming.exception()


def write_inbox(t, inbox: str, rows: DataFrame | None = None, order: Column | None = None) -> None:
    """The uploaded rows as the sources would leave them: a folder per database, one delimited file in each."""
    rows = (t.uploaded if rows is None else rows).repartition("database_identifier")
    rows = rows.sortWithinPartitions("database_identifier", F.col("offset") if order is None else order)
    rows.select("database_identifier", *CATALOGUE_COLUMNS).write.partitionBy("database_identifier").option(
        "header", True
    ).option("nullValue", "").csv(inbox)
    jvm = t.spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(inbox)
    files = root.getFileSystem(t.spark.sparkContext._jsc.hadoopConfiguration())
    for status in files.listStatus(root):
        name = status.getPath().getName()
        if "=" in name:
            files.rename(status.getPath(), jvm.org.apache.hadoop.fs.Path(root, name.partition("=")[2]))


def registry_messages(t) -> tuple[DataFrame, DataFrame]:
    """Management messages that leave the filters and applications of the workload, and one of each stopped."""
    filters = [(i, "ACTIVE", s.filter_id, s.name, s.text, list(s.communities), list(s.selections)) for i, s in enumerate(FILTERS)]
    filters += [(90, "ACTIVE", 99, "gone", None, [0], []), (91, "STOPPED", 99, None, None, None, None)]
    names = [r.community_name for r in t.communities.orderBy("community_id").collect()]
    apps = [
        (i, "ACTIVE", a.filter_id, a.application_id, names[a.community_id], a.template) for i, a in enumerate(APPLICATIONS)
    ]
    apps += [(80, "ACTIVE", 4, 9, names[0], APPLICATIONS[0].template), (81, "STOPPED", 4, 9, None, None)]
    # A filter is active while an application of it is; the fourth has one of another community.
    apps += [(82, "ACTIVE", 4, 10, names[1], APPLICATIONS[0].template)]
    return (
        t.values(
            filters,
            "seq long, action string, filter_id long, name string, filter string, communities array<long>, "
            "selections array<string>",
        ),
        t.values(
            apps,
            "seq long, action string, filter_id long, application_id long, community string, request_template string",
        ),
    )


# Requests of files: one upload per database, filters and applications from the messages.
FILE_REQUESTS = (
    with_views("uploaded", "databases", "communities", "filter_output", "gates")
    + """, held AS (SELECT DISTINCT database_identifier FROM uploaded),
served AS (SELECT d.*, c.community_name FROM databases d JOIN communities c ON d.community_id = c.community_id
   JOIN held h ON h.database_identifier = d.database_identifier),
placed AS (SELECT *, row_number() OVER (PARTITION BY filter_id, database_identifier ORDER BY "offset") AS n FROM filter_output),
cells AS (SELECT s.*, g.filter_id, f.count_value AS count_0, f.p10_value AS p10_0, n.analysis_id AS analysis_1
   FROM served s JOIN gates g ON list_contains(gate_communities, s.community_id)
   LEFT JOIN placed f ON f.filter_id = g.filter_id AND f.database_identifier = s.database_identifier AND f.n = 1
   LEFT JOIN placed n ON n.filter_id = g.filter_id AND n.database_identifier = s.database_identifier AND n.n = 2)
SELECT 1::BIGINT AS application_id, 'POST' AS method, 'http://counts.example/v2/series?source=' || database_identifier AS url,
       '{"series":"people","points":["' || coalesce(count_0::VARCHAR, '') || '"]}' AS body,
       '{"headers":{"X-Channel":"catalogue"}}' AS options FROM cells WHERE filter_id = 1 AND community_id = 1
UNION ALL
SELECT 2, 'PATCH', 'http://archive.example/' || community_id || '/deposits',
       NULL, '{"params":{"origin":"' || database_identifier || '"}}' FROM cells WHERE filter_id = 2 AND community_id = 0
UNION ALL
SELECT 3, 'POST', 'http://alerts.example/' || community_id || '/' || community_name,
       '{"first":"' || coalesce(p10_0::VARCHAR, '') || '","second":"' || coalesce(analysis_1::VARCHAR, '') || '"}', NULL
FROM cells WHERE filter_id = 3 AND community_id = 3"""
)
REQUEST = ("application_id", "method", "url", "body", "options")


def current(t):
    return current_registry(*registry_messages(t), t.communities)


@query("job_files_to_requests", FILE_REQUESTS)
def _files_to_requests(t):
    """Files to requests: ingest, fold of the registry, filters, delivery; a second run finds nothing new."""
    inbox, lake = folder(t, "inbox"), folder(t, "lake")
    write_inbox(t, inbox)
    ingest(t.spark, inbox, lake, t.databases, files_per_batch=10)
    if ingest(t.spark, inbox, lake, t.databases).files:
        raise AssertionError("files were loaded twice")
    now = current(t)
    rows, announced = read_table(t.spark, lake, RESULTS), read_table(t.spark, lake, UPLOADS)
    filtered = run_filters(rows, announced, t.databases, specs_from_registry(now.active_filters))
    requests = route(filtered.ready, filtered.output, t.communities, applications_from_registry(now.active_applications))
    return requests.where("application_id < 9").select(*REQUEST)


@query("job_stream_to_requests", FILE_REQUESTS)
def _stream_to_requests(t):
    """The same requests from a stream of registered files."""
    inbox, manifest, lake = folder(t, "inbox"), folder(t, "manifest"), folder(t, "lake")
    write_inbox(t, inbox)
    register_files(t.spark, identified(t.spark, list_files(t.spark, inbox)), manifest)
    now = current(t)
    finished(
        process_uploads(t.spark, manifest, lake, folder(t, "progress"), lambda: (t.databases, now.active_filters))
    )
    ready, output = (t.spark.read.parquet(f"{lake}/{name}").drop("batch_id") for name in ("data_ready", "filtered"))
    requests = route(ready, output, t.communities, applications_from_registry(now.active_applications))
    return requests.where("application_id < 9").select(*REQUEST)


@query(
    "job_result_files",
    with_views("filter_output")
    + """SELECT filter_id, upload_id, count(*) AS "rows", sum(count_value)::BIGINT AS total FROM filter_output
WHERE filter_id IN (1, 2) GROUP BY ALL""",
)
def _result_files(t):
    """Result files written by filter and upload, and read back."""
    root = folder(t, "results")
    write_result_files(fan_out(t.uploaded, FILTERS[:2]), FILTERS[:2], root)
    back = t.spark.read.option("header", True).schema("count_value long")
    counts = back.csv(f"{root}/filter_id=1").withColumn("filter_id", F.lit(1).cast("long"))
    every = t.spark.read.option("header", True).csv(f"{root}/filter_id=2")
    every = every.select(F.col("count_value").cast("long").alias("count_value"), F.lit(2).cast("long").alias("filter_id"), "upload_id")
    upload = F.regexp_extract(F.col("_metadata.file_path"), r"upload_id=(\d+)", 1).cast("long")
    first = counts.select("count_value", "filter_id", upload.alias("upload_id"))
    return first.unionByName(every.withColumn("upload_id", F.col("upload_id").cast("long"))).groupBy("filter_id", "upload_id").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("count_value").alias("total")
    )


@query(
    "scan_typed_and_malformed",
    with_views("uploaded")
    + """SELECT database_identifier, count(*) FILTER (WHERE analysis_id <> 105) AS good,
       count(*) FILTER (WHERE analysis_id = 105) AS malformed,
       sum(CASE WHEN analysis_id <> 105 THEN count_value + 1 END)::BIGINT AS total FROM uploaded GROUP BY 1""",
)
def _scan(t):
    """Delimited rows with spaces around them; those of one analysis carry a text where a number belongs."""
    inbox = folder(t, "inbox")
    cells = [F.col(c).cast("string").alias(c) for c in CATALOGUE_COLUMNS]
    rows = t.uploaded.select("database_identifier", *cells).withColumns(
        {
            "analysis_id": F.when(F.col("analysis_id") == "105", "none").otherwise(F.concat(F.lit(" "), "analysis_id", F.lit(" "))),
            "folder": F.col("database_identifier"),
        }
    )
    rows.drop("database_identifier").write.partitionBy("folder").option("header", True).option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(inbox)
    scanned = read_delimited(t.spark, inbox).withColumn("database_identifier", F.split_part("database_identifier", F.lit("="), F.lit(2)))
    stepped = transformed(good_rows(scanned), [lambda df: df.withColumn("count_value", F.col("count_value") + 1)])
    good = stepped.groupBy("database_identifier").agg(F.count(F.lit(1)).alias("good"), F.sum("count_value").alias("total"))
    bad = malformed_rows(scanned).groupBy("database_identifier").agg(F.count(F.lit(1)).alias("malformed"))
    joined = good.join(bad, "database_identifier", "full")
    return joined.select(
        "database_identifier", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("malformed", F.lit(0)).alias("malformed"), "total"
    )


@query(
    "messages_round_trip",
    with_views("file_status")
    + """SELECT status, "offset".rows::BIGINT AS "rows", make_timestamp(epoch_us("offset".timestamp) // 1000 * 1000) AS time
FROM file_status""",
)
def _messages(t):
    """Status messages as JSON lines, read with their schema, encoded, decoded and stored as a table."""
    path, table = folder(t, "messages"), folder(t, "status")
    status = t.file_status.select("status", F.col("offset").cast("struct<rows:long,timestamp:timestamp>").alias("offset"))
    status.write.json(path)
    reencode(encode_flat(read_json(t.spark, path, FILE_STATUS_SCHEMA)), FLAT, table)
    return t.spark.read.parquet(table).select("status", "rows", F.col("time").cast("timestamp_ntz").alias("time"))


FLAT = T.StructType(
    [T.StructField("status", T.StringType()), T.StructField("rows", T.LongType()), T.StructField("time", T.TimestampType())]
)


def encode_flat(status: DataFrame) -> DataFrame:
    return encode_json(
        status.select("status", F.col("offset.rows").cast("long").alias("rows"), F.col("offset.timestamp").alias("time"))
    )


@query(
    "decoded_messages",
    with_views("uploads")
    + 'SELECT event_id, "rows", make_timestamp(micros // 1000 * 1000) AS time FROM uploads',
)
def _decoded(t):
    """Messages as JSON texts with a key beside them, decoded to typed columns."""
    body = F.to_json(F.struct("rows", F.unix_millis(F.col("time").cast("timestamp")).alias("time")))
    kind = T.StructType([T.StructField("rows", T.LongType()), T.StructField("time", T.TimestampType())])
    typed = decode_json(t.uploads.select("event_id", body.alias("value")), kind)
    return typed.withColumn("time", F.col("time").cast("timestamp_ntz"))


@query(
    "registry_dump_load",
    with_views("databases", "communities")
    + """SELECT d.database_id::BIGINT AS database_id, d.database_identifier, d.database_name, c.community_name
FROM databases d JOIN communities c ON d.community_id = c.community_id""",
)
def _dump(t):
    """The registry written as a dump, a model in each line, and loaded from it."""
    path = folder(t, "dump")
    models = t.communities.select(
        F.lit("models.community").alias("model"),
        F.col("community_id").cast("long").alias("pk"),
        F.struct(F.col("community_name").alias("name")).alias("fields"),
    )
    models = models.select(F.to_json(F.struct("model", "pk", "fields")).alias("value")).unionByName(
        t.databases.select(
            F.to_json(
                F.struct(
                    F.lit("models.database").alias("model"),
                    F.col("database_id").alias("pk"),
                    F.struct(F.col("database_name").alias("name"), F.col("community_id").alias("community"), "database_identifier").alias("fields"),
                )
            ).alias("value")
        )
    )
    models.write.text(path)
    tables = read_dump(t.spark, path, lines=True)
    return tables["databases"].join(tables["communities"], "community_id").select(
        "database_id", "database_identifier", "database_name", "community_name"
    )


@query(
    "delivery_report",
    with_views("deliveries")
    + """SELECT application_id::INT AS application_id, count(*) AS deliveries,
       count(*) FILTER (WHERE response_code = 0) AS failed,
       count(*) FILTER (WHERE response_code BETWEEN 400 AND 499) AS rejected FROM deliveries GROUP BY 1""",
)
def _delivery_report(t):
    """Responses logged twice under one batch, and reported."""
    path = folder(t, "log")
    answered = F.col("response_code") > 0
    responses = t.deliveries.select(
        F.col("application_id").cast("int").alias("application_id"),
        F.col("time").cast("timestamp").alias("time"),
        F.when(answered, F.col("response_code")).alias("status_code"),
        F.when(answered, F.col("response_data")).alias("content"),
        F.when(~answered, F.lit("no route")).alias("error"),
    )
    logged = log_deliveries(responses).select(*DELIVERY_SCHEMA.names)
    for _ in range(2):
        record({"deliveries": logged}, path, 0)
    stored = t.spark.read.parquet(f"{path}/deliveries")
    none = t.uploads.select("database_id", F.col("time").cast("timestamp").alias("time"), F.col("rows").cast("int").alias("rows"))
    beats = t.beats.select("database_id", F.col("time").cast("timestamp").alias("time"), "reason")
    made = report(t.databases.select("database_id"), none, beats, stored, F.lit("2024-02-01 00:00:00").cast("timestamp"))
    return made.deliveries.select("application_id", "deliveries", "failed", "rejected")


@query(
    "appended_once",
    "SELECT event_type, count(*) AS events FROM events GROUP BY 1",
)
def _appended(t):
    """Batches appended, one of them replayed."""
    path = folder(t, "events")
    rows = t.read("events").select("event_id", "event_type")
    for batch_id in (0, 1, 1):
        append_batch(rows.where(F.col("event_id") % 2 == batch_id), path, batch_id)
    return t.spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


@query(
    "demultiplexed_read",
    with_views("uploaded")
    + "SELECT database_identifier, count(*) AS \"rows\" FROM uploaded WHERE database_identifier = md5('NATION_7') GROUP BY 1",
)
def _demultiplexed(t):
    """Rows of all databases in one partitioned table; a reader of one database reads its folder."""
    path = folder(t, "lake")
    write_by_database(t.uploaded.select("database_identifier", "analysis_id"), path)
    own = t.databases.where(F.col("database_name") == "NATION_7").first().database_identifier
    one = uploads.rows_of_database(t.spark.read.parquet(path), own)
    return one.groupBy("database_identifier").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "stream_filter",
    with_views("uploaded", "databases")
    + """SELECT community_id, p10_value, u.analysis_id FROM uploaded u JOIN databases d
  ON u.database_identifier = d.database_identifier WHERE p10_value > 20000""",
)
def _stream_filter(t):
    """A filter without state over a stream joined with the registered databases."""
    source, out = folder(t, "rows"), folder(t, "filtered")
    rows = t.uploaded.select("database_identifier", *CATALOGUE_COLUMNS)
    rows.write.parquet(source)
    known = with_registered(stream_since(t.spark, source, rows.schema), t.databases)
    spec = FilterSpec(1, "p10_value > 20000", ("p10_value", "analysis_id"))
    finished(continuous_filter(known, spec, out, folder(t, "progress"), ("community_id",)))
    return t.spark.read.schema("community_id int, p10_value double, analysis_id long").parquet(out)


@query(
    "stream_several_sinks",
    with_views("messages")
    + """SELECT 'kinds' AS sink, count(*) AS "rows" FROM messages
UNION ALL SELECT 'values', count(*) FROM messages WHERE value > 50""",
)
def _stream_several(t):
    """Two projections of one stream, which is read once."""
    source, out = folder(t, "events"), folder(t, "sinks")
    rows = t.messages.select("event_id", "event_type", "value")
    rows.write.parquet(source)
    sinks = {"kinds": lambda df: df.select("event_type"), "values": lambda df: df.where("value > 50").select("value")}
    finished(to_several(stream_since(t.spark, source, rows.schema), sinks, out, folder(t, "progress")))
    counted = None
    for name in sinks:
        part = t.spark.read.parquet(f"{out}/{name}").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("sink"), "rows")
        counted = part if counted is None else counted.unionByName(part)
    return counted


@query(
    "stream_closing",
    with_views("announced")
    + """SELECT upload_id, ("rows" - CASE WHEN upload_id % 5 = 0 THEN 1 ELSE 0 END)::BIGINT AS seen, "rows" AS expected
FROM announced WHERE upload_id % 5 <> 0""",
)
def _stream_closing(t):
    """Uploads that close at their announced rows, from a stream of rows and one of announcements."""
    data, told, out = folder(t, "rows"), folder(t, "told"), folder(t, "closed")
    at = F.lit("2024-01-01 00:00:00").cast("timestamp").alias("time")
    t.uploaded.select("upload_id", at).write.parquet(data)
    t.announced.select("upload_id", "rows", at).write.parquet(told)
    closing = closing_uploads(
        stream_since(t.spark, data, t.spark.read.parquet(data).schema),
        stream_since(t.spark, told, t.spark.read.parquet(told).schema),
    )
    writer = closing.writeStream.option("checkpointLocation", folder(t, "progress")).outputMode("append")
    finished(writer.trigger(availableNow=True).format("parquet").start(out))
    return t.spark.read.parquet(out).where("state = 'closed'").select("upload_id", "seen", "expected")


@query(
    "stream_liveness",
    with_views("beats") + "SELECT database_id, 'active' AS state, count(DISTINCT database_id) AS changes FROM beats GROUP BY 1",
)
def _stream_liveness(t):
    """Databases that show up in a stream of heartbeats."""
    source, out = folder(t, "beats"), folder(t, "changes")
    t.beats.select("database_id", F.col("time").cast("timestamp").alias("time")).write.parquet(source)
    stream = stream_since(t.spark, source, t.spark.read.parquet(source).schema)
    writer = liveness(stream, 10_000).writeStream.option("checkpointLocation", folder(t, "progress"))
    finished(writer.outputMode("append").trigger(availableNow=True).format("parquet").start(out))
    changes = t.spark.read.parquet(out).where("state = 'active'")
    return changes.groupBy("database_id", "state").agg(F.count(F.lit(1)).alias("changes"))


@query(
    "slices_in_pandas",
    with_views("filter_output")
    + """SELECT filter_id, upload_id, sum(count_value)::BIGINT AS total FROM filter_output GROUP BY ALL
UNION ALL SELECT filter_id, -1, sum(count_value)::BIGINT FROM filter_output GROUP BY 1""",
)
def _in_pandas(t):
    """User code that sees slices of any size as pandas, a batch at a time."""
    output = fan_out(t.uploaded, FILTERS).select("filter_id", "upload_id", "count_value")
    schema = "filter_id long, upload_id long, total long"

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.groupby(["filter_id", "upload_id"], as_index=False).agg(total=("count_value", "sum"))

    # A batch holds a part of a slice: the totals of the parts are added up.
    parts = in_batches(output, total, schema)
    whole = parts.groupBy("filter_id", "upload_id").agg(F.sum("total").alias("total"))
    every = parts.groupBy("filter_id").agg(F.sum("total").alias("total"))
    return whole.unionByName(every.select("filter_id", F.lit(-1).cast("long").alias("upload_id"), "total"))


@query(
    "reference_more",
    with_views("communities", "filters", "applications", "deliveries")
    + """SELECT c.community_id::BIGINT AS parent, 'filter' AS kind, f.filter_id::VARCHAR AS child
FROM communities c JOIN filters f ON list_contains(f.communities, c.community_id)
UNION ALL SELECT c.community_id, NULL, NULL FROM communities c
 WHERE NOT EXISTS (SELECT 1 FROM filters f WHERE list_contains(f.communities, c.community_id))
UNION ALL SELECT a.application_id, 'delivery', d.event_id::VARCHAR
FROM applications a JOIN deliveries d ON a.application_id = d.application_id
UNION ALL SELECT a.application_id, NULL, NULL FROM applications a
 WHERE a.application_id NOT IN (SELECT application_id FROM deliveries)
UNION ALL SELECT f.filter_id, 'community', c.community_name
FROM filters f JOIN communities c ON list_contains(f.communities, c.community_id)
UNION ALL SELECT f.filter_id, NULL, NULL FROM filters f WHERE f.communities IS NULL""",
)
def _reference_more(t):
    """1:N expansions: community to filters, application to deliveries, filter to communities."""
    filters, apps = folded_filters(t), folded_applications(t)
    members = filters.select("filter_id", F.explode("communities").alias("community_id"))
    of_community = registry.expand_many(t.communities, "community_id", {"filter": (members, F.col("filter_id"))})
    of_application = registry.expand_many(
        apps.select("application_id"), "application_id", {"delivery": (t.deliveries, F.col("event_id"))}
    )
    named = registry.expand_reference(members, "community_id", t.communities, {"community_name": "community_name"})
    of_filter = registry.expand_many(filters.select("filter_id"), "filter_id", {"community": (named, F.col("community_name"))})
    parts = [(of_community, "community_id"), (of_application, "application_id"), (of_filter, "filter_id")]
    picked = [df.select(F.col(key).cast("long").alias("parent"), "kind", "child") for df, key in parts]
    return picked[0].unionByName(picked[1]).unionByName(picked[2])


@query(
    "ordered_pages",
    with_views("uploads")
    + """SELECT 'newest' AS listing, event_id, row_number() OVER (ORDER BY time DESC, event_id) AS place FROM uploads
QUALIFY place <= 50
UNION ALL SELECT 'rows', event_id, row_number() OVER (ORDER BY "rows", event_id) AS place FROM uploads QUALIFY place <= 50""",
)
def _ordered_pages(t):
    """Newest first, and by a field the client names: the first page of each, with the place of a row in it."""
    rows = t.uploads.select("event_id", "time", "rows")
    listings = {
        "newest": stats.page(stats.newest_first(rows, tie="event_id"), [F.desc("time"), F.asc("event_id")], 1, 50),
        "rows": stats.page(stats.ordered_by(rows, "rows"), [F.asc("rows"), F.asc("event_id")], 1, 50),
    }
    shown = None
    for name, page in listings.items():
        # A page has fifty rows; they are numbered in the order in which they came.
        placed = [(name, r.event_id, i) for i, r in enumerate(page.collect(), 1)]
        part = t.values(placed, "listing string, event_id long, place long")
        shown = part if shown is None else shown.unionByName(part)
    return shown


@query(
    "pages_from_index",
    with_views("uploads")
    + """, ranked AS (SELECT event_id, row_number() OVER (ORDER BY time DESC, event_id) - 1 AS place, count(*) OVER () AS n FROM uploads)
SELECT 'first' AS page, event_id, place FROM ranked WHERE place < 50
UNION ALL SELECT 'middle', event_id, place FROM ranked WHERE place BETWEEN n // 2 AND n // 2 + 49
UNION ALL SELECT 'last', event_id, place FROM ranked WHERE place >= n // 50 * 50""",
)
def _pages_from_index(t):
    """Pages of the newest uploads from stored ranges: the first, rows in the middle and the last."""
    rows = t.uploads.select("event_id", "time")
    index = build_pages(rows, [("time", True), ("event_id", False)], folder(t, "pages"), range_rows=300)
    total = index.ranges().agg(F.sum("rows")).first()[0]
    parts = {
        "first": index.page(1, 50),
        "middle": index.between(total // 2, total // 2 + 50),
        "last": index.page(total // 50 + 1, 50),
    }
    shown = [df.select(F.lit(name).alias("page"), "event_id", "place") for name, df in parts.items()]
    return shown[0].unionByName(shown[1]).unionByName(shown[2])


@query(
    "job_import_sheets",
    with_views("sectioned")
    + """SELECT sheet_id, count(*) FILTER (WHERE type = 'Section') AS sections, count(*) FILTER (WHERE type = 'Group') AS groups,
       count(*) FILTER (WHERE type = 'Question') AS questions FROM sectioned GROUP BY 1""",
)
def _import(t):
    """The import job on every sheet: how much structure it made."""
    made = import_questionnaires(sheet(t).withColumn("search", F.lit("yes")))
    counted = None
    for kind, rows in (("sections", made.sections), ("groups", made.groups), ("questions", made.questions)):
        part = rows.select("sheet_id", *[(F.lit(1) if k == kind else F.lit(0)).alias(k) for k in ("sections", "groups", "questions")])
        counted = part if counted is None else counted.unionByName(part)
    return counted.groupBy("sheet_id").agg(*[F.sum(k).alias(k) for k in ("sections", "groups", "questions")])


@query(
    "job_validate",
    with_views("answers")
    + """SELECT a.fingerprint, a.question, a.value AS ident, a.question = 'toxic' OR a.value NOT IN ('en', 'de', 'fr', 'es') AS rejected
FROM answers a WHERE a.questionnaire = 1 AND a.question IN ('language', 'toxic') AND trim(a.value) <> ''""",
)
def _validate(t):
    """The validation job on all answers: chosen values, with those that are no choice."""
    choices = t.values(CHOICES, "questionnaire int, question string, place int, ident string, choice_key int")
    needs = t.values([(1, "toxic", "language", "en")], "questionnaire int, question string, requires_question string, requires_choice string")
    done = validate_answers(fingerprints(t), questions(t), document_answers(t), choices, needs)
    rejected = done.rejected_choices.select("fingerprint", "question", "ident", F.lit(True).alias("rejected"))
    chosen = done.choices.where("known").select("fingerprint", "question", "ident", F.lit(False).alias("rejected"))
    return chosen.unionByName(rejected)


@query(
    "job_history",
    with_views("writes", "changes")
    + """SELECT 'current' AS kind, fingerprint, count(*) AS answers FROM (SELECT * FROM writes
  QUALIFY row_number() OVER (PARTITION BY fingerprint, question ORDER BY submission DESC) = 1) WHERE value IS NOT NULL GROUP BY 2
UNION ALL SELECT 'changes', fingerprint, count(*) FROM changes GROUP BY 2""",
)
def _history(t):
    """The submission job: current answers and logged changes of each fingerprint."""
    subscribers = t.values([(1, 1)], "user_id long, fingerprint long")
    done = submissions(saves(t), subscribers)
    parts = [
        rows.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("answers")).select(F.lit(kind).alias("kind"), "fingerprint", "answers")
        for kind, rows in (("current", done.current), ("changes", done.changes))
    ]
    return parts[0].unionByName(parts[1])
