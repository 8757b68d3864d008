"""Upload, heartbeat and delivery queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.functions.text import from_millis, to_millis
from strataflow.operators import fanout, stats, uploads
from strataflow.operators.ordered import with_offset
from workload.base import FILTERS, VIEWS, query, with_views
from workload.filters import slices

DAY_MICROS = 86_400_000_000

# Databases of one community stay outside the registry, so that unknown uploads exist.
UNREGISTERED_COMMUNITY = 4
VIEWS["registered"] = f"SELECT * FROM databases WHERE community_id <> {UNREGISTERED_COMMUNITY}"

NOW = "TIMESTAMP '2024-01-31 00:00:00'"


def registered(t):
    return t.databases.where(F.col("community_id") != UNREGISTERED_COMMUNITY)


@query(
    "upload_notifications",
    with_views("file_status")
    + """SELECT database_identifier, database_id, event_id, "offset"."timestamp" AS time,
       "offset"."rows" - 1 AS "rows"
FROM file_status WHERE status = 'COMPLETED'""",
)
def _notifications(t):
    return uploads.upload_notifications(t.file_status, ["database_identifier", "database_id", "event_id"])


@query(
    "upload_row_check",
    with_views("announced")
    + """SELECT a.upload_id, a."rows", coalesce(c.counted, 0) AS counted,
       coalesce(c.counted, 0) = a."rows" AS complete
FROM announced a LEFT JOIN (SELECT upload_id, count(*) AS counted FROM uploaded GROUP BY upload_id) c
  ON a.upload_id = c.upload_id""",
)
def _row_check(t):
    announced = t.announced.select("upload_id", "rows")
    return uploads.row_check(announced, t.uploaded, ["upload_id"])


@query(
    "upload_known",
    with_views("uploads", "registered")
    + """SELECT u.database_identifier, u.event_id, u."rows", r.community_id
FROM uploads u JOIN registered r ON u.database_identifier = r.database_identifier""",
)
def _known(t):
    rows = t.uploads.select("database_identifier", "event_id", "rows")
    return uploads.known_uploads(rows, registered(t))


@query(
    "upload_unknown",
    with_views("uploads", "registered")
    + """SELECT u.database_identifier, u.event_id, u."rows" FROM uploads u
WHERE NOT EXISTS (SELECT 1 FROM registered r WHERE u.database_identifier = r.database_identifier)""",
)
def _unknown(t):
    rows = t.uploads.select("database_identifier", "event_id", "rows")
    return uploads.unknown_uploads(rows, registered(t))


@query(
    "slice_range_join",
    with_views("filter_output", "data_ready")
    + """, placed AS (SELECT filter_id, upload_id AS source_upload, analysis_id,
    row_number() OVER (PARTITION BY filter_id ORDER BY upload_id, "offset") - 1 AS place FROM filter_output)
SELECT p.filter_id, p.place, p.source_upload, p.analysis_id, r.upload_id, r.last_offset, r."count"
FROM placed p JOIN data_ready r ON p.filter_id = r.filter_id
 AND p.place BETWEEN r.last_offset + 1 - r."count" AND r.last_offset""",
)
def _slice_range_join(t):
    output = fanout.fan_out(t.uploaded, FILTERS).select("filter_id", "upload_id", "offset", "analysis_id")
    placed = with_offset(output, ["filter_id"], "upload_id", "place", ["offset"])
    placed = placed.select("filter_id", "place", F.col("upload_id").alias("source_upload"), "analysis_id")
    return uploads.slice_join(placed, slices(t).drop("database_identifier"), ["filter_id"], "place")


@query(
    "event_offsets",
    with_views("messages")
    + """SELECT event_id, database_id, row_number() OVER (PARTITION BY database_id ORDER BY micros, event_id) - 1
  AS "offset" FROM messages""",
)
def _event_offsets(t):
    rows = t.messages.select("event_id", "database_id", "micros")
    return uploads.assign_offsets(rows, ["database_id"], "micros", ["event_id"]).drop("micros")


@query(
    "json_payload",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, "
    "'{\"event_id\":' || event_id || ',\"k\":' || CAST(json_extract(props, '$.k') AS BIGINT) || '}' AS message "
    "FROM events",
)
def _json_payload(t):
    payload = T.StructType([T.StructField("k", T.LongType())])
    typed = t.read("events").select("event_id", F.from_json("props", payload)["k"].alias("k"))
    return typed.withColumn("message", F.to_json(F.struct("event_id", "k")))


@query(
    "partition_read",
    with_views("uploaded")
    + """SELECT upload_id AS batch, "offset" AS place, analysis_id, count_value FROM uploaded
WHERE database_identifier = md5('NATION_7')""",
)
def _partition_read(t):
    named = t.databases.where(F.col("database_name") == "NATION_7").select("database_identifier")
    rows = t.uploaded.select("database_identifier", "upload_id", "offset", "analysis_id", "count_value")
    return rows.join(named, "database_identifier", "left_semi").drop("database_identifier").withColumnsRenamed(
        {"upload_id": "batch", "offset": "place"}
    )


@query(
    "epoch_millis",
    "SELECT event_id, epoch_us(ts) // 1000 AS millis, make_timestamp(epoch_us(ts) // 1000 * 1000) AS decoded FROM events",
)
def _epoch_millis(t):
    encoded = t.read("events").select("event_id", to_millis(F.col("ts")).alias("millis"))
    return encoded.withColumn("decoded", from_millis(F.col("millis")))


@query(
    "last_active",
    with_views("databases", "beats")
    + f"""SELECT d.database_id, d.database_name, max(b.time) AS last_time,
       (epoch_us({NOW}) - epoch_us(max(b.time))) // 1000000 AS age_seconds,
       coalesce((epoch_us({NOW}) - epoch_us(max(b.time))) // 1000000 <= 50400, FALSE) AS active
FROM databases d LEFT JOIN beats b ON d.database_id = b.database_id AND b.reason = 'Periodic'
GROUP BY d.database_id, d.database_name""",
)
def _last_active(t):
    names = t.databases.select("database_id", "database_name")
    beats = t.beats.where(F.col("reason") == "Periodic")
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return stats.last_active(names, beats, now, period_hours=14)


@query(
    "beats_by_reason",
    with_views("beats") + "SELECT database_id, reason, count(*) AS beats FROM beats GROUP BY database_id, reason",
)
def _beats_by_reason(t):
    return stats.beats_by_reason(t.beats)


@query(
    "request_unanswered",
    with_views("beats")
    + f"""SELECT r.event_id, r.database_id, r.micros FROM beats r WHERE r.reason = 'Requested' AND NOT EXISTS (
  SELECT 1 FROM beats b WHERE b.reason = 'Periodic' AND b.database_id = r.database_id
     AND b.micros > r.micros AND b.micros <= r.micros + {DAY_MICROS // 24})""",
)
def _request_unanswered(t):
    columns = ["event_id", "database_id", "micros"]
    requests = t.beats.where(F.col("reason") == "Requested").select(*columns)
    answers = t.beats.where(F.col("reason") == "Periodic").select(*columns)
    return stats.unanswered_requests(requests, answers, "database_id", "micros", DAY_MICROS // 24)


@query(
    "upload_stats",
    with_views("uploads")
    + """SELECT database_id, count(*) AS uploads, sum("rows")::BIGINT AS total_rows,
       min(time) AS first_time, max(time) AS last_time FROM uploads GROUP BY database_id""",
)
def _upload_stats(t):
    return stats.upload_stats(t.uploads)


@query(
    "upload_interval",
    with_views("uploads")
    + """SELECT event_id, database_id, micros,
       micros - lag(micros) OVER (PARTITION BY database_id ORDER BY micros, event_id) AS gap FROM uploads""",
)
def _upload_interval(t):
    rows = t.uploads.select("event_id", "database_id", "micros")
    return stats.upload_intervals(rows, ["database_id"], "micros", ["event_id"])


@query(
    "delivery_stats",
    with_views("deliveries")
    + """SELECT application_id, count(*) AS deliveries,
       count(*) FILTER (WHERE response_code BETWEEN 200 AND 299) AS accepted,
       count(*) FILTER (WHERE response_code BETWEEN 400 AND 499) AS rejected,
       count(*) FILTER (WHERE response_code BETWEEN 500 AND 599) AS broken,
       count(*) FILTER (WHERE response_code = 0) AS failed,
       round(count(*) FILTER (WHERE response_code = 0) / count(*), 4) AS failed_share
FROM deliveries GROUP BY application_id""",
)
def _delivery_stats(t):
    return stats.delivery_stats(t.deliveries)


@query(
    "delivery_classes",
    with_views("deliveries")
    + """SELECT CASE WHEN response_code = 0 THEN 'failed' ELSE (response_code // 100) || 'xx' END AS code_class,
       count(*) AS deliveries FROM deliveries GROUP BY 1""",
)
def _delivery_classes(t):
    classed = t.deliveries.select(stats.code_class(F.col("response_code")).alias("code_class"))
    return classed.groupBy("code_class").agg(F.count(F.lit(1)).alias("deliveries"))


@query(
    "latest_record",
    with_views("deliveries")
    + """SELECT application_id, event_id, time, response_data, response_code FROM deliveries
QUALIFY row_number() OVER (PARTITION BY application_id ORDER BY time DESC, event_id DESC) = 1""",
)
def _latest_record(t):
    return stats.latest_record(t.deliveries, ["application_id"], ["time", "event_id"])


@query(
    "page_of_uploads",
    with_views("uploads")
    + """SELECT event_id, database_id, time, "rows" FROM uploads
ORDER BY time DESC, event_id DESC LIMIT 20 OFFSET 20""",
)
def _page_of_uploads(t):
    rows = t.uploads.select("event_id", "database_id", "time", "rows")
    return stats.page(rows, [F.desc("time"), F.desc("event_id")], 2, 20)


@query(
    "deliveries_newest_first",
    with_views("deliveries") + "SELECT application_id, event_id, time, response_code FROM deliveries",
)
def _newest_first(t):
    rows = t.deliveries.select("application_id", "event_id", "time", "response_code")
    return stats.newest_first(rows, "time", "event_id")


@query(
    "union_streams",
    with_views("beats", "uploads")
    + """SELECT database_id, time, reason AS detail, 'beat' AS stream FROM beats
UNION ALL SELECT database_id, time, "rows"::VARCHAR, 'upload' FROM uploads""",
)
def _union_streams(t):
    beats = t.beats.select("database_id", "time", F.col("reason").alias("detail"), F.lit("beat").alias("stream"))
    sent = t.uploads.select(
        "database_id", "time", F.col("rows").cast("string").alias("detail"), F.lit("upload").alias("stream")
    )
    return uploads.union_sources(beats, sent)
