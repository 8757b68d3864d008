"""Jobs over files that change: identity, start positions, registry changes between batches, cleanup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.plans.ingest import QUARANTINE, RESULTS, ingest, read_table
from strataflow.sources.manifest import identified, list_files, register_files
from strataflow.streaming.uploads import process_uploads
from workload.base import FILTERS, query, with_views
from workload.jobs import finished, folder, write_inbox


def place_files(t, rows: DataFrame, inbox: str, order: Column, name: str = "results.csv") -> None:
    """A file of a given name for each database, its rows in the given order; an earlier one is replaced."""
    made = folder(t, "made")
    write_inbox(t, made, rows, order)
    jvm, conf = t.spark.sparkContext._jvm, t.spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(made)
    files = root.getFileSystem(conf)
    for status in files.listStatus(root):
        if not status.isDirectory():
            continue
        own = jvm.org.apache.hadoop.fs.Path(f"{inbox}/{status.getPath().getName()}")
        files.mkdirs(own)
        target = jvm.org.apache.hadoop.fs.Path(own, name)
        for file in files.listStatus(status.getPath()):
            if file.getPath().getName().endswith(".csv"):
                files.delete(target, False)
                files.rename(file.getPath(), target)


@query(
    "changed_uploads",
    with_views("uploaded")
    + """, placed AS (SELECT *, row_number() OVER (PARTITION BY database_identifier ORDER BY "offset") AS n,
   count(*) OVER (PARTITION BY database_identifier) AS c FROM uploaded)
SELECT database_identifier, CASE WHEN any_value(database_id) % 2 = 1 AND any_value(c) > 1 THEN 2 ELSE 1 END::BIGINT AS uploads,
   max(CASE WHEN n = CASE WHEN database_id % 2 = 1 THEN c ELSE 1 END THEN "count_value" END) AS first_value,
   (CASE WHEN any_value(database_id) % 2 = 1 AND any_value(c) > 1 THEN 2 ELSE 1 END * any_value(c))::BIGINT AS "rows",
   0::BIGINT AS files_left FROM placed GROUP BY 1""",
)
def _changed(t):
    """Files replaced by the same rows, and by the rows in another order: only these are new uploads. Loaded files are moved."""
    inbox, lake = folder(t, "inbox"), folder(t, "lake")
    place_files(t, t.uploaded, inbox, F.col("offset").asc())
    ingest(t.spark, inbox, lake, t.databases)
    odd = t.uploaded.withColumn("offset", F.when(F.col("database_id") % 2 == 1, -F.col("offset")).otherwise(F.col("offset")))
    place_files(t, odd, inbox, F.col("offset").asc())
    ingest(t.spark, inbox, lake, t.databases)
    last = ingest(t.spark, inbox, lake, t.databases, cleanup="move").batch_id
    # What was loaded before the cleanup is moved as soon as it is touched again.
    place_files(t, t.uploaded, inbox, F.col("offset").asc())
    ingest(t.spark, inbox, lake, t.databases, cleanup="move")
    left = list_files(t.spark, inbox).groupBy("database_identifier").agg(F.count(F.lit(1)).alias("files_left"))
    if not read_table(t.spark, lake, QUARANTINE).isEmpty():
        raise AssertionError("good rows were rejected")
    rows = read_table(t.spark, lake, RESULTS).where(F.col("batch_id") <= last)
    newest = F.max_by("count_value", F.when(F.col("offset") == 0, F.col("batch_id")))
    counted = rows.groupBy("database_identifier").agg(
        F.count_distinct("upload_id").alias("uploads"), newest.alias("first_value"), F.count(F.lit(1)).alias("rows")
    )
    return counted.join(left, "database_identifier", "left").select(
        "database_identifier", "uploads", "first_value", "rows", F.coalesce("files_left", F.lit(0)).alias("files_left")
    )


def _filters(t, active: set[int]) -> DataFrame:
    rows = [
        (s.filter_id, s.name, s.text, list(s.selections), list(s.communities), "ACTIVE" if s.filter_id in active else "STOPPED")
        for s in FILTERS
    ]
    return t.values(
        rows, "filter_id long, name string, filter string, selections array<string>, communities array<long>, status string"
    )


@query(
    "job_stream_changes",
    with_views("filter_counts", "databases")
    + """, ran AS (SELECT f.filter_id, d.database_id % 2 AS part, f.matched FROM filter_counts f
   JOIN databases d ON f.database_identifier = d.database_identifier)
SELECT 'earliest' AS start, part::BIGINT AS batch, filter_id, sum(matched)::BIGINT AS matched FROM ran
   WHERE filter_id IN (2, 3) OR filter_id = CASE WHEN part = 0 THEN 1 ELSE 4 END GROUP BY ALL
UNION ALL SELECT 'latest', part, filter_id, sum(matched)::BIGINT FROM ran WHERE part = 1 AND filter_id <> 1 GROUP BY ALL
UNION ALL SELECT 'after 1', part, filter_id, sum(matched)::BIGINT FROM ran WHERE part = 1 AND filter_id <> 1 GROUP BY ALL""",
)
def _changes(t):
    """A filter stopped and one started between two batches; queries that start early, late and after a batch."""
    inbox, manifest = folder(t, "inbox"), folder(t, "manifest")
    active = {1, 2, 3}
    runs = {name: (folder(t, "lake"), folder(t, "progress")) for name in ("earliest", "latest", "after 1")}

    def arrive(part: int) -> None:
        place_files(t, t.uploaded.where(F.col("database_id") % 2 == part), inbox, F.col("offset").asc())
        register_files(t.spark, identified(t.spark, list_files(t.spark, inbox)), manifest)

    def run(name: str, since: str | int) -> None:
        lake, progress = runs[name]
        finished(
            process_uploads(t.spark, manifest, lake, progress, lambda: (t.databases, _filters(t, active)), since=since)
        )

    arrive(0)
    run("earliest", "earliest")
    run("latest", "latest")
    active = set(range(2, 1 + len(FILTERS)))
    arrive(1)
    run("earliest", "earliest")
    run("earliest", "earliest")
    run("latest", "latest")
    run("after 1", 1)
    shown = None
    for name, (lake, _) in runs.items():
        counts = t.spark.read.parquet(f"{lake}/counts").join(t.databases, "database_identifier")
        part = counts.groupBy((F.col("database_id") % 2).cast("long").alias("batch"), "filter_id").agg(F.sum("matched").alias("matched"))
        part = part.select(F.lit(name).alias("start"), "batch", "filter_id", "matched")
        shown = part if shown is None else shown.unionByName(part)
    return shown
