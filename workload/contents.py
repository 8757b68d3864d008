"""Whole contents of jobs and streams: rows instead of counts, every state, every filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.operators.fanout import fan_out
from strataflow.plans.delivery import write_result_files
from strataflow.plans.history import submissions
from strataflow.plans.questionnaires import import_questionnaires
from strataflow.streaming.state import closing_uploads, liveness
from strataflow.streaming.uploads import stream_since
from workload.base import FILTERS, query, with_views
from workload.catalogue import saves
from workload.jobs import finished, folder
from workload.sheets import sheet


def _streamed(t, source: str, made, name: str) -> DataFrame:
    """Rows a stream over a stored table gives, until nothing more happens."""
    out = folder(t, name)
    writer = made.writeStream.option("checkpointLocation", folder(t, "progress")).outputMode("append")
    finished(writer.trigger(availableNow=True).format("parquet").start(out))
    return t.spark.read.parquet(out)


@query(
    "stream_closing_states",
    with_views("announced")
    + """SELECT upload_id::BIGINT AS upload_id, ("rows" - CASE WHEN upload_id % 5 = 0 THEN 1 ELSE 0 END)::BIGINT AS seen,
       "rows" AS expected, CASE WHEN upload_id % 5 = 0 THEN 'expired' ELSE 'closed' END AS state FROM announced
UNION ALL SELECT -1, 1, 1, 'closed'""",
)
def _closing_states(t):
    """Uploads that close and uploads that expire, as a later upload moves the stream's time on."""
    data, told = folder(t, "rows"), folder(t, "told")
    first, later = (F.lit(x).cast("timestamp").alias("time") for x in ("2024-01-01 00:00:00", "2024-01-11 00:00:00"))
    mark = t.values([(-1, 1)], "upload_id long, rows long")
    t.uploaded.select("upload_id", first).unionByName(mark.select("upload_id", later)).write.parquet(data)
    t.announced.select("upload_id", "rows", first).unionByName(mark.select("upload_id", "rows", later)).write.parquet(told)
    closing = closing_uploads(
        stream_since(t.spark, data, t.spark.read.parquet(data).schema),
        stream_since(t.spark, told, t.spark.read.parquet(told).schema),
    )
    return _streamed(t, data, closing, "closed").select("upload_id", "seen", "expected", "state")


# Hours after its last beat at which a database counts as silent here.
QUIET_HOURS = 0.25


@query(
    "stream_liveness_states",
    with_views("beats")
    + f"""SELECT database_id, 'active' AS state, max(micros) // 1000 AS since FROM beats GROUP BY 1
UNION ALL SELECT database_id, 'silent', max(micros) // 1000 + {int(QUIET_HOURS * 3_600_000)} FROM beats GROUP BY 1
HAVING max(micros) // 1000 + {int(QUIET_HOURS * 3_600_000)} < (SELECT max(micros) // 1000 FROM beats) - 3600000""",
)
def _liveness_states(t):
    """Databases that show up, and those that fall silent, with the time since when."""
    source = folder(t, "beats")
    t.beats.select("database_id", F.col("time").cast("timestamp").alias("time")).coalesce(1).write.parquet(source)
    stream = stream_since(t.spark, source, t.spark.read.parquet(source).schema)
    changes = _streamed(t, source, liveness(stream, QUIET_HOURS), "changes")
    return changes.select("database_id", "state", F.unix_millis("since").alias("since"))


@query(
    "job_result_files_all",
    with_views("filter_output")
    + """SELECT filter_id, upload_id, count(*) AS "rows", sum(CASE WHEN filter_id IN (1, 2, 4) THEN count_value END)::BIGINT AS total,
       sum(CASE WHEN filter_id <> 1 THEN analysis_id END)::BIGINT AS analyses FROM filter_output GROUP BY ALL""",
)
def _result_files_all(t):
    """Result files of every filter, read back by their headers."""
    root = folder(t, "results")
    write_result_files(fan_out(t.uploaded, FILTERS), FILTERS, root)
    shown = None
    for spec in FILTERS:
        back = t.spark.read.option("header", True).csv(f"{root}/filter_id={spec.filter_id}")
        total, analyses = (
            F.sum(F.col(c).cast("long")) if c in back.columns else F.lit(None).cast("long") for c in ("count_value", "analysis_id")
        )
        part = back.groupBy(F.col("upload_id").cast("long").alias("upload_id")).agg(
            F.count(F.lit(1)).alias("rows"), total.alias("total"), analyses.alias("analyses")
        )
        part = part.select(F.lit(spec.filter_id).cast("long").alias("filter_id"), "upload_id", "rows", "total", "analyses")
        shown = part if shown is None else shown.unionByName(part)
    return shown


@query(
    "job_history_rows",
    with_views("writes", "changes")
    + """SELECT 'current' AS kind, fingerprint, NULL::BIGINT AS submission, question, NULL AS previous, value AS next FROM (SELECT * FROM writes
  QUALIFY row_number() OVER (PARTITION BY fingerprint, question ORDER BY submission DESC) = 1) WHERE value IS NOT NULL
UNION ALL SELECT 'change', fingerprint, submission, question, previous, next FROM changes
UNION ALL SELECT 'notice', fingerprint, max(submission), NULL, NULL, count(*)::VARCHAR FROM changes WHERE fingerprint % 3 = 0 GROUP BY fingerprint""",
)
def _history_rows(t):
    """Current answers, logged changes and notices of the submission job, whole."""
    followed = saves(t).where(F.col("fingerprint") % 3 == 0).select(F.lit(1).alias("user_id"), "fingerprint").distinct()
    done = submissions(saves(t), followed)
    none = F.lit(None).cast("string")
    current = done.current.select(F.lit("current").alias("kind"), "fingerprint", F.lit(None).cast("long").alias("submission"), "question", none.alias("previous"), F.col("value").alias("next"))
    changes = done.changes.select(F.lit("change").alias("kind"), "fingerprint", "submission", "question", "previous", "next")
    notices = done.notices.select(
        F.lit("notice").alias("kind"), "fingerprint", F.col("last_submission").alias("submission"), none.alias("question"), none.alias("previous"), F.col("changes").cast("string").alias("next")
    )
    return current.unionByName(changes).unionByName(notices)


@query(
    "job_import_rows",
    with_views("sectioned")
    + """, placed AS (SELECT sheet_id, section, line, type, text, slug, TRY_CAST(level AS INT) AS level FROM sectioned
   WHERE type IN ('Group', 'Question')),
parents AS (SELECT *, (SELECT max(p.line) FROM placed p WHERE p.sheet_id = c.sheet_id AND p.section = c.section
   AND p.line < c.line AND p.level < c.level) AS parent_line FROM placed c)
SELECT type AS kind, sheet_id, section, line, parent_line, text, CASE WHEN type = 'Question' THEN slug END AS slug FROM parents
UNION ALL SELECT type, sheet_id, section, line, NULL, text, NULL FROM sectioned
WHERE type IN ('IntroSection', 'Section', 'CloseSection')""",
)
def _import_rows(t):
    """Sections, groups and questions that the import makes of every sheet, with their places."""
    made = import_questionnaires(sheet(t).withColumn("search", F.lit("yes")))
    none = F.lit(None).cast("string")
    line = F.lit(None).cast(made.groups.schema["parent_line"].dataType)
    sections = made.sections.select(F.col("type").alias("kind"), "sheet_id", "section", "line", line.alias("parent_line"), "text", none.alias("slug"))
    groups = made.groups.select(F.lit("Group").alias("kind"), "sheet_id", "section", "line", "parent_line", "text", none.alias("slug"))
    questions = made.questions.select(F.lit("Question").alias("kind"), "sheet_id", "section", "line", "parent_line", "text", "slug")
    return sections.unionByName(groups).unionByName(questions)
