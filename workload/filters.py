"""Filter queries: selection, complement, three-way counts, fan-out, completion."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataflow.functions.text import csv_line
from strataflow.operators import fanout, uploads
from strataflow.schema import CATALOGUE_COLUMNS
from strataflow.session import cut_lineage
from workload.base import FILTERS, VIEWS, query, with_views

QUOTED = ", ".join(CATALOGUE_COLUMNS)


def _literal(spec) -> str:
    return spec.text or "TRUE"


VIEWS["filter_counts"] = "\nUNION ALL\n".join(
    f"""SELECT upload_id, database_identifier, {s.filter_id}::BIGINT AS filter_id,
       count(*) FILTER (WHERE {_literal(s)}) AS matched,
       count(*) FILTER (WHERE NOT ({_literal(s)})) AS unmatched,
       count(*) FILTER (WHERE ({_literal(s)}) IS NULL) AS unknown
FROM uploaded GROUP BY upload_id, database_identifier"""
    for s in FILTERS
)

VIEWS["filter_output"] = "\nUNION ALL\n".join(
    f"SELECT *, {s.filter_id}::BIGINT AS filter_id FROM uploaded WHERE {_literal(s)}" for s in FILTERS
)

VIEWS["gates"] = "SELECT * FROM (VALUES " + ", ".join(
    f"({s.filter_id}::BIGINT, {list(s.communities)}::INT[])" for s in FILTERS
) + ") AS g(filter_id, gate_communities)"

VIEWS["data_ready"] = """
SELECT filter_id, database_identifier, upload_id,
       (sum(matched) OVER (PARTITION BY filter_id ORDER BY upload_id) - 1)::BIGINT AS last_offset,
       matched AS "count"
FROM filter_counts"""


def counts(t):
    return fanout.count_matches(t.uploaded, ["upload_id", "database_identifier"], FILTERS)


def slices(t):
    """Slices of the filters' outputs, from counts that are stored as the filter job does."""
    return fanout.data_ready(cut_lineage(counts(t)), "upload_id", "database_identifier")


@query(
    "filter_select",
    with_views("uploaded") + 'SELECT upload_id, "offset", count_value FROM uploaded WHERE analysis_id = 0',
)
def _select(t):
    return fanout.filter_rows(t.uploaded, FILTERS[0], ["upload_id", "offset"])


@query(
    "filter_complement",
    with_views("uploaded")
    + """SELECT upload_id, count(*) AS unmatched_rows FROM uploaded
WHERE NOT (p10_value > 20000) GROUP BY upload_id""",
)
def _complement(t):
    rest = fanout.complement(t.uploaded, FILTERS[2], ["upload_id"])
    return rest.groupBy("upload_id").agg(F.sum("unmatched").alias("unmatched_rows"))


@query("filter_all", with_views("uploaded") + f'SELECT upload_id, "offset", {QUOTED} FROM uploaded')
def _all(t):
    return fanout.filter_rows(t.uploaded, FILTERS[1], ["upload_id", "offset"])


@query(
    "filter_three_way",
    with_views("filter_counts", "announced")
    + """SELECT a.upload_id, a.database_identifier, a."rows", filter_id, matched, unmatched, unknown,
       matched + unmatched + unknown = a."rows" AS complete
FROM announced a JOIN filter_counts c ON a.upload_id = c.upload_id""",
)
def _three_way(t):
    return fanout.completeness(counts(t), t.announced, ["upload_id", "database_identifier"])


@query(
    "filter_fanout",
    with_views("filter_output", "databases", "gates")
    + """SELECT o.filter_id, o.upload_id, o."offset", o.analysis_id, o.count_value, d.community_id,
       list_contains(gate_communities, d.community_id) AS belongs
FROM filter_output o JOIN databases d ON o.database_identifier = d.database_identifier
JOIN gates g ON o.filter_id = g.filter_id""",
)
def _fanout(t):
    rows = t.uploaded.select(
        "database_identifier", "upload_id", "offset", *CATALOGUE_COLUMNS
    )
    matched = fanout.fan_out(rows, FILTERS)
    gate = fanout.community_gate(t.databases.select("database_identifier", "community_id"), FILTERS)
    return matched.join(gate, ["database_identifier", "filter_id"]).select(
        "filter_id", "upload_id", "offset", "analysis_id", "count_value", "community_id", "belongs"
    )


@query(
    "all_filters_done",
    with_views("filter_counts", "announced")
    + f"""SELECT a.upload_id, count(DISTINCT CASE WHEN matched + unmatched + unknown = a."rows" THEN filter_id END)
         AS filters_done,
       count(DISTINCT CASE WHEN matched + unmatched + unknown = a."rows" THEN filter_id END) = {len(FILTERS)} AS done
FROM announced a JOIN filter_counts c ON a.upload_id = c.upload_id GROUP BY a.upload_id""",
)
def _all_done(t):
    checked = fanout.completeness(counts(t), t.announced, ["upload_id", "database_identifier"])
    return fanout.all_filters_done(checked, ["upload_id"], len(FILTERS))


@query(
    "data_ready_slices",
    with_views("data_ready") + 'SELECT filter_id, database_identifier, upload_id, last_offset, "count" FROM data_ready',
)
def _data_ready(t):
    return slices(t)


@query(
    "csv_lines",
    with_views("uploaded")
    + 'SELECT upload_id, "offset", concat_ws(\',\', '
    + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in CATALOGUE_COLUMNS)
    + ") AS line FROM uploaded",
)
def _csv_lines(t):
    return t.uploaded.select("upload_id", "offset", csv_line([F.col(c) for c in CATALOGUE_COLUMNS]).alias("line"))


@query(
    "slice_read",
    with_views("filter_output")
    + """SELECT upload_id, "offset", analysis_id, p10_value FROM filter_output
WHERE filter_id = 3 AND upload_id = 71997""",
)
def _slice_read(t):
    output = fanout.fan_out(t.uploaded, FILTERS)
    picked = uploads.slice_rows(output, 3, 71997)
    return picked.select("upload_id", "offset", "analysis_id", "p10_value")


MANY = 2000
# Kinds of filters, by number: the condition as text, and in SQL over a column ``i`` that holds the number.
MANY_KINDS = [
    (lambda i: f"analysis_id = {(0, 103, 104, 105)[i // 6 % 4]} AND count_value >= {150 * i}",
     "analysis_id = [0, 103, 104, 105][i // 6 % 4 + 1] AND count_value >= 150 * i"),
    (lambda i: f"p10_value BETWEEN {20 * i} AND {20 * i + 1500}", "p10_value BETWEEN 20 * i AND 20 * i + 1500"),
    (lambda i: f"stratum_1 IN ('F', 'NATION_{i % 25}') AND avg_value < {100 * i}",
     "stratum_1 IN ('F', 'NATION_' || (i % 25)) AND avg_value < 100 * i"),
    (lambda i: f"stratum_1 = 'O' AND {90 * i}.5 < p90_value AND analysis_id = 104",
     "stratum_1 = 'O' AND 90 * i + 0.5 < p90_value AND analysis_id = 104"),
    (lambda i: f"median_value > {i * 40} AND max_value <= {i * 160} AND min_value = 0",
     "median_value > i * 40 AND max_value <= i * 160 AND min_value = 0"),
    (lambda i: f"analysis_id IN (0, 2000000, {i}) AND count_value < {i * 100}",
     "analysis_id IN (0, 2000000, i) AND count_value < i * 100"),
]
MANY_FILTERS = [fanout.FilterSpec(i, MANY_KINDS[i % 6][0](i), (), (i % 5,)) for i in range(MANY)]
# One filter the index can't hold.
MANY_FILTERS.append(fanout.FilterSpec(MANY, "analysis_id = 0 OR p10_value IS NULL", (), (0,)))
VIEWS["many_filters"] = (
    "SELECT filter_id, upload_id, count_value, hit FROM (SELECT i AS filter_id, upload_id, count_value, CASE i % 6 "
    + " ".join(f"WHEN {k} THEN {sql}" for k, (_, sql) in enumerate(MANY_KINDS))
    + f" END AS hit FROM uploaded, range({MANY}) AS t(i)) UNION ALL SELECT {MANY}, upload_id, count_value,"
    + " analysis_id = 0 OR p10_value IS NULL FROM uploaded"
)


@query(
    "many_filters_counted",
    with_views("uploaded", "many_filters")
    + """SELECT filter_id, count(*) FILTER (WHERE hit) AS matched, count(*) FILTER (WHERE NOT hit) AS unmatched,
       count(*) FILTER (WHERE hit IS NULL) AS unknown FROM many_filters GROUP BY 1""",
)
def _many_counted(t):
    """Thousands of filters counted in one scan, through the index over their conditions."""
    counted = fanout.count_matches(t.uploaded, ["upload_id", "database_identifier"], MANY_FILTERS)
    return counted.groupBy("filter_id").agg(*[F.sum(c).alias(c) for c in ("matched", "unmatched", "unknown")])


@query(
    "many_filters_fanout",
    with_views("uploaded", "many_filters")
    + "SELECT filter_id, upload_id, count(*) AS \"rows\", sum(count_value)::BIGINT AS total FROM many_filters WHERE hit GROUP BY ALL",
)
def _many_fanout(t):
    """Every row once for each of the thousands of filters it matches."""
    output = fanout.fan_out(t.uploaded, MANY_FILTERS)
    return output.groupBy("filter_id", "upload_id").agg(F.count(F.lit(1)).alias("rows"), F.sum("count_value").alias("total"))
