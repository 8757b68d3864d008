"""Profiling queries: counts, distributions, strata, consistency, run log."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from strataflow.operators import profile, sketches
from strataflow.schema import CATALOGUE_COLUMNS
from strataflow.session import stage, stage_dir
from workload.base import SEGMENT_CONCEPTS, VIEWS, query, with_views


def _mean(column, count):
    """The mean of amounts in cents: their sum, which is whole cents, by their number."""
    return (F.round(F.col(column) * F.col(count), 2) / F.col(count)).alias(column)


def _rounded(df, keep):
    shown = {"avg_value": _mean("avg_value", "count_value"), "stdev_value": F.round("stdev_value", 2).alias("stdev_value")}
    return df.select(*keep, *[shown.get(c, F.col(c)) for c in CATALOGUE_COLUMNS])


def _strata(*values: str) -> str:
    filled = list(values) + ["NULL"] * (5 - len(values))
    return ", ".join(f"CAST({v} AS VARCHAR) AS stratum_{i + 1}" for i, v in enumerate(filled))


def _count_row(analysis: int, keep: str, strata: str, count: str, source: str, group: str) -> str:
    empty = ", ".join(f"NULL::DOUBLE AS {c}" for c in CATALOGUE_COLUMNS[7:])
    return f"""SELECT {keep}, {analysis}::BIGINT AS analysis_id, {strata}, {count} AS count_value, {empty}
FROM {source} GROUP BY {group}"""


def _distribution_row(analysis: str, keep: str, strata: str, value: str, source: str, group: str) -> str:
    quantiles = ", ".join(
        f"quantile_disc({value}, {p}) AS {n}"
        for n, p in {
            "median_value": 0.5, "p10_value": 0.1, "p25_value": 0.25, "p75_value": 0.75, "p90_value": 0.9
        }.items()
    )
    return f"""SELECT {keep}, {analysis}::BIGINT AS analysis_id, {strata}, count({value}) AS count_value,
       min({value}) AS min_value, max({value}) AS max_value, round(avg({value}) * count({value}), 2) / count({value}) AS avg_value,
       round(stddev_samp({value}), 2) AS stdev_value, {quantiles}
FROM {source} GROUP BY {group}"""


PERSON_COUNT = _count_row(
    0, "database_id", _strata("database_name"), "count(DISTINCT person_id)", "persons", "database_id, database_name"
)
SEGMENT_COUNT = _count_row(
    2, "database_id", _strata("segment"), "count(DISTINCT person_id)", "persons", "database_id, segment"
)
BALANCES = _distribution_row("103", "database_id", _strata(), "balance", "persons", "database_id")
SEGMENT_BALANCES = _distribution_row("104", "database_id", _strata("segment"), "balance", "persons", "database_id, segment")
VISIT_COSTS = _distribution_row("105", "database_id", _strata(), "visit_cost", "visits", "database_id")

# The catalogue rows of every database, as the profile job writes them.
VIEWS["results"] = "\nUNION ALL\n".join([PERSON_COUNT, SEGMENT_COUNT, BALANCES, SEGMENT_BALANCES, VISIT_COSTS])


def profile_results(t):
    """All analyses of the workload as one table of catalogue rows."""
    from strataflow.plans.profiling import Analysis, profile as run

    return run(
        {"persons": t.persons, "visits": t.visits},
        [
            Analysis(0, "persons", strata=("database_name",), entity="person_id"),
            Analysis(2, "persons", strata=("segment",), entity="person_id"),
            Analysis(103, "persons", value="balance"),
            Analysis(104, "persons", strata=("segment",), value="balance"),
            Analysis(105, "visits", value="visit_cost"),
        ],
        by=["database_id"],
    )


@query("profile_person_count", with_views("persons") + PERSON_COUNT)
def _person_count(t):
    facts = t.persons
    return profile.count_profile(facts, 0, ["database_id"], "person_id", ["database_name"])


@query("profile_strat_count", with_views("persons") + SEGMENT_COUNT)
def _strat_count(t):
    return profile.count_profile(t.persons, 2, ["database_id"], "person_id", ["segment"])


@query(
    "profile_distribution",
    with_views("persons", "visits") + BALANCES + "\nUNION ALL\n" + VISIT_COSTS,
)
def _distribution(t):
    balances = profile.distribution_profile(t.persons, 103, ["database_id"], "balance")
    costs = profile.distribution_profile(t.visits, 105, ["database_id"], "visit_cost")
    return _rounded(balances.unionByName(costs), ["database_id"])


@query(
    "profile_strat_distribution",
    _distribution_row(
        "104", "l_returnflag AS flag", _strata("l_returnflag", "l_linestatus"), "l_extendedprice", "lineitem",
        "l_returnflag, l_linestatus",
    ),
)
def _strat_distribution(t):
    facts = t.read("lineitem").withColumn("flag", F.col("l_returnflag"))
    rows = profile.distribution_profile(facts, 104, ["flag"], "l_extendedprice", ["l_returnflag", "l_linestatus"])
    return _rounded(rows, ["flag"])


@query(
    "profile_multi_strata",
    f"""SELECT * FROM (
{_distribution_row("CASE grouping(l_returnflag, l_linestatus, l_linenumber) WHEN 7 THEN 103 WHEN 3 THEN 104 WHEN 1 THEN 106 ELSE 107 END",
 "'lineitem' AS source", _strata("coalesce(l_returnflag, CAST(l_linenumber AS VARCHAR))", "l_linestatus"), "l_quantity", "lineitem",
 "GROUPING SETS ((), (l_returnflag), (l_returnflag, l_linestatus), (l_linenumber))")})""",
)
def _multi_strata(t):
    facts = t.read("lineitem").withColumn("source", F.lit("lineitem"))
    analyses = {103: [], 104: ["l_returnflag"], 106: ["l_returnflag", "l_linestatus"], 107: ["l_linenumber"]}
    return _rounded(profile.multi_strata_profile(facts, ["source"], "l_quantity", analyses), ["source"])


@query(
    "profile_consistency",
    with_views("persons")
    + """, totals AS (SELECT database_id, count(balance) AS n, avg(balance) AS a FROM persons GROUP BY database_id),
parts AS (SELECT database_id, segment, count(balance) AS n, avg(balance) AS a FROM persons GROUP BY database_id, segment)
SELECT t.database_id, t.n AS total_count, sum(p.n)::BIGINT AS strata_count, round(t.a * t.n, 2) / t.n AS total_avg,
       round(sum(p.a * p.n), 2) / sum(p.n) AS strata_avg, (t.n - sum(p.n))::BIGINT AS count_difference
FROM totals t JOIN parts p ON t.database_id = p.database_id GROUP BY t.database_id, t.n, t.a""",
)
def _consistency(t):
    results = profile.multi_strata_profile(t.persons, ["database_id"], "balance", {103: [], 104: ["segment"]})
    checked = profile.strata_consistency(results, ["database_id"], 103, 104)
    return checked.withColumns({"total_avg": _mean("total_avg", "total_count"), "strata_avg": _mean("strata_avg", "strata_count")})


@query(
    "run_log_parse",
    with_views("uploaded")
    + """SELECT database_id, upload_id, analysis_id - 2000000 AS analysis_id,
       CAST(regexp_extract(stratum_1, '^([0-9.]+) secs', 1) AS DOUBLE) AS elapsed_seconds
FROM uploaded WHERE analysis_id >= 2000000""",
)
def _run_log(t):
    return profile.run_log(t.uploaded, ["database_id", "upload_id"])


@query(
    "analysis_subset",
    with_views("uploaded")
    + """SELECT database_id, upload_id, "offset", analysis_id, count_value FROM uploaded
WHERE analysis_id IN (SELECT * FROM (VALUES (0), (103), (105)))""",
)
def _analysis_subset(t):
    allowed = t.values([(0,), (103,), (105,)], "analysis_id long")
    rows = t.uploaded.select("database_id", "upload_id", "offset", "analysis_id", "count_value")
    return profile.permitted_analyses(rows, allowed)


@query(
    "vocab_lookup",
    with_views("persons")
    + f""", vocabulary(code, concept_id, concept_name) AS (VALUES {", ".join(map(str, SEGMENT_CONCEPTS))})
SELECT database_id, segment, concept_id::INT AS concept_id, concept_name, count(*) AS persons
FROM persons LEFT JOIN vocabulary ON segment = code GROUP BY ALL""",
)
def _vocab_lookup(t):
    vocabulary = t.values(SEGMENT_CONCEPTS, "code string, concept_id int, concept_name string")
    mapped = profile.to_standard_concepts(t.persons, "segment", vocabulary)
    return mapped.groupBy("database_id", "segment", "concept_id", "concept_name").agg(F.count(F.lit(1)).alias("persons"))


@query(
    "profile_from_states",
    with_views("persons")
    + """SELECT database_id, 103::BIGINT AS analysis_id, count(balance) AS count_value, min(balance) AS min_value,
       max(balance) AS max_value, round(avg(balance) * count(balance), 2) / count(balance) AS avg_value,
       round(stddev_samp(balance), 2) AS stdev_value, TRUE AS median_near, TRUE AS p10_near, TRUE AS p90_near
FROM persons GROUP BY database_id""",
)
def _from_states(t):
    """Totals of databases merged from the stored states of strata, three batches, one written twice; ranks within the error."""
    path = f"{stage_dir(t.spark, 'jobs')}/states-{uuid.uuid4().hex}"
    for batch_id in (0, 1, 2, 1):
        own = t.persons.where(F.col("person_id") % 3 == batch_id)
        sketches.add_states(sketches.quantile_states(own, ["database_id", "segment"], "balance"), path, batch_id)
    merged = sketches.merged_quantiles(sketches.stored_states(t.spark, path), ["database_id"])
    made = stage(sketches.distribution_of(merged, ["database_id"]))
    cuts = {"median_value": 0.5, "p10_value": 0.1, "p90_value": 0.9}
    joined = t.persons.join(made.select("database_id", "count_value", *cuts), "database_id")
    near = []
    for name, fraction in cuts.items():
        below, upto = F.count_if(F.col("balance") < F.col(name)), F.count_if(F.col("balance") <= F.col(name))
        slack = F.any_value("count_value") * sketches.RANK_ERROR + 1
        rank = F.any_value("count_value") * fraction
        near.append(((below - slack <= rank) & (rank <= upto + slack)).alias(f"{name.split('_')[0]}_near"))
    checked = joined.groupBy("database_id").agg(*near)
    shown = made.withColumn("analysis_id", F.lit(103).cast("long")).join(checked, "database_id")
    return shown.select(
        "database_id", "analysis_id", "count_value", "min_value", "max_value", _mean("avg_value", "count_value"),
        F.round("stdev_value", 2).alias("stdev_value"), "median_near", "p10_near", "p90_near",
    )
