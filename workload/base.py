"""Registered queries and the stand-in tables they run on.

Each stand-in is a plain projection of the given tables, written once for Spark and once
as a common table expression, so that both engines see the same input.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.functions.text import to_micros
from strataflow.operators.fanout import FilterSpec
from strataflow.operators.routing import Application
from strataflow.session import local_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query with the SQL that gives the same rows."""

    def add(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def with_views(*names: str) -> str:
    """WITH clause of the named stand-ins and those they build on, in order."""
    needed: set[str] = set()

    def need(name: str) -> None:
        for other in VIEWS:
            if other not in needed and re.search(rf"\b(FROM|JOIN)\s+{other}\b", VIEWS[name]):
                need(other)
        needed.add(name)

    for name in names:
        need(name)
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({VIEWS[n]})" for n in VIEWS if n in needed)


# Filters of the workload: the counts, everything, a predicate that is unknown on rows
# without a distribution, and one on a text column.
FILTERS = [
    FilterSpec(1, "analysis_id = 0", ("count_value",), (0, 1, 2), "count"),
    FilterSpec(2, None, (), (0, 1, 2, 3, 4), "all"),
    FilterSpec(3, "p10_value > 20000", ("analysis_id", "p10_value"), (1, 3), "low_decile"),
    FilterSpec(4, "stratum_1 IN ('F', 'O') AND avg_value BETWEEN 100000 AND 300000", (), (2, 4), "strata"),
]

SEGMENT_CONCEPTS = [
    ("AUTOMOBILE", 8507, "automobile sector"),
    ("BUILDING", 8532, "building sector"),
    ("FURNITURE", 8551, "furniture sector"),
    ("MACHINERY", 8570, "machinery sector"),
]

APPLICATION_TEMPLATES = {
    1: """{
"method": "POST",
"url": "http://counts.example/v2/series?source={{ database_identifier }}",
"headers": {"X-Channel": "catalogue"},
"json": {"series": "people", "points": ["{{ filtered_data["count_value"][0] }}"]},
}""",
    2: """{
"method": "PATCH",
"url": "http://archive.example/{{ community_identifier }}/deposits",
"params": {"origin": "{{ database_identifier }}"},
"files": {"table": data_file},
}""",
    3: """{
"method": "POST",
"url": "http://alerts.example/{{ community_identifier }}/{{ community }}",
"json": {"first": "{{ filtered_data["p10_value"][0] }}", "second": "{{ filtered_data["analysis_id"][1] }}"},
}""",
}

APPLICATIONS = [
    Application(1, 1, 1, APPLICATION_TEMPLATES[1]),
    Application(2, 2, 0, APPLICATION_TEMPLATES[2]),
    Application(3, 3, 3, APPLICATION_TEMPLATES[3]),
]

VIEWS: dict[str, str] = {}

VIEWS["communities"] = "SELECT r_regionkey AS community_id, r_name AS community_name FROM region"

VIEWS["databases"] = """
SELECT n_nationkey AS database_id, md5(n_name) AS database_identifier, n_name AS database_name,
       n_regionkey AS community_id FROM nation"""

# Persons of a database, and the facts observed for them.
VIEWS["persons"] = """
SELECT c_custkey AS person_id, n_nationkey AS database_id, n_name AS database_name,
       c_mktsegment AS segment, c_acctbal AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey"""

VIEWS["visits"] = """
SELECT c_nationkey AS database_id, o_custkey AS person_id, o_orderstatus AS visit_status,
       o_totalprice AS visit_cost
FROM orders JOIN customer ON o_custkey = c_custkey"""

# Uploaded catalogue rows: one per order, one upload per database and year.
VIEWS["uploaded"] = """
SELECT (o_custkey % 25)::INT AS database_id,
       md5('NATION_' || (o_custkey % 25)) AS database_identifier,
       ((o_custkey % 25) * 10000 + year(o_orderdate))::BIGINT AS upload_id,
       o_orderkey AS "offset",
       (CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 103 WHEN '3-MEDIUM' THEN 104
             WHEN '4-NOT SPECIFIED' THEN 105 ELSE 2000000 END)::BIGINT AS analysis_id,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'NATION_' || (o_custkey % 25)
            WHEN '3-MEDIUM' THEN o_orderstatus
            WHEN '5-LOW' THEN CAST(o_orderkey / 4.0 AS DECIMAL(18, 2)) || ' secs' END AS stratum_1,
       NULL::VARCHAR AS stratum_2, NULL::VARCHAR AS stratum_3, NULL::VARCHAR AS stratum_4,
       NULL::VARCHAR AS stratum_5,
       floor(o_totalprice)::BIGINT AS count_value,
       CASE WHEN d THEN 0.0::DOUBLE END AS min_value,
       CASE WHEN d THEN o_totalprice END AS max_value,
       CASE WHEN d THEN o_totalprice / 2 END AS avg_value,
       CASE WHEN d THEN o_totalprice / 4 END AS stdev_value,
       CASE WHEN d THEN floor(o_totalprice / 2) END AS median_value,
       CASE WHEN d THEN floor(o_totalprice / 10) END AS p10_value,
       CASE WHEN d THEN floor(o_totalprice / 4) END AS p25_value,
       CASE WHEN d THEN floor(o_totalprice * 0.75) END AS p75_value,
       CASE WHEN d THEN floor(o_totalprice * 0.875) END AS p90_value
FROM (SELECT *, o_orderpriority IN ('2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED') AS d FROM orders)"""

# One announcement per upload; every fifth is off by one row.
VIEWS["announced"] = """
SELECT database_identifier, database_id, upload_id,
       (count(*) + CASE WHEN upload_id % 5 = 0 THEN 1 ELSE 0 END)::BIGINT AS "rows"
FROM uploaded GROUP BY database_identifier, database_id, upload_id"""

# System events.
VIEWS["messages"] = """
SELECT event_id, ts AS time, (user_id % 25)::INT AS database_id, user_id, event_type, value, props,
       epoch_us(ts) AS micros
FROM events"""

VIEWS["file_status"] = """
SELECT database_id, md5('NATION_' || database_id) AS database_identifier, event_id,
       CASE WHEN event_type = 'purchase' THEN 'COMPLETED' ELSE 'READING' END AS status,
       {'rows': floor(value)::BIGINT + 1, 'timestamp': time} AS "offset"
FROM messages WHERE event_type IN ('purchase', 'view')"""

VIEWS["uploads"] = """
SELECT event_id, database_id, md5('NATION_' || database_id) AS database_identifier, time,
       floor(value)::BIGINT AS "rows", micros
FROM messages WHERE event_type = 'purchase'"""

VIEWS["beats"] = """
SELECT event_id, database_id, time, micros,
       CASE WHEN event_type = 'click' THEN 'Requested' ELSE 'Periodic' END AS reason
FROM messages WHERE event_type IN ('click', 'view')"""

VIEWS["deliveries"] = """
SELECT event_id, user_id AS application_id, time, props AS response_data,
       (CASE WHEN event_type = 'error' AND value < 8 THEN 0 WHEN event_type = 'error' AND value < 16 THEN 503
             WHEN value > 30 THEN 404 ELSE 200 END)::INT AS response_code
FROM messages WHERE event_type IN ('error', 'purchase')"""

# Management messages of two channels: an application per user, a filter for several of them.
VIEWS["management"] = """
SELECT event_id, event_type AS channel, time, user_id AS application_id, (user_id % 40) AS filter_id,
       CASE WHEN value < 50 THEN 'STOPPED' WHEN value < 70 THEN 'EDIT' ELSE 'ACTIVE' END AS action,
       (user_id % 5)::INT AS community_id, props AS request_template
FROM messages WHERE event_type IN ('signup', 'click')"""


class Tables:
    """The given tables and their stand-ins as lazy DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def values(self, rows: list[tuple], schema: str) -> DataFrame:
        return local_table(self.spark, rows, schema)

    @cached_property
    def communities(self) -> DataFrame:
        return self.read("region").select(
            F.col("r_regionkey").alias("community_id"), F.col("r_name").alias("community_name")
        )

    @cached_property
    def databases(self) -> DataFrame:
        return self.read("nation").select(
            F.col("n_nationkey").alias("database_id"),
            F.md5("n_name").alias("database_identifier"),
            F.col("n_name").alias("database_name"),
            F.col("n_regionkey").alias("community_id"),
        )

    @cached_property
    def persons(self) -> DataFrame:
        nation = self.read("nation")
        customer = self.read("customer")
        return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
            F.col("c_custkey").alias("person_id"),
            F.col("n_nationkey").alias("database_id"),
            F.col("n_name").alias("database_name"),
            F.col("c_mktsegment").alias("segment"),
            F.col("c_acctbal").alias("balance"),
        )

    @cached_property
    def visits(self) -> DataFrame:
        orders, customer = self.read("orders"), self.read("customer")
        return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
            F.col("c_nationkey").alias("database_id"),
            F.col("o_custkey").alias("person_id"),
            F.col("o_orderstatus").alias("visit_status"),
            F.col("o_totalprice").alias("visit_cost"),
        )

    @cached_property
    def uploaded(self) -> DataFrame:
        price, priority, database = F.col("o_totalprice"), F.col("o_orderpriority"), F.col("o_custkey") % 25
        name = F.concat(F.lit("NATION_"), database.cast("string"))
        spread = priority.isin("2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")
        absent = F.lit(None).cast("string")
        return self.read("orders").select(
            database.cast("int").alias("database_id"),
            F.md5(name).alias("database_identifier"),
            (database * 10000 + F.year("o_orderdate")).alias("upload_id"),
            F.col("o_orderkey").alias("offset"),
            F.when(priority == "1-URGENT", 0)
            .when(priority == "2-HIGH", 103)
            .when(priority == "3-MEDIUM", 104)
            .when(priority == "4-NOT SPECIFIED", 105)
            .otherwise(2_000_000)
            .cast("long")
            .alias("analysis_id"),
            F.when(priority == "1-URGENT", name)
            .when(priority == "3-MEDIUM", F.col("o_orderstatus"))
            .when(
                priority == "5-LOW",
                F.concat((F.col("o_orderkey") / F.lit(4.0)).cast("decimal(18,2)").cast("string"), F.lit(" secs")),
            )
            .alias("stratum_1"),
            absent.alias("stratum_2"),
            absent.alias("stratum_3"),
            absent.alias("stratum_4"),
            absent.alias("stratum_5"),
            F.floor(price).alias("count_value"),
            F.when(spread, F.lit(0.0)).alias("min_value"),
            F.when(spread, price).alias("max_value"),
            F.when(spread, price / 2).alias("avg_value"),
            F.when(spread, price / 4).alias("stdev_value"),
            F.when(spread, F.floor(price / 2).cast("double")).alias("median_value"),
            F.when(spread, F.floor(price / 10).cast("double")).alias("p10_value"),
            F.when(spread, F.floor(price / 4).cast("double")).alias("p25_value"),
            F.when(spread, F.floor(price * 0.75).cast("double")).alias("p75_value"),
            F.when(spread, F.floor(price * 0.875).cast("double")).alias("p90_value"),
        )

    @cached_property
    def announced(self) -> DataFrame:
        late = F.when(F.col("upload_id") % 5 == 0, 1).otherwise(0)
        return (
            self.uploaded.groupBy("database_identifier", "database_id", "upload_id")
            .agg(F.count(F.lit(1)).alias("_n"))
            .select("database_identifier", "database_id", "upload_id", (F.col("_n") + late).alias("rows"))
        )

    @cached_property
    def messages(self) -> DataFrame:
        return self.read("events").select(
            "event_id",
            F.col("ts").alias("time"),
            (F.col("user_id") % 25).cast("int").alias("database_id"),
            "user_id",
            "event_type",
            "value",
            "props",
            to_micros(F.col("ts")).alias("micros"),
        )

    def _identified(self, *types: str) -> DataFrame:
        rows = self.messages.where(F.col("event_type").isin(*types))
        identifier = F.md5(F.concat(F.lit("NATION_"), F.col("database_id").cast("string")))
        return rows.withColumn("database_identifier", identifier)

    @cached_property
    def file_status(self) -> DataFrame:
        return self._identified("purchase", "view").select(
            "database_id",
            "database_identifier",
            "event_id",
            F.when(F.col("event_type") == "purchase", "COMPLETED").otherwise("READING").alias("status"),
            F.struct((F.floor("value") + 1).alias("rows"), F.col("time").alias("timestamp")).alias("offset"),
        )

    @cached_property
    def uploads(self) -> DataFrame:
        return self._identified("purchase").select(
            "event_id", "database_id", "database_identifier", "time", F.floor("value").alias("rows"), "micros"
        )

    @cached_property
    def beats(self) -> DataFrame:
        return self._identified("click", "view").select(
            "event_id",
            "database_id",
            "time",
            "micros",
            F.when(F.col("event_type") == "click", "Requested").otherwise("Periodic").alias("reason"),
        )

    @cached_property
    def deliveries(self) -> DataFrame:
        error, value = F.col("event_type") == "error", F.col("value")
        code = F.when(error & (value < 8), 0).when(error & (value < 16), 503).when(value > 30, 404).otherwise(200)
        return self._identified("error", "purchase").select(
            "event_id",
            F.col("user_id").alias("application_id"),
            "time",
            F.col("props").alias("response_data"),
            code.cast("int").alias("response_code"),
        )

    @cached_property
    def management(self) -> DataFrame:
        value = F.col("value")
        return self._identified("signup", "click").select(
            "event_id",
            F.col("event_type").alias("channel"),
            "time",
            F.col("user_id").alias("application_id"),
            (F.col("user_id") % 40).alias("filter_id"),
            F.when(value < 50, "STOPPED").when(value < 70, "EDIT").otherwise("ACTIVE").alias("action"),
            (F.col("user_id") % 5).cast("int").alias("community_id"),
            F.col("props").alias("request_template"),
        )

