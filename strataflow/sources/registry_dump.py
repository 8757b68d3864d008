"""Registry dumps: an array of ``{model, pk, fields}`` as dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DUMP_SCHEMA = (
    "model string, pk long, fields struct<name:string, community:long, database_identifier:string, filter:string, "
    "status:string, communities:array<long>, `column`:string, request_template:string>"
)


def read_dump(spark: SparkSession, path: str, lines: bool = False) -> dict[str, DataFrame]:
    """Tables ``communities, databases, filters, selections, applications``.

    A dump is one array, which one task reads, or with ``lines`` a model in each line, of any number of files.
    """
    dump = spark.read.schema(DUMP_SCHEMA).option("multiLine", not lines).json(path)
    kind = F.element_at(F.split("model", r"\."), -1)

    def rows(model: str, **columns: str) -> DataFrame:
        return dump.where(kind == model).select(*[F.expr(e).alias(n) for n, e in columns.items()])

    selections = rows("filterselection", selection_id="pk", filter_id="cast(fields.filter as long)", column="fields.`column`")
    # A filter selects at most the sixteen catalogue columns.
    ordered = selections.groupBy("filter_id").agg(
        F.array_sort(F.collect_list(F.struct("selection_id", "column")))["column"].alias("selections")
    )
    filters = rows(
        "filter",
        filter_id="pk",
        name="fields.name",
        filter="fields.filter",
        status="fields.status",
        communities="fields.communities",
    ).join(ordered, "filter_id", "left")
    return {
        "communities": rows("community", community_id="pk", community_name="fields.name"),
        "databases": rows(
            "database",
            database_id="pk",
            database_identifier="fields.database_identifier",
            database_name="fields.name",
            community_id="fields.community",
        ),
        "filters": filters,
        "selections": selections,
        "applications": rows(
            "application",
            application_id="pk",
            community_id="fields.community",
            filter_id="cast(fields.filter as long)",
            name="fields.name",
            request_template="fields.request_template",
            status="fields.status",
        ),
    }
