"""Similar items: nearest neighbours and the staged retrieval built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataflow.operators.nearindex import build_index, near_neighbours
from strataflow.operators.similar import similar_funnel, top_neighbours
from strataflow.session import stage
from workload.base import VIEWS, query, with_views

VIEWS["pairs"] = """
SELECT a.vec_id AS query_id, b.vec_id AS item_id, a.label AS query_label, b.label AS item_label,
       list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS similarity
FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id"""

VIEWS["ranked"] = """
SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, item_id) AS place FROM pairs"""


def items(t):
    return t.read("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")


@query(
    "similar_top_k",
    with_views("ranked")
    + """SELECT query_id, item_id, place::INT AS place, round(similarity, 5) AS similarity FROM ranked WHERE place <= 5""",
)
def _top_k(t):
    near = top_neighbours(items(t), items(t), 5)
    return near.select("query_id", "item_id", "place", F.round("similarity", 5).alias("similarity"))


@query(
    "similar_funnel",
    with_views("ranked")
    + """, first AS (SELECT DISTINCT item_id, item_label FROM ranked WHERE query_label = 0 AND place <= 20),
second AS (SELECT DISTINCT r.item_id, r.item_label FROM ranked r JOIN first f ON r.query_id = f.item_id
   WHERE f.item_label < 7 AND r.place <= 5)
SELECT 0::INT AS stage, 'retrieved' AS step, count(*) AS items FROM embeddings WHERE label = 0
UNION ALL SELECT 1, 'retrieved', count(*) FROM first
UNION ALL SELECT 1, 'filter_1', count(*) FROM first WHERE item_label < 7
UNION ALL SELECT 2, 'retrieved', count(*) FROM second
UNION ALL SELECT 2, 'filter_1', count(*) FROM second WHERE item_label < 7
UNION ALL SELECT 2, 'filter_2', count(*) FROM second WHERE item_label < 7 AND item_label <> 3""",
)
def _funnel(t):
    title, abstract = F.col("label") < 7, F.col("label") != 3
    return similar_funnel(items(t), F.col("label") == 0, [(20, [title]), (5, [title, abstract])])


@query(
    "similar_approximate",
    """SELECT count(*) AS queries, (20 * count(*))::BIGINT AS neighbours, TRUE AS recalled FROM embeddings""",
)
def _approximate(t):
    """Neighbours from the index: all there, and at least nine of ten of the exact ones among them."""
    rows = items(t)
    near = stage(near_neighbours(rows, build_index(rows, 20)).select("query_id", "item_id"))
    exact = top_neighbours(rows, rows, 20).select("query_id", "item_id")
    same = exact.join(near, ["query_id", "item_id"], "left_semi").agg(F.count(F.lit(1)).alias("same"))
    counted = near.agg(F.count_distinct("query_id").alias("queries"), F.count(F.lit(1)).alias("neighbours"))
    # Two tables of one row.
    both = counted.withColumn("one", F.lit(1)).join(same.withColumn("one", F.lit(1)), "one")
    return both.select("queries", "neighbours", (F.col("same") >= 0.9 * F.col("neighbours")).alias("recalled"))
