"""Query batches ``queries(query_id bigint, query_text string)``.

All batches run against the index of the whole ``documents`` table:

* ``benchmark``: every passage of the ``benchmark`` table is one AND query
  (passages are copied into documents, so hits exist);
* ``conversations``: every conversation turn is one query
  (query_id = position in (conv_id, turn) order, from 1);
* ``dev``: fixed short queries and the edge cases (repeated term, unseen
  term, blank).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ids import dense_ids
from ..sources.corpus import read_table

# Short dev-style queries (repeated term at 7 = 5 twice), then
# edge cases (unseen term, blank, punctuation token, repeated terms).
DEV_QUERIES = [
    (1, "we are"),
    (2, "of and"),
    (3, "the of and in"),
    (4, "very cool"),
    (5, "the"),
    (6, "a"),
    (7, "the the"),
    (8, "is it the"),
    (9, "of the in"),
    (10, "and the"),
    (11, "und der die"),
    (12, "de la le"),
    (13, "the zzzunseenzzz"),
    (14, "   "),
    (15, ""),
    (16, "the , of"),
    (17, "in  in in"),
]


def dev_queries(spark: SparkSession, sign: int = 1) -> DataFrame:
    """``sign=-1``: negative ids, which no other batch has."""
    rows = [(i * sign, t) for i, t in DEV_QUERIES]
    return spark.createDataFrame(rows, "query_id bigint, query_text string")


def dev_queries_sql(sign: int = 1) -> str:
    rows = ", ".join(f"({i * sign}, '{t}')" for i, t in DEV_QUERIES)
    return f"(SELECT CAST(query_id AS BIGINT) AS query_id, query_text FROM (VALUES {rows}) AS v(query_id, query_text))"


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "benchmark").select(
        F.col("item_id").cast("bigint").alias("query_id"), F.col("text").alias("query_text")
    )


BENCHMARK_QUERIES_SQL = "(SELECT CAST(item_id AS BIGINT) AS query_id, text AS query_text FROM benchmark)"


def conversation_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return dense_ids(turns, ["conv_id", "turn", "role", "text"], "query_id", start=1).select(
        "query_id", F.col("text").alias("query_text"))


CONVERSATION_QUERIES_SQL = (
    "(SELECT row_number() OVER (ORDER BY conv_id NULLS FIRST, turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)"
    " AS query_id, text AS query_text FROM conversations)"
)
