"""Scans, pass-through SQL, counts and duplicate names."""

from pyspark.sql import functions as F

from catalogue.base import query, table, views
from tablelift.operators.columns import keep_last_columns
from tablelift.sources import count_frame, read_source

JOINED = """
SELECT n_name, o_orderstatus, count(*) AS order_count, max(o_totalprice) AS top_price
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name, o_orderstatus
HAVING count(*) > 5
"""
PRICED = "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice >= {low} AND o_orderstatus = {state}"


@query("source_scan", "SELECT * FROM orders")
def source_scan(spark, folder):
    return table(spark, folder, "orders")


@query("source_query", JOINED)
def source_query(spark, folder):
    views(spark, folder, "orders", "customer", "nation")
    return read_source(spark, "view", query=JOINED)


@query("source_query_params", PRICED.format(low="150000.0", state="'O'"))
def source_query_params(spark, folder):
    views(spark, folder, "orders")
    marked = PRICED.format(low=":low", state=":state")
    return read_source(spark, "view", query=marked, params={"low": 150000.0, "state": "O"})


@query("source_count", "SELECT count(*) AS total_rows FROM lineitem")
def source_count(spark, folder):
    return count_frame(table(spark, folder, "lineitem"))


@query(
    "dedup_columns_last",
    """
    SELECT o_orderkey AS id, o_custkey AS owner, c_mktsegment AS state, c_acctbal AS amount, c_name AS name
    FROM orders JOIN customer ON o_custkey = c_custkey
    """,
)
def dedup_columns_last(spark, folder):
    left = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("owner"),
        F.col("o_orderstatus").alias("state"),
        F.col("o_totalprice").alias("amount"),
    )
    right = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("owner"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("state"),
        F.col("c_acctbal").alias("amount"),
    )
    return keep_last_columns(left.join(right, left["owner"] == right["owner"]))
