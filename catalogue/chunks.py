"""Row indexes, chunks, pages and the reports on them."""

from pyspark.sql import functions as F

from catalogue.base import query, table
from tablelift.operators.chunks import (
    assign_chunks,
    chunk_plan,
    find_chunk_limits,
    page,
    page_by_row_number,
    page_sweep,
    slice_rows,
    union_chunks,
    with_row_index,
)
from tablelift.operators.reports import chunk_counts, chunk_eta, chunk_report, reconcile_counts, throughput

NUMBERED_ORDERS = "SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_index FROM orders"
EVENT_CHUNK = 3000
LINE_CHUNK = 7000
LINE_ORDER = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate"
)
EVENT_CHUNKS = f"SELECT *, (row_number() OVER (ORDER BY event_id) - 1) // {EVENT_CHUNK} + 1 AS chunk_number FROM events"
EVENT_COUNTS = f"""
    SELECT chunk_number, count(*) AS rows, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS seconds
    FROM ({EVENT_CHUNKS}) GROUP BY chunk_number
"""
EVENT_REPORT = f"""
    SELECT chunk_number, rows, seconds, {EVENT_CHUNK}::BIGINT AS chunk_size,
           (chunk_number - 1) * {EVENT_CHUNK} AS chunk_offset,
           (sum(rows) OVER (ORDER BY chunk_number))::BIGINT AS cumulative,
           (sum(rows) OVER ())::BIGINT AS total_rows,
           round(sum(rows) OVER (ORDER BY chunk_number) * 100 / sum(rows) OVER (), 1) AS percent
    FROM ({EVENT_COUNTS})
"""


def event_counts(spark, folder):
    return chunk_counts(assign_chunks(table(spark, folder, "events"), ["event_id"], EVENT_CHUNK), time="ts")


@query("row_index", NUMBERED_ORDERS)
def row_index(spark, folder):
    return with_row_index(table(spark, folder, "orders"), ["o_orderkey"])


@query("chunk_assign", EVENT_CHUNKS)
def chunk_assign(spark, folder):
    return assign_chunks(table(spark, folder, "events"), ["event_id"], EVENT_CHUNK)


@query(
    "chunk_assign_ties",
    f"SELECT *, (row_number() OVER (ORDER BY {LINE_ORDER}) - 1) // {LINE_CHUNK} + 1 AS chunk_number FROM lineitem",
)
def chunk_assign_ties(spark, folder):
    return assign_chunks(
        table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], LINE_CHUNK, ties="all_columns"
    )


FILTER_CHUNK, FILTERED = 2, 1234


@query(
    "chunk_filter",
    f"""
    SELECT * FROM (SELECT *, (row_number() OVER (ORDER BY event_id) - 1) // {FILTER_CHUNK} + 1 AS chunk_number FROM events)
    WHERE chunk_number = {FILTERED}
    """,
)
def chunk_filter(spark, folder):
    """One of very many chunks, by a filter on the assigned number."""
    chunked = assign_chunks(table(spark, folder, "events"), ["event_id"], FILTER_CHUNK)
    return chunked.filter(F.col("chunk_number") == FILTERED)


@query(
    "chunk_plan",
    f"""
    SELECT n + 1 AS chunk_number, n * {LINE_CHUNK} AS chunk_offset, {LINE_CHUNK}::BIGINT AS chunk_size,
           least({LINE_CHUNK}, total - n * {LINE_CHUNK})::BIGINT AS chunk_rows,
           (total + {LINE_CHUNK - 1}) // {LINE_CHUNK} AS chunk_count, total AS total_rows
    FROM (SELECT total, unnest(range(0, (total + {LINE_CHUNK - 1}) // {LINE_CHUNK})) AS n
          FROM (SELECT count(*) AS total FROM lineitem))
    """,
)
def chunk_plan_query(spark, folder):
    return chunk_plan(table(spark, folder, "lineitem"), LINE_CHUNK)


@query("page_first", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 250 OFFSET 500")
def page_first(spark, folder):
    return page(table(spark, folder, "orders"), ["o_orderkey"], 500, 250)


@query("page_offset", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 2500 OFFSET 10000")
def page_offset(spark, folder):
    return page(table(spark, folder, "orders"), ["o_orderkey"], 10_000, 2_500)


@query(
    "page_rownum",
    "SELECT * EXCLUDE (row_index) FROM (" + NUMBERED_ORDERS + ") WHERE row_index >= 4000 AND row_index < 9000",
)
def page_rownum(spark, folder):
    return page_by_row_number(table(spark, folder, "orders"), ["o_orderkey"], 4000, 9000)


@query("slice_rows", "SELECT * FROM (" + NUMBERED_ORDERS + ") WHERE row_index >= 1200 AND row_index < 7400")
def slice_rows_query(spark, folder):
    return slice_rows(table(spark, folder, "orders"), ["o_orderkey"], 1200, 6200)


@query(
    "page_sweep",
    "SELECT * EXCLUDE (row_index), row_index // 4000 + 1 AS page_number FROM (" + NUMBERED_ORDERS + ")",
)
def page_sweep_query(spark, folder):
    return page_sweep(table(spark, folder, "orders"), ["o_orderkey"], 4000)


@query("union_chunks", "SELECT * FROM orders")
def union_chunks_query(spark, folder):
    orders = table(spark, folder, "orders")
    limits = find_chunk_limits(orders, ["o_orderkey"], -(-orders.count() // 4))
    return union_chunks(orders.filter(limits.within(n, n)) for n in range(1, limits.chunks + 1))


@query("chunk_report", EVENT_REPORT)
def chunk_report_query(spark, folder):
    return chunk_report(event_counts(spark, folder), EVENT_CHUNK)


@query(
    "chunk_eta",
    f"""
    SELECT *, coalesce((total_rows - cumulative)::DOUBLE / nullif(cumulative::DOUBLE / nullif(elapsed, 0), 0), 0.0)
              AS eta_seconds
    FROM (SELECT *, (sum(seconds::DECIMAL(20,6)) OVER (ORDER BY chunk_number))::DOUBLE AS elapsed
          FROM ({EVENT_REPORT}))
    """,
)
def chunk_eta_query(spark, folder):
    return chunk_eta(chunk_report(event_counts(spark, folder), EVENT_CHUNK))


TABLE_KEYS = {"orders": "o_orderkey", "customer": "c_custkey", "part": "p_partkey"}
TABLE_CHUNK = 400
TABLE_ROWS = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, (row_number() OVER (ORDER BY {key}) - 1) // {TABLE_CHUNK} + 1 AS chunk_number FROM {name}"
    for name, key in TABLE_KEYS.items()
)


@query(
    "chunk_report_tables",
    f"""
    SELECT table_name, chunk_number, rows, {TABLE_CHUNK}::BIGINT AS chunk_size,
           (chunk_number - 1) * {TABLE_CHUNK} AS chunk_offset,
           (sum(rows) OVER (PARTITION BY table_name ORDER BY chunk_number))::BIGINT AS cumulative,
           (sum(rows) OVER (PARTITION BY table_name))::BIGINT AS total_rows,
           round(sum(rows) OVER (PARTITION BY table_name ORDER BY chunk_number) * 100
                 / sum(rows) OVER (PARTITION BY table_name), 1) AS percent
    FROM (SELECT table_name, chunk_number, count(*) AS rows FROM ({TABLE_ROWS}) GROUP BY table_name, chunk_number)
    """,
)
def chunk_report_tables(spark, folder):
    chunked = union_chunks(
        assign_chunks(table(spark, folder, name), [key], TABLE_CHUNK).select(
            F.lit(name).alias("table_name"), "chunk_number"
        )
        for name, key in TABLE_KEYS.items()
    )
    return chunk_report(chunk_counts(chunked, by=["table_name"]), TABLE_CHUNK, by=["table_name"])


@query(
    "throughput",
    f"""
    SELECT rows, seconds, rows::DOUBLE / nullif(seconds, 0) AS rows_per_second
    FROM (SELECT sum(rows)::BIGINT AS rows, sum(seconds::DECIMAL(20,6))::DOUBLE AS seconds FROM ({EVENT_COUNTS}))
    """,
)
def throughput_query(spark, folder):
    return throughput(event_counts(spark, folder))


@query(
    "reconcile_counts",
    f"""
    SELECT chunk_number, count(*) AS expected_rows, count(*) FILTER (event_type <> 'error') AS actual_rows,
           count(*) = count(*) FILTER (event_type <> 'error') AS matches
    FROM ({EVENT_CHUNKS}) GROUP BY chunk_number
    """,
)
def reconcile_counts_query(spark, folder):
    source = assign_chunks(table(spark, folder, "events"), ["event_id"], EVENT_CHUNK)
    return reconcile_counts(source, source.filter(F.col("event_type") != "error"))
