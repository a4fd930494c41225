"""The control table: last chunk, upsert, folded history and what is left to do."""

from pyspark.sql import functions as F

from catalogue.base import query, table
from tablelift.operators.chunks import chunk_plan, whole_part
from tablelift.operators.control import current_status, last_chunk, remaining_chunks, upsert_control

CHUNK = 1000
KEYS = ["extraction_name", "chunk_number"]

# A chunk counts as loaded when its last event lies in the first half of a minute.
STATES = f"""
    SELECT event_type AS extraction_name, 'stage_' || event_type AS table_name,
           event_id // {CHUNK} + 1 AS chunk_number, count(*) AS rows_loaded,
           CASE WHEN extract(second FROM max(ts)) < 30 THEN 'OK' ELSE 'ERROR' END AS status,
           min(ts) AS created_at, max(ts) AS updated_at
    FROM events GROUP BY event_type, event_id // {CHUNK} + 1
"""
# A second attempt at the chunks that failed, and chunks of a run that starts two chunks later.
CHANGES = f"""
    SELECT extraction_name, 'retry' AS table_name, chunk_number + 2 AS chunk_number, rows_loaded + 1 AS rows_loaded,
           'OK' AS status, updated_at + INTERVAL 60 DAY AS created_at, updated_at + INTERVAL 60 DAY AS updated_at
    FROM ({STATES}) WHERE status = 'ERROR'
"""
MERGED = f"""
    SELECT extraction_name, chunk_number, coalesce(o.table_name, n.table_name) AS table_name,
           coalesce(n.rows_loaded, o.rows_loaded) AS rows_loaded, coalesce(n.status, o.status) AS status,
           coalesce(o.created_at, n.created_at) AS created_at, coalesce(n.updated_at, o.updated_at) AS updated_at
    FROM ({STATES}) o FULL JOIN ({CHANGES}) n USING (extraction_name, chunk_number)
"""


def states(spark, folder):
    number = (whole_part(F.col("event_id"), CHUNK) + 1).alias("chunk_number")
    loaded = F.when(F.second(F.max("ts")) < 30, "OK").otherwise("ERROR")
    return (
        table(spark, folder, "events")
        .groupBy(F.col("event_type").alias("extraction_name"), number)
        .agg(
            F.count(F.lit(1)).alias("rows_loaded"),
            loaded.alias("status"),
            F.min("ts").alias("created_at"),
            F.max("ts").alias("updated_at"),
        )
        .withColumn("table_name", F.concat(F.lit("stage_"), "extraction_name"))
    )


def changes(control):
    later = F.col("updated_at") + F.expr("INTERVAL 60 DAYS")
    return control.filter(F.col("status") == "ERROR").withColumns(
        {
            "table_name": F.lit("retry"),
            "chunk_number": F.col("chunk_number") + 2,
            "rows_loaded": F.col("rows_loaded") + 1,
            "status": F.lit("OK"),
            "created_at": later,
            "updated_at": later,
        }
    )


@query(
    "control_last_chunk",
    f"""
    SELECT extraction_name, coalesce(max(chunk_number) FILTER (status = 'OK'), 0) AS last_chunk
    FROM ({STATES}) GROUP BY extraction_name
    """,
)
def control_last_chunk(spark, folder):
    return last_chunk(states(spark, folder))


@query("control_upsert", MERGED)
def control_upsert(spark, folder):
    control = states(spark, folder)
    return upsert_control(control, changes(control), KEYS)


@query("control_current", MERGED)
def control_current(spark, folder):
    control = states(spark, folder)
    return current_status(control.unionByName(changes(control)), KEYS)


@query(
    "resume_remaining",
    f"""
    SELECT n + 1 AS chunk_number, n * {CHUNK} AS chunk_offset, {CHUNK}::BIGINT AS chunk_size,
           least({CHUNK}, total - n * {CHUNK})::BIGINT AS chunk_rows,
           (total + {CHUNK - 1}) // {CHUNK} AS chunk_count, total AS total_rows
    FROM (SELECT total, unnest(range(0, (total + {CHUNK - 1}) // {CHUNK})) AS n
          FROM (SELECT count(*) AS total FROM events))
    WHERE n + 1 NOT IN (SELECT chunk_number FROM ({STATES}) WHERE extraction_name = 'click' AND status = 'OK')
    """,
)
def resume_remaining(spark, folder):
    plan = chunk_plan(table(spark, folder, "events"), CHUNK)
    clicks = states(spark, folder).filter(F.col("extraction_name") == "click")
    return remaining_chunks(plan, clicks)
