"""Stream copies: once through, broken off and resumed, and with a state per chunk."""

from pyspark.sql import functions as F

from catalogue.base import query, table
from tablelift.operators.chunks import whole_part
from tablelift.operators.control import ControlTable
from tablelift.plans.run import run_config
from tablelift.session import new_folder
from tablelift.sinks import find_target, register_target
from tablelift.sinks.targets import FileTarget
from tablelift.streaming import copied_rows, stream_chunks, stream_copy, stream_load

GROUP = 2000


def event_files(spark, folder, parts=5):
    """The events as several files of neighbouring keys."""
    place = new_folder(spark, "events")
    table(spark, folder, "events").repartitionByRange(parts, "event_id").write.parquet(f"{place}/in")
    return place


@query("stream_copy", "SELECT * FROM events")
def stream_copy_query(spark, folder):
    place, schema = event_files(spark, folder), table(spark, folder, "events").schema
    stream_copy(spark, f"{place}/in", schema, f"{place}/out", f"{place}/checkpoint", files_per_batch=2)
    return copied_rows(spark, f"{place}/out")


@query("stream_resume", "SELECT * FROM events")
def stream_resume(spark, folder):
    place, schema = event_files(spark, folder), table(spark, folder, "events").schema
    paths = (f"{place}/in", schema, f"{place}/out", f"{place}/checkpoint")

    def break_off(batch):
        if batch == 2:
            raise RuntimeError("broken off")

    try:
        stream_copy(spark, *paths, files_per_batch=1, before_write=break_off)
    except Exception as error:
        if "broken off" not in str(error):
            raise
    for _ in range(2):
        stream_copy(spark, *paths, files_per_batch=1)
    return copied_rows(spark, f"{place}/out")


class BreaksInStream(FileTarget):
    """A file target whose second append fails after its rows were written."""

    def __init__(self):
        super().__init__("parquet")
        self.appends = 0

    def append(self, df, config, table, **more):
        super().append(df, config, table, **more)
        self.appends += 1
        if self.appends == 2:
            raise RuntimeError("broken off")


@query("stream_load", "SELECT * FROM events")
def stream_load_query(spark, folder):
    place, schema = event_files(spark, folder), table(spark, folder, "events").schema
    config, control = {"path": f"{place}/out"}, ControlTable(spark, f"{place}/control")
    register_target("breaks_in_stream", BreaksInStream())

    def run(target):
        stream_load(
            spark, f"{place}/in", schema, target, "events", f"{place}/checkpoint", control, ["event_id"], config, 2
        )

    try:
        run("breaks_in_stream")
    except Exception as error:
        if "broken off" not in str(error):
            raise
    run("parquet")
    return find_target("parquet").read(spark, config, "events")


@query(
    "stream_control",
    f"""
    SELECT event_id // {GROUP} + 1 AS chunk_number, count(*) AS rows_loaded, 'OK' AS status
    FROM events GROUP BY event_id // {GROUP} + 1
    """,
)
def stream_control(spark, folder):
    place, events = new_folder(spark, "events"), table(spark, folder, "events")

    def with_group(rows):
        return rows.withColumn("chunk_number", whole_part(F.col("event_id"), GROUP) + 1)

    # Every group of keys lies in several files, so its rows come in several batches.
    events.repartition(4, F.pmod(F.hash("event_id"), F.lit(4))).write.parquet(f"{place}/in")
    control = ControlTable(spark, f"{place}/control")
    stream_copy(
        spark, f"{place}/in", events.schema, f"{place}/out", f"{place}/checkpoint",
        files_per_batch=1, control=control, name="events", chunk=with_group,
    )
    return stream_chunks(control, "events")


@query("stream_two_sources", "SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 2 = 0")
def stream_two_sources(spark, folder):
    """Two streams, each with its own checkpoint, into one target."""
    place, events = event_files(spark, folder), table(spark, folder, "events")
    events.filter(F.col("event_id") % 2 == 0).write.parquet(f"{place}/second")
    stream_copy(spark, f"{place}/in", events.schema, f"{place}/out", f"{place}/checkpoint")
    stream_copy(spark, f"{place}/second", events.schema, f"{place}/out", f"{place}/checkpoint2")
    return copied_rows(spark, f"{place}/out")


@query(
    "run_stream",
    """
    SELECT 'extract' AS step, 'events' AS name, count(*) AS rows, 'OK' AS status FROM events
    UNION ALL SELECT 'load', 'events_load', count(*), 'OK' FROM events
    UNION ALL SELECT 'extract', 'events', 0, 'OK'
    UNION ALL SELECT 'load', 'events_load', 0, 'OK'
    """,
)
def run_stream(spark, folder):
    """A configured stream, run again when nothing new has come."""
    place = event_files(spark, folder)
    config = {
        "mode": "stream",
        "control_path": f"{place}/control",
        "extractions": [{"name": "events", "source": "parquet", "config": {"path": f"{place}/in"}}],
        "loads": [
            {
                "name": "events_load", "source": "events", "target": "parquet", "table": "events",
                "config": {"path": f"{place}/out", "checkpoint": f"{place}/checkpoint", "key": "event_id"},
            }
        ],
    }
    steps = [run_config(spark, config).select("step", "name", "rows", "status") for _ in range(2)]
    return steps[0].unionByName(steps[1])
