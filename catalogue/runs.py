"""Whole runs: configurations, fan-out, failures, and chunked copies that break and go on."""

from pyspark.sql import functions as F

from catalogue.base import query, table
from tablelift.operators.control import ControlTable
from tablelift.operators.chunks import assign_chunks
from tablelift.operators.reports import chunk_eta, chunk_report, copy_counts, step_summary
from tablelift.plans.copy import copy_in_chunks
from tablelift.plans.run import run_config, run_summary
from tablelift.session import new_folder
from tablelift.sinks import find_target, load, register_target
from tablelift.sinks.targets import FileTarget

COPIED = ["customer", "orders", "part"]
COPY_CHUNK = 2000


def extraction(folder, name, file=None):
    return {"name": name, "source": "Parquet", "config": {"path": f"{folder}/{file or name}.parquet"}}


def copy_load(name, place, table_name=None, **config):
    return {
        "name": f"{table_name or name}_load",
        "source": name,
        "target": "parquet",
        "config": {"path": place, **config},
        "table": table_name or name,
        "mode": "insert",
    }


def run_of(spark, folder, names, place, **more):
    config = {
        "extractions": [extraction(folder, n) for n in names],
        "loads": [copy_load(n, "${PLACE}") for n in names],
        **more,
    }
    return run_config(spark, config, values={"PLACE": place})


def written(spark, place, name):
    return find_target("parquet").read(spark, {"path": place}, name)


STEP_SQL = "\nUNION ALL\n".join(
    f"SELECT '{step}' AS step, '{label}' AS name, count(*) AS rows, 'OK' AS status FROM {name}"
    for name in COPIED
    for step, label in [("extract", name), ("load", f"{name}_load")]
)


@query("run_config", STEP_SQL)
def run_config_query(spark, folder):
    steps = run_of(spark, folder, COPIED, new_folder(spark, "run"))
    return steps.select("step", "name", "rows", "status")


@query(
    "run_fanout",
    """
    SELECT 'first' AS target, * FROM orders
    UNION ALL
    SELECT 'second' AS target, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
    """,
)
def run_fanout(spark, folder):
    place = new_folder(spark, "fanout")
    config = {
        "extractions": [extraction(folder, "orders")],
        "loads": [copy_load("orders", place, "first"), copy_load("orders", place, "second")],
    }
    run_config(spark, config)
    first, second = (written(spark, place, t).withColumn("target", F.lit(t)) for t in ("first", "second"))
    return first.unionByName(second)


@query(
    "run_summary",
    """
    SELECT 'completed' AS status, 6::BIGINT AS steps, 0::BIGINT AS failed_steps, n AS rows_extracted, n AS rows_loaded
    FROM (SELECT (SELECT count(*) FROM customer) + (SELECT count(*) FROM orders) + (SELECT count(*) FROM part) AS n)
    """,
)
def run_summary_query(spark, folder):
    steps = run_of(spark, folder, COPIED, new_folder(spark, "run"))
    return run_summary(steps).drop("seconds")


@query(
    "run_step_totals",
    """
    SELECT step, 3::BIGINT AS steps, 0::BIGINT AS failed,
           (SELECT count(*) FROM customer) + (SELECT count(*) FROM orders) + (SELECT count(*) FROM part) AS rows
    FROM (VALUES ('extract'), ('load')) AS kinds(step)
    """,
)
def run_step_totals(spark, folder):
    return step_summary(run_of(spark, folder, COPIED, new_folder(spark, "run"))).drop("seconds")


@query(
    "run_failure_isolated",
    """
    SELECT 'extract' AS step, 'customer' AS name, count(*) AS rows, 'OK' AS status FROM customer
    UNION ALL SELECT 'load', 'customer_load', count(*), 'OK' FROM customer
    UNION ALL SELECT 'extract', 'missing', 0, 'FAILED'
    UNION ALL SELECT 'load', 'missing_load', 0, 'SKIPPED'
    UNION ALL SELECT 'load', 'orphan_load', 0, 'SKIPPED'
    UNION ALL SELECT 'extract', 'orders', count(*), 'OK' FROM orders
    UNION ALL SELECT 'load', 'orders_load', 0, 'FAILED'
    """,
)
def run_failure_isolated(spark, folder):
    place = new_folder(spark, "run")
    config = {
        "extractions": [extraction(folder, "customer"), extraction(folder, "missing"), extraction(folder, "orders")],
        "loads": [
            copy_load("customer", place),
            copy_load("missing", place),
            copy_load("orphan", place),
            copy_load("orders", place) | {"target": "nowhere"},
        ],
    }
    return run_config(spark, config).select("step", "name", "rows", "status")


@query("transform_hook", "SELECT o_orderkey, upper(o_orderpriority) AS priority, o_totalprice * 2 AS doubled FROM orders")
def transform_hook(spark, folder):
    place = new_folder(spark, "hook")

    def doubled(orders):
        return orders.select(
            "o_orderkey", F.upper("o_orderpriority").alias("priority"), (F.col("o_totalprice") * 2).alias("doubled")
        )

    config = {
        "extractions": [extraction(folder, "orders")],
        "transformations": {"enabled": "true"},
        "loads": [copy_load("orders", place)],
    }
    run_config(spark, config, transforms={"orders": doubled})
    return written(spark, place, "orders")


@query("copy_chunked", "SELECT * FROM orders")
def copy_chunked(spark, folder):
    place = new_folder(spark, "copy")
    config = {
        "mode": "chunked",
        "control_path": f"{place}/control",
        "extractions": [
            {"name": "orders", "source": "parquet", "config": {"path": f"{folder}/orders.parquet", "batch_size": "2000"}}
        ],
        "loads": [copy_load("orders", place, chunk_key="o_orderkey")],
    }
    run_config(spark, config)
    return written(spark, place, "orders")


class BreaksOnce(FileTarget):
    """A file target whose third append fails after its rows were written."""

    def __init__(self):
        super().__init__("parquet")
        self.appends = 0

    def append(self, df, config, table, **more):
        super().append(df, config, table, **more)
        self.appends += 1
        if self.appends == 3:
            raise RuntimeError("broken off")


def broken_and_resumed(spark, folder):
    place = new_folder(spark, "resume")
    control = ControlTable(spark, f"{place}/control")
    register_target("breaks_once", BreaksOnce())
    copy = dict(
        name="orders", table="orders", key=["o_orderkey"], size=COPY_CHUNK, control=control, config={"path": place},
        waves=5,
    )
    orders = table(spark, folder, "orders")
    try:
        copy_in_chunks(orders, target="breaks_once", **copy)
    except RuntimeError:
        copy_in_chunks(orders, target="parquet", **copy)
    return place, control


@query("copy_resume", "SELECT * FROM orders")
def copy_resume(spark, folder):
    place, _ = broken_and_resumed(spark, folder)
    return written(spark, place, "orders")


@query(
    "copy_control",
    f"""
    SELECT 'orders' AS extraction_name, row_index // {COPY_CHUNK} + 1 AS chunk_number, {COPY_CHUNK}::BIGINT AS chunk_size,
           count(*) AS rows_loaded, 'OK' AS status
    FROM (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS row_index FROM orders)
    GROUP BY row_index // {COPY_CHUNK}
    """,
)
def copy_control(spark, folder):
    _, control = broken_and_resumed(spark, folder)
    return control.current().select("extraction_name", "chunk_number", "chunk_size", "rows_loaded", "status")


CHUNKED = {"customer": "c_custkey", "orders": "o_orderkey", "part": "p_partkey", "supplier": "s_suppkey"}
CHUNKED_SIZE = 300
CHUNKED_SQL = "\nUNION ALL\n".join(
    f"""
    SELECT '{kind}' AS target, '{name}' AS table_name, chunk_number, count(*) AS rows_loaded, 'OK' AS status,
           CAST(sum({key}) AS BIGINT) AS keys_in_target
    FROM (SELECT *, (row_number() OVER (ORDER BY {key}) - 1) // {CHUNKED_SIZE} + 1 AS chunk_number FROM {name})
    GROUP BY chunk_number
    """
    for kind in ("parquet", "table")
    for name, key in CHUNKED.items()
)


@query("run_chunked_tables", CHUNKED_SQL)
def run_chunked_tables(spark, folder):
    """Four tables copied side by side under one control path, to files and to catalog tables that are not there yet."""
    found = None
    for kind in ("parquet", "table"):
        place = new_folder(spark, "chunked")
        copied = {name: f"copy_{name}_{place[-32:]}" if kind == "table" else name for name in CHUNKED}
        config = {
            "mode": "chunked",
            "control_path": f"{place}/control",
            "extractions": [
                extraction(folder, name) | {"config": {"path": f"{folder}/{name}.parquet", "batch_size": CHUNKED_SIZE}}
                for name in CHUNKED
            ],
            "loads": [
                copy_load(name, place, copied[name], chunk_key=key, commit_rows=15 * CHUNKED_SIZE) | {"target": kind}
                for name, key in CHUNKED.items()
            ],
        }
        run_config(spark, config)
        states = ControlTable(spark, f"{place}/control").current()
        for name, key in CHUNKED.items():
            rows = find_target(kind).read(spark, {"path": place}, copied[name])
            numbered = assign_chunks(rows, [key], CHUNKED_SIZE).groupBy("chunk_number")
            keys = numbered.agg(F.sum(key).alias("keys_in_target"))
            own = states.filter(F.col("table_name") == copied[name]).join(keys, "chunk_number", "full")
            own = own.select(
                F.lit(kind).alias("target"), F.lit(name).alias("table_name"), "chunk_number", "rows_loaded", "status",
                "keys_in_target",
            )
            found = own if found is None else found.unionByName(own)
    return found


@query("run_same_stem", "SELECT 'orders' AS of, * FROM orders UNION ALL SELECT 'half', * FROM orders WHERE o_orderkey % 2 = 0")
def run_same_stem(spark, folder):
    """Queries over two folders of one name, side by side."""
    place = new_folder(spark, "stem")
    orders = table(spark, folder, "orders")
    orders.filter(F.col("o_orderkey") % 2 == 0).write.parquet(f"{place}/orders.parquet")
    config = {
        "extractions": [
            {"name": name, "source": "parquet", "config": {"path": f"{where}/orders.parquet"},
             "query": "SELECT * FROM orders"}
            for name, where in [("orders", folder), ("half", place)]
        ],
        "loads": [copy_load(name, f"{place}/out") for name in ("orders", "half")],
    }
    run_config(spark, config)
    return written(spark, f"{place}/out", "orders").withColumn("of", F.lit("orders")).unionByName(
        written(spark, f"{place}/out", "half").withColumn("of", F.lit("half"))
    )


@query("copy_resume_appended", "SELECT * FROM orders")
def copy_resume_appended(spark, folder):
    """The odd keys copied onto the even ones, broken off and resumed."""
    place = new_folder(spark, "resume")
    control = ControlTable(spark, f"{place}/control")
    orders = table(spark, folder, "orders")
    odd = orders.filter(F.col("o_orderkey") % 2 == 1)
    load(orders.filter(F.col("o_orderkey") % 2 == 0), "parquet", "orders", {"path": place})
    register_target("breaks_once", BreaksOnce())
    copy = dict(name="odd", table="orders", key=["o_orderkey"], size=700, control=control, config={"path": place}, waves=5)
    try:
        copy_in_chunks(odd, target="breaks_once", **copy)
    except RuntimeError:
        copy_in_chunks(odd, target="parquet", **copy)
    return written(spark, place, "orders")


@query(
    "copy_report",
    f"""
    SELECT chunk_number, rows, {COPY_CHUNK}::BIGINT AS chunk_size, (chunk_number - 1) * {COPY_CHUNK} AS chunk_offset,
           (sum(rows) OVER (ORDER BY chunk_number))::BIGINT AS cumulative, (sum(rows) OVER ())::BIGINT AS total_rows,
           round(sum(rows) OVER (ORDER BY chunk_number) * 100 / sum(rows) OVER (), 1) AS percent
    FROM (SELECT row_index // {COPY_CHUNK} + 1 AS chunk_number, count(*) AS rows
          FROM (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS row_index FROM orders)
          GROUP BY row_index // {COPY_CHUNK})
    """,
)
def copy_report(spark, folder):
    """The report of a copy from its control table; the times of the run itself differ from run to run."""
    _, control = broken_and_resumed(spark, folder)
    report = chunk_report(copy_counts(control, "orders"), COPY_CHUNK)
    return chunk_eta(report).drop("seconds", "elapsed", "eta_seconds")


@query(
    "copy_resume_null_key",
    """
    SELECT how, CASE WHEN o_orderkey > 0 THEN o_orderkey END AS k, o_totalprice AS price
    FROM orders, (VALUES ('by marks'), ('by keys')) AS ways(how)
    """,
)
def copy_resume_null_key(spark, folder):
    """A key with one null, copied and broken off in the second wave: resumed by the target's marks, and by the keys in the target."""

    class WithoutMarks(BreaksOnce):
        def append(self, df, config, table):
            super().append(df, config, table)

    orders = table(spark, folder, "orders")
    rows = orders.select(F.when(F.col("o_orderkey") > 0, F.col("o_orderkey")).alias("k"), F.col("o_totalprice").alias("price"))
    found = None
    for how, breaking in (("by marks", BreaksOnce()), ("by keys", WithoutMarks())):
        place = new_folder(spark, "resume")
        register_target("breaks_once", breaking)
        copy = dict(
            name="orders", table="orders", key=["k"], size=COPY_CHUNK, control=ControlTable(spark, f"{place}/control"),
            config={"path": place}, waves=5,
        )
        breaking.appends = 1
        try:
            copy_in_chunks(rows, target="breaks_once", **copy)
        except RuntimeError:
            copy_in_chunks(rows, target="parquet", **copy)
        copied = written(spark, place, "orders").select(F.lit(how).alias("how"), "k", "price")
        found = copied if found is None else found.unionByName(copied)
    return found


@query(
    "run_untidy_keys",
    """
    SELECT mode, c_custkey AS id_cliente, CASE WHEN mode = 'upsert' THEN upper(c_name) ELSE c_name END AS nombre
    FROM customer, (VALUES ('upsert'), ('chunked'), ('stream')) AS modes(mode)
    """,
)
def run_untidy_keys(spark, folder):
    """Keys named as the source spells its headers, in upper case, with spaces or mapped, in every mode."""
    place = new_folder(spark, "untidy")
    customer = table(spark, folder, "customer").select(F.col("c_custkey").alias("CLAVE CLIENTE"), F.col("c_name").alias("NOMBRE"))
    customer.write.parquet(f"{place}/in")
    customer.withColumn("NOMBRE", F.upper("NOMBRE")).write.parquet(f"{place}/changed")
    mapping = {"CLAVE CLIENTE": "ID CLIENTE"}

    def run(mode, source, name, **config):
        load_of = {
            "name": f"{name}_load", "source": name, "target": "parquet", "table": name,
            "config": {"path": f"{place}/out", "column_mapping": mapping} | config,
        }
        if config.get("keys"):
            load_of["mode"] = "upsert"
        whole = {
            "mode": mode, "control_path": f"{place}/control",
            "extractions": [{"name": name, "source": "parquet", "config": {"path": f"{place}/{source}"}}], "loads": [load_of],
        }
        run_config(spark, whole)

    run("batch", "in", "upsert", keys=["CLAVE CLIENTE"])
    run("batch", "changed", "upsert", keys="ID_CLIENTE", latest_by="NOMBRE")
    run("chunked", "in", "chunked", chunk_key="Clave Cliente", waves=2)
    run("stream", "in", "stream", key="ID CLIENTE", checkpoint=f"{place}/checkpoint")
    found = None
    for mode in ("upsert", "chunked", "stream"):
        copied = written(spark, f"{place}/out", mode).withColumn("mode", F.lit(mode))
        found = copied if found is None else found.unionByName(copied)
    return found
