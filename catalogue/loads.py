"""Loads into a target and what is in it afterwards."""

from pyspark.sql import functions as F

from catalogue.base import query, table
from catalogue.columns import EVENT_TEXT, untidy_customers
from tablelift.session import new_folder
from tablelift.sinks import find_target, load, register_target
from tablelift.sinks.targets import FileTarget
from tablelift.sinks.versions import Versions

TIDY = """
    SELECT c_custkey AS id, c_name AS nombre, c_nationkey AS c_nation_key, c_acctbal AS saldo, c_mktsegment AS categoria
    FROM customer
"""


def loaded(spark, *steps):
    """Do the loads one after the other into one new target and give its rows."""
    place = {"path": new_folder(spark, "load")}
    for rows, settings in steps:
        settings = dict(settings)
        mode = settings.pop("mode", "insert")
        load(rows, "parquet", "copied", place | settings, mode)
    return find_target("parquet").read(spark, place, "copied")


@query("load_typed", TIDY)
def load_typed(spark, folder):
    mapping = {"c_custkey": "id", "SALDO\ufffd": "saldo"}
    return loaded(spark, (untidy_customers(spark, folder), {"column_mapping": mapping}))


@query("load_all_text", f"SELECT {EVENT_TEXT} FROM events")
def load_all_text(spark, folder):
    return loaded(spark, (table(spark, folder, "events"), {"types": "text"}))


@query("load_append", "SELECT * FROM customer UNION ALL SELECT * FROM customer")
def load_append(spark, folder):
    customer = table(spark, folder, "customer")
    turned = customer.select(*reversed(customer.columns))
    return loaded(spark, (customer, {}), (turned, {}))


@query("load_create_if_absent", "SELECT * FROM part")
def load_create_if_absent(spark, folder):
    return loaded(spark, (table(spark, folder, "part"), {}))


@query("load_truncate", "SELECT * FROM customer")
def load_truncate(spark, folder):
    customer = table(spark, folder, "customer")
    earlier = customer.withColumn("c_acctbal", -F.col("c_acctbal"))
    return loaded(spark, (earlier, {}), (customer, {"truncate_before_load": "true"}))


@query("load_replace", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def load_replace(spark, folder):
    return loaded(
        spark, (table(spark, folder, "customer"), {}), (table(spark, folder, "supplier"), {"mode": "replace"})
    )


@query("load_empty_noop", "SELECT * FROM customer")
def load_empty_noop(spark, folder):
    customer = table(spark, folder, "customer")
    nothing = customer.filter(F.col("c_custkey") < F.lit(0))
    return loaded(spark, (customer, {}), (nothing, {"truncate_before_load": True}))


@query(
    "load_upsert",
    """
    WITH changes AS (
      SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, 'MOVED' AS c_mktsegment
      FROM customer WHERE c_mktsegment = 'BUILDING'
      UNION ALL
      SELECT -1 - s_suppkey, s_name, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier
    )
    SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM changes)
    UNION ALL
    SELECT * FROM changes
    """,
)
def load_upsert(spark, folder):
    customer, supplier = table(spark, folder, "customer"), table(spark, folder, "supplier")
    moved = customer.filter(F.col("c_mktsegment") == "BUILDING").withColumns(
        {"c_acctbal": F.col("c_acctbal") + 1, "c_mktsegment": F.lit("MOVED")}
    )
    added = supplier.select(
        (-1 - F.col("s_suppkey")).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"),
        F.lit("SUPPLIER").alias("c_mktsegment"),
    )
    changes = moved.unionByName(added)
    return loaded(spark, (customer, {}), (changes, {"mode": "upsert", "keys": ["C_CUSTKEY"]}))


class Unpublished(Versions):
    def _publish(self, version):
        raise RuntimeError("broken off")


class BreaksBeforePublishing(FileTarget):
    """A file target whose driver is lost when all files are written and the version is not yet published."""

    def versions(self, spark, config, table):
        return Unpublished(spark, self.folder(config, table), self.format)


@query(
    "load_upsert_broken",
    """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal + CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS c_acctbal, c_mktsegment FROM customer
    UNION ALL
    SELECT -1 - c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 50 = 0
    """,
)
def load_upsert_broken(spark, folder):
    """An upsert that breaks off when its files are written and the version is not yet published, and is done again."""
    customer, key = table(spark, folder, "customer"), F.col("c_custkey")
    changed = customer.filter(key % 3 == 0).withColumn("c_acctbal", F.col("c_acctbal") + 1)
    added = customer.filter(key % 50 == 0).withColumn("c_custkey", -1 - key)
    place = {"path": new_folder(spark, "load"), "keys": ["c_custkey"]}
    load(customer.repartitionByRange(4, "c_custkey"), "parquet", "copied", place)
    target = find_target("parquet")
    register_target("breaks_before_publishing", BreaksBeforePublishing("parquet"))
    try:
        load(changed.unionByName(added), "breaks_before_publishing", "copied", place, "upsert")
    except RuntimeError:
        if target.read(spark, place, "copied").count() != customer.count():
            raise
    load(changed.unionByName(added), "parquet", "copied", place, "upsert")
    return target.read(spark, place, "copied")


# The account balances of each nation fall into groups of equal latest_by, and of none.
LATEST = """
    SELECT c_custkey % 100 AS k, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_nationkey % 4 END AS version, c_custkey AS v
    FROM customer
"""


@query(
    "load_upsert_latest",
    f"""
    WITH old AS (SELECT c_custkey AS k, 0 AS version, c_custkey AS v FROM customer WHERE c_custkey % 2 = 0),
    new AS (
      SELECT k, version, v FROM (
        SELECT *, row_number() OVER (PARTITION BY k ORDER BY version DESC NULLS LAST, v DESC) AS n FROM ({LATEST}))
      WHERE n = 1
    )
    SELECT * FROM old WHERE k NOT IN (SELECT k FROM new) UNION ALL SELECT * FROM new
    """,
)
def load_upsert_latest(spark, folder):
    customer, key = table(spark, folder, "customer"), F.col("c_custkey")
    old = customer.filter(key % 2 == 0).select(key.alias("k"), F.lit(0).alias("version"), key.alias("v"))
    version = F.when(key % 3 != 0, F.col("c_nationkey") % 4)
    new = customer.select((key % 100).alias("k"), version.alias("version"), key.alias("v"))
    return loaded(spark, (old, {}), (new, {"mode": "upsert", "keys": ["k"], "latest_by": "version"}))


@query(
    "load_named_columns",
    """
    SELECT * FROM customer
    UNION ALL
    SELECT s_suppkey, s_name, NULL, s_acctbal, NULL FROM supplier
    """,
)
def load_named_columns(spark, folder):
    """Rows that name some of the target's columns, in another order."""
    named = table(spark, folder, "supplier").select(
        F.col("s_acctbal").alias("c_acctbal"), F.col("s_name").alias("c_name"), F.col("s_suppkey").alias("c_custkey")
    )
    return loaded(spark, (table(spark, folder, "customer"), {}), (named, {}))
