import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from tablelift.operators.upsert import one_per_key, upsert
from tablelift.session import new_folder
from tablelift.sinks import (
    counted_write,
    find_target,
    fit_to,
    load,
    register_target,
    supported_targets,
)
from tablelift.sinks.targets import FileTarget, JdbcTarget


@pytest.fixture(params=["parquet", "orc", "table", "view"])
def target(request, spark):
    """A kind of target, its config, an unused table name, and how to read it back."""
    config = {"path": new_folder(spark, "t")}
    name = f"copied_{request.param}_{abs(hash(config['path']))}"
    if request.param == "table":
        config = {"options": {"path": f"{config['path']}/{name}"}}
    return request.param, config, name, lambda: find_target(request.param).read(spark, config, name)


def test_create_append_truncate_replace(spark, target):
    kind, config, name, back = target
    first = spark.createDataFrame([(1, "a"), (2, "b")], "` ID ` int, `Año` string")
    assert load(first, kind, name, config) == 2
    assert back().columns == ["id", "ano"]
    turned = spark.createDataFrame([("c", 3)], "ano string, id int")
    assert load(turned, kind, name, config) == 1
    assert rows(back()) == [(1, "a"), (2, "b"), (3, "c")]
    assert load(turned, kind, name, config | {"truncate_before_load": "true"}) == 1
    assert rows(back()) == [(3, "c")]
    other = spark.createDataFrame([(1.5,)], "x double")
    assert load(other, kind, name, config, mode="replace") == 1
    assert rows(back()) == [(1.5,)]


def test_empty_input(spark, target):
    kind, config, name, back = target
    some, none = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([], "k int")
    load(some, kind, name, config)
    emptying = config | {"truncate_before_load": True}
    assert load(none, kind, name, emptying) == 0
    assert rows(back()) == [(1,)]
    assert load(none, kind, name, config) == 0
    assert load(none, kind, name, emptying | {"allow_empty": True}) == 0
    assert rows(back()) == []


def test_upsert_into_target(spark, target):
    kind, config, name, back = target
    load(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), kind, name, config)
    changes = spark.createDataFrame([(2, "B"), (3, "C")], "K int, V string")
    assert load(changes, kind, name, config | {"keys": ["K"]}, mode="upsert") == 2
    assert rows(back()) == [(1, "a"), (2, "B"), (3, "C")]


def test_truncate_keeps_the_table_definition(spark):
    config = {"path": new_folder(spark, "t")}
    load(spark.createDataFrame([(1, 2)], "k long, v int"), "parquet", "t", config)
    load(spark.createDataFrame([(3, 4)], "v int, k int"), "parquet", "t", config | {"truncate_before_load": 1})
    back = find_target("parquet").read(spark, config, "t")
    assert back.dtypes == [("k", "bigint"), ("v", "int")]
    assert rows(back) == [(4, 3)]


def test_false_as_text_does_not_truncate(spark):
    config = {"path": new_folder(spark, "t"), "truncate_before_load": "false"}
    for _ in range(2):
        load(spark.createDataFrame([(1,)], "k int"), "parquet", "t", config)
    assert find_target("parquet").read(spark, config, "t").count() == 2


def test_columns_must_fit(spark):
    config = {"path": new_folder(spark, "t")}
    load(spark.createDataFrame([(1, 2)], "k int, v int"), "parquet", "t", config)
    with pytest.raises(ValueError, match=r"missing \['v'\], unknown \['w'\]"):
        load(spark.createDataFrame([(1, 2)], "k int, w int"), "parquet", "t", config)


def test_a_value_that_does_not_fit_is_an_error(spark):
    frame, existing = spark.createDataFrame([("x",)], "k string"), spark.createDataFrame([], "k int")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        fit_to(frame, existing).collect()


def test_text_policy_and_names_as_they_are(spark):
    config = {"path": new_folder(spark, "t"), "types": "text", "clean_names": "no"}
    load(spark.createDataFrame([(1, True)], "`A B` int, C boolean"), "orc", "t", config)
    back = find_target("orc").read(spark, config, "t")
    assert back.dtypes == [("A B", "string"), ("C", "string")]
    assert rows(back) == [("1", "true")]


def test_mapping_before_write(spark, read):
    config = {"path": new_folder(spark, "t"), "column_mapping": {"C_NAME": "Nombre Completo"}}
    assert load(read("customer"), "parquet", "t", config) == 150
    assert find_target("parquet").read(spark, config, "t").columns[1] == "nombre_completo"


@pytest.mark.parametrize("problem", [{"mode": "merge"}, {"target": "excel"}, {"config": {"types": "fancy"}}])
def test_bad_settings(spark, problem):
    settings = {"target": "parquet", "table": "t", "config": {"path": new_folder(spark, "t")}} | problem
    with pytest.raises(ValueError):
        load(spark.range(1), **settings)


def test_unknown_target_names_the_valid_ones():
    with pytest.raises(ValueError, match="parquet"):
        find_target("excel")


def test_register_target(spark):
    register_target("OrC2", FileTarget("orc"))
    assert "orc2" in supported_targets()
    config = {"path": new_folder(spark, "t")}
    assert load(spark.range(3), "ORC2", "t", config) == 3


def test_upsert_wants_keys(spark):
    config = {"path": new_folder(spark, "t")}
    load(spark.range(2), "parquet", "t", config)
    with pytest.raises(ValueError, match="keys"):
        load(spark.range(2), "parquet", "t", config, mode="upsert")


def test_upsert_into_a_missing_table(spark):
    config = {"path": new_folder(spark, "t"), "keys": ["k"]}
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match="several new rows"):
        load(twice, "parquet", "t", config, mode="upsert")
    config = {"path": new_folder(spark, "t"), "keys": ["k"], "latest_by": "v"}
    assert load(twice, "parquet", "t", config, mode="upsert") == 2
    assert rows(find_target("parquet").read(spark, config, "t")) == [(1, "b")]
    assert load(twice.limit(0), "parquet", "t", config, mode="upsert") == 0
    assert rows(find_target("parquet").read(spark, config, "t")) == [(1, "b")]


def test_upsert_against_brute_force(spark):
    old = [(i % 50, i // 50, f"o{i}") for i in range(100)]
    new = [(i % 30 + 30, i // 30, f"n{i}") for i in range(60)]
    merged = {r[:2]: r for r in old} | {r[:2]: r for r in new}
    schema = "a int, b int, v string"
    got = upsert(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema), ["a", "b"])
    assert rows(got) == sorted(merged.values(), key=repr)


def test_null_keys_stay(spark):
    schema = "k int, v string"
    old, new = spark.createDataFrame([(None, "a")], schema), spark.createDataFrame([(None, "b")], schema)
    assert rows(upsert(old, new, ["k"])) == [(None, "a"), (None, "b")]


def test_several_new_rows_of_a_key(spark):
    new = spark.createDataFrame([(1, 10, "x"), (1, 20, "y"), (2, 5, "z")], "k int, at int, v string")
    with pytest.raises(Exception, match="several new rows"):
        one_per_key(new, ["k"]).collect()
    assert rows(one_per_key(new, ["k"], latest_by="at")) == [(1, 20, "y"), (2, 5, "z")]


def test_counted_write_of_a_proven_empty_frame(spark):
    nothing = spark.range(10).filter(F.lit(False))
    assert counted_write(nothing, lambda df: df.write.format("noop").mode("overwrite").save()) == 0


def test_equal_and_missing_latest_by(spark):
    schema = "k int, at int, v string"
    new = spark.createDataFrame([(1, None, "a"), (1, None, "b"), (2, None, "z"), (2, 1, "c"), (3, 4, "x"), (3, 4, "y")], schema)
    for order in (new, new.orderBy(F.desc("v"))):
        assert rows(one_per_key(order, ["k"], latest_by="at")) == [(1, None, "b"), (2, 1, "c"), (3, 4, "y")]


def test_upsert_leaves_other_files_alone(spark):
    config = {"path": new_folder(spark, "t"), "keys": ["k"]}
    place = find_target("parquet")
    spark.range(1000).selectExpr("id AS k", "id AS v").repartitionByRange(5, "k").write.parquet(f"{config['path']}/t")
    before = set(place.read(spark, config, "t").inputFiles())
    changes = spark.createDataFrame([(10, -1), (11, -2), (5000, -3)], "k bigint, v bigint")
    assert load(changes, "parquet", "t", config, mode="upsert") == 3
    after = place.read(spark, config, "t")
    assert len(before & set(after.inputFiles())) == 4
    expected = {k: k for k in range(1000)} | {10: -1, 11: -2, 5000: -3}
    assert rows(after) == sorted(expected.items(), key=repr)


def test_named_columns(spark):
    config = {"path": new_folder(spark, "t")}
    load(spark.createDataFrame([(1, 2, "x")], "k int, v int, w string"), "parquet", "t", config)
    assert load(spark.createDataFrame([("y", 5)], "w string, k int"), "parquet", "t", config) == 1
    assert rows(find_target("parquet").read(spark, config, "t")) == [(1, 2, "x"), (5, None, "y")]
    frame, existing = spark.range(1), spark.createDataFrame([], T.StructType([T.StructField("id", T.LongType()), T.StructField("must", T.LongType(), False)]))
    with pytest.raises(ValueError, match=r"missing \['must'\]"):
        fit_to(frame, existing)
    assert fit_to(frame, existing, cast=False).columns == ["id"]


@pytest.mark.parametrize("kind", ["parquet", "table", "view"])
def test_create_never_overwrites(spark, kind):
    place, config, name = find_target(kind), {"path": new_folder(spark, "t")}, f"made_{uuid.uuid4().hex}"
    place.create(spark.range(3), config, name)
    with pytest.raises(Exception):
        place.create(spark.range(5), config, name)
    assert place.read(spark, config, name).count() == 3
    place.append(spark.range(2), config, name)
    assert place.read(spark, config, name).count() == 5
    place.replace(spark.range(1), config, name)
    assert place.read(spark, config, name).count() == 1


def test_appending_to_a_view_adds_files_only(spark):
    place, name = find_target("view"), f"made_{uuid.uuid4().hex}"
    place.create(spark.range(3), {}, name)
    before = set(place.read(spark, {}, name).inputFiles())
    place.append(spark.range(3), {}, name)
    assert before < set(place.read(spark, {}, name).inputFiles())


class DriverError(Exception):
    """Stands for a database driver's error with an SQL state."""

    def __init__(self, state, number=0, cause=None):
        self.state, self.number, self.cause = state, number, cause

    def getSQLState(self):
        return self.state

    def getErrorCode(self):
        return self.number

    def getCause(self):
        return self.cause


@pytest.mark.parametrize(
    "error, missing",
    [
        (DriverError("42P01"), True),
        (DriverError("42000", 942), True),
        (DriverError(None, 0, DriverError("42P01")), True),
        (DriverError("08001"), False),
        (DriverError("42501"), False),
        (RuntimeError("connection lost"), False),
    ],
)
def test_only_a_missing_table_counts_as_absent(spark, monkeypatch, error, missing):
    place = JdbcTarget("postgresql")

    def read(*_):
        raise error

    monkeypatch.setattr(place, "read", read)
    if missing:
        assert place.exists(spark, {}, "t") is False
    else:
        with pytest.raises(type(error)):
            place.exists(spark, {}, "t")
