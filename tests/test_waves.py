"""Small waves of a chunked copy that are written together."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tablelift.operators.control import ControlTable
from tablelift.plans import copy as copying
from tablelift.plans.copy import copy_in_chunks
from tablelift.session import new_folder
from tablelift.sinks import find_target, load, register_target, takes_waves
from tablelift.sinks.targets import CatalogTarget, FileTarget
from tablelift.sinks.versions import Versions

PLACE = find_target("parquet")


def pairs(spark, first, last):
    return spark.range(first, last).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))


@pytest.fixture
def copy(spark):
    place = new_folder(spark, "waves")
    return dict(
        name="o", table="t", key=["k"], size=5, commit_rows=10, control=ControlTable(spark, f"{place}/control"), config={"path": place}
    )


@pytest.fixture
def writes(monkeypatch):
    """The writes of file targets that fill waves, and those of catalog tables."""
    calls = []

    def watch(kind, name):
        real = getattr(kind, name)
        monkeypatch.setattr(kind, name, lambda *a, **more: calls.append(name) or real(*a, **more))

    watch(Versions, "write")
    watch(Versions, "write_each")
    watch(CatalogTarget, "append")
    return calls


def states(control):
    return sorted(rows(control.current().select("chunk_number", "rows_loaded", "status")))


def test_one_write_and_a_version_for_each_wave(spark, copy, writes):
    done = copy_in_chunks(pairs(spark, 0, 47).repartition(3), **copy)
    assert (done.rows, done.chunks) == (47, 10)
    assert writes == ["write", "write_each"]  # the empty table, and all five waves
    version = PLACE.versions(spark, copy["config"], "t").current()
    assert version.number == 6 and len(version.marks) == 5
    for wave, part in enumerate(version.parts[1:]):
        held = PLACE.versions(spark, copy["config"], "t").read(version, [f"{copy['config']['path']}/t/{part.at}"])
        assert rows(held) == [(k, 2 * k) for k in range(10 * wave, min(10 * wave + 10, 47))]
    assert rows(PLACE.read(spark, copy["config"], "t")) == rows(pairs(spark, 0, 47))
    assert states(copy["control"]) == [(k, 5 if k < 10 else 2, "OK") for k in range(1, 11)]


def test_groups_are_bounded(spark, copy, writes, monkeypatch):
    monkeypatch.setattr(copying, "GROUP_ROWS", 25)
    copy_in_chunks(pairs(spark, 0, 47), **copy)
    assert writes == ["write", "write_each", "write_each", "write"]  # two waves, two, and one as it is
    monkeypatch.setattr(copying, "GROUP_ROWS", 1000)
    monkeypatch.setattr(copying, "GROUP_WAVES", 3)
    writes.clear()
    copy_in_chunks(pairs(spark, 0, 47), **copy | {"name": "p", "table": "u"}, staged=True)
    assert writes == ["write", "write_each", "write_each"]
    assert rows(PLACE.read(spark, copy["config"], "u")) == rows(PLACE.read(spark, copy["config"], "t")) == rows(pairs(spark, 0, 47))


def test_broken_off_between_the_waves_of_a_write(spark, copy, monkeypatch):
    real, calls = Versions.commit, []

    def breaking(self, *given):
        calls.append(1)
        if len(calls) == 4:  # the empty table and two waves are there
            raise RuntimeError("broken off")
        return real(self, *given)

    monkeypatch.setattr(Versions, "commit", breaking)
    with pytest.raises(RuntimeError, match="broken off"):
        copy_in_chunks(pairs(spark, 0, 47), **copy)
    assert rows(PLACE.read(spark, copy["config"], "t")) == rows(pairs(spark, 0, 20))
    assert states(copy["control"]) == [(k, 5, "OK") for k in range(1, 5)] + [(k, 0, "ERROR") for k in range(5, 11)]
    files = PLACE.versions(spark, copy["config"], "t").files
    left = [n for at in files.names("_data") for n in files.names(f"_data/{at}") if n.startswith("part_")]
    assert len(left) == 2
    monkeypatch.setattr(copying, "_rows_per_wave", None)
    done = copy_in_chunks(pairs(spark, 0, 47), **copy)
    assert done.resumed and done.chunks_done_before == 4
    assert rows(PLACE.read(spark, copy["config"], "t")) == rows(pairs(spark, 0, 47))


def test_a_wave_with_other_rows_is_refused_with_its_whole_write(spark, copy, monkeypatch):
    plan = copying._plan_waves
    # After the plan was made a row of the second wave has become one of the third.
    source = pairs(spark, 0, 30)
    changed = source.withColumn("k", F.when(F.col("k") == 15, 25.5).otherwise(F.col("k").cast("double")))
    monkeypatch.setattr(copying, "_plan_waves", lambda df, *a: plan(source.withColumn("k", F.col("k").cast("double")), *a))
    with pytest.raises(RuntimeError, match="wave 2 gave 9 rows instead of 10: the source has changed"):
        copy_in_chunks(changed, **copy)
    assert PLACE.read(spark, copy["config"], "t").isEmpty()
    assert {s for *_, s in states(copy["control"])} == {"ERROR"}


def test_a_catalog_table_gets_them_in_one_write(spark, copy, writes):
    table = f"waves_{uuid.uuid4().hex}"
    copy_in_chunks(pairs(spark, 0, 47), target="table", **copy | {"table": table})
    assert writes == ["append"]
    assert rows(spark.table(table)) == rows(pairs(spark, 0, 47))
    assert states(copy["control"]) == [(k, 5 if k < 10 else 2, "OK") for k in range(1, 11)]


def test_a_catalog_table_with_some_rows_of_a_broken_write(spark, copy, monkeypatch):
    """Each wave is in question for itself: one is whole, one lacks rows, the others are not there."""
    table = f"waves_{uuid.uuid4().hex}"

    def breaking(self, df, config, name, *more):
        df.where("k >= 10 and k < 24").select("k", "v").write.insertInto(name)
        raise RuntimeError("broken off")

    with monkeypatch.context() as broken:
        broken.setattr(CatalogTarget, "append", breaking)
        with pytest.raises(RuntimeError, match="broken off"):
            copy_in_chunks(pairs(spark, 0, 57), target="table", **copy | {"table": table})
    assert {s for *_, s in states(copy["control"])} == {"ERROR"}
    assert copy_in_chunks(pairs(spark, 0, 57), target="table", **copy | {"table": table}).resumed
    assert rows(spark.table(table)) == rows(pairs(spark, 0, 57))
    assert {s for *_, s in states(copy["control"])} == {"OK"}


def test_a_subclass_with_an_append_of_its_own_gets_wave_by_wave(spark, copy):
    class Counts(FileTarget):
        calls = 0

        def append(self, df, config, table, **more):
            self.calls += 1
            return super().append(df, config, table, **more)

    counting = Counts("parquet")
    register_target("counts", counting)
    assert takes_waves(PLACE) and takes_waves(find_target("table")) and not takes_waves(counting) and not takes_waves(find_target("jdbc"))
    copy_in_chunks(pairs(spark, 0, 47), target="counts", **copy)
    assert counting.calls == 5


def test_upserts_and_cleaning_after_it(spark, copy):
    copy_in_chunks(pairs(spark, 0, 47), **copy)
    changes = spark.createDataFrame([(12, -1), (46, -2), (99, -3)], "k long, v long")
    load(changes, "parquet", "t", {**copy["config"], "keys": "k"}, "upsert")
    expected = {k: 2 * k for k in range(47)} | {12: -1, 46: -2, 99: -3}
    assert dict(rows(PLACE.read(spark, copy["config"], "t"))) == expected
    version = PLACE.versions(spark, copy["config"], "t").current()
    assert sum(bool(part.without) for part in version.parts) <= 2  # the other waves' files stay
    assert PLACE.clean(spark, copy["config"], "t", unnamed_after_hours=0) >= 2
    assert dict(rows(PLACE.read(spark, copy["config"], "t"))) == expected


def test_marks_move_to_lists(spark, copy):
    copy_in_chunks(pairs(spark, 0, 700), **copy)
    versions = PLACE.versions(spark, copy["config"], "t")
    version = versions.current()
    assert len(version.marks) == 70 and len(version.parts) == 71
    assert len(json.loads(versions.files.text(versions._name(version.number)))["marks"]) <= 64
    copy_in_chunks(pairs(spark, 700, 800), **copy)
    version = versions.current()
    assert len(version.marks) == 10 and len({m.run for m in version.marks}) == 1
    assert PLACE.read(spark, copy["config"], "t").count() == 800
