import json
import threading

import pytest
from pyspark.sql import functions as F

from catalogue.loads import BreaksBeforePublishing
from conftest import rows
from tablelift.operators.control import ControlTable
from tablelift.plans import copy as copying
from tablelift.plans.copy import copy_in_chunks
from tablelift.plans.run import problems
from tablelift.session import has_files, new_folder
from tablelift.sinks import find_target, load, register_target
from tablelift.sinks.targets import FileTarget
from tablelift.sinks.versions import Mark, Versions, may_hold

PLACE = find_target("parquet")


@pytest.fixture
def config(spark):
    return {"path": new_folder(spark, "t"), "keys": ["k"]}


def pairs(spark, first, last, value=0):
    return spark.range(first, last).select(F.col("id").alias("k"), (F.col("id") + value).alias("v"))


def content(spark, config):
    return dict(tuple(r) for r in PLACE.read(spark, config, "t").collect())


@pytest.mark.parametrize("mode, settings", [("insert", {}), ("insert", {"truncate_before_load": True}), ("replace", {}), ("upsert", {})])
def test_broken_before_publishing_and_done_again(spark, config, mode, settings):
    """Never a row twice, never an empty table, no files left that nobody knows."""
    register_target("breaks", BreaksBeforePublishing("parquet"))
    load(pairs(spark, 0, 20).repartition(3), "parquet", "t", config)
    changes = pairs(spark, 20 if mode == "insert" and not settings else 10, 30, 100)
    files = set(PLACE.read(spark, config, "t").inputFiles())
    with pytest.raises(RuntimeError, match="broken off"):
        load(changes, "breaks", "t", config | settings, mode)
    assert content(spark, config) == {k: k for k in range(20)}
    versions = PLACE.versions(spark, config, "t")
    folders = set(versions.files.names("_data"))
    assert folders == {f.split("/")[-2] for f in files}
    assert load(changes, "parquet", "t", config | settings, mode) == changes.count()
    kept = {} if mode == "replace" or settings else {k: k for k in range(20)}
    assert content(spark, config) == kept | {r.k: r.v for r in changes.collect()}
    assert PLACE.read(spark, config, "t").count() == len(content(spark, config))


def test_broken_creation_leaves_no_table(spark, config):
    with pytest.raises(RuntimeError):
        BreaksBeforePublishing("parquet").create(pairs(spark, 0, 3), config, "t")
    assert not PLACE.exists(spark, config, "t")
    PLACE.create(pairs(spark, 0, 3), config, "t")
    assert len(content(spark, config)) == 3


def test_writers_side_by_side(spark, config):
    """Appends and an upsert of many threads: all arrive, none is lost to another."""
    PLACE.create(pairs(spark, 0, 100), config, "t")
    work = [lambda k=k: load(pairs(spark, 1000 + 10 * k, 1010 + 10 * k), "parquet", "t", config) for k in range(8)]
    work.append(lambda: load(pairs(spark, 50, 60, 7), "parquet", "t", config, "upsert"))
    failed = []

    def run(step):
        try:
            step()
        except Exception as error:
            failed.append(error)

    threads = [threading.Thread(target=run, args=[w]) for w in work]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    assert content(spark, config) == {k: k for k in [*range(100), *range(1000, 1080)]} | {k: k + 7 for k in range(50, 60)}
    assert PLACE.read(spark, config, "t").count() == 180


def test_a_reader_keeps_its_version(spark, config):
    load(pairs(spark, 0, 10), "parquet", "t", config)
    before = PLACE.read(spark, config, "t")
    load(pairs(spark, 5, 15, 100), "parquet", "t", config, "upsert")
    load(pairs(spark, 0, 1), "parquet", "t", config | {"truncate_before_load": True})
    assert rows(before) == [(k, k) for k in range(10)]
    assert content(spark, config) == {0: 0}


def test_only_files_that_may_hold_a_changed_key_are_opened(spark, config, monkeypatch):
    load(pairs(spark, 0, 1000).repartitionByRange(10, "k"), "parquet", "t", config)
    load(pairs(spark, 1, 2, 5), "parquet", "t", config, "upsert")  # looks at all files and notes their keys
    opened = []
    real = Versions.read
    monkeypatch.setattr(Versions, "read", lambda self, version, paths=None: opened.append(paths) or real(self, version, paths))
    load(pairs(spark, 555, 556, 5), "parquet", "t", config, "upsert")
    looked, merged = [p for p in opened if p is not None]
    last = PLACE.versions(spark, config, "t").current().parts[-2].at
    # One old file holds the key; those of the last upsert have not been looked at.
    assert len([p for p in looked if last not in p]) == 1 and len(merged) == 1
    monkeypatch.undo()
    assert content(spark, config) == {k: k for k in range(1000)} | {1: 6, 555: 560}


def test_bounds():
    ranges = [(1, 5), (10, 10), (20, 30)]
    inside = [([0, 1], True), ([5, 9], True), ([6, 9], False), ([10, 10], True), ([11, 19], False), ([31, 40], False), ([None, None], True)]
    for bounds, expected in inside + [([25, None], True), ([31, None], False), ([None, 0], False), ([], False)]:
        assert may_hold(bounds, ranges) is expected, bounds
    assert may_hold([1, 2], None) and not may_hold([1, 2], [])


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "double", "decimal(9,2)", "timestamp_ntz"])
def test_keys_of_other_types(spark, kind):
    config = {"path": new_folder(spark, "t"), "keys": ["k", "n"]}
    spell = {"date": "date_add(date'2020-01-01', cast(id as int))", "string": "concat(repeat('long key ', 9), id)"}
    spell |= {"timestamp": "timestamp_seconds(id * 1000)", "timestamp_ntz": "cast(timestamp_seconds(id * 1000) as timestamp_ntz)"}

    def table(first, last, value):
        key = spell.get(kind, f"cast(id as {kind})")
        return spark.range(first, last).selectExpr(f"IF(id % 17 = 0, null, {key}) AS k", "id % 2 AS n", f"id + {value} AS v")

    load(table(0, 50, 0).repartitionByRange(4, "v"), "parquet", "t", config | {"types": "typed"})
    for value in (100, 200):  # the second one meets bounds
        load(table(40, 60, value), "parquet", "t", config, "upsert")
    found = [r.v for r in PLACE.read(spark, config, "t").collect()]
    nulls = [0, 17, 34, 51 + 100, 51 + 200]  # equal to no other key
    assert sorted(found) == sorted([k for k in range(40) if k % 17] + [k + 200 for k in range(40, 60) if k % 17] + nulls)


def test_plain_files_are_taken_over(spark, config):
    folder = f"{config['path']}/t"
    pairs(spark, 0, 10).repartitionByRange(2, "k").write.parquet(folder)
    assert PLACE.exists(spark, config, "t") and len(content(spark, config)) == 10
    load(pairs(spark, 10, 12), "parquet", "t", config)
    load(pairs(spark, 0, 1, 5), "parquet", "t", config, "upsert")
    assert content(spark, config) == {k: k for k in range(1, 12)} | {0: 5}
    load(pairs(spark, 0, 2), "parquet", "t", config, "replace")
    assert content(spark, config) == {0: 0, 1: 1}


def test_many_versions(spark, config):
    """Parts move to lists, and the newest version is found without listing all; cleaning leaves what is needed."""
    PLACE.create(pairs(spark, 0, 1).coalesce(1), config, "t")
    versions = PLACE.versions(spark, config, "t")
    part = versions.current().parts[0]
    for k in range(1, 150):
        versions.commit(lambda known, k=k: known.with_part(part if k == 149 else versions.current().parts[0], Mark("m", "r", str(k % 3))))
    version = versions.current()
    assert len(version.parts) == 150 and len(version.lists) == 2 and len(version.marks) == 3
    tail = json.loads(versions.files.text(versions._name(version.number)))["parts"]
    assert len(tail) <= 64
    versions.files.put("_versions/_last", "garbled")
    assert versions.current().number == version.number
    versions.commit(lambda known: known.with_part(part, Mark("m", "next run")))
    assert [m.run for m in versions.current().marks] == ["next run"]
    versions.commit(lambda known: known.with_parts([part]))
    assert PLACE.clean(spark, config, "t") == 0 and len(versions._names("_versions")) == 1
    assert content(spark, config) == {0: 0}


def test_cleaning_removes_what_only_old_versions_hold(spark, config):
    load(pairs(spark, 0, 100).repartitionByRange(4, "k"), "parquet", "t", config)
    load(pairs(spark, 0, 1, 5), "parquet", "t", config, "upsert")
    load(pairs(spark, 1, 2, 5), "parquet", "t", config, "upsert")
    assert PLACE.clean(spark, config, "t", keep=3) == 0
    before = content(spark, config)
    assert PLACE.clean(spark, config, "t") == 2
    assert content(spark, config) == before
    load(pairs(spark, 0, 2), "parquet", "t", config, "replace")
    PLACE.clean(spark, config, "t")
    assert has_files(spark, f"{config['path']}/t/_data") and content(spark, config) == {0: 0, 1: 1}


def test_what_a_lost_load_has_left(spark, config):
    load(pairs(spark, 0, 10), "parquet", "t", config)
    versions = PLACE.versions(spark, config, "t")
    lost = versions.write(pairs(spark, 10, 20).coalesce(1), {})
    assert PLACE.clean(spark, config, "t") == PLACE.clean(spark, config, "t", unnamed_after_hours=1) == 0
    assert versions.names(lost)
    assert PLACE.clean(spark, config, "t", unnamed_after_hours=0) == 1
    assert not versions.names(lost) and content(spark, config) == {k: k for k in range(10)}


class Breaks(FileTarget):
    """Breaks at the given append, before its files or after its version."""

    def __init__(self, at, after):
        super().__init__("parquet")
        self.at, self.after, self.calls = at, after, 0

    def append(self, df, config, table, **more):
        self.calls += 1
        if self.calls < self.at or self.after:
            super().append(df, config, table, **more)
        if self.calls == self.at:
            raise RuntimeError("broken off")


@pytest.mark.parametrize("at, after", [(2, False), (3, True), (1, True)])
def test_resume_by_marks_reads_no_rows_of_the_target(spark, read, monkeypatch, at, after):
    place = new_folder(spark, "copy")
    control = ControlTable(spark, f"{place}/control")
    copy = dict(name="o", table="t", key=["k"], size=100, control=control, config={"path": place}, waves=5)
    source = read("orders").select(F.when(F.col("o_orderkey") > 3, F.col("o_orderkey")).alias("k"), F.col("o_totalprice").alias("v"))
    source = source.filter("k is not null").unionByName(source.filter("k is null").limit(1))
    register_target("breaks", Breaks(at, after))
    with pytest.raises(RuntimeError):
        copy_in_chunks(source, target="breaks", **copy)
    if at > 1 or after:
        monkeypatch.setattr(copying, "_rows_per_wave", None)
    done = copy_in_chunks(source, **copy)
    assert done.resumed and done.chunks_done_before == 3 * (at - 1)
    assert rows(PLACE.read(spark, {"path": place}, "t")) == rows(source)
    assert rows(control.current().select("status").distinct()) == [("OK",)]


def test_a_changed_source_is_refused_before_its_rows_count(spark, monkeypatch):
    place = new_folder(spark, "copy")
    copy = dict(table="t", key=["k"], size=10, control=ControlTable(spark, f"{place}/c"), config={"path": place})
    real = copying.ChunkLimits.rows_in
    monkeypatch.setattr(copying.ChunkLimits, "rows_in", lambda self, chunk: real(self, chunk) + 1)
    with pytest.raises(RuntimeError, match="the source has changed"):
        copy_in_chunks(pairs(spark, 0, 30), "o", **copy)
    assert content(spark, {"path": place}) == {}


def test_a_truncated_target_is_copied_again(spark, read):
    """Marks go with the rows they stand for."""
    place = new_folder(spark, "copy")
    control, config = ControlTable(spark, f"{place}/control"), {"path": place}
    copy = dict(name="o", table="t", key=["o_orderkey"], size=100, control=control, config=config, waves=5)
    register_target("breaks", Breaks(3, False))
    with pytest.raises(RuntimeError):
        copy_in_chunks(read("orders"), target="breaks", **copy)
    PLACE.refill(read("orders").limit(0), config, "t")
    copy_in_chunks(read("orders"), **copy)
    assert rows(PLACE.read(spark, config, "t")) == rows(read("orders"))


def test_problems_of_keys(spark, small):
    def found(mode="batch", load_mode="insert", **config):
        whole = {
            "mode": mode, "extractions": [{"name": "c", "source": "parquet", "config": {"path": f"{small}/customer.parquet"}}],
            "loads": [{"name": "l", "source": "c", "target": "parquet", "table": "t", "mode": load_mode, "config": config}],
        }
        return rows(problems(spark, whole))

    assert found() == found("chunked", chunk_key="C CUSTKEY".replace(" ", "_")) == []
    assert found("chunked") == [("l", "the load's config needs 'chunk_key'")]
    assert found("stream", key="c_custkey") == [("l", "the load's config needs 'checkpoint'")]
    assert found(load_mode="upsert") == [("l", "the load's config needs 'keys'")]
    assert found(load_mode="upsert", keys=["c_custkey", "X Y"], latest_by="when") == [
        ("l", "keys: no column x_y"), ("l", "latest_by: no column when"),
    ]
    assert found(load_mode="upsert", keys=["id"], column_mapping={"c_custkey": "id"}) == []
    assert found(column_mapping={"c_custkey": "c_name"})[0][1].startswith("several columns")
    missing = {"extractions": [{"name": "c", "source": "parquet", "config": {"path": "/nowhere/at/all"}}], "loads": [{"name": "l", "source": "c", "target": "parquet"}]}
    assert rows(problems(spark, missing))[0][1].startswith("the source cannot be read")
