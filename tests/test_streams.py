import pytest
from pyspark.sql import functions as F

from conftest import rows
from tablelift.operators.control import ControlTable
from tablelift.session import new_folder
from tablelift.sinks import find_target, register_target
from tablelift.sinks.targets import FileTarget
from tablelift.streaming import copied_rows, stream_chunks, stream_copy, stream_load


@pytest.fixture
def events(spark, read):
    place = new_folder(spark, "events")
    read("events").repartitionByRange(5, "event_id").write.parquet(f"{place}/in")
    return place


def paths(place, schema):
    return f"{place}/in", schema, f"{place}/out", f"{place}/checkpoint"


def test_each_file_is_a_batch(spark, read, events):
    control = ControlTable(spark, f"{events}/control")
    done = stream_copy(spark, *paths(events, read("events").schema), files_per_batch=1, control=control, name="e")
    assert done == 5
    assert rows(copied_rows(spark, f"{events}/out")) == rows(read("events"))
    states = control.current().collect()
    assert sorted(r.chunk_number for r in states) == [1, 2, 3, 4, 5]
    assert sum(r.rows_loaded for r in states) == read("events").count()


@pytest.mark.parametrize("at", [0, 2])
def test_broken_off_and_resumed(spark, read, events, at):
    schema = read("events").schema

    def break_off(batch):
        if batch == at:
            raise RuntimeError("broken off")

    with pytest.raises(Exception, match="broken off"):
        stream_copy(spark, *paths(events, schema), files_per_batch=1, before_write=break_off)
    for _ in range(2):
        stream_copy(spark, *paths(events, schema), files_per_batch=1)
    assert rows(copied_rows(spark, f"{events}/out")) == rows(read("events"))


def test_broken_between_write_and_commit(spark, read, events):
    """The state is saved after the rows: a failure there repeats the batch, not its rows."""
    schema = read("events").schema

    def fail(batch):
        raise RuntimeError("no state")

    control = ControlTable(spark, f"{events}/control")
    with pytest.raises(Exception, match="no state"):
        stream_copy(spark, *paths(events, schema), files_per_batch=1, control=control, chunk=fail)
    stream_copy(spark, *paths(events, schema), files_per_batch=1, control=control)
    assert rows(copied_rows(spark, f"{events}/out")) == rows(read("events"))


def test_new_files_only(spark, read, events):
    schema = read("events").schema
    stream_copy(spark, *paths(events, schema), files_per_batch=1)
    read("events").limit(10).write.mode("append").parquet(f"{events}/in")
    stream_copy(spark, *paths(events, schema), files_per_batch=1, config={"column_mapping": {}})
    assert copied_rows(spark, f"{events}/out").count() == read("events").count() + 10


class BreaksHalfway(FileTarget):
    """Writes half of the rows of the given batch and fails."""

    def __init__(self, at, step):
        super().__init__("parquet")
        self.at, self.step, self.calls = at, step, 0

    def _put(self, df, config, table, put):
        self.calls += 1
        if self.calls != self.at:
            return put(df, config, table)
        if self.step == "half":
            put(df.filter("event_id % 2 = 0"), config, table)
        elif self.step == "after":
            put(df, config, table)
        raise RuntimeError("broken off")

    def create(self, df, config, table):
        self._put(df, config, table, super().create)

    def append(self, df, config, table):
        self._put(df, config, table, super().append)


@pytest.mark.parametrize("at, step", [(1, "half"), (2, "half"), (2, "after")])
def test_stream_into_a_table(spark, read, events, at, step):
    control, config = ControlTable(spark, f"{events}/control"), {"path": f"{events}/out"}
    register_target("halfway", BreaksHalfway(at, step))

    def run(target):
        stream_load(
            spark, f"{events}/in", read("events").schema, target, "e", f"{events}/checkpoint", control, ["event_id"],
            config, files_per_batch=2,
        )

    with pytest.raises(Exception, match="broken off"):
        run("halfway")
    assert control.last_chunk("stream") == at - 1
    run("parquet")
    assert rows(find_target("parquet").read(spark, config, "e")) == rows(read("events"))
    states = control.current().collect()
    assert {r.status for r in states} == {"OK"} and sum(r.rows_loaded for r in states) == read("events").count()


def test_two_streams_fill_one_target(spark, read, events):
    schema = read("events").schema
    stream_copy(spark, *paths(events, schema))
    stream_copy(spark, f"{events}/in", schema, f"{events}/out", f"{events}/other_checkpoint")
    assert copied_rows(spark, f"{events}/out").count() == 2 * read("events").count()


def test_chunks_over_several_batches(spark, read, events):
    schema, control = read("events").schema, ControlTable(spark, f"{events}/control")

    def chunk(batch):
        return batch.withColumn("chunk_number", F.col("event_id") % 3 + 1)

    stream_copy(spark, *paths(events, schema), files_per_batch=1, control=control, name="e", chunk=chunk)
    found = {r.chunk_number: r.rows_loaded for r in stream_chunks(control, "e").collect()}
    assert found == {r.chunk_number: r["count"] for r in chunk(read("events")).groupBy("chunk_number").count().collect()}
