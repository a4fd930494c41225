import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tablelift.session import new_folder
from tablelift.sinks import find_target, load, register_target
from tablelift.sources import read_source, register_source, supported_sources
from tablelift.streaming import stream_into


def paged_source():
    """A source of pages: numbers from 0, a partition for each page, which reads only pages that the filters leave."""
    import pyarrow as pa
    from pyspark.sql.datasource import DataSource, DataSourceReader, GreaterThanOrEqual, InputPartition

    class Page(InputPartition):
        def __init__(self, first, last):
            super().__init__(None)
            self.first, self.last = first, last

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.total, self.size, self.least, self.seen = int(options["total"]), int(options["page"]), 0, options.get("seen")

        def pushFilters(self, filters):
            for f in filters:
                if isinstance(f, GreaterThanOrEqual) and f.attribute == ("id",):
                    self.least = max(self.least, f.value)
                else:
                    yield f

        def partitions(self):
            first = self.least // self.size * self.size
            return [Page(max(k, self.least), min(k + self.size, self.total)) for k in range(first, self.total, self.size)]

        def read(self, page):
            if self.seen:
                open(f"{self.seen}/{page.first}", "w").close()
            numbers = list(range(page.first, page.last))
            yield pa.RecordBatch.from_pydict({"id": pa.array(numbers, pa.int64()), "name": [f"n{k}" for k in numbers]})

    class Paged(DataSource):
        @classmethod
        def name(cls):
            return "paged_numbers"

        def schema(self):
            return "id bigint, name string"

        def reader(self, schema):
            return Reader(self.options)

    return Paged


def file_sink():
    """A sink of JSON files: a task writes a file of its own, a commit names the files of a batch."""
    import glob
    import uuid

    from pyspark import TaskContext
    from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage

    class Wrote(WriterCommitMessage):
        def __init__(self, name):
            self.name = name

    def write_rows(folder, iterator):
        name = f"{folder}/{uuid.uuid4().hex}.rows"
        with open(name, "w") as out:
            for row in iterator:
                out.write(json.dumps(row.asDict()) + "\n")
        return Wrote(name)

    def publish(folder, label, messages):
        with open(f"{folder}/{label}.draft", "w") as out:
            out.write("\n".join(m.name for m in messages if m))
        os.replace(f"{folder}/{label}.draft", f"{folder}/{label}.commit")

    class Batch(DataSourceWriter):
        def __init__(self, folder, overwrite):
            self.folder, self.overwrite = folder, overwrite
            os.makedirs(folder, exist_ok=True)

        def write(self, iterator):
            return write_rows(self.folder, iterator)

        def commit(self, messages):
            if self.overwrite:
                for old in glob.glob(f"{self.folder}/*.commit"):
                    os.remove(old)
            publish(self.folder, uuid.uuid4().hex, messages)

    class Stream(DataSourceStreamWriter):
        def __init__(self, options):
            self.folder, self.breaks = options["path"], options.get("breaks")
            os.makedirs(self.folder, exist_ok=True)

        def write(self, iterator):
            return write_rows(self.folder, iterator)

        def commit(self, messages, batch):
            publish(self.folder, f"batch-{batch}", messages)  # a batch that comes again takes the place of its first attempt
            if self.breaks and int(self.breaks) == batch:
                raise RuntimeError("broken off")

        def abort(self, messages, batch):
            pass

    class Reader(DataSourceReader):
        def __init__(self, folder):
            self.folder = folder

        def read(self, _):
            for commit in sorted(glob.glob(f"{self.folder}/*.commit")):
                for name in open(commit).read().split():
                    for line in open(name):
                        row = json.loads(line)
                        yield row["id"], row["name"]

    class Files(DataSource):
        @classmethod
        def name(cls):
            return "json_files"

        @staticmethod
        def exists(options):
            return bool(glob.glob(f"{options['path']}/{options['table']}/*.commit"))

        def schema(self):
            return "id bigint, name string"

        def _folder(self):
            return f"{self.options['path']}/{self.options['table']}"

        def reader(self, schema):
            return Reader(self._folder())

        def writer(self, schema, overwrite):
            return Batch(self._folder(), overwrite)

        def streamWriter(self, schema, overwrite):
            return Stream(self.options)

    return Files


@pytest.fixture
def pushdown(spark):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    yield
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_a_paged_source(spark, tmp_path, pushdown):
    register_source("Pages", paged_source())
    assert "pages" in supported_sources()
    seen = tmp_path / "seen"
    seen.mkdir()
    config = {"total": 95, "page": 10, "seen": str(seen)}
    everything = read_source(spark, "pages", config)
    assert everything.rdd.getNumPartitions() == 10 and everything.agg(F.sum("id")).first()[0] == 95 * 94 // 2
    for name in os.listdir(seen):
        os.rename(seen / name, tmp_path / f"done-{name}")
    assert rows(read_source(spark, "pages", config).filter("id >= 73").select("id")) == [(k,) for k in range(73, 95)]
    assert sorted(map(int, os.listdir(seen))) == [73, 80, 90]
    found = read_source(spark, "pages", config, "SELECT count(*) AS n FROM paged_numbers WHERE name LIKE :like", {"like": "n9%"})
    assert rows(found) == [(6,)]


def test_a_load_into_a_data_source(spark, tmp_path):
    register_target("files", file_sink())
    config, place = {"path": str(tmp_path)}, find_target("files")
    numbers = spark.range(20).withColumn("name", F.concat(F.lit("n"), "id"))
    assert not place.exists(spark, config, "t")
    assert load(numbers, "files", "t", config) == 20 and place.exists(spark, config, "t")
    assert load(numbers.filter("id < 5"), "files", "t", config) == 5
    assert place.read(spark, config, "t").count() == 25
    assert load(numbers.filter("id < 7"), "files", "t", config | {"truncate_before_load": True}) == 7
    assert rows(place.read(spark, config, "t")) == [(k, f"n{k}") for k in range(7)]
    with pytest.raises(ValueError, match="there already"):
        place.create(numbers, config, "t")


def test_a_repeated_batch_of_a_stream_counts_once(spark, tmp_path):
    place = new_folder(spark, "stream")
    numbers = spark.range(40).withColumn("name", F.concat(F.lit("n"), "id"))
    numbers.repartitionByRange(4, "id").write.parquet(f"{place}/in")
    sink, options = file_sink(), {"path": f"{tmp_path}/t"}
    stream = (spark, f"{place}/in", numbers.schema, sink)
    with pytest.raises(Exception, match="broken off"):
        stream_into(*stream, options | {"breaks": 2}, f"{place}/checkpoint", files_per_batch=1)
    stream_into(*stream, options, f"{place}/checkpoint", files_per_batch=1)
    register_target("files", sink)
    assert rows(find_target("files").read(spark, {"path": str(tmp_path)}, "t")) == rows(numbers)
    assert stream_into(*stream, options, f"{place}/checkpoint") == 0
