"""Session set-up and the shared folder for staged tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}

#: Removes the shuffle files of a query at its end, where Spark (4.1) has the setting; others keep them until the driver collects its garbage.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_releasing, _release_lock = {}, threading.Lock()


def build_session(
    master: str = "local[*]", shuffle_partitions: int = 8, memory: str = "8g", java_options: str = ""
) -> SparkSession:
    """A single-machine session for tests and benchmarks; on a cluster the job brings its own."""
    builder = (
        SparkSession.builder.master(master)
        .appName("tablelift")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if java_options:
        builder = builder.config("spark.driver.extraJavaOptions", java_options)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, named by the cluster in ``spark.checkpoint.dir``.

    Only a single-machine session may go without the setting; it gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="tablelift-")
    return _local_folders[context.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/tablelift/{label}-{uuid.uuid4().hex}"


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Queries begun inside leave no shuffle files behind; the session's own setting holds again when the last thread is out."""
    key = id(spark)
    with _release_lock:
        depth, before = _releasing.get(key) or (0, spark.conf.get(RELEASE, None))
        _releasing[key] = depth + 1, before
        spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        with _release_lock:
            depth, before = _releasing.pop(key)
            if depth > 1:
                _releasing[key] = depth - 1, before
            elif before is None:
                spark.conf.unset(RELEASE)
            else:
                spark.conf.set(RELEASE, before)


def stage(df: DataFrame, label: str = "stage", **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder, with ``options`` of the writer, and return the written table.

    The result has a fixed content and no lineage, so passes over it agree and a lost executor
    costs a re-read, not a recomputation. Nothing reads the shuffle files again, so they go at once.
    """
    path = new_folder(df.sparkSession, label)
    with released(df.sparkSession):
        df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Folder:
    """Small files below a folder that every executor can reach, read and written from the driver."""

    def __init__(self, spark: SparkSession, folder: str):
        self.name, self._jvm, self._settings = folder.rstrip("/"), spark._jvm, spark._jsc.hadoopConfiguration()
        self._path_of = self._jvm.org.apache.hadoop.fs.Path  # looked up once: each lookup is several calls
        self.system = self._path_of(self.name).getFileSystem(self._settings)
        self._renaming = None

    def path(self, name: str = ""):
        return self._path_of(f"{self.name}/{name}" if name else self.name)

    def exists(self, name: str = "") -> bool:
        return self.system.exists(self.path(name))

    def names(self, name: str = "") -> list[str]:
        """The files and folders in a folder, none if it is not there."""
        return sorted(entry.getPath().getName() for entry in self.system.listStatus(self.path(name))) if self.exists(name) else []

    def status(self, whole_name: str):
        """Size and time of any file of this file system, given as a URI."""
        return self.system.getFileStatus(self._path_of(self._jvm.java.net.URI(whole_name)))

    def text(self, name: str) -> str:
        stream = self.system.open(self.path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """Write a file, in place of one that is there."""
        stream = self.system.create(self.path(name), True)
        stream.write(bytearray(text.encode()))
        stream.close()

    def move(self, name: str, to: str) -> bool:
        """Rename a file, never over another; whether it was done. On a local disk the look and the rename are two steps."""
        if self.system.getUri().getScheme() == "file":  # the other way starts a process for each of several looks
            return not self.exists(to) and self.system.rename(self.path(name), self.path(to))
        if self._renaming is None:
            context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.system.getUri(), self._settings)
            none = self._jvm.java.lang.reflect.Array.newInstance(self._jvm.org.apache.hadoop.fs.Options.Rename.NONE.getClass(), 0)
            self._renaming = context, none
        context, options = self._renaming
        try:
            context.rename(self.path(name), self.path(to), options)
        except Exception as error:
            if "FileAlreadyExists" in str(getattr(error, "java_exception", None) or error):
                return False
            raise
        return True

    def delete(self, name: str, whole: bool = False) -> None:
        self.system.delete(self.path(name), whole)


def make_folder(spark: SparkSession, folder: str) -> None:
    """Make ``folder`` unless it is there; safe from several threads and jobs."""
    place = Folder(spark, folder)
    place.system.mkdirs(place.path())


def has_files(spark: SparkSession, folder: str) -> bool:
    """Whether ``folder`` is there and holds anything but hidden and marker files."""
    return any(name[0] not in "_." for name in Folder(spark, folder).names())
