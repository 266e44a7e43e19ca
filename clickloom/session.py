"""Session settings and the place for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import SparkSession

#: Open windows and seen lines and ids live off-heap and on the executors' disks and are checkpointed as changes only. All of an
#: executor's state shares one cache and one write buffer: each partition's own would be some 100 MB, whatever the executor has.
STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}

#: What the jobs assume.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    **STATE,
}


def build_session(app: str = "clickloom", master: str | None = None,
                  initial_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with :data:`SETTINGS`; ``conf`` keys use ``__`` for a dot.

    ``initial_partitions`` is the width of batch shuffles before AQE merges small partitions: about
    the largest shuffle's bytes / 200 MB, at 100 TB hundreds of thousands. AQE can merge but not
    split what an aggregate reads. Streams don't use it; their state has a number of its own.
    """
    builder = SparkSession.builder.appName(app)
    if initial_partitions:
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", initial_partitions)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session may go without that setting; it gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if spark.conf.get("spark.master", "").split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="clickloom-")
    return f"{base.rstrip('/')}/clickloom/{label}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Settings that hold inside; keys use ``__`` for a dot. Queries keep those they were started with."""
    conf = {k.replace("__", "."): v for k, v in conf.items()}
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shuffles_removed(spark: SparkSession) -> AbstractContextManager[None]:
    """Queries that end inside leave no shuffle files; without it these stay until the driver happens to collect its garbage."""
    return settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is; one that isn't there is fine."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder on whatever file system it is; none if it isn't there."""
    files, place = _place(spark, path)
    return [status.getPath().getName() for status in files.listStatus(place)] if files.exists(place) else []


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    files, place = _place(spark, path)
    return files.getContentSummary(place).getLength()


def read_file(spark: SparkSession, path: str) -> str:
    """A small text file."""
    files, place = _place(spark, path)
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_file(spark: SparkSession, path: str, text: str) -> None:
    """A small text file that readers see as a whole or not at all: written aside, then renamed."""
    files, place = _place(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    stream = files.create(aside, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    if not files.rename(aside, place):
        files.delete(aside, False)
        raise FileExistsError(path)
