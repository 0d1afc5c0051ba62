"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Joins are declared without hints: a side is broadcast only if its measured
# size is under Spark's threshold, and a hot key's partition is split at run
# time. Both need adaptive execution.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split from the size a task should have, not from four times that, and also
    # where few partitions make a third of all rows only a few medians large.
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Before a join runs, Spark takes a Parquet file's size for that of its rows, which are ten times
    # as large in memory; a side that is small after all is still broadcast at run time.
    "spark.sql.sources.fileCompressionFactor": "10",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("starlane")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        # Call sites of columns are worth four round trips to the JVM each only in debugging.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in {**ADAPTIVE, **extra}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_adaptive(spark: SparkSession) -> SparkSession:
    """The settings above, as far as the caller has not made them."""
    made = spark.conf.getAll
    for name, value in ADAPTIVE.items():
        if name not in made:
            spark.conf.set(name, value)
    return spark


def importable(spark: SparkSession) -> SparkSession:
    """Lets Python workers on this machine find the package where the driver found it.

    A cluster's executors get it as they get any library, e.g. by ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[1])
    paths = spark.sparkContext.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if context.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="starlane-"))
    return context.getCheckpointDir()


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever Spark can reach it."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def make_folder(spark: SparkSession, path: str) -> None:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(there)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders under ``path``; none if it is not there."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = there.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(there):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(there) if s.isDirectory())


_open: ContextVar[list[str] | None] = ContextVar("open", default=None)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new name in the shared folder; inside ``scratch`` what is written there goes with its end."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if _open.get() is not None:
        _open.get().append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes the intermediate tables made inside; what is to last must be written elsewhere by then."""
    paths: list[str] = []
    token = _open.set(paths)
    try:
        yield
    finally:
        _open.reset(token)
        for path in paths:
            remove_path(spark, path)


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file if there is none of that name; False if there is.

    On a store that keeps to ``create`` without overwriting (HDFS; object stores with conditional writes)
    only one of several writers succeeds, and so on a local disk.
    """
    jvm = spark._jvm
    there = jvm.org.apache.hadoop.fs.Path(path)
    system = there.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(there.getParent())
    data = text.encode()
    try:
        if system.getUri().getScheme() == "file":
            files = jvm.java.nio.file
            options = spark.sparkContext._gateway.new_array(files.OpenOption, 2)
            options[0], options[1] = files.StandardOpenOption.CREATE_NEW, files.StandardOpenOption.WRITE
            files.Files.write(files.Path.of(system.makeQualified(there).toUri()), data, options)
        else:
            out = system.create(there, False)
            out.write(data)
            out.close()
    except Py4JJavaError as error:
        if "AlreadyExists" in str(error.java_exception):
            return False
        raise
    return True
