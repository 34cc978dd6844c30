"""Session defaults for tests and the benchmark, and the shared folder for written tables."""

from __future__ import annotations

import contextlib
import contextvars
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("barloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Bars are one row per interval: a window buffer of one block fits well in memory.
        .config("spark.sql.windowExec.buffer.in.memory.threshold", "16384")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: The folder of the step that is running, below the library's own.
_SCRATCH: contextvars.ContextVar[str] = contextvars.ContextVar("scratch", default="")


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="barloom-")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for a written table, under the folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session. Only where it is unset in a local session,
    as in tests, is a temporary folder chosen. A cluster without it is refused: a folder on one
    machine is not visible to the executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = _local_root()
    return f"{root.rstrip('/')}/barloom/{_SCRATCH.get()}{purpose}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """A folder for the tables written inside, removed at the end.

    For steps that leave their result elsewhere, such as a merge or a micro-batch: what they write on
    the way is not kept. Nothing read from these tables may be used after the step.
    """
    outer = _SCRATCH.get()
    folder = f"{outer}scratch-{uuid.uuid4().hex}/"
    token = _SCRATCH.set(folder)
    try:
        yield
    finally:
        path = shared_dir(spark, "").rsplit("/", 1)[0]
        _SCRATCH.reset(token)
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


#: Shuffle files of a query are removed when it ends, not when the driver happens to collect garbage.
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries run inside leave no shuffle files behind.

    For steps that write tables and read them back: nobody reads their shuffles again, and without
    this those of all steps lie on the disks together. The session's own setting returns at the end.
    """
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLE_CLEANUP)
        else:
            spark.conf.set(_SHUFFLE_CLEANUP, before)
