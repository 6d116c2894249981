"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.streaming.stopGracefullyOnShutdown": "true",
    "spark.sql.streaming.stopTimeout": "60s",
}


def build_session(app_name: str = "parley", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above. The master comes from spark-submit unless given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for stream checkpoints and staged tables, gone when the driver ends.

    It lies under the cluster's shared ``spark.checkpoint.dir``. Without that setting a local
    session gets a temporary folder, and a cluster is an error: its executors share no such folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="parley-")
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries that begin and end in here leave no shuffle files behind.

    Spark otherwise keeps them until the driver's heap is collected, for a stream those of many batches.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


_STAGED: ContextVar[list[str] | None] = ContextVar("staged", default=None)


@contextmanager
def stages_deleted(spark: SparkSession) -> Iterator[None]:
    """Deletes at the end what ``staged`` writes in here: a stream's batch needs it no longer than that."""
    paths: list[str] = []
    token = _STAGED.set(paths)
    try:
        yield
    finally:
        _STAGED.reset(token)
        for path in paths:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the work folder and read back.

    For a costly result that is read more than once: it is computed once, and a lost executor
    costs a re-read and not a recomputation.
    """
    path = work_dir(df.sparkSession, name)
    if (paths := _STAGED.get()) is not None:
        paths.append(path)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
