"""Materialise a frame so that lost executors cost a re-read, not a re-run."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

_SETTING = "spark.checkpoint.dir"
_LOCAL_FOLDER: list[str] = []
_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a local session may make its own."""
    folder = spark.conf.get(_SETTING, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder that every executor can reach")
    if not _LOCAL_FOLDER:
        _LOCAL_FOLDER.append(tempfile.mkdtemp(prefix="biblioweave-"))
    return _LOCAL_FOLDER[0]


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """Tables that ``durable`` writes inside the block lie in one folder, which is removed at its end.

    Write what has to stay before the block ends: frames that read the removed tables cannot be used after it.
    """
    folder = f"{_run_folder.get() or shared_folder(spark)}/run-{uuid.uuid4().hex}"
    token = _run_folder.set(folder)
    try:
        yield folder
    finally:
        _run_folder.reset(token)
        path, system = file_system(spark, folder)
        system.delete(path, True)


def file_system(spark: SparkSession, folder: str):
    """The folder as a path of its file system, and that file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def durable(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Parquet keeps column pruning and filter pushdown for the readers, and its
    real size lets the optimizer decide about broadcasts.
    """
    path = f"{_run_folder.get() or shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, name: str, **kinds: Column) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """``durable``, and the number of ``rows`` written (and of those that each of ``kinds`` holds for).

    The rows are counted on their way into the files, by the tasks that write them, so no frame is read again for its count.
    """
    seen = Observation()
    marks = [F.count_if(condition).alias(kind) for kind, condition in kinds.items()]
    stored = durable(df.observe(seen, F.count(F.lit(1)).alias("rows"), *marks), name)
    return stored, lambda: dict(seen.get)
