"""Where intermediate and finished tables live.

Everything that must survive the loss of an executor is written as Parquet below
the shared folder the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Return the shared folder; choose one only in local mode when none is set."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="signalwatch-"))
    return context.getCheckpointDir().rstrip("/")


_handed_out: list[str] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    path = f"{shared_dir(spark)}/signalwatch/{name}-{uuid.uuid4().hex}"
    _handed_out.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what was stored at fresh paths in between; for a whole run, whose results
    lie elsewhere."""
    before = len(_handed_out)
    try:
        yield
    finally:
        for path in _handed_out[before:]:
            drop(spark, path)
        del _handed_out[before:]


def save(df: DataFrame, path: str) -> DataFrame:
    """Drop and recreate a table: overwrite ``path`` and read it back, typed."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _place(spark: SparkSession, path: str):
    """A path and the Hadoop file system it belongs to."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def drop(spark: SparkSession, path: str) -> None:
    """Delete a stored table or folder, if there is one."""
    place, system = _place(spark, path)
    system.delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _place(spark, path)
    return system.exists(place)


def size_of(spark: SparkSession, path: str) -> int:
    """How many bytes the files below a path hold."""
    place, system = _place(spark, path)
    return system.getContentSummary(place).getLength()


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once so later steps read it instead of computing it again."""
    return save(df, fresh_path(df.sparkSession, name))


def together(spark: SparkSession, steps: Mapping[str, Callable[[], DataFrame]],
             parallel: int = 4) -> dict[str, DataFrame]:
    """Run steps that do not need each other side by side.

    Each step is a Spark job of its own; small ones leave room on the cluster for others.
    """
    run = inheritable_thread_target(spark)(lambda step: step())
    with ThreadPool(parallel) as pool:
        return dict(zip(steps, pool.map(run, steps.values())))
