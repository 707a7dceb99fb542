"""Session settings the library depends on, and tables staged in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_owned: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or where that is unset the warehouse's.

    A local warehouse is shared on one machine only, so on a cluster it raises.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    local = warehouse.startswith(("/", "file:")) or "://" not in warehouse
    if local and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set spark.checkpoint.dir: the warehouse {warehouse} is a folder of the driver's machine")
    return f"{warehouse}/_stages"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; an enclosing ``staging`` removes it."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _owned:
        _owned[-1].append(path)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Put a finished folder in the place of another."""
    jvm = spark.sparkContext._jvm
    old, new = jvm.org.apache.hadoop.fs.Path(target), jvm.org.apache.hadoop.fs.Path(source)
    files = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(old, True)
    if not files.rename(new, old):
        raise OSError(f"{source} could not be moved to {target}")


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Own the stages written inside and remove them at the end, when every result must have been saved."""
    _owned.append([])
    try:
        yield
    finally:
        for path in _owned.pop():
            remove_path(spark, path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    A lost executor then costs a re-read and not a recomputation, and later plans read only the
    columns they need, with real sizes to plan joins by.
    """
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
