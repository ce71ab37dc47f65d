"""Intermediate results written to the folder all executors share.

A pinned result survives lost executors, cuts the lineage, and tells the optimiser
its true size, so a later join broadcasts it only if it really is small.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_runs: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where it is unset, a session whose executors are threads of
    the driver gets a folder of its own, removed when Python ends; any other is refused."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if "dir" not in _own:
        _own["dir"] = tempfile.mkdtemp(prefix="starloom-")
        atexit.register(shutil.rmtree, _own["dir"], ignore_errors=True)
    return _own["dir"]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder of the open run, or in the scratch folder."""
    folder = _runs[-1] if _runs else f"{scratch_root(spark)}/starloom"
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in any file system Spark knows."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """Everything pinned inside lies in one folder, which is removed at the end. What is
    computed from it must be written by then."""
    _runs.append(scratch_path(spark, "run"))
    try:
        yield _runs[-1]
    finally:
        remove_folder(spark, _runs.pop())


def pin(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
