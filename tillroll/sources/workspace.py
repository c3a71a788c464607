"""Shared folder for intermediate tables, saved models and lineage cuts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None
_staged: list[str] = []


def root(spark: SparkSession) -> str:
    """The folder the session names; a temporary one only for a local master."""
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/") + "/tillroll"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="tillroll-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def new_path(spark: SparkSession, name: str) -> str:
    return f"{root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back; ``options`` are the writer's.

    Used where several branches of one plan need the same wide intermediate: it is
    computed once, survives the loss of executors, and each branch then scans only
    the columns it needs.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.mode("overwrite").options(**options).parquet(path)
    _staged.append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a staged table that no plan reads any more."""
    folders = {uri.rsplit("/", 1)[0] for uri in df.inputFiles()}
    for path in [p for p in _staged if any(f.endswith(p.split(":", 1)[-1]) for f in folders)]:
        _staged.remove(path)
        _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def release(spark: SparkSession) -> int:
    """Delete the tables staged by this process; call it once their results are written."""
    n = len(_staged)
    while _staged:
        _delete(spark, _staged.pop())
    return n
