"""Cutting the lineage of frames that driver loops build on, and snapshots of triples.

Both go to the folder that the session's ``spark.checkpoint.dir`` names, which driver and executors
share; only where none is named (as in tests), to a local one. A lost executor loses nothing of them.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def ensure_folder(spark: SparkSession) -> str:
    """The checkpoint folder, which is set if it was not."""
    context = spark.sparkContext
    held = context._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get().rstrip("/")
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not named and not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    context.setCheckpointDir(named or "file://" + tempfile.mkdtemp(prefix="graphloom-"))
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


def checkpoint(df: DataFrame) -> DataFrame:
    """``df``, computed and written; for small frames that a loop reads once or twice."""
    ensure_folder(df.sparkSession)
    return df.checkpoint()


def snapshot(df: DataFrame, *order: str) -> DataFrame:
    """``df`` as a Parquet table, sorted within its files by ``order``, so that filters on it skip row groups.

    The table is deleted when the driver ends.
    """
    spark = df.sparkSession
    path = f"{ensure_folder(spark)}/graphloom-{uuid.uuid4().hex}"
    (df.sortWithinPartitions(*order) if order else df).write.parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def _delete_all() -> None:
    for spark, path in _written:
        context = spark.sparkContext
        if context._jsc is not None:
            target = context._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
    _written.clear()


atexit.register(_delete_all)
