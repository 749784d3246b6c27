"""Intermediate tables in the folder that driver and executors share.

Operators that use a result twice write it as Parquet below ``spark.checkpoint.dir``, so that lineage
ends there and a lost executor costs no more than its own tasks. The tables are deleted when the
Python driver ends or :func:`release` is called.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_written: list[tuple[SparkSession, str]] = []


def lowest(hashed: Column, share: float) -> Column:
    """Whether a 64-bit hash is in the lowest ``share`` of all: a sample of rows that does not depend on their order, of any size."""
    return F.lit(True) if share >= 1 else hashed < F.lit(int(share * 2.0**64) - (1 << 63))


def folder(spark: SparkSession) -> str:
    """The shared folder that the session names; a local one only where none is named and the master is local, as in tests."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    held = context._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get().rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    made = "file://" + tempfile.mkdtemp(prefix="graphloom-")
    context.setCheckpointDir(made)
    return made


def table(df: DataFrame, name: str) -> DataFrame:
    """``df``, written and read again."""
    spark = df.sparkSession
    path = f"{folder(spark)}/graphloom-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append((spark, path))
    made = spark.read.schema(df.schema).parquet(path)
    made._graphloom_path = path
    return made


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release(*tables: DataFrame) -> None:
    """Deletes given tables, which are those that :func:`table` returned, or all."""
    paths = {getattr(t, "_graphloom_path", None) for t in tables}
    for spark, path in list(_written):
        if not tables or path in paths:
            _written.remove((spark, path))
            if spark.sparkContext._jsc is not None:
                _delete(spark, path)


atexit.register(release)
