"""Joins and cuts that hold at any size: hot keys, checkpoints and the shared folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key with more than one in so many rows is hot. There can't be more hot keys than this.
HOT = 1000


def cut(df: DataFrame, spark: SparkSession) -> DataFrame:
    """``df`` written to the shared checkpoint folder, read back without its lineage."""
    shared_folder(spark)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that the session names. Only a local session, as in tests, may leave it unset."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-"))
    return context.getCheckpointDir()


def remove(spark: SparkSession, folder: str) -> None:
    """Deletes a folder of intermediate results, wherever Spark keeps it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def join_hot(rows: DataFrame, table: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``rows`` (without null keys) joined with ``table``, which has one row for each ``key``.

    Hot keys of ``rows`` are at most HOT many, so their part of ``table`` is broadcast and their rows stay where they
    are; the other rows are shuffled by key. ``rows`` is read three times and should be written out.
    """
    total = rows.count()
    hot = rows.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > max(1, total // HOT)).select(key)
    known = table.join(F.broadcast(hot), key, "left_semi")
    warm = rows.join(F.broadcast(hot), key, "left_semi").join(F.broadcast(known), key, how)
    cold = rows.join(F.broadcast(hot), key, "left_anti").join(table, key, how)
    return warm.unionByName(cold)
