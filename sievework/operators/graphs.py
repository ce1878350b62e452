"""Connected components by spreading the least label; tables of intermediate results."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def cut(df: DataFrame) -> DataFrame:
    """The frame written to the shared checkpoint folder and read back without its lineage."""
    folder(df.sparkSession)
    return df.checkpoint()


def folder(spark: SparkSession) -> str:
    """The checkpoint folder that the session names. Only a local session, as in tests, may leave it unset."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-"))
    return context.getCheckpointDir()


class Scratch:
    """Intermediate tables of one run: Parquet in the shared folder, as lasting as a checkpoint, compressed, with columns that can be pruned."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.folder = spark, f"{folder(spark)}/{name}-{uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def drop(self, *names: str) -> None:
        """Deletes tables that no result reads any more."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b): the least node that it's connected with. Labels only fall,
    and jump along labels, so the rounds end, after about the logarithm of the longest chain. Labels are hashed, one row a node: nothing is
    sorted or broadcast, and AQE splits the other side's partition if many rows share a node."""
    both = cut(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    state = cut(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")))
    while True:
        near = both.join(state.withColumnRenamed("node", "b").hint("shuffle_hash"), "b").groupBy("a").agg(F.min("root").alias("near"))
        lower = state.join(near.hint("shuffle_hash"), state["node"] == near["a"]).select("node", "root", F.least("root", "near").alias("next"))
        jump = lower.select(F.col("node").alias("next"), F.col("next").alias("jump"))
        moved = lower.join(jump.hint("shuffle_hash"), "next", "left").select("node", "root", F.least("next", "jump").alias("then"))
        moved = cut(moved)
        state = moved.select("node", F.col("then").alias("root"))
        if moved.filter("then < root").limit(1).count() == 0:
            return state
