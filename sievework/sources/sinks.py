"""Sinks. A table is a folder of versions; a new version is complete before its name is the latest."""

from __future__ import annotations

import json
from typing import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from sievework.operators.ranking import order_for_csv


def publish_version(df: DataFrame, table_dir: str, version: str | None = None) -> str:
    """Writes a version beside the others; the path that it's read from is never overwritten.

    Every write has a folder of its own, also one of a version that is written again. The pointer is a table of one
    row a write, appended once the folder is complete, so readers see one write or the other whole. One writer at a time.
    """
    folder = uuid4().hex
    path = f"{table_dir}/v-{folder}"
    df.write.parquet(path)
    _point(df.sparkSession, table_dir, version or folder, folder)
    return path


_POINTER = "turn bigint, version string, folder string"
_MANIFEST = "bucket int, folder string"


def _point(spark: SparkSession, table_dir: str, version: str, folder: str) -> None:
    turn = (_pointer(spark, table_dir).agg(F.max("turn")).first()[0] if _exists(spark, f"{table_dir}/pointer") else None) or 0
    spark.createDataFrame([(turn + 1, version, folder)], _POINTER).coalesce(1).write.mode("append").json(f"{table_dir}/pointer")


def _pointer(spark: SparkSession, table_dir: str) -> DataFrame:
    return spark.read.schema(_POINTER).json(f"{table_dir}/pointer")


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path).schema  # noqa: B018
        return True
    except AnalysisException:
        return False


def _latest(spark: SparkSession, table_dir: str, other_than: str | None = None) -> str:
    pointer = _pointer(spark, table_dir)
    if other_than is not None:
        pointer = pointer.filter(F.col("version") != other_than)
    return pointer.agg(F.max_by("folder", "turn")).first()[0]


def read_version(spark: SparkSession, table_dir: str, other_than: str | None = None) -> DataFrame:
    """The latest complete version, whole or in buckets; with ``other_than`` the latest of another name."""
    folder = _latest(spark, table_dir, other_than)
    if folder.startswith("m-"):
        return _read_buckets(spark, table_dir, _manifest(spark, table_dir, folder))
    return spark.read.parquet(f"{table_dir}/v-{folder}")


def manifest(spark: SparkSession, table_dir: str) -> dict[int, str]:
    """Where the latest version in buckets has each bucket: at most as many entries as there are buckets."""
    return _manifest(spark, table_dir, _latest(spark, table_dir))


def _manifest(spark: SparkSession, table_dir: str, folder: str) -> dict[int, str]:
    return {r.bucket: r.folder for r in spark.read.schema(_MANIFEST).json(f"{table_dir}/{folder}").collect()}


def _read_buckets(spark: SparkSession, table_dir: str, places: dict[int, str]) -> DataFrame:
    schema = spark.read.schema("columns string").json(f"{table_dir}/schema").first()[0]
    schema = StructType.fromJson(json.loads(schema))
    paths = [f"{table_dir}/{folder}/bucket={bucket}" for bucket, folder in places.items()]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def bucket_of(key: str, buckets: int) -> Column:
    """The bucket of a key; null keys have one too."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def publish_buckets(df: DataFrame, table_dir: str, key: str, buckets: int = 64, version: str | None = None) -> str:
    """A version as buckets of the key's hash, with a manifest that names each bucket's folder. The columns are
    fixed by the first version."""
    spark = df.sparkSession
    if not _exists(spark, f"{table_dir}/schema"):
        spark.createDataFrame([(df.schema.json(),)], "columns string").coalesce(1).write.json(f"{table_dir}/schema")
    return _rewrite(df, table_dir, key, buckets, {}, version)


def merge_buckets(batch: DataFrame, table_dir: str, key: str, upsert: Callable[[DataFrame, DataFrame], DataFrame], buckets: int = 64, version: str | None = None) -> str:
    """The latest version (other than ``version``) merged with ``batch``. Only buckets that the batch's keys fall in are
    read and written; the new manifest points to the old folders of the rest."""
    spark = batch.sparkSession
    places = _manifest(spark, table_dir, _latest(spark, table_dir, version))
    touched = {r.bucket for r in batch.select(bucket_of(key, buckets).alias("bucket")).distinct().collect()}  # ``buckets`` at most
    old = _read_buckets(spark, table_dir, {b: f for b, f in places.items() if b in touched})
    rest = {b: f for b, f in places.items() if b not in touched}
    return _rewrite(upsert(old, batch).select(*old.columns), table_dir, key, buckets, rest, version)


def _rewrite(df: DataFrame, table_dir: str, key: str, buckets: int, rest: dict[int, str], version: str | None) -> str:
    spark, name = df.sparkSession, uuid4().hex
    marked = df.withColumn("bucket", bucket_of(key, buckets))
    marked.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{table_dir}/w-{name}")
    made = {}
    if _exists(spark, f"{table_dir}/w-{name}/bucket=*"):  # a version without rows has no bucket
        made = {r.bucket: f"w-{name}" for r in spark.read.parquet(f"{table_dir}/w-{name}").select("bucket").distinct().collect()}
    rows = sorted((rest | made).items())
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.json(f"{table_dir}/m-{name}")
    _point(spark, table_dir, version or name, f"m-{name}")
    return f"{table_dir}/m-{name}"


def drop_old_versions(spark: SparkSession, table_dir: str, keep: int = 2) -> list[str]:
    """Deletes the folders that none of the latest ``keep`` versions reads; gives their names."""
    rows = _pointer(spark, table_dir).orderBy(F.desc("turn")).limit(keep).collect()
    used = {r.folder if r.folder.startswith("m-") else f"v-{r.folder}" for r in rows}
    used |= {f for r in rows if r.folder.startswith("m-") for f in _manifest(spark, table_dir, r.folder).values()}
    path = spark._jvm.org.apache.hadoop.fs.Path(table_dir)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in store.listStatus(path)]
    gone = [n for n in names if n[:2] in ("m-", "v-", "w-") and n not in used]
    for n in gone:
        store.delete(spark._jvm.org.apache.hadoop.fs.Path(path, n), True)
    return gone


def save_seen(df: DataFrame, path: str) -> str:
    """The whole set, once each."""
    return publish_version(df.select("url").distinct(), path)


def load_seen(spark: SparkSession, path: str) -> DataFrame:
    """The set that was saved last, empty before the first."""
    return read_version(spark, path) if _exists(spark, f"{path}/pointer") else spark.createDataFrame([], "url string")


def write_article_doc(articles: DataFrame, failed: DataFrame, path: str, run_ts: str) -> None:
    """Articles and failed sources, by month."""
    month = F.lit(run_ts[:7])
    articles.withColumn("run_date", F.lit(run_ts)).withColumn("month", month).write.mode("append").partitionBy("month").json(f"{path}/articles")
    failed.withColumn("run_date", F.lit(run_ts)).withColumn("month", month).write.mode("append").partitionBy("month").json(f"{path}/failed_sources")


def write_jobs_csv(jobs: DataFrame, path: str) -> None:
    """Jobs in order as CSV, range-sorted, so that the parts in name order are the order of the rows."""
    order_for_csv(jobs).write.mode("overwrite").csv(path, header=True)


def write_unsent(df: DataFrame, path: str, day: str) -> None:
    """Rows that couldn't be sent, by day."""
    df.withColumn("day", F.lit(day)).write.mode("append").partitionBy("day").parquet(path)
