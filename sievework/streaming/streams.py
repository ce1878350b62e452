"""Streams: landing files, new addresses, continuous upserts, liveness, breakers and counts."""

from __future__ import annotations

from typing import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, LongType, StructField, StructType, TimestampType

from sievework.operators import bloom
from sievework.operators.graphs import cut
from sievework.operators.runs import merged, summed_up
from sievework.sources.sinks import _exists, _latest, merge_buckets, publish_buckets, publish_version, read_version


def stream_landing(spark: SparkSession, path: str, schema, fmt: str = "parquet", files: int | None = None) -> DataFrame:
    """Files of a folder as they arrive."""
    reader = spark.readStream.format(fmt).schema(schema)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).load(path)


def stream_new_urls(stream: DataFrame, ts: str, key: str, delay: str = "72 hours", arrival: Column | None = None) -> DataFrame:
    """Each key once within the delay. Undated rows count from their arrival."""
    timed = stream.withColumn("event_time", F.coalesce(F.col(ts).cast("timestamp"), arrival if arrival is not None else F.current_timestamp()))
    return timed.withWatermark("event_time", delay).dropDuplicatesWithinWatermark([key])


#: Words of the seen set's filter (two longs each) before it has to grow; the most that is broadcast; the share of
#: foreign keys let through beyond which it grows.
SEEN_WORDS, SEEN_MOST, SEEN_ERROR = 1 << 14, 1 << 18, 0.05


def stream_unseen(stream: DataFrame, ts: str, key: str, place: str, deliver: Callable[[DataFrame, int], None], delay: str = "72 hours", words: int = SEEN_WORDS):
    """T2 beyond the delay: ``deliver`` gets each key once, however long ago it came first. A null is a key too.

    The watermark's state holds keys within the delay; all keys ever delivered are a table at ``place``, one folder a
    batch, with a Bloom filter beside it (``filter``, ``about``: its words, keys, bytes and error rate). A key that the filter
    lacks is new without a look at the table; only the others are anti-joined exactly. The filter is broadcast as long as it has
    at most SEEN_MOST words; beyond that, and where there is none, all keys are anti-joined. It grows four times, from the
    table, when it lets too many foreign keys through. A batch that is run again reads the batches before its own only.
    """

    def meet(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = cut(batch)
        about = _before(spark, f"{place}/about", "words bigint, keys bigint, bytes bigint, error_rate double", number)
        latest = about.orderBy(F.desc("batch")).first() if about is not None else None
        keys = _before(spark, f"{place}/keys", StructType([rows.schema[key]]), number)
        known = None
        if latest is None or keys is None:
            fresh = rows
        else:
            open_rows, certain = rows, None
            if latest.words <= SEEN_MOST:
                known = spark.read.schema("word bigint, bits bigint").parquet(f"{place}/filter/batch={latest.batch}")
                open_rows = bloom.may_hold(rows, known, latest.words, key)
                certain = rows.join(open_rows.select(F.col(key).alias("_k")).distinct(), F.col(key).eqNullSafe(F.col("_k")), "left_anti")
            fresh = open_rows.join(keys.select(F.col(key).alias("_k")), F.col(key).eqNullSafe(F.col("_k")), "left_anti")
            fresh = fresh.unionByName(certain) if certain is not None else fresh
        fresh = cut(fresh.dropDuplicates([key]))
        deliver(fresh, number)
        fresh.select(key).write.mode("overwrite").parquet(f"{place}/keys/batch={number}")
        size = latest.words if latest is not None else words
        table = bloom.build(fresh, size, key)
        table = cut(bloom.unite(table.unionByName(known)) if known is not None else table)
        total = (latest["keys"] if latest is not None else 0) + fresh.count()
        error = table.agg(bloom.error_rate(size).alias("e")).first()["e"] or 0.0
        if error > SEEN_ERROR and size < SEEN_MOST:
            size *= 4
            table = cut(bloom.build(spark.read.schema(StructType([rows.schema[key]])).parquet(f"{place}/keys").filter(F.col("batch") <= number) if keys is not None else fresh, size, key))
            error = table.agg(bloom.error_rate(size).alias("e")).first()["e"] or 0.0
        table.write.mode("overwrite").parquet(f"{place}/filter/batch={number}")
        told = spark.createDataFrame([(size, total, size * 16, float(error))], "words bigint, keys bigint, bytes bigint, error_rate double")
        told.coalesce(1).write.mode("overwrite").json(f"{place}/about/batch={number}")

    once = stream_new_urls(stream, ts, key, delay)
    return once.writeStream.foreachBatch(meet).option("checkpointLocation", f"{place}/state").trigger(availableNow=True).start()


def _before(spark: SparkSession, path: str, schema, number: int) -> DataFrame | None:
    """What batches before this one left in a folder (with ``batch``), or None."""
    if not _exists(spark, path):
        return None
    form = "json" if path.endswith("/about") else "parquet"
    columns = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return spark.read.format(form).schema(f"{columns}, batch bigint").load(path).filter(F.col("batch") < number)


def stream_upsert(stream: DataFrame, table_dir: str, upsert: Callable[[DataFrame, DataFrame], DataFrame], checkpoint: str, key: str = "url", buckets: int = 64):
    """Every micro-batch is merged into the table, whose versions are buckets of the key's hash: a batch reads and
    writes the buckets of its keys, and the next manifest points to the old files of the rest. The batch's number names its
    version; a batch that is run again is merged into the version before its own. A table that was published whole is put into buckets
    first."""
    spark = stream.sparkSession
    if not _latest(spark, table_dir).startswith("m-"):
        publish_buckets(read_version(spark, table_dir), table_dir, key, buckets)

    def merge(batch: DataFrame, number: int) -> None:
        merge_buckets(cut(batch), table_dir, key, upsert, buckets, f"batch-{number}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class _Liveness(StatefulProcessor):
    """Last attempt and last success of a source, in seconds; a timer tells when success is too old."""

    def __init__(self, days: int) -> None:
        self.limit = days * 86_400

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", StructType([StructField("attempt", LongType()), StructField("success", LongType())]))

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802
        attempt, success = self.state.get() if self.state.exists() else (0, 0)
        for rows_ in rows:
            seconds = rows_["seconds"]
            attempt = max(attempt, int(seconds.max()))
            done = seconds[rows_["upserted"] > 0]
            success = max(success, int(done.max()) if len(done) else 0)
        self.state.update((attempt, success))
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(((success or attempt) + self.limit) * 1000)
        yield pd.DataFrame({"source_id": [key[0]], "last_attempt": [attempt], "last_success": [success], "alert": [attempt - success > self.limit]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802
        attempt, success = self.state.get()
        yield pd.DataFrame({"source_id": [key[0]], "last_attempt": [attempt], "last_success": [success], "alert": [True]})

    def close(self) -> None:
        pass


def stream_liveness(stream: DataFrame, days: int = 8) -> DataFrame:
    """T4: attempts and successes of each source as they change (seconds), with an alert when success is too old."""
    rows = stream.select("source_id", F.col("ts").cast("timestamp").alias("ts"), F.unix_timestamp(F.col("ts").cast("timestamp")).alias("seconds"), "upserted").withWatermark("ts", "1 hour")
    return rows.groupBy("source_id").transformWithStateInPandas(_Liveness(days), "source_id bigint, last_attempt bigint, last_success bigint, alert boolean", "Update", "EventTime")


class _Breaker(StatefulProcessor):
    """Failures in a row of a source; rows of a batch are taken by ``seq``."""

    def __init__(self, n: int) -> None:
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", StructType([StructField("n", IntegerType())]))

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802
        run = self.count.get()[0] if self.count.exists() else 0
        told = pd.concat(rows)
        told = told[told["outcome"].isin(["failure", "success"])].sort_values("seq")
        failed = (told["outcome"] == "failure").to_numpy()
        total = np.cumsum(failed)
        # Failures since the last success: all so far less those up to it; before any success the state's run counts.
        runs = total - np.maximum.accumulate(np.where(failed, -run, total)) if len(total) else total
        self.count.update((int(runs[-1]) if len(runs) else run,))
        opened = told["seq"].to_numpy()[failed & (runs == self.n)]
        yield pd.DataFrame({"source_id": [key[0]] * len(opened), "abort_at": opened})

    def close(self) -> None:
        pass


def stream_breaker(stream: DataFrame, n: int = 3) -> DataFrame:
    """T5: where a source has failed n times in a row; another outcome than failure or success changes nothing. A task
    holds a source's rows of one micro-batch, so bound that (``files`` of ``stream_landing``) where a source is hot."""
    rows = stream.select("source_id", "seq", "outcome")
    return rows.groupBy("source_id").transformWithStateInPandas(_Breaker(n), "source_id bigint, abort_at bigint", "Append", "None")


def stream_breaker_runs(stream: DataFrame, place: str, n: int = 3):
    """T5 for hot sources: as ``stream_breaker``, but a micro-batch is summed up in ranges of (source, order), so a source that
    holds all its rows is spread over tasks, each in constant memory; one number a source is carried on. Openings
    (source_id, abort_at) go to ``place``/opened by batch, and a batch that is run again writes them again."""

    def meet(batch: DataFrame, number: int) -> None:
        spark, version = batch.sparkSession, f"batch-{number}"
        pieces = cut(summed_up(batch, n))
        earlier = read_version(spark, f"{place}/trailing", other_than=version) if number else None
        found = cut(merged(pieces, n, earlier))
        found.filter(F.col("length").isNotNull()).select("source_id", "abort_at").write.mode("overwrite").parquet(f"{place}/opened/batch={number}")
        now = found.filter(F.col("trailing").isNotNull()).select("source_id", "trailing")
        if earlier is not None:
            now = earlier.join(now.select(F.col("source_id").alias("_s")), F.col("source_id").eqNullSafe(F.col("_s")), "left_anti").unionByName(now)
        publish_version(now, f"{place}/trailing", version)

    return stream.writeStream.foreachBatch(meet).option("checkpointLocation", f"{place}/state").trigger(availableNow=True).start()


def intake_counts(df: DataFrame, ts: str, window: str = "1 day", slide: str | None = None, late: str | None = None) -> DataFrame:
    """Rows by window, tumbling or sliding, for tables and streams alike."""
    timed = df.withColumn("event_time", F.col(ts).cast("timestamp"))
    timed = timed.withWatermark("event_time", late) if late else timed
    w = F.window("event_time", window, slide) if slide else F.window("event_time", window)
    return timed.groupBy(w.alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), "n")


def split_late(batch: DataFrame, ts: str, delay_hours: int, newest: Column) -> tuple[DataFrame, DataFrame]:
    """(rows in time, rows later than the delay before the newest time seen)."""
    late = F.col(ts).cast("timestamp") < newest - F.make_dt_interval(F.lit(0), F.lit(delay_hours))
    return batch.filter(~F.coalesce(late, F.lit(False))), batch.filter(late)


def stream_split_late(stream: DataFrame, ts: str, delay_hours: int, place: str, on_time: Callable[[DataFrame, int], None], late: Callable[[DataFrame, int], None]):
    """T7 as a stream: each micro-batch is split by the newest time that earlier ones brought, and the parts go to two sinks.

    The newest time is state, one row a batch at ``place``/newest; it never falls, and a batch that is run again is split by
    what the batches before it brought. Before the first dated row, and for rows without a time, nothing is late.
    """

    def meet(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = cut(batch)
        seen = _before(spark, f"{place}/newest", StructType([StructField("newest", TimestampType())]), number)
        newest = seen.agg(F.max("newest")).first()[0] if seen is not None else None
        told = F.lit(newest).cast("timestamp")
        fine, behind = split_late(rows, ts, delay_hours, told)
        on_time(fine, number)
        late(behind, number)
        rows.agg(F.greatest(F.max(F.col(ts).cast("timestamp")), told).alias("newest")).write.mode("overwrite").parquet(f"{place}/newest/batch={number}")

    return stream.writeStream.foreachBatch(meet).option("checkpointLocation", f"{place}/state").trigger(availableNow=True).start()
