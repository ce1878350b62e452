"""Runs of failures by summaries that merge.

A stretch of a source's outcomes is summed up by its leading failures, its trailing failures and whether it has a
success; runs between two successes inside it are complete. Summaries of neighbouring stretches merge in any grouping, so
a source is dealt in ranges of its order, each range is read once in constant memory, and only summaries (one for each source
and range) come together. A run keeps its first n failures at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StructField, StructType

_PIECE = [("_range", LongType()), ("won", BooleanType()), ("lead", ArrayType(LongType())), ("lead_n", LongType()), ("trail", ArrayType(LongType())), ("trail_n", LongType())]
_RUN = [("began", LongType()), ("abort_at", LongType()), ("length", LongType()), ("trailing", LongType())]


def _schema(source, fields) -> StructType:
    return StructType([source, *(StructField(name, kind) for name, kind in fields)])


def _sum_up(n: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (source, seq, failed, range) in order as pieces; a complete run inside a stretch is a piece without a range."""
        at, piece, run, schema = None, None, None, None
        out: list[dict] = []

        def complete(run: dict | None) -> None:
            if run and run["n"] >= n:
                out.append({"source_id": at, "_range": None, "won": True, "lead": run["first"], "lead_n": run["n"], "trail": [], "trail_n": 0})

        def ended() -> None:
            if piece:
                out.append({**piece, "source_id": at, "trail": run["first"] if run else [], "trail_n": run["n"] if run else 0})

        for batch in batches:
            source = batch.schema.field(0)
            lists = pa.list_(pa.int64())
            kinds = {"_range": pa.int64(), "won": pa.bool_(), "lead": lists, "lead_n": pa.int64(), "trail": lists, "trail_n": pa.int64()}
            schema = pa.schema([pa.field("source_id", source.type), *(pa.field(k, v) for k, v in kinds.items())])
            for name, seq, failed, place in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if piece is None or name != at:
                    ended()
                    at, run = name, None
                    piece = {"_range": place, "won": False, "lead": [], "lead_n": 0}
                if not failed:
                    if piece["won"]:
                        complete(run)
                    piece["won"], run = True, {"first": [], "n": 0}
                elif piece["won"]:
                    run["n"] += 1
                    if run["n"] <= n:
                        run["first"].append(seq)
                else:
                    piece["lead_n"] += 1
                    if piece["lead_n"] <= n:
                        piece["lead"].append(seq)
            if len(out) > 10_000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out.clear()
        ended()
        if schema:
            yield pa.RecordBatch.from_pylist(out, schema)

    return work


def _merge(n: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (source, failures before, pieces in order): the runs that pieces make together, then one row with what trails."""
        for batch in batches:
            out: list[dict] = []
            for source, before, pieces in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                first, length = [], 0

                def close(source=source) -> None:
                    if before < n <= before + length:
                        out.append({"source_id": source, "began": first[0], "abort_at": first[n - before - 1], "length": before + length, "trailing": None})

                for piece in pieces:
                    first, length = first + piece["lead"][: n - len(first)], length + piece["lead_n"]
                    if piece["won"]:
                        close()
                        first, length, before = piece["trail"], piece["trail_n"], 0
                close()
                out.append({"source_id": source, "began": None, "abort_at": None, "length": None, "trailing": before + length})
            schema = pa.schema([pa.field("source_id", batch.schema.field(0).type), *(pa.field(name, pa.int64()) for name, _ in _RUN)])
            yield pa.RecordBatch.from_pylist(out, schema)

    return work


def summed_up(log: DataFrame, n: int) -> DataFrame:
    """One summary for each source and range of ``log`` (source_id, seq, outcome), and the complete runs inside of n or more."""
    told = log.filter(F.col("outcome").isin("failure", "success") & F.col("seq").isNotNull()).select("source_id", F.col("seq").cast("bigint").alias("seq"), (F.col("outcome") == "failure").alias("failed"))
    ranges = told.repartitionByRange("source_id", "seq").sortWithinPartitions("source_id", "seq").withColumn("_range", F.spark_partition_id().cast("bigint"))
    return ranges.mapInArrow(_sum_up(n), _schema(log.schema["source_id"], _PIECE))


def merged(pieces: DataFrame, n: int, before: DataFrame | None = None) -> DataFrame:
    """(source_id, began, abort_at, length, trailing): a row for each run of n failures or more that opens, with ``abort_at``
    its n-th failure, and a row for each source with the failures that trail. ``before`` (source_id, trailing)
    holds what trailed earlier; a source's summaries are one array, at most one for each range."""
    inside = pieces.filter(F.col("_range").isNull())
    inside = inside.select("source_id", F.element_at("lead", 1).alias("began"), F.element_at("lead", n).alias("abort_at"), F.col("lead_n").alias("length"), F.lit(None).cast("bigint").alias("trailing"))
    whole = pieces.filter(F.col("_range").isNotNull()).groupBy("source_id").agg(F.array_sort(F.collect_list(F.struct(*(name for name, _ in _PIECE)))).alias("pieces"))
    if before is None:
        whole = whole.withColumn("before", F.lit(0).cast("bigint"))
    else:
        earlier = before.select(F.col("source_id").alias("_source"), F.col("trailing").alias("before"))
        whole = whole.join(earlier, F.col("source_id").eqNullSafe(F.col("_source")), "left").withColumn("before", F.coalesce("before", F.lit(0).cast("bigint")))
    return inside.unionByName(whole.select("source_id", "before", "pieces").mapInArrow(_merge(n), _schema(pieces.schema["source_id"], _RUN)))
