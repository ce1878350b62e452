"""Keeping one row of several. Order is always a column; the key columns break ties last.

Where only the first row of a group matters, it's a ``min_by`` aggregate: partial results are combined
before the shuffle, so a group that holds a third of all rows sends one row from each task.
"""

from __future__ import annotations

from functools import lru_cache
from hashlib import blake2b
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.text import norm_key, norm_place


def _first(df: DataFrame, keys: list[Column], order: list[Column], last: bool = False) -> DataFrame:
    """The first (or last) whole row of each group by the order; null keys are a group."""
    names = [f"k{i}" for i in range(len(keys))]
    packed = df.select(*(k.alias(n) for k, n in zip(keys, names, strict=True)), F.struct(*order).alias("o"), F.struct("*").alias("row"))
    pick = F.max_by if last else F.min_by
    return packed.groupBy(*names).agg(pick("row", "o").alias("row")).select("row.*")


def collapse_identical(listings: DataFrame, order: str = "seq", source: str = "source_id") -> DataFrame:
    """The earliest of equal titles and places within a source; a missing place equals only a missing one."""
    return _first(listings, [F.col(source), norm_key("title"), norm_place("location_raw")], [F.col(order)])


def first_by_key(df: DataFrame, key: str, order: str = "seq") -> DataFrame:
    """The first row of each key."""
    return _first(df, [F.col(key)], [F.col(order)])


def first_by_title_company(jobs: DataFrame, order: str) -> DataFrame:
    """The first row of each title and company, case folded."""
    return _first(jobs, [F.lower(F.trim("title")), F.lower(F.trim("company"))], [F.col(order)])


def cap_per_group(df: DataFrame, group: str, caps: dict[str, int], order: str = "seq", default: int = 15) -> DataFrame:
    """The first rows of each group, up to its cap. The rank is limited before it's exchanged (window group limit)."""
    cap = F.coalesce(*(F.when(F.col(group) == k, F.lit(v)) for k, v in caps.items()), F.lit(default))
    most = max([*caps.values(), default])
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(group).orderBy(order))).filter(F.col("_rank") <= most)
    return ranked.filter(F.col("_rank") <= cap).drop("_rank")


def first_by_priority(df: DataFrame, key: str, priority: dict[str, int], limit: int | None = None, source: str = "source", order: str = "seq") -> DataFrame:
    """Of rows with one key the one whose source comes first; then at most ``limit`` rows in the same order."""
    turn = F.coalesce(*(F.when(F.col(source) == k, F.lit(v)) for k, v in priority.items()), F.lit(len(priority)))
    out = _first(df, [F.col(key)], [turn, F.col(order)])
    return out.orderBy(turn, order).limit(limit) if limit is not None else out


def best_of_group(df: DataFrame, group: str, score: str = "score", url: str = "url", order: str = "seq") -> DataFrame:
    """The highest score of each group, aggregator links last; rows without a group stay."""
    keyed = F.coalesce(F.col(group).cast("string"), F.concat(F.lit("row "), F.col(order).cast("string")))
    return _first(df, [keyed], [-F.coalesce(score, F.lit(0)), F.contains(F.coalesce(url, F.lit("")), F.lit("news.google.com")), F.col(order)])


def superseded_in_series(events: DataFrame) -> DataFrame:
    """Pending events of a recurring series but for the soonest of each name."""
    series = events.filter((F.col("status") == "pending") & F.col("event_date").isNotNull() & F.col("recurrence").isNotNull())
    turn = F.row_number().over(Window.partitionBy("name").orderBy("event_date", "event_id"))
    return series.withColumn("_turn", turn).filter("_turn > 1").drop("_turn").withColumn("reason", F.lit("recurring_series_superseded"))


def latest_by(df: DataFrame, key: str, ts: str, tie: str) -> DataFrame:
    """The newest row of each key; of equal times the highest ``tie``."""
    return _first(df, [F.col(key)], [F.col(ts), F.col(tie)], last=True)


def in_window(df: DataFrame, ts: str, now: Column, days_back: int = 0, days_ahead: int = 0) -> DataFrame:
    """Rows from so many days before to so many days after ``now``."""
    return df.filter(F.col(ts).between(now - F.expr(f"interval {days_back} days"), now + F.expr(f"interval {days_ahead} days")))


def one_of(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row of each key where rows have no order: that with the least hash of all its columns, at every run."""
    return _first(df, [F.col(k) for k in keys], [F.xxhash64(F.to_json(F.struct("*")))])


def assign_batches(df: DataFrame, size: int = 15, bucket: str | None = None, order: str = "seq") -> DataFrame:
    """Batch number and place inside it. Rows are numbered within a bucket: a column's value, or a range of the
    order, which Spark makes as many of as it has shuffle partitions, so no task sees all rows; a batch is (bucket, batch)."""
    from sievework.operators.graphs import cut
    from sievework.operators.ranking import place_in_group

    if bucket:  # a column's values may be of any size
        numbered = place_in_group(df.withColumn("bucket", F.col(bucket)), ["bucket"], [order], "_n").withColumn("_n", F.col("_n") - 1)
    else:
        named = cut(df.repartitionByRange(order).withColumn("bucket", F.spark_partition_id()))
        numbered = named.withColumn("_n", F.row_number().over(Window.partitionBy("bucket").orderBy(order)) - 1)
    return numbered.withColumn("batch", F.floor(F.col("_n") / size)).withColumn("idx", F.col("_n") % size).drop("_n")


_PRIME = 0x9E3779B97F4A7C15
_SAMPLE, _COMMON = 16, 65_536


@lru_cache(maxsize=4)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """2**bits powers of an odd number and of its inverse modulo 2**64."""
    inverse = pow(_PRIME, -1, 1 << 64)
    steps = [np.full(1 << bits, k, np.uint64) for k in (_PRIME, inverse)]
    for step in steps:
        step[0] = 1
    return np.cumprod(steps[0]), np.cumprod(steps[1])


def _shingles(text: bytes, size: int) -> np.ndarray:
    """The distinct 64-bit hashes, in order, of runs of ``size`` words of a text with single spaces; of the whole text if it's shorter."""
    view = np.frombuffer(text, np.uint8)
    spaces = np.flatnonzero(view == 32)
    starts, ends = np.concatenate([[0], spaces + 1]), np.append(spaces, len(view))
    size = min(size, len(starts))
    starts, ends = starts[: len(starts) - size + 1], ends[size - 1 :]
    up, down = _powers((len(view) + 1).bit_length())
    sums = np.zeros(len(view) + 1, np.uint64)
    np.cumsum((view + np.uint64(1)) * up[: len(view)], out=sums[1:])
    value = (sums[ends] - sums[starts]) * down[starts]
    value = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique((value ^ (value >> np.uint64(32))).view(np.int64))


def _items(text: bytes, size: int, block: str) -> np.ndarray:
    """The shingles of a text as sorted numbers; texts of other blocks have none of them."""
    mark = int.from_bytes(blake2b(block.encode(), digest_size=8).digest(), "little") if block else 0
    return np.sort(_shingles(text, size) ^ np.int64(mark - (mark >> 63 << 64)))


def group_stories(df: DataFrame, text: str, threshold: float = 0.8, block: str | None = None, size: int = 5, key: str = "seq") -> DataFrame:
    """Rows with ``story``, the smallest key of texts that resemble one another (Jaccard of word shingles).

    Equal shingle sets are one set first, told apart by 128 bits. Sets then join as in ``setjoin``: prefixes in an order that
    puts shingles last that are common in a sample of the texts, stars first, then only pairs of different components.
    Texts are read again for the sets that meet. Texts of different blocks never resemble one another; a null key joins
    a story but doesn't name it.
    """
    from sievework.operators import bloom, setjoin
    from sievework.operators.graphs import Scratch, connected

    scratch, bar = Scratch(df.sparkSession, "stories"), setjoin.Bar(threshold)
    blocks = F.coalesce(F.concat(F.lit("b"), F.col(block).cast("string")), F.lit("")) if block else F.lit("")
    # a text and its block travel as one string; a normal text has no line feed
    whole = F.concat_ws("\n", blocks, norm_key(text))

    def items(joined: bytes) -> np.ndarray:
        name, _, own = joined.partition(b"\n")
        return _items(own, size, name.decode())

    def sets_of(texts: pa.Array) -> Iterator[np.ndarray]:
        return (items(t.as_py().encode()) for t in texts)

    sample = df.select(whole.alias("t")).filter(F.pmod(F.xxhash64("t"), F.lit(_SAMPLE)) == 0).distinct()
    common = setjoin.order(sample, sets_of, _COMMON)
    about = scratch.keep(setjoin.describe(df.select(F.col(key).alias("key"), F.xxhash64(whole).alias("mark"), whole.alias("t")), sets_of, bar, common), "about")
    same = about.groupBy("hi", "lo").agg(F.min("key").alias("first"), F.min(F.struct("mark", "key")).alias("text"), *(F.first(c).alias(c) for c in ("m", *setjoin.SKETCH, "rare", "wide")))
    sets = scratch.keep(same.withColumn("sid", F.monotonically_increasing_id()), "sets")

    def texts(wanted: DataFrame) -> DataFrame:
        asked = sets.join(wanted, "sid").select("sid", "text.mark", "text.key")
        rows = df.select(F.col(key).alias("key"), whole.alias("t")).withColumn("mark", F.xxhash64("t"))
        held = bloom.may_hold(rows, bloom.build(asked, setjoin.WORDS, "mark", "key"), setjoin.WORDS, "mark", "key")
        asked = asked.withColumnsRenamed({"mark": "mark2", "key": "key2"})
        return held.join(asked, (F.col("mark") == F.col("mark2")) & F.col("key").eqNullSafe(F.col("key2"))).select("sid", "t").dropDuplicates(["sid"])

    sizes = sets.select(F.col("sid").alias("x"), F.col("m").alias("mx")), sets.select(F.col("sid").alias("y"), F.col("m").alias("my"))

    def links(near: DataFrame, name: str) -> DataFrame:
        met = setjoin.overlaps(setjoin.alike(near, sets, bar), texts, items, scratch.keep, name).join(sizes[0], "x").join(sizes[1], "y")
        return scratch.keep(met.filter(setjoin.similar(bar, F.col("both"), F.col("mx"), F.col("my"))).select(F.col("x").alias("a"), F.col("y").alias("b")), f"{name}-links")

    near, crowded = setjoin.stars(sets, bar, scratch.keep)
    first = links(near, "first")
    second = links(setjoin.apart(sets, crowded, connected(first), bar), "second")
    labels = connected(first.union(second))
    named = sets.join(labels, sets["sid"] == labels["node"], "left").select("hi", "lo", F.coalesce("root", "sid").alias("root"), "first")
    story = named.groupBy("root").agg(F.min("first").alias("story"))
    stories = scratch.keep(named.join(story, "root").select("hi", "lo", "story"), "named")
    keyed = about.join(stories, ["hi", "lo"]).select(F.col("key").alias("_key"), F.col("mark").alias("_mark"), "story").distinct()
    keyed = scratch.keep(keyed, "keyed")
    scratch.drop("about", "sets", "stars", "named", *(f"{a}{b}" for a in ("first", "second") for b in ("", "-near", "-texts", "-links")))
    return df.join(keyed, (F.xxhash64(whole) == F.col("_mark")) & F.col(key).eqNullSafe(F.col("_key"))).drop("_key", "_mark")
