"""A mergeable blocked Bloom filter as a table of words.

A key falls into one 64-bit word and sets BITS bits of it, so a filter is a frame (word, bits) with at most
``words`` rows: partitions build theirs on their own, the union of filters is ``bit_or`` by word, and a test is one
join with a table of a known size. Nothing runs outside Spark's own functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits that a key sets.
BITS = 4


def word_of(words: int, *key: Column) -> Column:
    """The word that a key falls into. A null is a value of its own."""
    return F.pmod(F.xxhash64(F.lit(1), *_plain(key)), F.lit(words)).cast("bigint")


def mask_of(*key: Column) -> Column:
    """The bits that a key sets in its word."""
    mixed = F.xxhash64(F.lit(2), *_plain(key))
    mask = F.lit(0).cast("bigint")
    for k in range(BITS):
        place = F.shiftrightunsigned(mixed, 6 * k).bitwiseAND(63).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    return mask


def _plain(key: tuple[Column, ...]) -> list[Column]:
    return [c for k in key for c in (k.isNull(), k)]


def build(keys: DataFrame, words: int, *key: str) -> DataFrame:
    """The filter (word, bits) of the keys; each partition unites its own first."""
    return unite(keys.select(word_of(words, *map(F.col, key)).alias("word"), mask_of(*map(F.col, key)).alias("bits")))


def unite(filters: DataFrame) -> DataFrame:
    """The union of filters of one size: what any of them may hold."""
    return filters.groupBy("word").agg(F.expr("bit_or(bits)").alias("bits"))


def may_hold(df: DataFrame, table: DataFrame, words: int, *key: str) -> DataFrame:
    """The rows whose key may be among those of the filter: none of the filter's keys is lost."""
    held, seen = table.select(F.col("word").alias("_word"), F.col("bits").alias("_bits")), [F.col(k) for k in key]
    marked = df.join(F.broadcast(held), word_of(words, *seen) == F.col("_word"))
    mask = mask_of(*seen)
    return marked.filter(F.col("_bits").bitwiseAND(mask) == mask).select(*df.columns)


def error_rate(words: int) -> Column:
    """An aggregate of a filter: the share of foreign keys that it lets through: the mean over words of (share of bits set) ** BITS."""
    return F.sum(F.pow(F.bit_count("bits") / 64.0, F.lit(float(BITS)))) / F.lit(float(words))
