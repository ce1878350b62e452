"""SimHash near-duplicates by tiled exact comparison.

A text is lower-cased in A-Z, cut into words by ASCII white space and into shingles of three words.
Each shingle is hashed by XXH64 (seed 42); bit b of the fingerprint is 1 if more than half of the
hashes have it. Two fingerprints are linked at RADIUS or fewer differing bits, and groups are the
connected components of the links.

Fingerprints are cut into five segments. Three differing bits leave two segments alike, so distinct
fingerprints are dealt by each pair of segments: ten keys of about 26 bits, whose groups stay small up
to billions of fingerprints. Within a group they are ordered by population count and cut into tiles, and
tiles are compared with numpy exclusive-or and bit counts. Tile pairs whose counts are more than RADIUS
apart are skipped, which loses nothing. A group of over TILE fingerprints is split into tiles by
population count and, within a count, by hash; each pair of tiles is then a task's unit of its own, so
that no group has to fit one task. A unit emits a spanning forest of its links, at most one row per
fingerprint, never all pairs.

Defined cases: null and empty texts have fingerprint zero and are linked like any other; texts of
one or two words are one shingle; repeated rows have one fingerprint; ids may be null (they join a
component but never name it); other columns are left alone, but for one with the name of the new
column, which is replaced. ``keep_one`` keeps rows without an id, and of each group the row with the
least id; of those with that id the least hash of the columns (maps left out) decides, at every run alike.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType
from xxhash import xxh64_intdigest

from sievework.llm.skew import cut, join_hot, shared_folder
from sievework.operators.graphs import connected

RADIUS, WORDS, SEED = 3, 3, 42
#: (first bit, bits) of the segments.
SEGMENTS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
#: Fingerprints of one tile.
TILE = 2048
_CHUNK = 1 << 15


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint of one text, unsigned."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < WORDS:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(WORDS)), strict=False))
    hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = hashes[at : at + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


@F.arrow_udf(LongType())
def _fingerprints(column: pa.Array) -> pa.Array:
    found = np.fromiter((fingerprint(x.as_py()) for x in column), dtype=np.uint64, count=len(column))
    return pa.array(found.view(np.int64))


def fingerprints(docs: DataFrame, text: str = "text", into: str = "fingerprint") -> DataFrame:
    """``docs`` with the signed 64-bit fingerprint of the text in the new column ``into``."""
    return docs.withColumn(into, _fingerprints(F.col(text).cast("string")))


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def forest(left: np.ndarray, right: np.ndarray | None = None, radius: int = RADIUS, tile: int = TILE) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``left``, or between ``left`` and ``right``, as (smaller, larger).

    Rows are cut into tiles by population count; a pair of tiles out of reach is skipped.
    """
    same = right is None
    if same and len(left) == 2:
        p, q = sorted(left.tolist())
        return [(p, q)] if p != q and ((p ^ q) & (1 << 64) - 1).bit_count() <= radius else []
    sides = []
    for side in (left,) if same else (left, right):
        counts = np.bitwise_count(side.view(np.uint64))
        order = np.argsort(counts, kind="stable")
        sides.append((side[order], counts[order]))
    (a, ca), (b, cb) = sides[0], sides[-1]
    label = np.arange(len(a) if same else len(a) + len(b))
    shift = 0 if same else len(a)
    out = []
    for i in range(0, len(a), tile):
        rows, low, high = a[i : i + tile], int(ca[i]), int(ca[min(i + tile, len(a)) - 1])
        for j in range(i if same else 0, len(b), tile):
            columns = b[j : j + tile]
            if int(cb[j]) > high + radius:
                break
            if int(cb[min(j + tile, len(b)) - 1]) < low - radius:
                continue
            for at in range(0, len(rows), 256):
                near = np.bitwise_count(rows[at : at + 256, None].view(np.uint64) ^ columns[None, :].view(np.uint64)) <= radius
                for x in np.flatnonzero(near.sum(axis=1) > int(same and i == j)):
                    own, beside = i + at + x, np.flatnonzero(near[x]) + j + shift
                    strange = beside[label[beside] != label[own]]
                    for other in strange[np.unique(label[strange], return_index=True)[1]]:
                        p, q = int(a[own]), int(b[other - shift])
                        label[label == label[other]] = label[own]
                        if p != q:
                            out.append((min(p, q), max(p, q)))
    return out


def _units(batches):
    """Rows sorted by unit (bucket, tile, other tile), as (unit's left rows, right rows or None)."""
    key, left, right = None, [], []

    def done():
        mine = np.concatenate(left) if left else np.zeros(0, np.int64)
        other = np.concatenate(right) if right else None
        return mine, other

    for batch in batches:
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
        bucket, unit, side, value = columns
        if not len(bucket):
            continue
        alike = np.concatenate([[True], (bucket[1:] == bucket[:-1]) & (unit[1:] == unit[:-1]), [True]])
        grouped = alike[:-1] | alike[1:]  # one that stands alone, and not at the batch's ends, has nobody to meet
        bucket, unit, side, value = (x[grouped] for x in columns)
        ends = np.flatnonzero((bucket[1:] != bucket[:-1]) | (unit[1:] != unit[:-1])) + 1
        for i, j in zip([0, *ends], [*ends, len(bucket)], strict=True):
            if key is not None and (bucket[i], unit[i]) != key:
                yield done()
                left, right = [], []
            key = (bucket[i], unit[i])
            sides, values = side[i:j], value[i:j]
            if j - i == 1 or not sides.any():
                (right if sides[0] else left).append(values)
            else:
                left.append(values[sides == 0])
                right.append(values[sides == 1])
    if key is not None:
        yield done()


def _compare(batches):
    found: list[tuple[int, int]] = []
    for left, right in _units(batches):
        if len(left) + (len(right) if right is not None else 0) > 1 and len(left):
            found += forest(left, right)
        if len(found) > 10_000:
            yield _pairs(found)
            found = []
    yield _pairs(found)


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    table = np.array(found, dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(table[:, 0]), pa.array(table[:, 1])], ["a", "b"])


def links(prints: DataFrame, tile: int = TILE) -> DataFrame:
    """Links (a, b) that connect what RADIUS connects, from a frame of distinct values ``fp``.

    The table of groups larger than one tile has at most one row for TILE rows dealt; AQE sees its size and
    broadcasts it only if it is small.
    """
    segments = [F.expr(f"shiftrightunsigned(fp, {at})").bitwiseAND((1 << bits) - 1) for at, bits in SEGMENTS]
    keys = [F.lit(k << 26) + segments[a] * (1 << 13) + segments[b] for k, (a, b) in enumerate(combinations(range(len(SEGMENTS)), 2))]
    dealt = prints.select("fp", F.bit_count("fp").alias("ones"), F.explode(F.array(*keys)).alias("bucket"))
    crowded = dealt.groupBy("bucket").agg(F.count("*").alias("total")).filter(F.col("total") > tile).select("bucket")
    hot = (
        dealt.join(crowded, "bucket", "left_semi").groupBy("bucket", "ones").agg(F.count("*").alias("n"))
        .groupBy("bucket").agg(F.map_from_entries(F.collect_list(F.struct("ones", F.ceil(F.col("n") / tile).cast("int").alias("m")))).alias("tiles"))
    )
    known = dealt.join(hot, "bucket", "left")
    # A tile of a large group is (ones, part); its number orders them. It meets itself and each tile within reach.
    part = F.pmod(F.xxhash64("fp"), F.try_element_at("tiles", F.col("ones"))).cast("int")
    known = known.withColumn("mine", F.when(F.col("tiles").isNotNull(), F.col("ones") * 1_000_000 + part))
    reach = F.flatten(
        F.transform(
            F.sequence(F.col("ones") - RADIUS, F.col("ones") + RADIUS),
            lambda c: F.when(
                F.try_element_at("tiles", c).isNotNull(),
                F.transform(F.sequence(F.lit(0), F.try_element_at("tiles", c) - 1), lambda k: c * 1_000_000 + k),
            ).otherwise(F.array().cast("array<int>")),
        )
    )
    units = known.select(
        "bucket", "fp", "mine",
        F.explode(F.when(F.col("mine").isNull(), F.array(F.lit(0))).otherwise(reach)).alias("other"),
    ).select(
        "bucket",
        F.when(F.col("mine").isNull(), F.lit(0).cast("bigint"))
        .otherwise(F.least("mine", "other").cast("bigint") * 100_000_000 + F.greatest("mine", "other")).alias("unit"),
        F.when(F.col("mine") > F.col("other"), 1).otherwise(0).alias("side"), "fp",
    )
    sent = units.repartition("bucket", "unit").sortWithinPartitions("bucket", "unit")
    return sent.mapInArrow(_compare, "a bigint, b bigint").distinct()


def components(pairs: DataFrame, spark: SparkSession) -> DataFrame:
    """(fp, root): the smallest value connected with each value that has a link.

    The rows are pairs of numbers and a value that many share isn't looked for: AQE splits the partition that one
    outgrows. Looking for hot values took two counts and several broadcasts a round, which the driver has to plan and hold.
    """
    shared_folder(spark)
    return connected(pairs).select(F.col("node").alias("fp"), "root")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, fingerprint (bigint) and component_id (the smallest id of its component)."""
    spark = docs.sparkSession
    printed = cut(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))).select("doc_id", "fingerprint"), spark)
    return resolve(printed)


def resolve(printed: DataFrame) -> DataFrame:
    """Components of a written frame (doc_id, fingerprint)."""
    named, head = _heads(printed, F.col("doc_id"))
    named = cut(named.select(F.col("fp").alias("fingerprint"), "root"), printed.sparkSession)
    ids = cut(join_hot(named, head.withColumnRenamed("first", "component_id"), "root").select("fingerprint", "component_id"), printed.sparkSession)
    return join_hot(printed, ids, "fingerprint").select("doc_id", "fingerprint", "component_id")


def _heads(printed: DataFrame, first: Column) -> tuple[DataFrame, DataFrame]:
    """(fp, first, root) of each fingerprint and (root, first) of each component, with the least ``first``."""
    spark = printed.sparkSession
    least = cut(printed.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(first).alias("first")), spark)
    root = components(links(least.select("fp")), spark)
    named = least.join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return named, named.groupBy("root").agg(F.min("first").alias("first"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component: the row with the smallest id; the columns stay as they are.

    Only (id, hash of the row, fingerprint) is grouped; texts move once, by id and hash, after equal rows of a
    task have become one.
    """
    names, taken = docs.columns, {c.lower() for c in docs.columns}
    mark = next(m for m in ("_" * k + "mark" for k in range(len(taken) + 1)) if m not in taken)
    plain = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    held = docs.filter(F.col("doc_id").isNotNull()).withColumn(mark, F.xxhash64(*plain))
    printed = held.select("doc_id", F.col(mark).alias("mark"), F.col("text").alias("text"))
    printed = cut(fingerprints(printed).select("doc_id", "mark", "fingerprint"), docs.sparkSession)
    _, head = _heads(printed, F.struct("doc_id", "mark"))
    chosen = head.select(F.col("first.doc_id").alias("doc_id"), F.col("first.mark").alias(mark))
    kept = held.dropDuplicates(["doc_id", mark]).join(chosen, ["doc_id", mark], "left_semi").select(*(f"`{c}`" for c in names))
    return kept.unionByName(docs.filter(F.col("doc_id").isNull()))
