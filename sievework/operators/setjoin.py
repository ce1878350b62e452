"""Exact joins of sets by Jaccard similarity: ordered prefixes with positions, stars first, texts verified in streams.

A set is described by its size, a 1,024-bit parity sketch and the first items (``rare``) of an order that is the
same for all sets; two sets of similarity t or more share one of them (prefix filter). A posting carries the item's place
and the set's size: at the first item that two sets share, what can still follow bounds their overlap, so most pairs of a
posting list are refused before they're written. The sketch refuses more: where two sketches differ in
more bits than the sets may differ in items, they aren't similar. Sets of more than 1,024 items have a wider sketch, too, of one to
two bits an item; it travels to the pairs before any text does. These filters lose nothing.

Lists are worked through twice. First each set meets the head of its list, the set with the most room: the list's item comes
first in its order, so the least of it is unlike the others (a star, linear in the list). In a crowd of near copies that is one with the
fewest edits, which most of the others resemble, where a head by number is as a rule edited too much to be like any. Links
that hold make components. Then only pairs of different components meet, in blocks ordered by size class and place: a pair of
blocks whose sizes or places can't fit is skipped whole. Lists of two are done after the first pass; a Bloom filter keeps
their postings from being shuffled again. Texts travel once for each star that they are in.

Texts are described and counted in runs of a bounded number of items, each handed on at once, so that beside the batch that
Spark sends a task holds one run, and Spark holds no row back until Python has answered it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from fractions import Fraction
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from sievework.operators import bloom

#: Entries of a block of a posting list, and of a list that isn't cut into blocks; members of a star that one task compares; words of the Bloom filter; pairs that a task holds to hand each on once.
BLOCK, FEW, STAR, WORDS, ROWS = 512, 64, 512, 1 << 18, 500_000
#: Items of the sets that a task describes or counts at a time, and texts that it has as Python strings at a time.
RUN, TEXTS = 1 << 18, 256
SKETCH = [f"k{i}" for i in range(16)]
NUMBERS = ["hi", "lo", "m", *SKETCH]
_MIX = np.uint64(0xD6E8FEB86659FD93)


class Bar:
    """A similarity, in whole numbers."""

    def __init__(self, threshold: float) -> None:
        exact = Fraction(str(threshold))
        self.p, self.q = exact.numerator, exact.denominator

    def overlap(self, m, n):
        """The least overlap of sets of these sizes."""
        return -(-self.p * (m + n) // (self.p + self.q))

    def prefix(self, m: int) -> int:
        """Items of which a similar set shares one."""
        return m - -(-self.p * m // self.q) + 1

    def sizes_fit(self, m, n):
        return self.q * np.minimum(m, n) >= self.p * np.maximum(m, n)


def sketch(items: np.ndarray) -> np.ndarray:
    """1,024 parities of the items: sets that differ in k items differ in at most k of them."""
    place = ((items.view(np.uint64) * _MIX) >> np.uint64(54)).astype(np.int64)
    odd = np.bincount(place, minlength=1024) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def wide(items: np.ndarray) -> np.ndarray:
    """Parities of more than 1,024 items, a power of two of them: its halves united by XOR are the sketch of half the size."""
    if len(items) <= 1024:
        return np.zeros(0, np.int64)
    bits = 1 << (len(items) - 1).bit_length()
    place = (((items.view(np.uint64) * _MIX) >> np.uint64(32)) & np.uint64(bits - 1)).astype(np.int64)
    odd = np.bincount(place, minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def ordered(items: np.ndarray, common: np.ndarray, often: np.ndarray) -> np.ndarray:
    """The items by (how common they are, value); ``common`` is sorted, others count as seldom."""
    if not len(common):
        return np.sort(items)
    at = np.minimum(np.searchsorted(common, items), len(common) - 1)
    return items[np.lexsort((items, np.where(common[at] == items, often[at], 0)))]


def _runs(sets: Iterable[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """The sets in turn, in runs of about RUN items."""
    held, total = [], 0
    for own in sets:
        held.append(own)
        total += len(own) + 1
        if total >= RUN:
            yield held
            held, total = [], 0
    if held:
        yield held


def _counted(sets: Callable[[pa.Array], Iterable[np.ndarray]]):
    def work(batches):
        """Of texts (t), the items (g) and how many sets of a run have them (n)."""
        for batch in batches:
            for run in _runs(sets(batch.column(0))):
                yield _batch(["g", "n"], *np.unique(np.concatenate(run), return_counts=True))

    return work


def order(sample: DataFrame, sets: Callable[[pa.Array], Iterable[np.ndarray]], most: int) -> Broadcast:
    """The ``most`` most common items of the texts (t) that more than three of them have, sorted, and how many have each.

    Runs are counted where they are, so a common item is one row a run; the rest, nearly all different, is dealt without a table of it in the task.
    """
    dealt = sample.select("t").mapInArrow(_counted(sets), "g bigint, n bigint").repartition("g")
    counts = dealt.groupBy("g").agg(F.sum("n").alias("n")).filter("n > 3")
    known = sorted((r.g, r.n) for r in counts.orderBy(F.desc("n"), "g").limit(most).collect())
    return sample.sparkSession.sparkContext.broadcast((np.array([g for g, _ in known], np.int64), np.array([n for _, n in known], np.int64)))


def _described(sets: Callable[[pa.Array], Iterable[np.ndarray]], bar: Bar, common: Broadcast):
    def work(batches):
        """The other columns of texts (t) and what NUMBERS, ``rare`` and ``wide`` say of their sets, run by run."""
        for batch in batches:
            at, names = 0, [c for c in batch.schema.names if c != "t"]
            for run in _runs(sets(batch.column("t"))):
                numbers, rare, wides = np.zeros((len(run), len(NUMBERS)), np.int64), [], []
                for k, own in enumerate(run):
                    numbers[k] = [*np.frombuffer(blake2b(own.tobytes(), digest_size=16).digest(), np.int64), len(own), *sketch(own)]
                    rare.append(ordered(own, *common.value)[: bar.prefix(len(own))])
                    wides.append(wide(own))
                kept, lists = (batch.column(c).slice(at, len(run)) for c in names), (pa.array(c, pa.list_(pa.int64())) for c in (rare, wides))
                yield pa.RecordBatch.from_arrays([*kept, *(pa.array(c) for c in numbers.T), *lists], [*names, *NUMBERS, "rare", "wide"])
                at += len(run)

    return work


def describe(texts: DataFrame, sets: Callable[[pa.Array], Iterable[np.ndarray]], bar: Bar, common: Broadcast) -> DataFrame:
    """The rows of ``texts`` with NUMBERS, ``rare`` and ``wide`` of the set of each text (t) in its place."""
    kept = [f for f in texts.schema if f.name != "t"]
    made = [*(StructField(n, LongType()) for n in NUMBERS), *(StructField(n, ArrayType(LongType())) for n in ("rare", "wide"))]
    return texts.mapInArrow(_described(sets, bar, common), StructType([*kept, *made]))


def _postings(sets: DataFrame, *more: str) -> DataFrame:
    return sets.select("sid", "m", *more, F.posexplode("rare").alias("pos", "g"))


def _lists(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Rows sorted by their first column, as (where lists begin, the columns) of whole lists; lists of one row are left out."""
    held: list[list[np.ndarray]] = []

    def cut(parts: list[list[np.ndarray]]):
        table = [np.concatenate(x) for x in zip(*parts, strict=True)]
        g = table[0]
        new = np.concatenate([[True], g[1:] != g[:-1], [True]])
        table = [x[~(new[:-1] & new[1:])] for x in table]
        if len(table[0]):
            yield np.flatnonzero(np.concatenate([[True], table[0][1:] != table[0][:-1]])), table

    for batch in batches:
        rows = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(columns)]
        if not len(rows[0]):
            continue
        last = np.searchsorted(rows[0], rows[0][-1])  # the last list may go on
        if rows[0][0] == rows[0][-1]:
            if held and held[-1][0][-1] != rows[0][0]:
                yield from cut(held)
                held = []
            held.append(rows)
            continue
        held.append([x[:last] for x in rows])
        yield from cut(held)
        held = [[x[last:] for x in rows]]
    if held:
        yield from cut(held)


def _batch(names: list[str], *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names)


def _stars(bar: Bar):
    def work(batches):
        """Of each list (g, sid, m, pos), most room first, the pairs with its head that may be similar (kind 0); lists of three or more (kind 1)."""
        for starts, (g, sid, m, pos) in _lists(batches, 4):
            sizes = np.diff(np.append(starts, len(g)))
            head = np.repeat(starts, sizes)
            left = np.minimum(m[head] - pos[head], m - pos)
            near = (sid != sid[head]) & bar.sizes_fit(m[head], m) & (left >= bar.overlap(m[head], m))
            yield _batch(["kind", "x", "y"], np.zeros(near.sum()), sid[head][near], sid[near])
            many = g[starts][sizes > 2]
            yield _batch(["kind", "x", "y"], np.ones(len(many)), many, many)

    return work


def stars(sets: DataFrame, bar: Bar, keep: Callable[[DataFrame, str], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """The pairs (x, y) of the head of a list with others that may be similar, and the items of lists of three or more."""
    dealt = _postings(sets).select("g", "sid", "m", "pos").repartition("g").sortWithinPartitions("g", "pos", "sid")
    found = keep(dealt.mapInArrow(_stars(bar), "kind bigint, x bigint, y bigint"), "stars")
    return found.filter("kind = 0").select("x", "y").distinct(), found.filter("kind = 1").select(F.col("x").alias("g"))


def block_pairs(m: np.ndarray, pos: np.ndarray, bar: Bar) -> tuple[np.ndarray, list[tuple[slice, slice]]]:
    """An order of a list's entries, by size class and place, and the pairs of blocks that sizes and places don't rule out."""
    kind = np.floor(np.log(np.maximum(m, 1)) / -np.log(np.sqrt(bar.p / bar.q))).astype(np.int64) if bar.p < bar.q else m
    order = np.lexsort((pos, kind))
    cuts = [slice(i, min(i + BLOCK, len(m))) for i in range(0, len(m), BLOCK)]
    low = np.array([m[order[c]].min() for c in cuts])
    high = np.array([m[order[c]].max() for c in cuts])
    first = np.array([pos[order[c]].min() for c in cuts])
    i, j = np.triu_indices(len(cuts))
    fits = (bar.q * high[i] >= bar.p * low[j]) & (bar.q * high[j] >= bar.p * low[i])
    fits &= (bar.p + bar.q) * first[i] <= bar.q * high[i] - bar.p * low[j]
    fits &= (bar.p + bar.q) * first[j] <= bar.q * high[j] - bar.p * low[i]
    return order, [(cuts[a], cuts[b]) for a, b in zip(i[fits].tolist(), j[fits].tolist(), strict=True)]


def alike(near: DataFrame, sets: DataFrame, bar: Bar) -> DataFrame:
    """The pairs (x, y) of ``near`` that may be similar by their sketches: by wide ones, where both sets have them."""
    names = ["m", "wide", *SKETCH]
    sides = [sets.select(F.col("sid").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in names)) for s in "xy"]
    pairs = near.join(sides[0], "x").join(sides[1], "y")
    wx, wy = F.col("wide_x"), F.col("wide_y")

    def half(w):
        n = (F.size(w) / 2).cast("int")
        return F.zip_with(F.slice(w, F.lit(1), n), F.slice(w, n + 1, n), lambda a, b: a.bitwiseXOR(b))

    apart = F.zip_with(F.when(F.size(wx) > F.size(wy), half(wx)).otherwise(wx), F.when(F.size(wy) > F.size(wx), half(wy)).otherwise(wy), lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    plain = sum((F.bit_count(F.col(f"{k}_x").bitwiseXOR(F.col(f"{k}_y"))) for k in SKETCH), F.lit(0))
    fits = (F.size(wx) <= 2 * F.size(wy)) & (F.size(wy) <= 2 * F.size(wx)) & (F.size(wx) > 0)
    differ = F.when(fits, F.aggregate(apart, F.lit(0), lambda a, b: a + b)).otherwise(plain)
    twice = F.least(F.col("m_x") + F.col("m_y") - differ, 2 * F.least("m_x", "m_y"))  # the overlap is at most half of this
    return pairs.filter(twice * (bar.p + bar.q) >= (F.col("m_x") + F.col("m_y")) * 2 * bar.p).select("x", "y")


def _apart(bar: Bar):
    def work(batches):
        """Of each list (g, sid, m, pos, root, sketch), the pairs of different roots that may be similar."""
        found: list[np.ndarray] = []
        for starts, (g, sid, m, pos, root, *bits) in _lists(batches, 5 + len(SKETCH)):
            ends = np.append(starts[1:], len(g))
            bits = np.stack(bits, axis=1).view(np.uint64)
            mixed = np.maximum.reduceat(root, starts) != np.minimum.reduceat(root, starts)
            reach, share = (bar.p + bar.q) * (m - pos) - bar.p * m, bar.p * m  # the overlap that a place leaves is enough for a size n: reach >= p * n

            def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
                may = m[a] + m[b] - 2 * bar.overlap(m[a], m[b])
                for words in slice(0, 2), slice(2, len(SKETCH)):  # a few words refuse most pairs
                    may = may - np.bitwise_count(bits[a, words] ^ bits[b, words]).sum(axis=1, dtype=np.int64)
                    a, b, may = a[may >= 0], b[may >= 0], may[may >= 0]
                return np.stack([np.minimum(sid[a], sid[b]), np.maximum(sid[a], sid[b])], axis=1)

            few = mixed & (ends - starts <= FEW)  # short lists all at once: each row with the row after it, the second after it, ...
            a, last, step = np.flatnonzero(np.repeat(few, ends - starts)), np.repeat(ends[few], (ends - starts)[few]), 1
            while len(a):
                a, last = a[a + step < last], last[a + step < last]
                b = a + step
                near = (root[a] != root[b]) & (reach[a] >= share[b]) & (reach[b] >= share[a])
                found.append(alike(a[near], b[near]))
                step += 1
            for i, j in zip(starts[mixed & ~few].tolist(), ends[mixed & ~few].tolist(), strict=True):
                order, pairs = block_pairs(m[i:j], pos[i:j], bar)
                order = order + i
                for one, two in pairs:
                    a, b = order[one], order[two]
                    near = root[a][:, None] != root[b]
                    near &= reach[a][:, None] >= share[b]
                    near &= reach[b] >= share[a][:, None]
                    x, y = np.nonzero(near)
                    if one == two:
                        x, y = x[x < y], y[x < y]
                    found.append(alike(a[x], b[y]))
                if sum(map(len, found)) > 2 * ROWS:
                    found = [_once(found)]
                    if len(found[0]) > ROWS:
                        yield _batch(["x", "y"], *found.pop().T)
            found = [_once(found)]
            if len(found[0]) > ROWS:
                yield _batch(["x", "y"], *found.pop().T)
        yield _batch(["x", "y"], *_once(found).T)

    return work


def _once(found: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate([np.zeros((0, 2), np.int64), *found]), axis=0)


def apart(sets: DataFrame, crowded: DataFrame, roots: DataFrame, bar: Bar) -> DataFrame:
    """The pairs (x, y) of sets of different components (``roots``: node, root) that share a crowded item and may be similar."""
    listed = bloom.may_hold(_postings(sets, *SKETCH), bloom.build(crowded, WORDS, "g"), WORDS, "g")
    rooted = listed.join(roots, listed["sid"] == roots["node"], "left").withColumn("root", F.coalesce("root", "sid"))
    dealt = rooted.select("g", "sid", "m", "pos", "root", *SKETCH).repartition("g").sortWithinPartitions("g", "sid")
    return dealt.mapInArrow(_apart(bar), "x bigint, y bigint").distinct()


def overlaps(near: DataFrame, texts: Callable[[DataFrame], DataFrame], items: Callable[[bytes], np.ndarray], keep: Callable[[DataFrame, str], DataFrame], name: str) -> DataFrame:
    """(x, y, both): how many items the sets of each pair (x, y) share. ``texts`` gives (sid, t) for a frame of sids,
    ``items`` the sorted items of a text. A star of many members is compared in parts."""
    near = keep(near, f"{name}-near")
    held = keep(texts(near.select(F.col("x").alias("sid")).union(near.select("y")).distinct()), f"{name}-texts")
    parts = near.groupBy("x").agg(F.ceil(F.count("*") / STAR).cast("int").alias("parts"))
    members = near.join(parts, "x").select("x", F.pmod(F.xxhash64("y"), "parts").cast("int").alias("part"), F.col("y").alias("sid"))
    heads = parts.select("x", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("x").alias("sid"))
    side = F.when(F.col("sid") == F.col("x"), 0).otherwise(1).alias("side")
    dealt = heads.unionByName(members).join(held, "sid").select("x", "part", side, "sid", "t").repartition("x", "part").sortWithinPartitions("x", "part", "side")

    def compare(batches):
        head, own = None, None
        for batch in (whole.slice(at, TEXTS) for whole in batches for at in range(0, len(whole), TEXTS)):
            x, y, both = [], [], []
            for key, part, first, sid, text in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                mine = items(text.encode())
                if not first:
                    head, own = (key, part), mine
                elif head == (key, part) and len(own):
                    at = np.minimum(np.searchsorted(own, mine), len(own) - 1)
                    x.append(key)
                    y.append(sid)
                    both.append(int((own[at] == mine).sum()))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (x, y, both)], ["x", "y", "both"])

    return keep(dealt.mapInArrow(compare, "x bigint, y bigint, both bigint"), name)


def similar(bar: Bar, both, m, n):
    """Whether sets of these sizes with this overlap are similar, as a column."""
    return both * (bar.p + bar.q) >= (m + n) * bar.p
