"""Source divergence audit by chunk factorization.

How far do the sources of a language differ in the words that they use, and which words does each use
more than its language does? Terms are the regular expression TERM's matches, lower-cased in A-Z, and a
language keeps the terms that at least LEAST of its documents hold.

Chunk factorization: a term never spans white space, so a text is a bag of chunks. Tasks count the chunks
of each document and add them up by (lang, source, chunk), a bounded number at a time; then each
globally distinct chunk is cut into terms once, and the terms are joined back to the counts.
Occurrences add up. Documents that hold a term lie between the largest of its chunks' document counts and
their sum, and only for terms where these two don't decide are documents told apart: such a chunk is in
fewer than LEAST documents, whose numbers the counting tasks wrote beside the counts. So no row
of (document, term) is ever made for common terms, and no key is hot: a chunk has at most
one row for each task and group.

Pairs of sources are compared in blocks: the terms of a language are dealt into buckets and its sources into
tiles of TILE, and a task takes one bucket of two tiles as two dense integer matrices. It hands back one
row for each pair of sources, never one for each term; terms that neither of two sources has
are counted, not listed.

Defined cases: null text, lang and source are ''; a row is a document, so repeated rows count
each; texts without terms still make their (lang, source) group occur; ties go by UTF-8 order; an empty
table gives no rows; other columns aren't read. All arithmetic is on 64-bit integers.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.operators import bloom
from sievework.operators.graphs import Scratch

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: The same in UTF-8, where every byte of other scripts is 128 or more.
_LETTERS = re.compile(rb"[A-Za-z\x80-\xff]+")
#: Documents of a language that a kept term is in, at least; ranks of the term part; parts of one in a share.
LEAST, RANKS, SCALE = 10, 10, 1_000_000_000
#: Chunks of documents that a task adds up at once; terms of a bucket, about; sources of a tile.
HELD, BUCKET, TILE = 2_000_000, 4_096, 64
#: Words of the Bloom filter that keeps other chunks' document numbers from being shuffled.
WORDS = 1 << 18

_COUNTS = "lang string, source string, chunk binary, n bigint, docs bigint, number bigint, numbers array<bigint>"


class _Held:
    """Entries (group, chunk, times, document) of a task until they are added up by group and chunk."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.chunks: list[bytes] = []
        self.times: list[int] = []
        self.documents: list[tuple[int, int, int]] = []  # group, number, entries

    def add(self, group: tuple[str, str], text: bytes, number: int) -> None:
        own = Counter(text.split()) or {b"": 1}
        self.chunks += own.keys()
        self.times += own.values()
        self.documents.append((self.groups.setdefault(group, len(self.groups)), number, len(own)))

    def sums(self) -> pa.RecordBatch:
        coded = pa.array(self.chunks, pa.binary()).dictionary_encode()
        group, number, entries = np.array(self.documents, np.int64).reshape(-1, 3).T
        key = np.repeat(group, entries) * len(coded.dictionary) + coded.indices.to_numpy()
        order = np.argsort(key, kind="stable")
        key = key[order]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        docs = np.diff(np.append(starts, len(key)))
        few = docs < LEAST
        numbers = np.repeat(number, entries)[order][np.repeat(few, docs)]
        offsets = np.concatenate([[0], np.cumsum(np.where(few, docs, 0))]).astype(np.int32)
        at, chunk = np.divmod(key[starts], len(coded.dictionary))
        names = [pa.array(x, pa.string()).take(pa.array(at)) for x in zip(*self.groups, strict=True)]
        summed = np.add.reduceat(np.array(self.times, np.int64)[order], starts)
        listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(numbers), mask=pa.array(~few))
        columns = [*names, coded.dictionary.take(pa.array(chunk)), pa.array(summed), pa.array(docs), listed]
        return pa.RecordBatch.from_arrays(columns, ["lang", "source", "chunk", "n", "docs", "numbers"])


def _count(batches: Iterator[pa.RecordBatch], most: int = HELD) -> Iterator[pa.RecordBatch]:
    """Rows (lang, source, text, number) as counts by (lang, source, chunk); a text without a chunk counts the chunk ''."""
    held = _Held()
    for batch in batches:
        for lang, source, text, number in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            held.add((lang, source), text, number)
            if len(held.chunks) > most:
                yield held.sums()
                held = _Held()
    if held.chunks:
        yield held.sums()


def _singled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts with the number of a chunk's only document in a plain column ``number``; ``numbers`` stays for those of several."""
    for batch in batches:
        docs, places, listed = batch["docs"].to_numpy(), batch["numbers"].offsets.to_numpy(), batch["numbers"].values.to_numpy()
        one, sizes = docs == 1, np.diff(places)
        single = np.zeros(len(docs), np.int64)
        single[one] = listed[places[:-1][one]]
        offsets = np.concatenate([[0], np.cumsum(np.where(one, 0, sizes))]).astype(np.int32)
        several = pa.ListArray.from_arrays(pa.array(offsets), pa.array(listed[np.repeat(~one, sizes)]), mask=pa.array(one | (docs >= LEAST)))
        columns = [*(batch[c] for c in ("lang", "source", "chunk", "n", "docs")), pa.array(single, mask=~one), several]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "chunk", "n", "docs", "number", "numbers"])


def chunk_counts(docs: DataFrame, most: int = HELD) -> DataFrame:
    """Counts by (lang, source, chunk) of each task: n occurrences, docs documents and, under LEAST, their numbers:
    ``number`` if it's one, as most are, since a list costs several times as much to write and read, or else ``numbers``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")

    def count(batches):
        return _singled(_count(batches, most))

    lang, source = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))
    return docs.select(lang, source, text, F.monotonically_increasing_id().alias("number")).mapInArrow(count, _COUNTS)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, chunk, docs), equal chunks next to one another, by the distinct terms of the chunk, with how often each is in it. A chunk is cut once."""
    last, own = None, {}
    for batch in batches:
        at, terms, times = [], [], []
        for i, chunk in enumerate(batch.column(1).to_pylist()):
            if chunk != last:
                last, own = chunk, Counter(_LETTERS.findall(chunk.lower()))
            at += [i] * len(own)
            terms += own.keys()
            times += own.values()
        found = [pa.array(terms, pa.binary()).cast(pa.string()), pa.array(times, pa.int64())]
        yield pa.RecordBatch.from_arrays([*batch.take(pa.array(at, pa.int64())).columns, *found], ["lang", "chunk", "docs", "term", "k"])


def _share(count: Column, total: Column, terms: Column) -> Column:
    return F.expr("1L") + F.call_function("div", F.lit(SCALE).cast("bigint") * (count + 2), total + 2 * terms)


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _shares(counts: np.ndarray, totals: np.ndarray, terms: int) -> np.ndarray:
    return 1 + SCALE * (counts + 2) // (totals + 2 * terms)


def _compare(key, members: pa.Table, counts: pa.Table, tile_size: int = TILE) -> pa.Table:
    """One bucket of two tiles: for each pair (a, b) of sources, the sum over the terms that either tile has, and how many these are."""
    if not counts.num_rows:
        return pa.table({"lang": pa.array([], pa.string()), **{c: pa.array([], pa.int64()) for c in ("a", "b", "value", "met")}})
    lang, _, first, second = (k.as_py() for k in key)
    member = members.to_pylist()[0]
    terms = np.asarray(counts["term"].combine_chunks().dictionary_encode().indices)
    places, n = counts["place"].to_numpy(), counts["n"].to_numpy()
    width, sides = int(terms.max()) + 1, []
    for tile, totals in ((first, member["left"]), (second, member["right"])):
        dense = np.zeros((len(totals), width), np.int64)
        own = places // tile_size == tile
        dense[places[own] % tile_size, terms[own]] = n[own]
        sides.append(_shares(dense, np.array(totals, np.int64)[:, None], member["terms"]))
    a, b, value = [], [], []
    for i, p in enumerate(sides[0]):
        q = sides[1]
        value.append(((p - q) ** 2 // (p + q)).sum(axis=1))
        a.append(np.full(len(q), first * tile_size + i))
        b.append(second * tile_size + np.arange(len(q)))
    size = sum(map(len, a))
    flat = [np.concatenate(x).astype(np.int64) for x in (a, b, value)]
    return pa.table({"lang": pa.array([lang] * size, pa.string()), "a": flat[0], "b": flat[1], "value": flat[2], "met": np.full(size, width, np.int64)})


def audit(docs: DataFrame, held: int = HELD, bucket: int = BUCKET, tile: int = TILE) -> DataFrame:
    """(lang, source, part, item, value, rank) of every group of ``docs``: part 'pair' has each other source of the
    language, part 'term' the RANKS terms that the group uses more than its language by most. The sizes decide what a task holds only."""
    scratch = Scratch(docs.sparkSession, "divergence")
    kept = scratch.keep
    counted = kept(chunk_counts(docs, held), "chunks")
    # Dealt by chunk at once: tasks have added up their own rows, so adding them up again before the shuffle finds little.
    sums = counted.select("lang", "source", "chunk", "n", "docs").repartition("chunk").groupBy("lang", "source", "chunk").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    sums = kept(sums, "sums")
    groups = sums.select("lang", "source").distinct()  # the chunk '' of texts without any is among them and has no terms
    whole = sums.repartition("chunk").groupBy("chunk", "lang").agg(F.sum("docs").alias("docs")).select("lang", "chunk", "docs")
    cut = kept(whole.sortWithinPartitions("chunk").mapInArrow(_cut, "lang string, chunk binary, docs bigint, term string, k bigint"), "terms")

    bounds = cut.groupBy("lang", "term").agg(F.max("docs").alias("low"), F.sum("docs").alias("high")).filter(F.col("high") >= LEAST)
    bounds = kept(bounds, "bounds")
    open_terms = bounds.filter(F.col("low") < LEAST).select("lang", "term")
    open_chunks = kept(cut.filter(F.col("docs") < LEAST).join(open_terms.hint("shuffle_hash"), ["lang", "term"]).select("lang", "chunk", "term"), "open")
    numbers = counted.filter(F.col("number").isNotNull() | F.col("numbers").isNotNull()).select("lang", "chunk", "number", "numbers")
    numbers = bloom.may_hold(numbers, bloom.build(open_chunks, WORDS, "lang", "chunk"), WORDS, "lang", "chunk")
    told = numbers.join(open_chunks.hint("shuffle_hash"), ["lang", "chunk"]).select("lang", "term", F.explode(F.coalesce("numbers", F.array("number"))).alias("number")).distinct()
    more = told.groupBy("lang", "term").agg(F.count("*").alias("docs")).filter(F.col("docs") >= LEAST).select("lang", "term")
    terms = kept(bounds.filter(F.col("low") >= LEAST).select("lang", "term").unionByName(more), "kept")
    scratch.drop("chunks", "bounds", "open")

    wanted = cut.join(terms.hint("shuffle_hash"), ["lang", "term"]).select("lang", "chunk", "term", "k")
    used = sums.join(wanted.hint("shuffle_hash"), ["lang", "chunk"]).groupBy("lang", "source", "term")
    used = kept(used.agg(F.sum(F.col("n") * F.col("k")).alias("n")), "used")
    sizes = terms.groupBy("lang").agg(F.count("*").alias("terms"))
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    known = groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").fillna(0, ["total", "terms"])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    known = kept(known.withColumn("place", place), "groups")
    scratch.drop("sums", "terms", "kept")
    return _pairs(used, known, bucket, tile).unionByName(_terms(used, known))


def _terms(used: DataFrame, known: DataFrame) -> DataFrame:
    whole = used.groupBy("lang", "term").agg(F.sum("n").alias("all"))
    totals = known.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    rows = used.join(whole, ["lang", "term"]).join(known, ["lang", "source"]).join(totals, "lang")
    p, q = _share(F.col("n"), F.col("total"), F.col("terms")), _share(F.col("all"), F.col("lang_total"), F.col("terms"))
    rows = rows.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).filter("p > q")
    rows = rows.withColumn("value", _apart(F.col("p"), F.col("q")))
    return _ranked(rows, "term").filter(F.col("rank") <= RANKS)


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def _pairs(used: DataFrame, known: DataFrame, bucket: int, size: int) -> DataFrame:
    tiles = known.groupBy("lang", F.floor(F.col("place") / size).alias("tile")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "total"))), lambda x: x["total"]).alias("totals"), F.max("terms").alias("terms")
    )
    buckets = F.ceil(F.col("terms") / bucket).cast("bigint")
    left = tiles.select("lang", F.col("tile").alias("first"), F.col("totals").alias("left"), "terms")
    right = tiles.select(F.col("lang").alias("lang2"), F.col("tile").alias("second"), F.col("totals").alias("right"))
    units = left.join(right, (F.col("lang") == F.col("lang2")) & (F.col("first") <= F.col("second"))).filter("terms > 0")
    units = units.select("lang", F.explode(F.sequence(F.lit(0).cast("bigint"), buckets - 1)).alias("bucket"), "first", "second", "left", "right", "terms")

    last = known.groupBy("lang").agg(F.floor(F.max("place") / size).alias("last"))
    rows = used.join(known.select("lang", "source", "place", "terms"), ["lang", "source"]).join(last, "lang")
    tile = F.floor(F.col("place") / size)
    rows = rows.select(
        "lang", F.pmod(F.xxhash64("term"), buckets).alias("bucket"), tile.alias("tile"), "term", F.col("place").cast("bigint").alias("place"), "n",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last"))).alias("other"),
    )
    rows = rows.select("lang", "bucket", F.least("tile", "other").alias("first"), F.greatest("tile", "other").alias("second"), "term", "place", "n")
    key = ["lang", "bucket", "first", "second"]

    def compare(key, members, counts):
        return _compare(key, members, counts, size)

    found = units.groupBy(*key).cogroup(rows.groupBy(*key)).applyInArrow(compare, "lang string, a bigint, b bigint, value bigint, met bigint")
    found = found.filter("a < b").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("met").alias("met"))
    found = found.unionByName(found.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value", "met"))

    one = known.select("lang", "source", F.col("place").cast("bigint").alias("a"), F.col("total").alias("own"), "terms")
    two = known.select("lang", F.col("source").alias("item"), F.col("place").cast("bigint").alias("b"), F.col("total").alias("others"))
    pairs = one.join(two, "lang").filter("a <> b").join(found, ["lang", "a", "b"], "left").fillna(0, ["value", "met"])
    none = F.lit(0).cast("bigint")
    absent = _apart(_share(none, F.col("own"), F.col("terms")), _share(none, F.col("others"), F.col("terms")))
    value = F.when(F.col("terms") == 0, none).otherwise(F.col("value") + (F.col("terms") - F.col("met")) * absent)
    return _ranked(pairs.withColumn("value", value), "pair")


def brute_sql() -> str:
    """DuckDB SQL for the rows of ``audit(documents)``."""
    return f"""
        WITH d AS (
            SELECT row_number() OVER () AS number, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '{TERM}') AS found FROM documents
        ), o AS (SELECT number, lang, source, unnest(found) AS term FROM d),
        k AS (SELECT lang, term FROM o GROUP BY ALL HAVING count(DISTINCT number) >= {LEAST}),
        c AS (SELECT lang, source, term, count(*) AS n FROM o JOIN k USING (lang, term) GROUP BY ALL),
        g AS (SELECT DISTINCT lang, source FROM d),
        v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
        gt AS (SELECT lang, source, CAST(coalesce(sum(n), 0) AS BIGINT) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
        lt AS (SELECT lang, CAST(sum(total) AS BIGINT) AS total FROM gt GROUP BY lang),
        lc AS (SELECT lang, term, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY ALL),
        p AS (
            SELECT lang, source, term, coalesce(c.n, 0) AS n, 1 + ({SCALE} * (coalesce(c.n, 0) + 2)) // (gt.total + 2 * v.v) AS p
            FROM gt JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)
        ), q AS (SELECT lang, term, 1 + ({SCALE} * (n + 2)) // (lt.total + 2 * v.v) AS q FROM lc JOIN lt USING (lang) JOIN v USING (lang)),
        pairs AS (
            SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
            FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ), part AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
        ), r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM part
        )
        SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= {RANKS}
    """
