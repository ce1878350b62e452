"""N-gram Jaccard join by set-relation skipping.

A document's set is its distinct 4-word shingles (ASCII lower case; fewer words are one shingle); two documents link at a
Jaccard similarity of THRESHOLD or more, and a component is what links connect. The join is exact.

Equal sets are one set first. Index-level skipping: posting lists of the sets' prefixes hold size and place and are
ordered in blocks by size class and place; a pair of blocks whose sizes or places can't give enough overlap is skipped whole
(``sievework.operators.setjoin``). Answer-level skipping: the first pass over the lists gives each set its most similar
head, with the exact overlap. The pairs that are left (sets of different components) are then answered from their heads' answer:
with the overlap o of heads h(x), h(y) counted once,

    o - |h(x) - x| - |h(y) - y|  <=  overlap of x and y  <=  o + |x - h(x)| + |y - h(y)|,

and all four differences are known, so a crowd of near copies beside another crowd costs one comparison of heads and a row of
arithmetic for each pair; only pairs that the bounds and wide sketches leave open are counted on their texts. A pair of heads with a
single pair below it isn't asked for: the pair itself is counted.

Shingles are 64-bit hashes (a chance of 2**-64 for two of a pair to fall together); sets are told apart by 128 bits. The
order of a prefix puts shingles last that are common in a sample of one text in SAMPLE; any order gives the same
answers. A hot set, list or head is pre-aggregated, streamed or compared in parts; nothing is collected but the
COMMON most common shingles.

Defined cases: null, empty and blank texts have an empty set, n_shingles 0, and are linked with nothing, not even one another: each such
row's component is its own id; repeated rows are rows of one set; rows without an id get their component but never
name it; columns but id and text aren't read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.simhash import components
from sievework.llm.textbatch import Words, slices, utf8
from sievework.operators import bloom, setjoin
from sievework.operators.graphs import Scratch

THRESHOLD, WORDS = 0.85, 4
#: One text in SAMPLE is read for the order of shingles; the COMMON most common go last.
SAMPLE, COMMON = 16, 65_536
#: Bytes of texts whose words are found at a time, which needs some dozens of bytes for each (more for one text that is longer).
SLICE = 1 << 18
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def sets_of(column: pa.Array, size: int = WORDS) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, sorted."""
    data, offsets = utf8(column)
    for _, part, places in slices(data, offsets, SLICE):
        words = Words(_LOWER[part], places)
        counts = np.bincount(words.texts, minlength=len(places) - 1)
        first, hashes = words.windows(*range(size))
        ends = np.searchsorted(words.texts[first], np.arange(len(places)))
        begins = np.concatenate([[0], np.cumsum(counts)])
        for i, n in enumerate(counts.tolist()):
            if n >= size:
                yield np.unique(hashes[ends[i] : ends[i + 1]].view(np.int64))
            elif n:
                own = words.hashes[begins[i] : begins[i + 1]].tobytes()
                yield np.frombuffer(blake2b(own, digest_size=8).digest(), np.int64)
            else:
                yield np.zeros(0, np.int64)


def _items(text: bytes) -> np.ndarray:
    return next(sets_of(pa.array([text.decode()], pa.string())))


def derived(near: DataFrame, heads: DataFrame, sizes: DataFrame, count, bar: setjoin.Bar, keep) -> DataFrame:
    """The pairs (x, y) of ``near`` that are links, as (a, b): answered from the heads' answers where these decide.

    ``heads`` is (sid, head, both) with one row for each set that has a head, ``sizes`` (sid, m), and ``count`` gives
    (x, y, both) for pairs that have to be counted.
    """
    related = sizes.join(heads, "sid", "left").join(sizes.select(F.col("sid").alias("head"), F.col("m").alias("mh")), "head", "left")
    plain = F.col("head").isNull()
    related = related.select(
        "sid", "m", F.coalesce("head", "sid").alias("head"),
        F.when(plain, 0).otherwise(F.col("m") - F.col("both")).alias("own"), F.when(plain, 0).otherwise(F.col("mh") - F.col("both")).alias("lacks"),
    )
    sides = [related.select(*(F.col(c).alias(f"{c}_{s}") for c in related.columns)) for s in "xy"]
    pairs = near.join(sides[0], F.col("x") == F.col("sid_x")).join(sides[1], F.col("y") == F.col("sid_y"))
    pairs = keep(pairs.withColumns({"hx": F.least("head_x", "head_y"), "hy": F.greatest("head_x", "head_y")}), "related")
    asked = pairs.filter("hx <> hy").groupBy("hx", "hy").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("hx").alias("x"), F.col("hy").alias("y"))
    answers = count(asked, "heads").select(F.col("x").alias("hx"), F.col("y").alias("hy"), "both")
    known = pairs.join(answers, ["hx", "hy"], "left")
    least, enough = F.col("m_x") + F.col("m_y"), lambda both: setjoin.similar(bar, both, F.col("m_x"), F.col("m_y"))
    low = enough(F.col("both") - F.col("lacks_x") - F.col("lacks_y"))
    high = enough(F.least(F.col("both") + F.col("own_x") + F.col("own_y"), least))
    known = keep(known.select("x", "y", "m_x", "m_y", F.coalesce(low, F.lit(False)).alias("sure"), F.coalesce(high, F.lit(True)).alias("may")), "answers")
    counted = count(known.filter("may AND NOT sure").select("x", "y"), "open").join(known.select("x", "y", "m_x", "m_y"), ["x", "y"])
    links = counted.filter(enough(F.col("both"))).select("x", "y").unionByName(known.filter("sure").select("x", "y"))
    return links.select(F.col("x").alias("a"), F.col("y").alias("b"))


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    spark, bar = docs.sparkSession, setjoin.Bar(threshold)
    scratch = Scratch(spark, "setrelation")
    keep = scratch.keep
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    sample = rows.select("t").filter(F.pmod(F.xxhash64("t"), F.lit(SAMPLE)) == 0).distinct()
    common = setjoin.order(sample, sets_of, COMMON)
    about = keep(setjoin.describe(rows.select("doc_id", F.xxhash64("t").alias("mark"), "t"), sets_of, bar, common), "about")
    same = about.filter("m > 0").groupBy("hi", "lo").agg(
        F.min("doc_id").alias("first"), F.min(F.struct("mark", "doc_id")).alias("text"), *(F.first(c).alias(c) for c in ("m", *setjoin.SKETCH, "rare", "wide"))
    )
    sets = keep(same.withColumn("sid", F.monotonically_increasing_id()), "sets")
    sizes = sets.select("sid", "m")

    def texts(wanted: DataFrame) -> DataFrame:
        asked = sets.join(wanted, "sid").select("sid", "text.mark", "text.doc_id")
        marked = rows.withColumn("mark", F.xxhash64("t"))
        held = bloom.may_hold(marked, bloom.build(asked, setjoin.WORDS, "mark", "doc_id"), setjoin.WORDS, "mark", "doc_id")
        asked = asked.withColumnsRenamed({"mark": "mark2", "doc_id": "doc_id2"})
        return held.join(asked, (F.col("mark") == F.col("mark2")) & F.col("doc_id").eqNullSafe(F.col("doc_id2"))).select("sid", "t").dropDuplicates(["sid"])

    def count(near: DataFrame, name: str) -> DataFrame:
        asked = near if name == "heads" else setjoin.alike(near, sets, bar)  # what unlike heads share is wanted, too
        return setjoin.overlaps(asked, texts, _items, keep, name)

    near, crowded = setjoin.stars(sets, bar, keep)
    met = count(near, "first").join(sizes.select(F.col("sid").alias("x"), F.col("m").alias("mx")), "x").join(sizes.select(F.col("sid").alias("y"), F.col("m").alias("my")), "y")
    met = keep(met.filter(setjoin.similar(bar, F.col("both"), F.col("mx"), F.col("my"))), "first-links")
    heads = met.groupBy(F.col("y").alias("sid")).agg(F.max(F.struct("both", (-F.col("x")).alias("x"))).alias("best")).select("sid", (-F.col("best.x")).alias("head"), "best.both")
    first = met.select(F.col("x").alias("a"), F.col("y").alias("b"))
    roots = components(first, spark).select(F.col("fp").alias("node"), "root")
    second = keep(derived(setjoin.apart(sets, crowded, roots, bar), keep(heads, "chosen"), sizes, count, bar, keep), "second-links")
    labels = components(first.unionByName(second), spark)
    named = sets.join(labels, sets["sid"] == labels["fp"], "left").select("hi", "lo", F.coalesce("root", "sid").alias("root"), "first")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = keep(named.join(least, "root").select("hi", "lo", "component_id"), "named")
    found = keep(about.select("doc_id", "hi", "lo", "m").join(named, ["hi", "lo"], "left"), "found")
    used = [f"{name}{part}" for name in ("first", "heads", "open") for part in ("", "-near", "-texts")]
    scratch.drop("about", "sets", "stars", "chosen", "related", "answers", "named", "first-links", "second-links", *used)
    own = F.when(F.col("m") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", F.col("m").alias("n_shingles"), own.alias("component_id"))


def brute_sql() -> str:
    """DuckDB SQL for the rows of ``join(documents)``, where ids are distinct and not null."""
    return r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), s AS (
            SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END) AS g FROM w
        ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
        l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i.n >= 85 * (x.n + y.n - i.n)),
        e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
        r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
        SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, least(w.doc_id, coalesce(min(r.b), w.doc_id)) AS component_id
        FROM w LEFT JOIN n USING (doc_id) LEFT JOIN r ON r.a = w.doc_id GROUP BY w.doc_id
    """
