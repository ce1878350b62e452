"""Secret scans with corpus-wide ownership.

Base kinds (assign, access, hex) are found by fixed patterns, leftmost and non-overlapping within a
kind. Wider kinds (``WIDER``) are candidates only. Every candidate's value is hashed, and over the
whole corpus each hash is counted by distinct owners and distinct repositories. A value of
EXAMPLE_OWNERS owners, or of EXAMPLE_REPOSITORIES repositories that aren't all one owner's, is a widely
copied example; any other looks like a live credential of those who hold it, in however many of their
own repositories. Spans of a base kind always stay; spans of a wider kind are added if they look live.

A repository is (owner, repository columns); for ``documents`` the owner is the source and the
repository its source and language.

Defined cases: null and empty texts have no spans; offsets are code points; a null owner is an
owner of its own; repeated rows have equal spans and count once; other columns pass through, but for one
with the name of the new column, which is replaced.
"""

from __future__ import annotations

import hashlib
import re
from typing import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sievework.llm.skew import cut, join_hot

#: Base kinds in the order that breaks ties.
KINDS = ("assign", "access", "hex")
#: A value with at least so many distinct owners is a widely copied example.
EXAMPLE_OWNERS = 5
#: So is one in so many repositories of two owners or more.
EXAMPLE_REPOSITORIES = 10

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_HEX_RUN = re.compile(r"[0-9a-f]{24,}")
#: Further credential shapes: (kind, lower-case text that must occur, pattern).
WIDER = (
    ("private_key", "-----begin", re.compile(r"-----BEGIN ([A-Z ]*PRIVATE KEY)-----(?:(?!-----BEGIN ).)*?-----END \1-----", re.DOTALL)),
    ("jwt", "eyj", re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+")),
    ("url_login", "://", re.compile(r"\b[a-z][a-z0-9+.-]{1,15}+://[^\s:/@]++:(?P<value>[^\s:/@]{3,}+)@", re.IGNORECASE)),
    ("bearer", "bearer ", re.compile(r"\bbearer [A-Za-z0-9._~+/-]{20,}+=*+", re.IGNORECASE)),
)


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the base kinds, by start and then by kind."""
    out = []
    low = text.lower()
    if any(x in low for x in _ASSIGN_WORDS):
        out += [("assign", m.start(), m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end(), m[0]) for m in _HEX_RUN.finditer(text)]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def wider_spans(text: str) -> list[tuple[str, int, int, str]]:
    """Candidates of further kinds; the value is the group of that name, or else the whole match."""
    low = text.lower()
    return [(kind, m.start(), m.end(), m.groupdict().get("value") or m[0]) for kind, must, pattern in WIDER if must in low for m in pattern.finditer(text)]


def _scan(text: str | None) -> list[dict]:
    if not text:
        return []
    return [
        {"kind": k, "first": a, "last": b, "value": hashlib.sha256(v.encode()).hexdigest()} for k, a, b, v in base_spans(text) + wider_spans(text)
    ]


def candidates(docs: DataFrame, text: str = "text", into: str = "candidates") -> DataFrame:
    """``docs`` with an array of (kind, first, last, SHA-256 of the value) in the new column ``into``."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("first", pa.int32()), ("last", pa.int32()), ("value", pa.string())]))

    @F.arrow_udf("array<struct<kind: string, first: int, last: int, value: string>>")
    def scan(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array([_scan(x.as_py()) for x in column], kind)

    return docs.withColumn(into, scan(F.col(text).cast("string")))


def ownership(found: DataFrame, owner: list[str], repository: list[str]) -> DataFrame:
    """(value, n_owners, n_repositories) of every candidate of a frame with ``candidates``.

    Equal (value, owner, repository) meet in the map-side aggregate first, so a value that a third of
    all rows hold sends one row for each task and repository.
    """
    rows = found.select(
        F.explode("candidates.value").alias("value"),
        F.struct(*(F.col(c) for c in owner)).alias("o"), F.struct(*(F.col(c) for c in owner + repository)).alias("r"),
    ).distinct()
    by_owner = rows.groupBy("value", "o").agg(F.count("*").alias("n"))
    return by_owner.groupBy("value").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repositories"))


def is_example(owners: str = "n_owners", repositories: str = "n_repositories") -> Column:
    """True for values that are widely copied."""
    return (F.col(owners) >= EXAMPLE_OWNERS) | (F.col(owners) > 1) & (F.col(repositories) >= EXAMPLE_REPOSITORIES)


def scan(docs: DataFrame, key: list[str], owner: list[str], repository: list[str], text: str = "text") -> DataFrame:
    """``key`` columns, one row per row of ``docs``, with ``spans``: an array of
    (kind, first, last, n_owners, n_repositories, live) by place and kind."""
    spark = docs.sparkSession
    names = {c: f"k{i}" for i, c in enumerate(dict.fromkeys(key + owner + repository))}
    base = docs.select(*(F.col(c).alias(n) for c, n in names.items()), F.col(text).alias("text"))
    found = candidates(base).drop("text").withColumn("row", F.monotonically_increasing_id())
    found = cut(found, spark)  # the scan of the texts is needed twice; only spans are written
    owned = cut(ownership(found, [names[c] for c in owner], [names[c] for c in repository]), spark)
    spans = (
        join_hot(found.select("row", F.explode("candidates").alias("c")).select("row", "c.*"), owned, "value")
        .withColumn("live", ~is_example())
        .filter(F.col("kind").isin(*KINDS) | F.col("live"))
        .withColumn("turn", _turn(F.col("kind")))
        .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("first", "turn", "kind", "last", "n_owners", "n_repositories", "live"))).alias("spans"))
    )
    none = F.array().cast(spans.schema["spans"].dataType)
    return found.join(spans, "row", "left").select(*(F.col(names[c]).alias(c) for c in key), F.coalesce("spans", none).alias("spans"))


def _turn(kind: Column) -> Column:
    order = [*KINDS, *(k for k, _, _ in WIDER)]
    return F.coalesce(*(F.when(kind == k, F.lit(i)) for i, k in enumerate(order)))


def redact(docs: DataFrame, owner: list[str], repository: list[str], text: str = "text") -> DataFrame:
    """``docs`` with every live-looking span of ``text`` replaced by ``[SECRET:kind]``; widely copied examples stay.

    Spans that overlap are replaced as one. Only the rows with a candidate are written out and joined
    with verdicts; all other texts stay where they are and aren't shuffled.
    """
    spark = docs.sparkSession
    whole = candidates(docs.select(F.struct("*").alias("doc")), f"doc.`{text}`", "candidates")
    hit = cut(whole.filter(F.size("candidates") > 0).withColumn("row", F.monotonically_increasing_id()), spark)
    names = {c: f"k{i}" for i, c in enumerate(dict.fromkeys(owner + repository))}
    held = hit.select(*(F.col(f"doc.`{c}`").alias(n) for c, n in names.items()), "candidates")
    owned = ownership(held, [names[c] for c in owner], [names[c] for c in repository])
    common = cut(owned.filter(is_example()).select("value", F.lit(True).alias("example")), spark)
    live = (
        join_hot(hit.select("row", F.explode("candidates").alias("c")).select("row", "c.*"), common, "value", "left")
        .filter(F.col("example").isNull())
        .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("first", "last", "kind"))).alias("live"))
    )

    @F.arrow_udf(StringType())
    def masked(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array([mask(t.as_py(), s.as_py()) for t, s in zip(texts, spans, strict=True)], pa.string())

    changed = hit.join(live, "row", "left").select(
        *(masked(F.col(f"doc.`{c}`"), F.col("live")).alias(c) if c == text else F.col(f"doc.`{c}`").alias(c) for c in docs.columns)
    )
    return whole.filter(F.size("candidates") == 0).select("doc.*").unionByName(changed)


def mask(text: str | None, spans: list[dict] | None) -> str | None:
    if not text or not spans:
        return text
    out, at = [], 0
    for span in spans:
        if span["first"] >= at:
            out += [text[at : span["first"]], f"[SECRET:{span['kind']}]"]
        at = max(at, span["last"])
    return "".join([*out, text[at:]])
