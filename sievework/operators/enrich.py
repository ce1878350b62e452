"""Scorers: objects with ``score(rows) -> list of dicts`` that run inside Arrow batches.

The scorers shipped here are deterministic rules; any other object with that method can be passed. A
reply is a JSON text for each row, so replies go through the same repair and checks as a model's.
"""

from __future__ import annotations

import json
import time
from typing import Any, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sievework.functions import wordlists as W
from sievework.functions.jsonx import has_fields, repair_json
from sievework.operators.dedupe import assign_batches
from sievework.operators.joins import attach_scores

NEWS_REPLY = "score int, category string, reason string, summary string, tags array<string>"
JOB_REPLY = "relevant boolean, seniority string, employment_type string, remote_status string, job_function string, summary string"
EVENT_REPLY = "name string, date string, location string, description string, relevance_category string, extraction_confidence string"


class RuleNewsScorer:
    """Scores 1 to 5 by how many salvage signals a title and text have."""

    def score(self, rows: list[dict[str, Any]]) -> list[dict[str, Any]]:
        out = []
        for row in rows:
            text = f"{row.get('title') or ''} {row.get('snippet') or ''}".lower()
            hits = [t for t in W.SALVAGE_SIGNALS if t in text]
            noise = any(t in text for t in W.NOISE_TOPICS)
            out.append({"score": 1 if noise else min(5, 1 + len(hits)), "category": hits[0] if hits else "other", "reason": ",".join(hits), "summary": text.strip()[:150], "tags": hits[:5]})
        return out


class RuleJobScorer:
    """Classifies a job by words of its title."""

    def score(self, rows: list[dict[str, Any]]) -> list[dict[str, Any]]:
        out = []
        for row in rows:
            title = (row.get("title") or "").lower()
            level = next((k for k in W.SENIORITY if k in title), "mid")
            kind = next((f for f in W.FUNCTIONS if f.split(" ")[0].lower()[:6] in title), "Other")
            out.append({"relevant": not any(t in title for t in W.SCORE_UNRELATED), "seniority": level, "employment_type": "full_time", "remote_status": "onsite", "job_function": kind, "summary": title[:150]})
        return out


class RuleEventScorer:
    """Reads an event record from a page's title and text."""

    def score(self, rows: list[dict[str, Any]]) -> list[dict[str, Any]]:
        out = []
        for row in rows:
            text = row.get("text") or ""
            relevant = any(t in text.lower() for t in W.SALVAGE_SIGNALS)
            out.append({"name": (row.get("title") or "").strip()[:120], "date": None, "location": None, "description": text[:300], "relevance_category": "relevant" if relevant else "not_relevant", "extraction_confidence": "low"})
        return out


class ExcerptScorer:
    """The text up to its last sentence within a limit."""

    def __init__(self, most: int = 400) -> None:
        self.most = most

    def score(self, rows: list[dict[str, Any]]) -> list[dict[str, Any]]:
        return [{"excerpt": (row.get("text") or "")[: self.most].rsplit(".", 1)[0].strip() or "null"} for row in rows]


class Retry:
    """A scorer that is tried again after 2, 4, ... seconds, then fails its task."""

    def __init__(self, scorer: Any, attempts: int = 3, pause: float = 2.0) -> None:
        self.scorer, self.attempts, self.pause = scorer, attempts, pause

    def score(self, rows: list[dict[str, Any]]) -> list[dict[str, Any]]:
        for attempt in range(1, self.attempts + 1):
            try:
                return self.scorer.score(rows)
            except Exception:
                if attempt == self.attempts:
                    raise
                time.sleep(self.pause**attempt)
        raise AssertionError


def with_retry(scorer: Any, attempts: int = 3) -> Retry:
    return Retry(scorer, attempts)


def replies(df: DataFrame, keys: list[str], inputs: list[str], scorer: Any, size: int = 15) -> DataFrame:
    """``keys`` and ``reply`` (JSON text) of every row; the scorer sees ``size`` rows at a time."""
    schema = df.select(*keys).schema.add("reply", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), size):
                part = batch.slice(at, size)
                found = scorer.score(part.select(inputs).to_pylist())
                columns = [part.column(part.schema.get_field_index(k)) for k in keys]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([json.dumps(x) for x in found], pa.string())], [*keys, "reply"])

    return df.select(*dict.fromkeys([*keys, *inputs])).mapInArrow(run, schema)


def carried(df: DataFrame, inputs: list[str], scorer: Any, size: int = 15, into: str = "reply", error: str = "reply_error") -> DataFrame:
    """``df`` with two new columns, in one Arrow stage and without a shuffle: ``into`` is the JSON text of a row's reply, ``error`` a struct
    of kind and message, null if there is none.

    The scorer sees ``size`` rows at a time. Where it fails, or replies to another number of rows, the rows of that batch stay, with
    a null reply and the error; so does a row whose reply is null or can't be written as JSON. Columns of the new names are replaced.
    """
    kept = [c for c in df.columns if c not in (into, error)]
    problem = pa.struct([("kind", pa.string()), ("message", pa.string())])
    schema = df.select(*kept).schema.add(into, "string").add(error, StructType().add("kind", "string").add("message", "string"))

    def answers(part: pa.RecordBatch) -> tuple[list[str | None], list[dict | None]]:
        try:
            found = scorer.score(part.select(inputs).to_pylist())
            if len(found) != len(part):
                raise ValueError(f"{len(found)} replies to {len(part)} rows")
            return [None if x is None else json.dumps(x) for x in found], [None] * len(part)
        except Exception as e:  # whatever a scorer raises belongs to its rows
            return [None] * len(part), [{"kind": type(e).__name__, "message": str(e)[:500]}] * len(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, problems = [], []
            for at in range(0, len(batch), size):
                more, bad = answers(batch.slice(at, size))
                texts += more
                problems += bad
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string()), pa.array(problems, problem)], [*kept, into, error])

    return df.select(*kept).mapInArrow(run, schema)


def score_batches(df: DataFrame, scorer: Any | None = None, size: int = 15, order: str = "seq") -> tuple[DataFrame, DataFrame]:
    """(scored rows, rows without a usable reply). A reply is joined on its batch and place."""
    batches = assign_batches(df, size, order=order)
    keys = ["bucket", "batch", "idx"]
    found = replies(batches, keys, ["title", "snippet"], scorer or RuleNewsScorer(), size)
    parsed = found.withColumn("r", repair_json(F.col("reply"), NEWS_REPLY)).filter(F.col("r.score").isNotNull() & has_fields(F.col("reply"), ["score", "reason"]))
    scored, missing = attach_scores(batches, parsed.select(*keys, "r"))
    return scored.select(*df.columns, "r.*"), missing.select(*df.columns)


def classify_rows(df: DataFrame, scorer: Any | None = None, key: str = "job_id") -> DataFrame:
    """Rows with the struct ``reply``, null if it couldn't be had or read, and ``reply_error``."""
    found = carried(df, ["title"], scorer or RuleJobScorer())
    return found.withColumn("reply", repair_json(F.col("reply"), JOB_REPLY))


def extract_events(pages: DataFrame, scorer: Any | None = None, key: str = "page_id") -> DataFrame:
    """Event records of pages with title and text, and ``reply_error``; a category off the list is null."""
    found = carried(pages.select(*dict.fromkeys([key, "title", "text"])), ["title", "text"], scorer or RuleEventScorer())
    parsed = found.select(key, repair_json(F.col("reply"), EVENT_REPLY).alias("r"), "reply_error").select(key, "r.*", "reply_error")
    known = F.col("relevance_category").isin("relevant", "maybe", "not_relevant")
    return parsed.withColumn("relevance_category", F.when(known, F.col("relevance_category")))


def enrich_rows(df: DataFrame, scorer: Any | None = None, key: str = "seq") -> DataFrame:
    """Summary and tags of rows with title and snippet, and ``reply_error``."""
    found = carried(df.select(*dict.fromkeys([key, "title", "snippet"])), ["title", "snippet"], scorer or RuleNewsScorer())
    return found.select(key, repair_json(F.col("reply"), NEWS_REPLY).alias("r"), "reply_error").select(key, "r.summary", "r.tags", "reply_error")


def excerpt_rows(df: DataFrame, scorer: Any | None = None, max_chars: int = 400, key: str = "doc_id") -> DataFrame:
    """An excerpt of at most so many characters, and ``reply_error``; the word null is null."""
    found = carried(df.select(*dict.fromkeys([key, "text"])), ["text"], scorer or ExcerptScorer(max_chars))
    text = F.left(F.get_json_object("reply", "$.excerpt"), F.lit(max_chars))
    return found.select(key, F.when(F.lower(text) != "null", text).alias("excerpt"), "reply_error")
