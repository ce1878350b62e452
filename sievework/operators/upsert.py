"""Keyed updates: full outer joins that return the new table or its changes. Writing is a separate call."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.operators.dedupe import superseded_in_series
from sievework.operators.joins import both_sides, with_source_health


def upsert_news(existing: DataFrame, incoming: DataFrame, key: str = "url", keep_reviewed: bool = True) -> DataFrame:
    """M1: the new table with ``change``: inserted, updated (a strictly higher score), skipped or stored.

    Of several rows of a key the highest score counts, then the lowest ``seq``, stored and incoming alike; a null is a
    key. A reviewed status is kept unless ``keep_reviewed`` is false.
    """
    best = F.max_by(F.struct("*"), F.struct("score", -F.col("seq")))
    both = both_sides(existing, incoming, key, best, best)
    better = F.col("new.score") > F.col("old.score")
    change = F.when(F.col("old").isNull(), "inserted").when(F.col("new").isNull(), "stored").when(better, "updated").otherwise("skipped")
    out = both.withColumn("change", change)
    takes = F.col("change").isin("inserted", "updated")
    columns = []
    for c in existing.columns:
        value = F.when(takes, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}"))
        if c == "status" and keep_reviewed:
            value = F.when(F.col("old").isNotNull(), F.col("old.status")).otherwise(F.col("new.status"))
        columns.append(value.alias(c))
    return out.select(*columns, "change")


def _merged(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    return both_sides(existing, incoming, key, F.min(F.struct("*")), F.min(F.struct("*")))


def upsert_events(existing: DataFrame, incoming: DataFrame, now: Column, key: str = "url") -> DataFrame:
    """M2: seen times are always refreshed; content changes only while a row is pending; new rows are pending. A null is
    a key; of several rows of a key the least (by its columns in order) counts."""
    fixed = {key, "status", "scraped_at", "first_seen_at", "last_seen_at"}
    fresh, known = F.col("old").isNull(), F.col("new").isNotNull()
    columns = []
    for c in existing.columns:
        old, new = F.col(f"old.{c}"), F.col(f"new.{c}") if c in incoming.columns else F.lit(None)
        if c == key:
            value = F.col(key)
        elif c == "status":
            value = F.when(fresh, "pending").otherwise(old)
        elif c == "last_seen_at":
            value = F.when(known, now).otherwise(old)
        elif c in fixed:
            value = F.when(fresh, now).otherwise(old)
        else:
            value = F.when(fresh | (known & (F.col("old.status") == "pending")), new).otherwise(old)
        columns.append(value.alias(c))
    change = F.when(fresh, "inserted").when(~known, "stored").when(F.col("old.status") == "pending", "updated").otherwise("seen")
    return _merged(existing, incoming, key).select(*columns, change.alias("change"))


def upsert_jobs(existing: DataFrame, incoming: DataFrame, now: Column, key: str = "url") -> tuple[DataFrame, DataFrame]:
    """M3: (table, outcomes). Unknown: inserted as pending; archived: reactivated to pending; else updated, status kept.
    A null is a key; of several rows of a key the least (by its columns in order) counts."""
    both = _merged(existing, incoming, key)
    outcome = F.when(F.col("new").isNull(), "stored").when(F.col("old").isNull(), "inserted").when(F.col("old.status") == "archived", "reactivated").otherwise("updated")
    marked = both.withColumn("outcome", outcome)
    columns = []
    for c in existing.columns:
        old, new = F.col(f"old.{c}"), F.col(f"new.{c}") if c in incoming.columns else F.lit(None)
        if c == key:
            columns.append(F.col(key))
        elif c == "status":
            columns.append(F.when(F.col("outcome").isin("inserted", "reactivated"), "pending").otherwise(old).alias(c))
        elif c == "last_seen":
            columns.append(F.when(F.col("new").isNotNull(), now).otherwise(old).alias(c))
        else:
            columns.append(F.when(F.col("new").isNotNull(), F.coalesce(new, old)).otherwise(old).alias(c))
    return marked.select(*columns), marked.filter("outcome <> 'stored'").select(key, "outcome")


def stamp_sources(sources: DataFrame, outcomes: DataFrame, now: Column) -> DataFrame:
    """M4: the attempt is always stamped, success only if a row was written; the last error is kept."""
    seen = outcomes.groupBy("source_id").agg(F.sum("upserted").alias("upserted"), F.max_by("error", "seq").alias("new_error"))
    out = sources.join(seen, "source_id", "left")
    tried = F.col("upserted").isNotNull()
    return out.select(
        "source_id", F.when(tried, now).otherwise(F.col("last_attempt")).alias("last_attempt"),
        F.when(F.col("upserted") > 0, now).otherwise(F.col("last_success")).alias("last_success"),
        F.coalesce("new_error", "last_error").alias("last_error"),
    )


def sweep_jobs(jobs: DataFrame, sources: DataFrame, now: Column, grace: int = 8, health: int = 8) -> tuple[DataFrame, DataFrame]:
    """M5: (table, buckets). Approved and pending jobs that a healthy source no longer shows are archived."""
    live = F.col("status").isin("approved", "pending")
    marked = with_source_health(jobs, sources, now, grace, health).withColumn("bucket", F.when(live, F.col("bucket")).otherwise("not_swept"))
    gone = F.col("bucket") == "archive"
    table = marked.withColumn("status", F.when(gone, "archived").otherwise(F.col("status"))).withColumn("archived_at", F.when(gone, now))
    return table.select(*jobs.columns, "archived_at"), marked.groupBy("bucket").agg(F.count("*").alias("n"))


def sweep_events(events: DataFrame, today: Column) -> DataFrame:
    """M6: pending events whose date has passed are rejected."""
    past = (F.col("status") == "pending") & (F.col("event_date") < today)
    return events.withColumn("reason", F.when(past, "event_date_passed")).withColumn("status", F.when(past, "rejected").otherwise(F.col("status")))


def auto_reject(events: DataFrame, category_ids: DataFrame, reason: str, key: str = "event_id") -> DataFrame:
    """M7: named events are rejected while they are pending."""
    named = events.join(category_ids.select(key, F.lit(True).alias("_named")).distinct(), key, "left")
    hit = F.col("_named") & (F.col("status") == "pending")
    return named.withColumn("reason", F.when(hit, reason)).withColumn("status", F.when(hit, "rejected").otherwise(F.col("status"))).drop("_named")


def apply_series_collapse(events: DataFrame) -> DataFrame:
    """M8: superseded events of a series are rejected, unless they already were."""
    return auto_reject(events, superseded_in_series(events), "recurring_series_superseded")


def apply_classification(classified: DataFrame, now: Column) -> DataFrame:
    """M9: jobs with ``rules`` and ``reply`` become a change frame: rejected by a rule or by the reply, or pending
    with the reply's fields; a job whose reply is missing stays as it is."""
    rejected = F.col("rules.rejected")
    off = F.col("reply.relevant") == F.lit(False)
    outcome = F.when(rejected, F.col("rules.reason")).when(F.col("reply").isNull(), "scorer_error").when(off, "not_relevant").otherwise("passed")
    status = F.when(rejected | off, "rejected").when(F.col("reply").isNull(), F.col("status")).otherwise("pending")
    reason = F.when(F.col("outcome").isin("passed", "scorer_error"), F.lit(None)).otherwise(F.col("outcome"))
    return classified.withColumn("outcome", outcome).withColumn("new_status", status).withColumn("reason", reason).withColumn("classified_at", F.when(F.col("outcome") != "scorer_error", now))


def import_sources(existing: DataFrame, discovered: DataFrame, now: Column) -> DataFrame:
    """Active rows of the companies found anew are switched off, and fresh rows appended."""
    found = discovered.select("company_id").distinct().withColumn("_found", F.lit(True))
    old = existing.join(found, "company_id", "left").withColumn("is_active", F.coalesce("is_active", F.lit(False)) & F.col("_found").isNull()).drop("_found")
    fresh = discovered.withColumn("is_active", F.lit(True)).withColumn("discovered_at", now)
    return old.unionByName(fresh.select(*[c for c in fresh.columns if c in existing.columns]), allowMissingColumns=True)


def backfill_null(df: DataFrame, values: DataFrame, key: str, col: str) -> DataFrame:
    """One column is filled where it's null; the rest stays. A null is a key; of several values of a key the least counts."""
    new = values.groupBy(F.col(key).alias("_key")).agg(F.min(col).alias("_new"))
    return df.join(new, F.col(key).eqNullSafe(F.col("_key")), "left").withColumn(col, F.coalesce(col, "_new")).select(*df.columns)


def add_seen(seen: DataFrame, delivered: DataFrame, key: str = "url") -> DataFrame:
    """Seen keys and those delivered now, each once."""
    return seen.select(key).union(delivered.select(key)).distinct()


def changes_only(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Rows that a write would change, new ones included."""
    shared = [c for c in after.columns if c in before.columns and c != key]
    old = before.select(F.col(key).alias("_key"), *(F.col(c).alias(f"_{c}") for c in shared))
    differs = reduce(lambda a, b: a | b, (~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in shared), F.col("_key").isNull())
    return after.join(old, after[key] == F.col("_key"), "left").filter(differs).select(*after.columns)
