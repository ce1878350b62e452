"""Counts and summaries. Each is one aggregate over one scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions import wordlists as W


def n_if(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


def job_snapshot(jobs: DataFrame, sources: DataFrame) -> DataFrame:
    """A1: jobs by status and without a function, and the names of active sources never scraped."""
    counts = jobs.agg(*(n_if(F.col("status") == s, s) for s in ("approved", "pending", "rejected", "archived")), n_if((F.col("status") == "pending") & F.col("job_function").isNull(), "pending_without_function"))
    never = sources.filter(F.col("is_active") & F.col("last_success").isNull()).agg(F.array_join(F.sort_array(F.collect_set("name")), ", ").alias("never_scraped"), F.count("*").alias("n_never_scraped"))
    return counts.crossJoin(never)  # one row and one row


def event_snapshot(events: DataFrame, today: Column) -> DataFrame:
    """A2: verified events to come, and pending and rejected ones."""
    return events.agg(n_if((F.col("status") == "verified") & (F.col("event_date") >= today), "verified_upcoming"), n_if(F.col("status") == "pending", "pending"), n_if(F.col("status") == "rejected", "rejected"))


def status_distribution(df: DataFrame) -> DataFrame:
    """A3: rows by status and reason, a dash for null."""
    dash = lambda c: F.coalesce(F.col(c), F.lit("—"))
    return df.groupBy(dash("status").alias("status"), dash("reason").alias("reason")).agg(F.count("*").alias("n"))


def step_summary(run_log: DataFrame) -> DataFrame:
    """A4: each step's sums and status: failed, warning without rows, or success."""
    out = run_log.groupBy("step").agg(F.sum("jobs_found").alias("scraped"), F.sum("inserted").alias("new"), F.sum(F.col("updated") + F.col("reactivated")).alias("updated"), F.count("*").alias("sources"), n_if(F.col("errors") > 0, "sources_with_errors"))
    return out.withColumn("status", F.when(F.col("sources_with_errors") == F.col("sources"), "failed").when(F.col("scraped") == 0, "warning").otherwise("success"))


def tier_counts(scored: DataFrame) -> DataFrame:
    """A5: rows by tier of the score; others count in the total only."""
    s = F.coalesce(F.col("score").try_cast("int"), F.lit(0))
    return scored.agg(n_if(s == 5, "tier5"), n_if(s == 4, "tier4"), n_if(s == 3, "tier3"), n_if(s.between(1, 2), "low"), F.count("*").alias("total"))


def source_mix(scored: DataFrame) -> DataFrame:
    """Rows by source."""
    return scored.groupBy("source").agg(F.count("*").alias("n"))


def feed_stats(articles: DataFrame) -> DataFrame:
    """Each feed's rows, drops, unknown dates, and range of dates."""
    return articles.groupBy("feed").agg(
        F.count("*").alias("total"), n_if(F.col("stage") == "date_dropped", "date_dropped"), n_if(F.col("published").isNull(), "unknown_date"),
        n_if(F.col("stage") == "kept", "kept"), n_if(F.col("stage") == "cap_dropped", "cap_dropped"), F.min("published").alias("oldest"), F.max("published").alias("newest"),
    )


def intake_funnel(articles: DataFrame) -> DataFrame:
    """Rows that reach each stage."""
    reached = lambda *out: ~F.col("stage").isin(*out)
    return articles.agg(
        F.count("*").alias("fetched"), n_if(reached("date_dropped"), "after_date"), n_if(reached("date_dropped", "cap_dropped"), "after_cap"),
        n_if(reached("date_dropped", "cap_dropped", "duplicate"), "after_dedupe"), n_if(F.col("stage") == "kept", "final"),
    )


def archive_breakdown(changes: DataFrame, by: str = "company") -> DataFrame:
    """Archived rows by company."""
    return changes.filter(F.col("bucket") == "archive").groupBy(by).agg(F.count("*").alias("n"))


def extraction_report(extractions: DataFrame) -> DataFrame:
    """A10: outcomes, and events by category, in one pass by grouping sets."""
    return extractions.rollup("outcome", "category").agg(F.count("*").alias("n"), F.grouping_id().cast("bigint").alias("level"))


def discovery_breakdown(results: DataFrame) -> DataFrame:
    """Results by platform, by confidence and by scrapability, in one pass."""
    keys = ["ats_platform", "confidence", "scrapability"]
    sets = results.groupingSets([[F.col(k)] for k in keys], *(F.col(k) for k in keys))
    name = F.when(F.grouping(keys[0]) == 0, keys[0]).when(F.grouping(keys[1]) == 0, keys[1]).otherwise(keys[2])
    return sets.agg(name.alias("dimension"), F.coalesce(*keys).alias("value"), F.count("*").alias("n")).select("dimension", "value", "n")


def job_mix(jobs: DataFrame) -> DataFrame:
    """Jobs by source and relevance."""
    return jobs.groupBy("source", "relevancy").agg(F.count("*").alias("n"))


def rejection_audit(candidates: DataFrame, reasons: list[str]) -> DataFrame:
    """Each source's candidates by the head of their reason; accepted where there is none."""
    head = F.when(F.col("reason").isNull(), "accepted").otherwise(F.regexp_extract("reason", "^([a-z_]+)", 1))
    return candidates.groupBy("source_id").agg(*(n_if(head == r, r) for r in ["accepted", *reasons]))


def freshness(df: DataFrame, ts_col: str, now: Column) -> DataFrame:
    """The newest time and whole hours since."""
    newest = F.max(F.col(ts_col).cast("timestamp"))
    return df.agg(newest.alias("newest"), F.floor((F.unix_timestamp(now) - F.unix_timestamp(newest)) / 3600).alias("hours_since"))


def run_totals(run_log: DataFrame) -> DataFrame:
    """Sums over all sources."""
    return run_log.agg(*(F.sum(c).alias(c) for c in ("jobs_found", "inserted", "updated", "reactivated", "errors")), F.count("*").alias("sources"))


def backfill_estimate(jobs: DataFrame, unit_cost: float = 0.0001, min_chars: int = 50, text: str = "text") -> DataFrame:
    """Rows in all, rows to skip and to process, and the cost in millionths."""
    enough = F.length(F.coalesce(text, F.lit(""))) >= min_chars
    return jobs.agg(F.count("*").alias("total"), n_if(~enough, "skippable"), n_if(enough, "processable"), (F.count_if(enough) * round(unit_cost * 1_000_000)).alias("cost_micro"))


def status_mix(jobs: DataFrame) -> DataFrame:
    """Rows by status."""
    return jobs.groupBy("status").agg(F.count("*").alias("n"))


def silent_sources(sources: DataFrame, discovered: DataFrame) -> DataFrame:
    """Sources that ran without error and yielded nothing, and sources that failed."""
    n = discovered.groupBy("source_id").agg(F.sum("n").alias("n"))
    state = sources.join(n, "source_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    kind = F.when(~F.col("ok"), "failed").when(F.col("n") == 0, "silent")
    return state.withColumn("kind", kind).filter(F.col("kind").isNotNull()).select("source_id", "kind")


def classifier_tally(classified: DataFrame) -> DataFrame:
    """Rows by outcome."""
    return classified.groupBy("outcome").agg(F.count("*").alias("n"))


def group_sizes(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of each group."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def order_rank(c: Column, order: list[str] = W.SENIORITY_ORDER) -> Column:
    """Place in a custom order, from 1; values outside it come after."""
    place = F.array_position(F.array(*(F.lit(x.lower()) for x in order)), F.lower(c))
    return F.when(c.isNull() | (place == 0), len(order) + 1).otherwise(place)
