"""Reports as rows (section, place, line). A line's place is a number inside its section, so nothing depends on the order of rows.

Sections that list rows are limited by their definition (a look-back, a top n); totals are one-row aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.dates import event_date_text, month_bucket
from sievework.functions.text import escape_md, meta_line
from sievework.operators import metrics as A
from sievework.operators import ranking as O
from sievework.operators.dedupe import in_window


def _listed(df: DataFrame, section: Column, order: list, line: Column) -> DataFrame:
    """Lines of sections that may hold any number of rows, numbered inside each without gathering one in a task."""
    rows = df.withColumn("section", section).withColumn("line", line)
    return O.place_in_group(rows, ["section"], order).select("section", "place", "line")


def _numbered(df: DataFrame, section: Column | str, order: list, line: Column) -> DataFrame:
    """Lines of short sections (figures, top lists), numbered inside each."""
    rows = df.withColumn("section", F.lit(section) if isinstance(section, str) else section)
    place = F.row_number().over(Window.partitionBy("section").orderBy(*order))
    return rows.withColumn("place", place.cast("bigint")).withColumn("line", line).select("section", "place", "line")


def _facts(row: DataFrame, section: str) -> DataFrame:
    """A one-row frame as lines ``name: value``."""
    names = [c for c in row.columns]
    lines = F.array(*(F.struct(F.lit(i + 1).cast("bigint").alias("place"), F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit("—"))).alias("line")) for i, c in enumerate(names)))
    return row.select(F.lit(section).alias("section"), F.inline(lines))


def research_digest(scored: DataFrame, jobs: DataFrame, failed: DataFrame, core: list[str], n_jobs: int = 30) -> DataFrame:
    """Articles by tier, the jobs longlist, failed sources, run statistics and source mix."""
    s = F.coalesce(F.col("score").try_cast("int"), F.lit(0))
    tier = F.when(s.between(3, 5), F.concat(F.lit("tier "), s)).when(s.between(1, 2), "low")
    line = F.concat_ws(" | ", s.cast("string"), escape_md("source"), escape_md("url"))
    articles = _listed(scored.withColumn("section", tier).filter(F.col("section").isNotNull()), F.col("section"), [F.desc("published_at"), "seq"], line)
    top = O.top_jobs(jobs, core, n_jobs)
    longlist = _numbered(top, "jobs", ["job_id"], F.concat_ws(" | ", escape_md("title"), escape_md("company"), F.coalesce(escape_md("location_raw"), F.lit(""))))
    mix = _numbered(A.source_mix(scored), "sources", [F.desc("n"), "source"], F.concat(F.col("source"), F.lit(": "), F.col("n").cast("string")))
    bad = _numbered(failed.select("source_id").distinct(), "failed", ["source_id"], F.col("source_id").cast("string"))
    return articles.unionByName(longlist).unionByName(_facts(A.tier_counts(scored), "statistics")).unionByName(mix).unionByName(bad)


def newsletter_source(news: DataFrame, jobs: DataFrame, events: DataFrame, now: Column, today: Column) -> DataFrame:
    """R2: news of 30 days by score, approved jobs by level and company, and events of 90 days by month."""
    recent = in_window(news.filter(F.col("score") >= 3), "published_at", now, 30)
    news_lines = _listed(recent.withColumn("section", F.concat(F.lit("score "), F.col("score"))), F.col("section"), [F.desc("published_at"), "seq"], meta_line(F.col("source"), F.date_format("published_at", "yyyy-MM-dd"), F.col("url")))
    approved = jobs.filter(F.col("status") == "approved").withColumn("section", F.concat(F.lit("jobs "), F.coalesce("seniority", F.lit("Other"))))
    job_lines = _listed(approved, F.col("section"), ["company", "job_id"], meta_line(F.col("company"), F.col("title"), F.col("location_raw")))
    coming = events.filter((F.col("status") == "verified") & F.col("event_date").between(today, F.date_add(today, 90)))
    event_lines = _listed(coming.withColumn("section", F.concat(F.lit("events "), month_bucket(F.col("event_date")))), F.col("section"), ["event_date", "event_id"], F.concat(event_date_text(F.col("event_date"), F.col("event_date")), F.lit(" "), F.col("name")))
    return news_lines.unionByName(job_lines).unionByName(event_lines)


def weekly_pick_report(news: DataFrame, now: Column, n: int = 5) -> DataFrame:
    """Picks of the last seven days, alternates and totals."""
    week = O.weekly_pick(in_window(news, "published_at", now, 7), n)
    lines = _listed(week.withColumnRenamed("place", "_place"), F.when(F.col("picked"), "picked").otherwise("alternates"), [F.asc_nulls_last("_place"), F.desc("score"), F.desc("published_at"), "seq"], meta_line(F.col("source"), F.col("score").cast("string"), F.col("url")))
    totals = week.agg(F.count("*").alias("in_window"), F.count_if("picked").alias("picked"))
    return lines.unionByName(_facts(totals, "totals"))


def jobs_run_report(run_log: DataFrame, classified: DataFrame, sweep: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Steps, errors, classifier outcomes, sweep buckets, and the state."""
    steps = A.step_summary(run_log)
    line = F.concat_ws(" | ", "step", "status", *(F.col(c).cast("string") for c in ("scraped", "new", "updated", "sources", "sources_with_errors")))
    outcomes = _numbered(A.classifier_tally(classified), "classifier", [F.desc("n"), "outcome"], F.concat(F.col("outcome"), F.lit(": "), F.col("n").cast("string")))
    buckets = _numbered(sweep, "sweep", [F.desc("n"), "bucket"], F.concat(F.col("bucket"), F.lit(": "), F.col("n").cast("string")))
    return _numbered(steps, "steps", ["step"], line).unionByName(outcomes).unionByName(buckets).unionByName(_facts(snapshot, "state"))


def events_run_report(extractions: DataFrame, sweep: DataFrame, snapshot: DataFrame, silent: DataFrame) -> DataFrame:
    """Extraction outcomes and categories, swept events by reason, the state, and sources that were silent or failed."""
    line = F.concat_ws(" / ", F.coalesce("outcome", F.lit("—")), F.coalesce("category", F.lit("—")), F.col("n").cast("string"))
    found = _numbered(A.extraction_report(extractions), F.concat(F.lit("extraction "), F.col("level")), [F.desc("n"), F.asc_nulls_first("outcome"), F.asc_nulls_first("category")], line)
    swept = _numbered(A.status_distribution(sweep), "sweep", [F.desc("n"), "status", "reason"], F.concat_ws(" / ", "status", "reason", F.col("n").cast("string")))
    quiet = _numbered(silent.groupBy("kind").agg(F.count("*").alias("n")), "sources", ["kind"], F.concat(F.col("kind"), F.lit(": "), F.col("n").cast("string")))
    return found.unionByName(swept).unionByName(_facts(snapshot, "state")).unionByName(quiet)


def intake_report(articles: DataFrame) -> DataFrame:
    """Each feed's figures, and the funnel."""
    stats = A.feed_stats(articles)
    line = F.concat_ws(" | ", "feed", *(F.coalesce(F.col(c).cast("string"), F.lit("—")) for c in ("total", "date_dropped", "unknown_date", "kept", "cap_dropped", "oldest", "newest")))
    return _numbered(stats, "feeds", ["feed"], line).unionByName(_facts(A.intake_funnel(articles), "funnel"))


def discovery_report(results: DataFrame) -> DataFrame:
    """Results by each dimension, and the first twelve names that need review."""
    parts = _numbered(A.discovery_breakdown(results), F.col("dimension"), [F.desc("n"), "value"], F.concat(F.col("value"), F.lit(": "), F.col("n").cast("string")))
    names = O.first_n_text(results.filter(F.col("confidence") != "high"), "name", 12)
    more = F.when(F.col("more") > 0, F.concat(F.lit(" (+"), F.col("more").cast("string"), F.lit(" more)"))).otherwise("")
    return parts.unionByName(_numbered(names, "review", ["text"], F.concat(F.col("text"), more)))


def monitor_report(stages: DataFrame) -> DataFrame:
    """One row: fetched, recent, scored 3 or more, new, and the best of each story."""
    kept = F.col("recent") & (F.col("score") >= 3)
    new = kept & ~F.col("seen")
    return stages.agg(F.count("*").alias("fetched"), F.count_if("recent").alias("after_lookback"), F.count_if(kept).alias("scored"), F.count_if(kept & F.col("seen")).alias("already_seen"), F.countDistinct(F.when(new, F.col("story_key"))).alias("after_story_dedupe"))
