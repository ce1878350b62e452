"""Joins. Strategies are Catalyst's and AQE's; a side is hinted for broadcast only if its size is fixed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions import wordlists as W
from sievework.functions.rules import contains_any
from sievework.functions.text import host, publisher_stem, url_escape
from sievework.operators.dedupe import one_of


def active_sources(sources: DataFrame, companies: DataFrame, platform: str | None = None) -> DataFrame:
    """Active sources with their company; a missing one has a blank name and no flags."""
    on = sources.filter(F.coalesce("is_active", F.lit(False)))
    on = on.filter(F.col("ats_platform") == platform) if platform else on
    known = companies.select("company_id", F.col("name").alias("company_name"), "is_fdi", "is_irish_founded", "allowlisted")
    flags = [F.coalesce(c, F.lit(False)).alias(c) for c in ("is_fdi", "is_irish_founded", "allowlisted")]
    return on.join(known, "company_id", "left").select(*sources.columns, F.coalesce("company_name", F.lit("")).alias("company_name"), *flags)


def with_company(jobs: DataFrame, companies: DataFrame) -> DataFrame:
    """Jobs with their company's columns, null where it's unknown."""
    known = companies.select("company_id", *(F.col(c).alias(f"company_{c}" if c in jobs.columns else c) for c in companies.columns if c != "company_id"))
    return jobs.join(known, "company_id", "left")


def with_source_health(jobs: DataFrame, sources: DataFrame, now: Column, grace: int = 8, health: int = 8) -> DataFrame:
    """Jobs with ``bucket``: no_history, unhealthy, not_stale or archive."""
    joined = jobs.join(sources.select("source_id", "last_success"), "source_id", "left")
    days = lambda n: F.make_dt_interval(F.lit(n))
    success, seen = F.col("last_success").cast("timestamp"), F.col("last_seen").cast("timestamp")
    bucket = (
        F.when(success.isNull(), "no_history")
        .when(success < now - days(health), "unhealthy")
        .when(seen.isNull() | (seen >= success - days(grace)), "not_stale")
        .otherwise("archive")
    )
    return joined.withColumn("bucket", bucket)


def not_seen(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't among the seen ones; a null that was seen counts as seen."""
    return df.join(seen.select(F.col(key).alias("_key")), F.col(key).eqNullSafe(F.col("_key")), "left_anti")


def match_company(df: DataFrame, terms: list[str], col: str = "company") -> DataFrame:
    """Rows whose company's text has a term in it; the list is a literal, matched as one pattern."""
    return df.filter(contains_any(col, terms))


def resolve_included(items: DataFrame, included: DataFrame) -> DataFrame:
    """Items with the name that (payload_id, type, id) has among the included records."""
    names = included.select("payload_id", F.col("type").alias("rel_type"), F.col("id").alias("rel_id"), F.col("name").alias("rel_name"))
    return items.join(names, ["payload_id", "rel_type", "rel_id"], "left")


def attach_assets(picks: DataFrame, news: DataFrame, assets: DataFrame) -> DataFrame:
    """Picks with their news item and its first asset of kind news."""
    first = assets.filter(F.col("kind") == "news").groupBy("news_id").agg(F.min_by("asset_url", "asset_id").alias("asset_url"))
    return picks.join(news.select("news_url", "news_id"), "news_url", "left").join(first, "news_id", "left")


def with_publisher(df: DataFrame, publisher_map: dict[str, str] | None = None, url: str = "url") -> DataFrame:
    """The publisher's name by host, or else derived from the host. The map is a fixed list, so a literal."""
    table = publisher_map or W.PUBLISHERS
    known = F.create_map(*(F.lit(x) for pair in table.items() for x in pair))
    return df.withColumn("publisher", F.coalesce(F.try_element_at(known, host(url)), publisher_stem(url)))


def attach_scores(batches: DataFrame, replies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with the reply of their batch and place (one each; others are dropped), and the rows without."""
    keys = ["bucket", "batch", "idx"]
    one = one_of(replies, keys)
    return batches.join(one, keys), batches.join(one, keys, "left_anti")


def diff_by_key(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Every key once as inserted, updated or stored, with the two rows as structs. A null is a key; of a side's rows
    of one key the least row (by its columns in order) counts."""
    kind = F.when(F.col("old").isNull(), "inserted").when(F.col("new").isNull(), "stored").otherwise("updated")
    return both_sides(existing, incoming, key, F.min(F.struct("*")), F.min(F.struct("*"))).withColumn("change", kind)


def both_sides(existing: DataFrame, incoming: DataFrame, key: str, old: Column, new: Column) -> DataFrame:
    """(key, old, new): one row a key, with what the aggregates make of either side's rows, or null. A null is a key."""
    left = existing.groupBy(F.col(key).alias("_old_key")).agg(old.alias("old"))
    right = incoming.groupBy(F.col(key).alias("_new_key")).agg(new.alias("new"))
    met = left.join(right, F.col("_old_key").eqNullSafe(F.col("_new_key")), "full_outer")
    return met.select(F.coalesce("_old_key", "_new_key").alias(key), "old", "new")


def build_queries(companies: DataFrame, templates: list[str]) -> DataFrame:
    """One address for each company and template; ``{q}`` stands for the quoted name."""
    made = companies.select("company_id", "name", F.posexplode(F.array(*(F.lit(t) for t in templates))).alias("template_no", "template"))
    return made.withColumn("query_url", F.replace("template", F.lit("{q}"), url_escape(F.col("name")))).drop("template")


def attach_detail(listings: DataFrame, details: DataFrame, key: str = "url") -> DataFrame:
    """Listings with the description of their landed detail page."""
    return listings.join(details.groupBy(key).agg(F.min("description").alias("description")), key, "left")


def attach_outcome(listings: DataFrame, outcomes: DataFrame, key: str = "url") -> DataFrame:
    """Listings with what their write came to; failed where there is no outcome. A null is a key; of several outcomes
    of a key the least by name counts."""
    one = outcomes.groupBy(F.col(key).alias("_key")).agg(F.min("outcome").alias("outcome"))
    met = listings.join(one, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
    return met.withColumn("outcome", F.coalesce("outcome", F.lit("failed")))
