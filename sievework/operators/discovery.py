"""Decisions over landed probes of career sites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.functions import wordlists as W
from sievework.functions.jsonx import valid_response
from sievework.functions.rules import scrapability, usable_page
from sievework.functions.text import board_slug, workday_parts


def expand_urls(df: DataFrame, slug: str = "slug", templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """one address for each row and platform."""
    table = F.array(*(F.struct(F.lit(i).alias("platform_rank"), F.lit(p).alias("platform"), F.lit(t).alias("template")) for i, (p, t) in enumerate(templates or W.API_TEMPLATES)))
    return df.withColumn("_t", F.explode(table)).select(*df.columns, "_t.platform_rank", "_t.platform", F.replace("_t.template", F.lit("{slug}"), F.col(slug)).alias("api_url"))


def settle_probes(probe_log: DataFrame) -> DataFrame:
    """The last attempt of each probe counts; a timeout there is a miss."""
    last = probe_log.groupBy("probe_id").agg(F.max_by("status", "attempt").alias("status"), F.max("attempt").alias("attempts"))
    return last.withColumn("hit", F.coalesce(F.col("status") == 200, F.lit(False)))


def best_api_hit(probes: DataFrame) -> DataFrame:
    """For each company the first valid reply, by slug and then by platform."""
    fine = probes.filter((F.col("status") == 200) & valid_response(F.col("platform"), F.col("body")))
    best = F.min_by(F.struct("platform", "slug", "api_url"), F.struct("slug_rank", "platform_rank"))
    return fine.groupBy("company_id").agg(best.alias("hit")).select("company_id", "hit.*")


def decide_first_pass(companies: DataFrame, hits: DataFrame, pages: DataFrame, verified: DataFrame) -> DataFrame:
    """An API hit; else the first page with a body: its job board (verified or not), or plain HTML; else nothing."""
    page = pages.filter((F.col("status") == 200) & (F.length("html") > 0)).groupBy("company_id").agg(F.min_by(F.struct("final_url", "html"), "page_rank").alias("page"))
    joined = companies.select("company_id", "name").join(hits.select("company_id", F.col("platform").alias("api_platform")), "company_id", "left").join(page, "company_id", "left")
    joined = joined.withColumn("board", board_slug("page.html", "page.final_url"))
    checked = joined.join(verified.select("company_id", F.lit(True).alias("_ok")).distinct(), "company_id", "left")
    api, board, found = F.col("api_platform").isNotNull(), F.col("board").isNotNull(), F.col("page").isNotNull()
    ok = F.coalesce("_ok", F.lit(False))
    return checked.select(
        "company_id", "name",
        F.when(api, F.col("api_platform")).when(board, F.col("board.platform")).when(found, "custom_html").otherwise("none_found").alias("ats_platform"),
        F.when(api | (board & ok), "high").when(board, "medium").when(found, "low").otherwise("none").alias("confidence"),
        F.when(api | (board & ok), "easy").when(board, "medium").when(found, scrapability("page.html")).otherwise("none").alias("scrapability"),
        (~api & ~(board & ok)).alias("needs_review"),
    )


def decide_second_pass(results: DataFrame, pages: DataFrame, slug_hits: DataFrame) -> DataFrame:
    """D3: usable pages only: Workday first, then other boards, then a slug's hit if no page was found, then plain HTML."""
    usable = pages.filter((F.col("status") == 200) & usable_page("final_url")).withColumn("board", board_slug("html", "final_url")).withColumn("workday", workday_parts("html", "final_url"))
    stage = F.when(F.col("workday").isNotNull(), 1).when(F.col("board").isNotNull(), 2).otherwise(4)
    platform = F.when(stage == 1, "workday").when(stage == 2, F.col("board.platform")).otherwise("custom_html")
    slug = F.when(stage == 1, F.col("workday.tenant")).when(stage == 2, F.col("board.slug"))
    found = usable.select("company_id", stage.alias("stage"), platform.alias("ats_platform"), slug.alias("ats_slug"), F.col("page_rank").alias("turn"))
    fallback = slug_hits.join(usable.select("company_id").distinct(), "company_id", "left_anti").select("company_id", F.lit(3).alias("stage"), F.col("platform").alias("ats_platform"), F.col("slug").alias("ats_slug"), F.lit(0).alias("turn"))
    best = found.unionByName(fallback).groupBy("company_id").agg(F.min_by(F.struct("stage", "ats_platform", "ats_slug"), F.struct("stage", "turn")).alias("best"))
    return results.select("company_id").join(best, "company_id", "left").select("company_id", F.coalesce("best.stage", F.lit(5)).alias("stage"), F.coalesce("best.ats_platform", F.lit("none_found")).alias("ats_platform"), "best.ats_slug")


def apply_known(results: DataFrame, known: DataFrame) -> DataFrame:
    """Answers known beforehand override what was probed."""
    given = known.select("company_id", F.col("ats_platform").alias("_platform"))
    return results.join(given, "company_id", "left").withColumn("ats_platform", F.coalesce("_platform", "ats_platform")).withColumn("source", F.when(F.col("_platform").isNotNull(), "known").otherwise("probed")).drop("_platform")
