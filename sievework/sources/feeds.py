"""Landed feeds, listing pages, tables and documents; and the sinks."""

from __future__ import annotations

from typing import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievework.functions.text import absolute_url, col, collapse, first_token, host, strip, strip_tracking
from sievework.sources.cards import BOARDS, SITES, Site, container_rows, job_cards, site_rows

_ITEM = "struct<title: string, link: string, pubDate: string, description: string>"
_ENTRY = "struct<title: string, link: array<struct<_href: string>>, updated: string, published: string, summary: string>"


def read_feed_items(xml_df: DataFrame, payload: str = "xml", feed: str = "feed") -> DataFrame:
    """Items of RSS texts, and entries of Atom texts where there is no item; rows without title or link go."""
    parsed = xml_df.withColumn("r", F.from_xml(col(payload), f"channel struct<item: array<{_ITEM}>>, entry array<{_ENTRY}>"))
    rss = F.transform(F.coalesce("r.channel.item", F.array().cast(f"array<{_ITEM}>")), lambda i: F.struct(i["title"].alias("title"), i["link"].alias("link"), i["pubDate"].alias("pub_date"), i["description"].alias("snippet")))
    atom = F.transform(
        F.coalesce("r.entry", F.array().cast(f"array<{_ENTRY}>")),
        lambda e: F.struct(e["title"].alias("title"), F.try_element_at(e["link"], F.lit(1))["_href"].alias("link"), F.coalesce(e["published"], e["updated"]).alias("pub_date"), e["summary"].alias("snippet")),
    )
    rows = parsed.select(feed, F.posexplode(F.when(F.size(rss) > 0, rss).otherwise(atom)).alias("seq", "i")).select(feed, "seq", "i.*")
    return rows.filter((strip(F.coalesce("title", F.lit(""))) != "") & (strip(F.coalesce("link", F.lit(""))) != ""))


def first_nonempty(dfs: list[DataFrame], key: str = "feed", names: list[str] | None = None) -> DataFrame:
    """For each key the rows of the first frame that has any, with ``method``."""
    rows = None
    for i, df in enumerate(dfs):
        own = df.withColumn("method", F.lit(names[i] if names else str(i))).withColumn("_rank", F.lit(i))
        rows = own if rows is None else rows.unionByName(own, allowMissingColumns=True)
    best = rows.groupBy(key).agg(F.min("_rank").alias("_rank"))
    return rows.join(best, [key, "_rank"], "left_semi").drop("_rank")


def extract_listing(pages: DataFrame, site_rules: dict[str, Site] | None = None, most: int = 40) -> DataFrame:
    """S3: (page_id, seq, title, link, date, snippet) of a listing page's articles: by the layout of its host, if
    ``site_rules`` (SITES by default) has one, or else of the first containers. Dates are as the page writes them;
    links are made absolute."""
    schema = "page_id bigint, url string, seq int, title string, link string, date string, snippet string"
    rules = SITES if site_rules is None else site_rules

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "seq", "title", "link", "date", "snippet"]
        kinds = [pa.int64(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string()]
        for batch in batches:
            rows = []
            for page, url, own, html in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                found = site_rows(html, rules[own]) if own in rules else container_rows(html, most)
                rows += [(page, url, k, *row) for k, row in enumerate(found)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)

    found = pages.select("page_id", "url", host("url").alias("own"), "html").mapInArrow(run, schema)
    return found.withColumn("link", absolute_url("link", "url")).drop("url")


def discover_links(pages: DataFrame, allow: str, block: str, fallback: str, cap: int = 30) -> DataFrame:
    """(page_id, seq, link): links that the patterns allow; where a page has none, those of the fallback; the first of each, up to the cap."""
    hrefs = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    links = pages.select("page_id", "url", F.posexplode(hrefs).alias("seq", "href"))
    links = links.withColumn("link", strip_tracking(absolute_url("href", "url"))).filter(~F.col("link").rlike(block))
    tier = F.when(F.col("link").rlike(allow), 1).when(F.col("link").rlike(fallback), 2)
    marked = links.withColumn("tier", tier).filter(F.col("tier").isNotNull()).groupBy("page_id", "tier", "link").agg(F.min("seq").alias("seq"))
    best = marked.withColumn("best", F.min("tier").over(Window.partitionBy("page_id"))).filter(F.col("tier") == F.col("best"))
    ranked = best.withColumn("turn", F.row_number().over(Window.partitionBy("page_id").orderBy("seq")))
    return ranked.filter(F.col("turn") <= cap).select("page_id", "seq", "tier", "link")


def normalise_board_results(payloads: DataFrame) -> DataFrame:
    """Rows of a board's result pages."""
    schema = "results array<struct<title: string, company: struct<display_name: string>, location: struct<display_name: string>, redirect_url: string, description: string>>"
    rows = payloads.select(F.explode(F.from_json("payload", schema)["results"]).alias("j"))
    return rows.select(
        F.coalesce("j.title", F.lit("")).alias("title"), F.coalesce("j.company.display_name", F.lit("Company Not Listed")).alias("company"),
        F.coalesce("j.location.display_name", F.lit("")).alias("location"), F.coalesce("j.redirect_url", F.lit("")).alias("link"),
        F.left(F.coalesce("j.description", F.lit("")), F.lit(300)).alias("summary"),
    )


def extract_job_cards(pages: DataFrame, platform: str, company: Column | str | None = None) -> DataFrame:
    """Cards of a board's landed pages (one of BOARDS), by its selectors, with its defaults for what is missing.
    ``company`` names the company of pages whose cards don't."""
    board = BOARDS[platform]
    schema = "page_id bigint, url string, seq int, title string, company string, location string, link string, known string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "seq", "title", "company", "location", "link", "known"]
        kinds = [pa.int64(), pa.string(), pa.int32(), *[pa.string()] * 5]
        for batch in batches:
            rows = []
            for page, url, known, html in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                rows += [(page, url, k, *card, known) for k, card in enumerate(job_cards(html, board))]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)

    named = F.lit(None).cast("string") if company is None else col(company)
    found = pages.select("page_id", "url", named.alias("known"), "html").mapInArrow(run, schema)
    base = F.lit(board.base) if board.base else F.col("url")
    return found.select(
        "page_id", "seq", "title", F.coalesce("company", "known", F.lit(board.no_company)).alias("company"), "location",
        F.coalesce(absolute_url("link", base), F.when(F.lit(platform == "linkedin"), "").otherwise(base)).alias("link"), F.lit("").alias("summary"), F.lit(platform).alias("platform"),
    )


def read_csv_table(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with a header, all columns text, without a byte order mark."""
    df = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"')
    return df.toDF(*(c.lstrip("﻿") for c in df.columns))


def read_latest(spark: SparkSession, glob: str, fmt: str = "csv", folders: bool = False, **options) -> DataFrame:
    """The file of a glob whose name comes last; with ``folders`` all files of the folder whose name comes last."""
    names = spark.read.format("binaryFile").load(glob).select("path")  # paths only: contents aren't read
    newest = names.agg(F.max(F.regexp_replace("path", "/[^/]*$", "") if folders else F.col("path"))).first()[0]
    return spark.read.format(fmt).options(**options).load(newest)


_ARTICLE = "title string, link string, pubDate string, source string, snippet string"
_FAILED = "source string, url string, error string"


def read_article_doc(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(articles, failed sources) of a document, with its run_date and each one's place.

    One JSON object is one task's work, so it must fit one; what S14 writes is read by ``read_article_folder`` and may be of any size. A document
    without one of the two lists has no such rows.
    """
    schema = f"articles array<struct<{_ARTICLE}>>, failed_sources array<struct<{_FAILED}>>, run_date string"
    doc = spark.read.schema(schema).json(path, multiLine=True)
    articles, failed = (doc.select("run_date", F.posexplode(c).alias("seq", "a")).select("run_date", "seq", "a.*") for c in ("articles", "failed_sources"))
    return articles, failed


def read_article_folder(spark: SparkSession, path: str, article: str = _ARTICLE, failed: str = _FAILED) -> tuple[DataFrame, DataFrame]:
    """(articles, failed sources) that S14 wrote below ``path``: a row a line, so any size is read in parallel and a
    filter on ``month`` reads that month's folders only. No failed sources is an empty frame."""
    read = lambda part, schema: spark.read.schema(f"{schema}, run_date string, month string").json(f"{path}/{part}")
    return read("articles", article), read("failed_sources", failed)


def import_sheet(sheet: DataFrame, default_score: int = 4) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects with a reason) of a sheet with url and title."""
    read = sheet.withColumn("url", F.coalesce(first_token("url"), F.lit(""))).withColumn("title", F.coalesce(collapse("title"), F.lit("")))
    reason = (
        F.when(F.col("url") == "", "no_url").when(~F.col("url").rlike("(?i)^https?://"), "bad_scheme")
        .when(F.lower("title").isin("", "unknown"), "no_title")
    )
    marked = read.withColumn("reason", reason)
    return marked.filter(F.col("reason").isNull()).drop("reason").withColumn("score", F.lit(default_score)), marked.filter(F.col("reason").isNotNull())
