"""The page readers as table functions for SQL, one call for each row of a lateral join.

``SELECT p.page_id, r.* FROM pages p, LATERAL listing_rows(p.html, p.url) r`` gives the rows of ``extract_listing``. Rows
reach and leave Python in Arrow batches; a page is read alone, so memory is bounded by one page and its rows.

Defined cases: a null or empty page has no rows; a null address leaves links as written; a platform that is none of BOARDS
is an error that names it.
"""

from __future__ import annotations

import re
from typing import Iterator
from urllib.parse import urljoin, urlsplit

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sievework.functions import wordlists as W
from sievework.sources.cards import BOARDS, SITES, container_rows, job_cards, site_rows

_HREF = re.compile(r'href="([^"]*)"')


def resolved(href: str | None, base: str | None) -> str | None:
    """An address seen from a page; an empty one is the page's."""
    if href is None or base is None:
        return href
    return urljoin(base, href.strip()) or base


def untracked(url: str) -> str:
    """An address without tracking parameters."""
    before, mark, rest = url.partition("?")
    if not mark or "#" in before:
        return url
    query, hashed, fragment = rest.partition("#")
    kept = [p for p in query.split("&") if p and (name := p.split("=", 1)[0]) not in W.TRACKING and not name.startswith("utm_")]
    return before + ("?" + "&".join(kept) if kept else "") + hashed + fragment


class ListingRows:
    """S3: a listing page's articles, by its host's layout or the first containers."""

    def eval(self, html: str | None, url: str | None) -> Iterator[tuple]:
        own = (urlsplit(url or "").hostname or "").removeprefix("www.")
        found = site_rows(html, SITES[own]) if own in SITES else container_rows(html, 40)
        for k, (title, link, date, snippet) in enumerate(found):
            yield k, title, resolved(link, url), date, snippet


class PageLinks:
    """Every link of a page in its order, absolute and without tracking; patterns and caps are the SQL's."""

    def eval(self, html: str | None, url: str | None) -> Iterator[tuple]:
        for k, m in enumerate(_HREF.finditer(html or "")):
            yield k, untracked(resolved(m[1], url))


class CardRows:
    """The job cards of a board's page, with its defaults."""

    def eval(self, html: str | None, url: str | None, platform: str | None) -> Iterator[tuple]:
        if platform not in BOARDS:
            raise ValueError(f"no board {platform!r}")
        board = BOARDS[platform]
        base = board.base or url
        for k, (title, company, location, link) in enumerate(job_cards(html, board)):
            where = resolved(link, base) if link is not None else "" if platform == "linkedin" else base
            yield k, title, board.no_company if company is None else company, location, where


def register_html_tables(spark: SparkSession) -> None:
    """``listing_rows(html, url)``, ``page_links(html, url)`` and ``card_rows(html, url, platform)`` for SQL."""
    tables = {
        "listing_rows": (ListingRows, "seq int, title string, link string, date string, snippet string"),
        "page_links": (PageLinks, "seq int, link string"),
        "card_rows": (CardRows, "seq int, title string, company string, location string, link string"),
    }
    for name, (reader, schema) in tables.items():
        spark.udtf.register(name, F.udtf(reader, returnType=schema, useArrow=True))
