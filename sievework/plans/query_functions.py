"""Queries of the scalar functions (F) and predicates (P)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.functions import dates as D
from sievework.functions import jsonx as J
from sievework.functions import rules as R
from sievework.functions import text as X
from sievework.functions import wordlists as W
from sievework.functions.pages import html_to_text, main_content, page_meta, register_html_udfs
from sievework.operators import filters as P
from sievework.operators.discovery import expand_urls
from sievework.plans.registry import query
from sievework.plans.views import over, table, view


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def any_of(expr: str, terms: list[str]) -> str:
    """SQL: any of the terms is in the text."""
    return "(" + " OR ".join(f"contains(lower({expr}), {lit(t)})" for t in terms) + ")"


def hits(expr: str, terms: list[str]) -> str:
    """SQL: how many of the terms are in the text."""
    return "(" + " + ".join(f"CAST(contains(lower({expr}), {lit(t)}) AS INTEGER)" for t in terms) + ")"


def decoded(expr: str) -> str:
    """SQL: a text with these references decoded, which HTML also reads without their semicolon (a cut title may end so)."""
    for name, mark in (("nbsp", " "), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("amp", "&")):
        expr = f"regexp_replace({expr}, '&{name};?', '{mark}', 'g')"
    return expr


_ARTICLE = "regexp_replace(regexp_extract(html, '<article>(.*?)</article>', 1, 's'), '<[^>]*>', ' ', 'g')"
#: SQL: the text of a page's article, with single spaces.
MAIN_TEXT = rf"""regexp_replace(regexp_replace({decoded(_ARTICLE)}, '\s+', ' ', 'g'), '^ | $', '', 'g')"""


# Text ----------------------------------------------------------------------------------------------


@query("f1_norm_key", r"SELECT doc_id, md5(trim(regexp_replace(lower(text), '\s+', ' ', 'g'))) AS key FROM documents")
def f1(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(X.norm_key("text")).alias("key"))


@query("f2_strip_tags", r"SELECT page_id, md5(regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '^\s+|\s+$', '', 'g')) AS plain FROM pages")
def f2(spark, d):
    return table(spark, d, "pages").select("page_id", F.md5(X.strip_tags("html")).alias("plain"))


#: SQL: all text of a page but for scripts and styles, with single spaces.
PLAIN_TEXT = r"""regexp_replace(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->', ' ', 'gs'), '<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'), '^ | $', '', 'g')"""


@query("f3_html_to_text", f"SELECT page_id, CASE WHEN length(p) > 2000 THEN left(p, 1997) || '...' ELSE p END AS plain FROM (SELECT page_id, {PLAIN_TEXT} AS p FROM pages)")
def f3(spark, d):
    return table(spark, d, "pages").select("page_id", html_to_text("html", 2000, True).alias("plain"))


@query("f4_main_content", f"SELECT page_id, {MAIN_TEXT} AS main FROM pages")
def f4(spark, d):
    return table(spark, d, "pages").select("page_id", main_content("html").alias("main"))


#: SQL: a title as the query quotes it in an attribute, and as a reader gets it.
_QUOTED = decoded("""replace(regexp_extract(html, '<title>(.*?)</title>', 1), '"', '')""")


@query("f5_page_meta", rf"""
    SELECT page_id, CASE WHEN page_id % 4 <> 0 THEN regexp_replace({_QUOTED}, '^\s+|\s+$', '', 'g') END AS og_title,
           CASE page_id % 4 WHEN 1 THEN 'https://cdn.example.org/i.png' WHEN 2 THEN regexp_extract(url, '^([a-zA-Z]+://[^/?#]+)', 1) || '/i/' || page_id || '.png' END AS image_url
    FROM pages""")
def f5(spark, d):
    title = F.replace(F.regexp_extract("html", "<title>(.*?)</title>", 1), F.lit('"'), F.lit(""))
    image = F.when(F.col("page_id") % 4 == 1, '<meta property="og:image" content="https://cdn.example.org/i.png"><meta name="twitter:image" content="/other.png">').when(
        F.col("page_id") % 4 == 2, F.concat(F.lit('<META NAME="twitter:image" CONTENT=" /i/'), F.col("page_id"), F.lit('.png ">'))
    )
    named = F.when(F.col("page_id") % 4 != 0, F.concat(F.lit('<meta property="og:title" content="'), title, F.lit('"><meta property="og:title" content="later">')))
    headed = F.concat(F.coalesce(named, F.lit("")), F.coalesce(image, F.lit("")), F.col("html"))
    return table(spark, d, "pages").select("page_id", page_meta(headed, "url").alias("m")).select("page_id", "m.*")


@query("x8_html_udfs", f"SELECT page_id, md5({MAIN_TEXT}) AS main FROM pages")
def x8(spark, d):
    register_html_udfs(spark)
    table(spark, d, "pages").createOrReplaceTempView("pages")
    return spark.sql("SELECT page_id, md5(html_main_text(html)) AS main FROM pages")


_TITLE = "regexp_extract(html, '<title>(.*?)</title>', 1)"


@query("f6_choose_title", f"SELECT page_id, CASE WHEN {_TITLE} <> url AND length({_TITLE}) >= 15 THEN {_TITLE} ELSE url END AS title FROM pages")
def f6(spark, d):
    og = F.regexp_extract("html", "<title>(.*?)</title>", 1)
    return table(spark, d, "pages").select("page_id", X.choose_title("url", og).alias("title"))


_NAMED = "p_name || CASE p_partkey % 6 WHEN 0 THEN '  Limited' WHEN 1 THEN ' Inc.' WHEN 2 THEN ' (PN)' WHEN 3 THEN ' Group, ' WHEN 4 THEN 's' ELSE '' END"
_SUFFIX = "|".join(s.replace(".", r"\.") for s in W.LEGAL_SUFFIXES)
_NORM = rf"trim(regexp_replace(rtrim(regexp_replace(trim(regexp_replace(trim(regexp_replace(lower({{}}), '\s+', ' ', 'g')), '\s*\([^)]*\)\s*$', '')), '({_SUFFIX})$', '')), '[.,;:]+$', ''))"


@query("f7_norm_company", f"WITH n AS (SELECT p_partkey AS job_id, p_name, {_NAMED} AS org FROM part) SELECT job_id, {_NORM.format('org')} AS name, regexp_replace({_NORM.format('org')}, 's$', '') = regexp_replace({_NORM.format('p_name')}, 's$', '') AS same FROM n")
def f7(spark, d):
    n = table(spark, d, "part").select(F.col("p_partkey").alias("job_id"), "p_name", F.expr(_NAMED).alias("org"))
    return n.select("job_id", X.norm_company("org").alias("name"), X.names_match(X.norm_company("org"), X.norm_company("p_name")).alias("same"))


@query("f8_clip", "SELECT doc_id, CASE WHEN length(text) > 120 THEN left(text, 117) || '...' ELSE text END AS clipped FROM documents")
def f8(spark, d):
    return table(spark, d, "documents").select("doc_id", X.clip("text", 120, "...").alias("clipped"))


_HOST = r"regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)', 1)), '^www\.', '')"
_MULTI = "|".join(t.replace(".", r"\.") for t in W.MULTI_TLDS)
_STEM = rf"replace(CASE WHEN regexp_matches({_HOST}, '({_MULTI})$') THEN regexp_replace({_HOST}, '({_MULTI})$', '') ELSE regexp_replace({_HOST}, '\.[^.]*$', '') END, '-', ' ')"
_TITLED = f"array_to_string(list_transform(regexp_extract_all({_STEM}, '([a-z]+|[^a-z]+)', 1), lambda x: upper(left(x, 1)) || substr(x, 2)), '')"


@query("f9_publisher_stem", f"SELECT page_id, {_TITLED} AS publisher FROM pages")
def f9(spark, d):
    return table(spark, d, "pages").select("page_id", X.publisher_stem("url").alias("publisher"))


@query("f10_domain", r"SELECT page_id, regexp_extract(url, 'https?://(?:www\.)?([^/]+)', 1) AS domain, CASE WHEN page_id % 2 = 0 THEN CASE WHEN regexp_matches(url, '[?&]q=([^&]+)') THEN 'GNews: ' || replace(regexp_extract(url, '[?&]q=([^&]+)', 1), '+', ' ') ELSE 'Google News' END ELSE regexp_extract(url, 'https?://(?:www\.)?([^/]+)', 1) END AS label FROM pages")
def f10(spark, d):
    kind = F.when(F.col("page_id") % 2 == 0, "google_news").otherwise("site_rss")
    return table(spark, d, "pages").select("page_id", X.domain("url").alias("domain"), X.feed_label("url", kind).alias("label"))


_JOB_URL = "'https://' || CASE p_partkey % 3 WHEN 0 THEN 'ie' WHEN 1 THEN 'www' ELSE 'am' END || '.linkedin.com/jobs/view/' || replace(p_name, ' ', '-') || '-' || CAST(4199990000 + p_partkey * 7 AS STRING) || CASE p_partkey % 4 WHEN 0 THEN '/?refId=99' WHEN 1 THEN '#top' WHEN 2 THEN '/' ELSE '' END"


@query("f11_job_url", rf"WITH u AS (SELECT p_partkey AS job_id, {_JOB_URL} AS url FROM part) SELECT job_id, 'https://www.linkedin.com/jobs/view/' || regexp_extract(url, '/jobs/view/([^/?#]+)', 1) || '/' AS canonical, regexp_extract(url, '://([^.]+)\.', 1) AS sub, CAST(regexp_extract(regexp_extract(url, '/jobs/view/([^/?#]+)', 1), '(\d+)$', 1) AS BIGINT) AS number FROM u")
def f11(spark, d):
    u = table(spark, d, "part").select(F.col("p_partkey").alias("job_id"), F.expr(_JOB_URL).alias("url"))
    return u.select("job_id", X.canonical_job_url("url").alias("canonical"), X.subdomain("url").alias("sub"), X.job_id("url").alias("number"))


_KEPT = "list_filter(string_split(regexp_extract(url, '[?]([^#]*)', 1), '&'), lambda p: p <> '' AND NOT starts_with(p, 'utm_') AND split_part(p, '=', 1) NOT IN (" + ", ".join(map(lit, W.TRACKING)) + "))"


@query("f12_strip_tracking", f"SELECT page_id, CASE WHEN regexp_extract(url, '[?]([^#]*)', 1) = '' THEN url ELSE regexp_extract(url, '^([^?#]*)', 1) || CASE WHEN len({_KEPT}) > 0 THEN '?' || array_to_string({_KEPT}, '&') ELSE '' END || regexp_extract(url, '(#.*)$', 1) END AS clean FROM pages")
def f12(spark, d):
    return table(spark, d, "pages").select("page_id", X.strip_tracking("url").alias("clean"))


# How a page may write an address, and what it stands for on https://h.example/a/b/c.
_WRITTEN = [("", "https://h.example/a/b/", ""), ("../", "https://h.example/a/", ""), ("./x/../", "https://h.example/a/b/", ""), ("../../../../", "https://h.example/", ""), ("/r/./s/../", "https://h.example/r/", ""), ("//o.example/../", "https://o.example/../", ""), ("", "https://h.example/a/b/", "?q=../z#./y"), ("../..", "https://h.example/", "")]


@query("f13_absolute_url", """SELECT page_id, CASE WHEN page_id % 9 = 8 THEN regexp_extract(url, '^([a-zA-Z]+://[^/?#]+)', 1) || regexp_extract(html, 'href="([^"]*)"', 1) ELSE CASE page_id % 9 """ + " ".join(f"WHEN {k} THEN '{b}'" for k, (_, b, _) in enumerate(_WRITTEN)) + """ END || CASE WHEN page_id % 9 = 7 THEN '' ELSE 'p' || page_id || CASE WHEN page_id % 9 = 6 THEN '?q=../z#./y' ELSE '' END END END AS link FROM pages""")
def f13(spark, d):
    k, own = (F.col("page_id") % 9).cast("int"), F.concat(F.lit("p"), F.col("page_id").cast("string"))
    href = F.coalesce(*(F.when(k == i, F.concat(F.lit(a), own if a != "../.." else F.lit(""), F.lit(c))) for i, (a, _, c) in enumerate(_WRITTEN)), F.regexp_extract("html", 'href="([^"]*)"', 1))
    base = F.when(k == 8, F.col("url")).otherwise("https://h.example/a/b/c")
    return table(spark, d, "pages").select("page_id", X.absolute_url(href, base).alias("link"))


@query("f14_slug_variants", r"""SELECT c_custkey AS company_id, regexp_replace(lower(c_name), '[^a-z0-9]', '', 'g') || '|' || regexp_replace(lower(c_name), '[^a-z0-9]+', '-', 'g') || '|x' || c_custkey AS slugs FROM customer""")
def f14(spark, d):
    site = F.concat(F.lit("https://www.x"), F.col("c_custkey").cast("string"), F.lit(".com/y"))
    return table(spark, d, "customer").select(F.col("c_custkey").alias("company_id"), F.array_join(X.slug_variants("c_name", site), "|").alias("slugs"))


@query("f15_expand_urls", "WITH t AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, {lit(p)}, {lit(t)})" for i, (p, t) in enumerate(W.API_TEMPLATES)) + ") AS t(platform_rank, platform, template)) SELECT s_suppkey AS source_id, CAST(platform_rank AS BIGINT) AS platform_rank, platform, replace(template, '{slug}', lower(replace(s_name, '#', '-'))) AS api_url FROM supplier, t")
def f15(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("source_id"), F.lower(F.replace("s_name", F.lit("#"), F.lit("-"))).alias("slug"))
    return expand_urls(s).select("source_id", F.col("platform_rank").cast("bigint").alias("platform_rank"), "platform", "api_url")


_BOARD = "'<a href=\"' || CASE s_suppkey % 5 WHEN 0 THEN 'https://boards.greenhouse.io/' WHEN 1 THEN 'https://jobs.lever.co/' WHEN 2 THEN 'https://t.wd3.myworkdayjobs.com/en-US/' WHEN 3 THEN 'https://jobs.lever.co/jobs' ELSE 'https://example.org/' END || 'slug-' || CAST(s_suppkey AS STRING) || '\">' || CASE WHEN s_suppkey % 10 = 4 THEN 'Career site by Teamtailor' WHEN s_suppkey % 10 = 9 THEN '<script src=\"https://jobs.teamtailor.com/t/x\">' ELSE '' END"


@query("f16_fingerprint", f"WITH b AS (SELECT s_suppkey AS source_id, {_BOARD} AS html FROM supplier) SELECT source_id, CASE source_id % 5 WHEN 0 THEN 'greenhouse' WHEN 1 THEN 'lever' WHEN 3 THEN 'lever' WHEN 4 THEN 'teamtailor' END AS platform, CASE source_id % 5 WHEN 0 THEN 'slug-' || source_id WHEN 1 THEN 'slug-' || source_id WHEN 3 THEN 'jobsslug-' || source_id WHEN 4 THEN CASE WHEN source_id % 10 = 9 THEN 'jobs' ELSE '' END END AS slug, CASE WHEN source_id % 5 = 2 THEN 't' END AS tenant, CASE WHEN source_id % 5 = 2 THEN 'slug-' || source_id END AS site FROM b")
def f16(spark, d):
    b = table(spark, d, "supplier").select(F.col("s_suppkey").alias("source_id"), F.expr(_BOARD).alias("html"))
    found = b.select("source_id", X.board_slug("html", F.lit("")).alias("b"), X.workday_parts("html", F.lit("")).alias("w"))
    return found.select("source_id", "b.platform", "b.slug", "w.tenant", "w.site")


@query("f17_safe_name", "SELECT p_partkey AS job_id, CASE WHEN p_partkey % 9 = 0 THEN 'story' ELSE regexp_replace(regexp_replace(lower(p_name || ' ' || p_type), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') END AS safe FROM part")
def f17(spark, d):
    name = F.when(F.col("p_partkey") % 9 == 0, "?!").otherwise(F.concat_ws(" ", "p_name", "p_type"))
    return table(spark, d, "part").select(F.col("p_partkey").alias("job_id"), X.safe_name(name).alias("safe"))


@query("f18_escape", r"SELECT doc_id, md5(replace(text, '|', '\|')) AS md, md5(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')) AS html FROM documents")
def f18(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(X.escape_md("text")).alias("md"), F.md5(X.escape_html("text")).alias("html"))


@query("f19_salary", "SELECT p_partkey AS job_id, CASE WHEN p_size % 3 = 0 THEN NULL WHEN p_size % 3 = 1 THEN 'EUR ' || p_size || '+ YEAR' ELSE 'EUR ' || p_size || '–' || (p_size + 10) || ' YEAR' END AS salary FROM part")
def f19(spark, d):
    low, high = F.when(F.col("p_size") % 3 != 0, F.col("p_size")), F.when(F.col("p_size") % 3 == 2, F.col("p_size") + 10)
    return table(spark, d, "part").select(F.col("p_partkey").alias("job_id"), X.salary_text(F.lit("EUR"), low, high, F.lit("YEAR")).alias("salary"))


@query("f20_location_text", "SELECT s_suppkey AS source_id, CASE WHEN s_suppkey % 4 = 0 AND s_suppkey % 3 = 0 THEN NULL WHEN s_suppkey % 4 = 0 THEN 'N' || s_nationkey WHEN s_suppkey % 3 = 0 THEN s_name ELSE s_name || ', N' || s_nationkey END AS place FROM supplier")
def f20(spark, d):
    a, b = F.when(F.col("s_suppkey") % 4 != 0, F.col("s_name")), F.when(F.col("s_suppkey") % 3 == 0, " ").otherwise(F.concat(F.lit("N"), F.col("s_nationkey")))
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("source_id"), X.location_text(a, b).alias("place"))


@query("f21_lines", over("v_news", "SELECT seq, source || ' - ' || 'Score ' || score || '. read more-' || url AS story, source || CASE WHEN seq % 2 = 0 THEN ' · ' || story_key ELSE '' END AS meta, '#' || source || ' #' || status AS tags FROM v_news"))
def f21(spark, d):
    n = view(spark, d, "v_news")
    return n.select("seq", X.story_line(F.col("source"), F.concat(F.lit("Score "), F.col("score"), F.lit("..")), F.col("url")).alias("story"), X.meta_line(F.col("source"), F.when(F.col("seq") % 2 == 0, F.col("story_key")).otherwise("")).alias("meta"), X.hashtags(F.array("source", F.concat(F.lit("##"), F.col("status")))).alias("tags"))


@query("f22_first_token", r"SELECT doc_id, nullif(regexp_extract(text, '(\S+)', 1), '') AS token FROM documents")
def f22(spark, d):
    return table(spark, d, "documents").select("doc_id", X.first_token("text").alias("token"))


@query("f23_content_hash", over("v_news", """SELECT seq, left(sha256('{"source":"' || source || '","url":"' || url || '"}'), 8) AS hash FROM v_news"""))
def f23(spark, d):
    return view(spark, d, "v_news").select("seq", X.content_hash(F.struct("source", "url")).alias("hash"))


# Dates ---------------------------------------------------------------------------------------------

_DAY = "CAST(o_orderdate AS DATE)"


@query("f24_feed_date", f"SELECT o_orderkey AS event_id, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE CAST({_DAY} AS TIMESTAMP) + INTERVAL 8 HOUR END AS published FROM orders")
def f24(spark, d):
    day = F.col("o_orderdate").cast("timestamp") + F.expr("interval 8 hours")
    k = F.col("o_orderkey") % 4
    raw = F.when(k == 0, F.date_format(day, "EEE, dd MMM yyyy HH:mm:ss 'GMT'")).when(k == 1, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k == 2, F.date_format(day + F.expr("interval 1 hour"), "d MMM yyyy HH:mm:ss '+0100'")).otherwise("soon")
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("event_id"), D.parse_feed_date(raw).cast("timestamp_ntz").alias("published"))


@query("f25_sheet_date", f"SELECT o_orderkey AS event_id, CASE WHEN o_orderkey % 6 = 5 THEN NULL ELSE {_DAY} END AS day FROM orders")
def f25(spark, d):
    formats = ["dd/MM/yyyy", "yyyy-MM-dd", "MMMM d, yyyy", "d MMM yyyy", "dd-MM-yyyy"]
    raw = F.coalesce(*(F.when(F.col("o_orderkey") % 6 == k, F.date_format("o_orderdate", f)) for k, f in enumerate(formats)), F.lit("someday"))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("event_id"), D.parse_sheet_date(raw).cast("date").alias("day"))


@query("f26_ordinal_date", f"SELECT o_orderkey AS event_id, {_DAY} AS day FROM orders")
def f26(spark, d):
    n = F.day("o_orderdate")
    end = F.when(n.isin(1, 21, 31), "st").when(n.isin(2, 22), "nd").when(n.isin(3, 23), "rd").otherwise("th")
    raw = F.concat(n.cast("string"), end, F.date_format("o_orderdate", " MMMM yyyy"))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("event_id"), D.parse_ordinal_date(raw).alias("day"))


_WORDS = "CASE event_id % 8 WHEN 0 THEN 'Just now' WHEN 1 THEN 'Yesterday' WHEN 2 THEN event_id % 20 || ' hours ago' WHEN 3 THEN event_id % 20 || ' days ago' WHEN 4 THEN event_id % 20 || ' weeks ago' WHEN 5 THEN event_id % 20 || ' months ago' WHEN 6 THEN '1 year ago' ELSE 'n/a' END"


@query("f27_days_ago", "SELECT event_id AS seq, CAST(CASE event_id % 8 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 0 WHEN 3 THEN event_id % 20 WHEN 4 THEN event_id % 20 * 7 WHEN 5 THEN event_id % 20 * 30 WHEN 6 THEN 365 END AS BIGINT) AS days, CAST(greatest(floor(epoch(TIMESTAMP '2024-01-31 00:00:00' - ts) / 86400), 0) AS BIGINT) AS iso_days FROM events")
def f27(spark, d):
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    return table(spark, d, "events").select(F.col("event_id").alias("seq"), D.days_ago(F.expr(_WORDS), now).alias("days"), D.days_ago(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")), now).alias("iso_days"))


@query("f28_event_date_text", over("v_event", "SELECT event_id, CASE WHEN event_date IS NULL THEN '' WHEN event_id % 2 = 0 THEN day(event_date) || '-' || day(event_date + 2) || ' ' || strftime(event_date, '%b') ELSE strftime(event_date, '%a %d %b') END AS shown, coalesce(strftime(event_date, '%B %Y'), 'Unknown date') AS month FROM v_event"))
def f28(spark, d):
    end = F.when(F.col("event_id") % 2 == 0, F.date_add("event_date", 2)).otherwise(F.col("event_date"))
    return view(spark, d, "v_event").select("event_id", D.event_date_text(F.col("event_date"), end).alias("shown"), D.month_bucket(F.col("event_date")).alias("month"))


@query("f29_runtime_text", "SELECT event_id AS seq, CASE WHEN s >= 3600 THEN s // 3600 || 'h ' || lpad(CAST(s % 3600 // 60 AS VARCHAR), 2, '0') || 'm ' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') || 's' WHEN s >= 60 THEN s // 60 || 'm ' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') || 's' ELSE s || 's' END AS runtime FROM (SELECT event_id, event_id % 9000 AS s FROM events)")
def f29(spark, d):
    return table(spark, d, "events").select(F.col("event_id").alias("seq"), D.runtime_text(F.col("event_id") % 9000).alias("runtime"))


@query("f42_iso_or_null", "SELECT event_id AS seq, CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' WHEN 1 THEN strftime(ts, '%Y-%m-%d') END AS iso FROM events")
def f42(spark, d):
    k = F.col("event_id") % 3
    raw = F.when(k == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k == 1, F.date_format("ts", "yyyy-MM-dd")).otherwise("yesterday")
    return table(spark, d, "events").select(F.col("event_id").alias("seq"), D.iso_or_null(raw).alias("iso"))


# JSON, enums and scores -----------------------------------------------------------------------------


@query("f30_job_posting", over("v_job", "SELECT job_id, CASE WHEN job_id % 3 < 2 THEN title END AS title, CASE WHEN job_id % 3 < 2 THEN location_raw END AS location, CASE WHEN job_id % 3 < 2 THEN company END AS org FROM v_job"))
def f30(spark, d):
    place = F.struct(F.struct(F.col("location_raw").alias("addressLocality")).alias("address"))
    body = F.struct(F.lit("JobPosting").alias("@type"), "title", F.struct(F.col("company").alias("name")).alias("hiringOrganization"), place.alias("jobLocation"))
    html = F.concat(F.lit("<html><script>x</script><script type=\"application/ld+json\">"), F.when(F.col("job_id") % 3 < 2, F.to_json(body)).otherwise("{broken"), F.lit("</script>"))
    return view(spark, d, "v_job").select("job_id", J.job_posting(html).alias("p")).select("job_id", "p.title", "p.location", "p.org")


_REPLY = """CASE doc_id % 5 WHEN 0 THEN '{"score": 4, "reason": "x"}' WHEN 1 THEN '```json {"score": 3, "reason": "y"} ```' WHEN 2 THEN 'Sure! {"score": 2} Hope that helps' WHEN 3 THEN '{"score": 5, "rea' ELSE 'none' END"""


@query("f31_repair_json", "SELECT doc_id, CAST(CASE doc_id % 5 WHEN 0 THEN 4 WHEN 1 THEN 3 WHEN 2 THEN 2 END AS BIGINT) AS score, CASE doc_id % 5 WHEN 0 THEN 'x' WHEN 1 THEN 'y' END AS reason FROM documents")
def f31(spark, d):
    return table(spark, d, "documents").select("doc_id", J.repair_json(F.expr(_REPLY), "score bigint, reason string").alias("r")).select("doc_id", "r.score", "r.reason")


@query("f32_has_fields", "SELECT doc_id, doc_id % 5 = 0 AS complete FROM documents")
def f32(spark, d):
    return table(spark, d, "documents").select("doc_id", J.has_fields(F.expr(_REPLY), ["score", "reason"]).alias("complete"))


def _case(expr: str, mapping: dict[str, str]) -> str:
    return f"CASE lower(trim({expr})) " + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items()) + " END"


_SPELLING = "CASE p_partkey % 5 WHEN 0 THEN ' Senior ' WHEN 1 THEN 'STAFF' WHEN 2 THEN 'junior' WHEN 3 THEN 'fixed-term' ELSE 'Flexible' END"


@query("f33_norm_enum", f"SELECT p_partkey AS job_id, {_case(_SPELLING, W.SENIORITY)} AS seniority, {_case(_SPELLING, W.EMPLOYMENT)} AS employment, {_case(_SPELLING, W.REMOTE)} AS remote FROM part")
def f33(spark, d):
    s = F.expr(_SPELLING)
    return table(spark, d, "part").select(F.col("p_partkey").alias("job_id"), *(R.norm_enum(s, m).alias(n) for n, m in (("seniority", W.SENIORITY), ("employment", W.EMPLOYMENT), ("remote", W.REMOTE))))


@query("f34_norm_function", "SELECT p_partkey AS job_id, CASE p_partkey % 4 WHEN 0 THEN 'Engineering' WHEN 1 THEN 'Data & Analytics' END AS fn FROM part")
def f34(spark, d):
    raw = F.expr("CASE p_partkey % 4 WHEN 0 THEN ' Engineering (core) ' WHEN 1 THEN 'Data & Analytics' WHEN 2 THEN 'null' ELSE p_type END")
    return table(spark, d, "part").select(F.col("p_partkey").alias("job_id"), R.norm_function(raw).alias("fn"))


@query("f35_record", over("v_job", f"SELECT job_id, CASE WHEN regexp_matches(title, '(?i)\\b({'|'.join(W.JUNIOR_WORDS)})\\b') THEN 'rules' ELSE 'scorer' END AS model FROM v_job"))
def f35(spark, d):
    jobs = P.run_rules(view(spark, d, "v_job").withColumns({"is_fdi": F.lit(False), "is_irish_founded": F.lit(False), "allowlisted": F.lit(False)}))
    reply = F.when(~F.col("rules.rejected"), F.lit("{}"))
    return jobs.select("job_id", J.classification_record(F.col("rules"), reply, F.lit("2024-01-31"))["model"].alias("model"))


@query("f36_embedded_picks", over("v_news", "SELECT seq, source AS company, url AS news_url FROM v_news WHERE seq % 2 = 0"))
def f36(spark, d):
    picks = F.to_json(F.array(F.struct(F.col("source").alias("company"), F.lit("s").alias("slug"), F.col("url").alias("news_url"))))
    notes = F.when(F.col("seq") % 2 == 0, F.concat(F.lit("call back\nPICKS_JSON: "), picks)).otherwise("nothing")
    return view(spark, d, "v_news").select("seq", F.explode(J.embedded_picks(notes)).alias("p")).select("seq", "p.company", "p.news_url")


CORE, SPORTS = ["brand#1", "brand#22"], ["brand#2", "brand#3"]


def score_sql(title: str, summary: str, company: str, source: str) -> str:
    core = any_of(company, CORE)
    one = lambda c, n: f"CASE WHEN {c} THEN {n} ELSE 0 END"
    return (
        f"CAST({one(core, 8)} + {one(any_of(title, W.SCORE_STRONG), 10)} + {one(any_of(summary, W.SCORE_STRONG), 5)} + 2 * {hits(title, W.SCORE_KEYWORDS)} + {hits(summary, W.SCORE_KEYWORDS)}"
        f" - {one(any_of(title, W.SCORE_EXCLUDED), 5)} - {one(any_of(title, W.SCORE_UNRELATED), 5)} + {one(f'{any_of(company, SPORTS)} AND NOT {core}', 1)} + {one(f'{source} <> ' + lit('LinkedIn'), 5)} AS BIGINT)"
    )


@query("f37_relevance_score", over("v_job", f"SELECT job_id, s AS score, CASE WHEN s >= 10 THEN 'high' WHEN s >= 5 THEN 'medium' WHEN s > 0 THEN 'low' END AS band FROM (SELECT job_id, {score_sql('title', 'summary', 'company', 'source')} AS s FROM v_job)"))
def f37(spark, d):
    s = R.relevance_score(*(F.col(c) for c in ("title", "summary", "company", "source")), CORE, SPORTS)
    return view(spark, d, "v_job").select("job_id", s.alias("score")).withColumn("band", R.relevance_band(F.col("score")))


_SIGNS = ["the", "and", "of", "re"]


@query("f38_scrapability", f"SELECT page_id, CASE WHEN {hits('html', W.CAREER_SIGNS)} >= 3 THEN 'medium' ELSE 'hard' END AS kind, CAST({hits('html', _SIGNS)} AS BIGINT) AS signs FROM pages")
def f38(spark, d):
    return table(spark, d, "pages").select("page_id", R.scrapability("html").alias("kind"), R.count_terms(F.col("html"), _SIGNS).cast("bigint").alias("signs"))


_SHAPES = """CASE s_suppkey % 6 WHEN 0 THEN '{"jobs": []}' WHEN 1 THEN '[]' WHEN 2 THEN '{"totalFound": 3}' WHEN 3 THEN '{"totalFound": 0}' WHEN 4 THEN 'oops' ELSE '{"error": 1}' END"""
_KINDS = "CASE s_suppkey % 4 WHEN 0 THEN 'greenhouse' WHEN 1 THEN 'smartrecruiters' WHEN 2 THEN 'ashby' ELSE 'personio' END"


@query("f39_valid_response", """
    SELECT s_suppkey AS source_id, CASE s_suppkey % 6 WHEN 1 THEN true WHEN 4 THEN false ELSE CASE s_suppkey % 4 WHEN 0 THEN s_suppkey % 6 = 0 WHEN 1 THEN s_suppkey % 6 = 2 WHEN 2 THEN s_suppkey % 6 = 0 ELSE true END END AS valid FROM supplier""")
def f39(spark, d):
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("source_id"), J.valid_response(F.expr(_KINDS), F.expr(_SHAPES)).alias("valid"))


@query("f40_join_nonempty", "SELECT p_partkey AS job_id, CASE WHEN p_size % 2 = 0 THEN p_brand || ', ' ELSE '' END || p_type AS joined FROM part")
def f40(spark, d):
    return table(spark, d, "part").select(F.col("p_partkey").alias("job_id"), X.join_nonempty(F.array(F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise(""), F.col("p_type"), F.lit(None))).alias("joined"))


@query("f41_rewrite_notes", "SELECT p_partkey AS job_id, p_name || chr(10) || 'STATUS: done' AS notes FROM part")
def f41(spark, d):
    notes = F.concat(F.col("p_name"), F.lit("\nSTATUS: open\n"), F.lit("COVER: "), F.col("p_type"))
    return table(spark, d, "part").select(F.col("p_partkey").alias("job_id"), X.rewrite_notes(notes, ["STATUS:", "COVER:"], ["STATUS: done"]).alias("notes"))


# Predicates ----------------------------------------------------------------------------------------


@query("p1_project", over("v_job", "SELECT job_id, title FROM v_job"))
def p1(spark, d):
    return P.project(view(spark, d, "v_job"), ["job_id", "title"])


@query("p2_where_all", over("v_job", "SELECT job_id FROM v_job WHERE status IN ('approved', 'pending') AND job_function IS NOT NULL AND seniority_rank BETWEEN 10 AND 30"))
def p2(spark, d):
    return P.where_all(view(spark, d, "v_job"), [F.col("status").isin("approved", "pending"), F.col("job_function").isNotNull(), F.col("seniority_rank").between(10, 30)]).select("job_id")


_TERMS = ["ation", "mente", "keit", "worthless"]


@query("p3_contains_any", over("v_article", f"SELECT seq FROM v_article WHERE {any_of('title', _TERMS)}"))
def p3(spark, d):
    return view(spark, d, "v_article").filter(R.contains_any("title", _TERMS)).select("seq")


@query("p4_drop_noise", over("v_article", f"SELECT seq FROM v_article WHERE NOT ({any_of('title', ['thatthe', 'leaux'])} AND NOT {any_of('title', ['tion', 'sport'])})"))
def p4(spark, d):
    return P.drop_noise(view(spark, d, "v_article"), noise=["thatthe", "leaux"], salvage=["tion", "sport"]).select("seq")


@query("p5_matches_word", over("v_job", r"SELECT job_id, regexp_matches(title, '(?i)\b(metal|gree|small)\b') AS hit FROM v_job"))
def p5(spark, d):
    return view(spark, d, "v_job").select("job_id", R.matches_word("title", ["metal", "gree", "small"]).alias("hit"))


_STAFF = "title || CASE job_id % 6 WHEN 0 THEN ' Brand Ambassador' WHEN 1 THEN ' Customer Support Agents' WHEN 2 THEN ' Community Moderation' ELSE '' END"
_NOISE = "|".join(W.NOISE_TITLES)


@query("p6_relevance_reason", over("v_job", rf"SELECT job_id, CASE WHEN source_id <> 7 AND regexp_matches({_STAFF}, '(?i)\b({_NOISE})\b') THEN 'relevance_noise (' || lower(regexp_extract({_STAFF}, '(?i)\b({_NOISE})\b', 1)) || ')' END AS reason FROM v_job"))
def p6(spark, d):
    return view(spark, d, "v_job").select("job_id", R.relevance_reason(F.expr(_STAFF), "source_id", [7]).alias("reason"))


_N = r"regexp_matches(location_raw, '(?i)\b\d+ locations?\b')"
GEO = (
    f"CASE WHEN location_raw IS NULL OR location_raw = '' THEN 'pending' WHEN {any_of('location_raw', W.ELIGIBLE)} THEN 'pass' WHEN {_N} OR {any_of('location_raw', W.MANY_PLACES_REJECT)} THEN 'reject' "
    f"WHEN {any_of('location_raw', W.MANY_PLACES_PENDING)} THEN 'pending' WHEN {any_of('location_raw', W.REJECTED)} THEN 'reject' ELSE 'pending' END"
)
_OFFICE = "regexp_replace(lower(regexp_extract(url, '/job/([^/]+)/', 1)), '-+', ' ', 'g')"
GEO_WIDE = (
    f"CASE WHEN location_raw IS NULL OR location_raw = '' THEN 'pending' WHEN {any_of('location_raw', W.ELIGIBLE_WIDE)} THEN 'pass' WHEN {_N} OR {any_of('location_raw', W.MANY_PLACES_PENDING)} THEN "
    f"CASE WHEN {_OFFICE} = '' THEN 'pending' WHEN {any_of(_OFFICE, W.OFFICE_ELIGIBLE + W.OFFICE_BRITAIN)} THEN 'pass' WHEN {any_of(_OFFICE, W.OFFICE_REJECTED)} THEN 'reject' ELSE 'pending' END "
    f"WHEN {any_of('location_raw', W.REJECTED_WIDE)} THEN 'reject' ELSE 'pending' END"
)


@query("p7_geo_verdict", over("v_job", f"SELECT job_id, {GEO} AS verdict FROM v_job"))
def p7(spark, d):
    return view(spark, d, "v_job").select("job_id", R.geo_verdict("location_raw").alias("verdict"))


@query("p8_geo_verdict_wide", over("v_job", f"SELECT job_id, {GEO_WIDE} AS verdict FROM v_job"))
def p8(spark, d):
    return view(spark, d, "v_job").select("job_id", R.geo_verdict_wide("location_raw", "url").alias("verdict"))


@query("p9_fresh_lenient", over("v_article", "SELECT seq FROM v_article WHERE published_on IS NULL OR published_on >= DATE '2024-01-31' - CASE feed_type WHEN 'site_rss' THEN 35 ELSE 40 END"))
def p9(spark, d):
    return P.fresh_lenient(view(spark, d, "v_article"), "published_on", "feed_type", W.AGE_LIMITS, F.lit("2024-01-31").cast("timestamp")).select("seq")


@query("p10_fresh_strict", over("v_job", "WITH a AS (SELECT job_id, CASE WHEN job_id % 3 = 0 THEN NULL ELSE job_id % 150 END AS days, CASE WHEN job_id % 6 = 0 THEN NULL ELSE 4199999000 + job_id * 10 END AS number FROM v_job) SELECT job_id, CASE WHEN days > 90 THEN 'posted_too_old (' || days || 'd)' WHEN days IS NULL AND number IS NULL THEN 'posted_age_unknown' WHEN days IS NULL AND number < 4200000000 THEN 'stale_id (' || number || ')' END AS reason FROM a").replace("FROM part) WITH a", "FROM part), a"))
def p10(spark, d):
    j = F.col("job_id")
    return view(spark, d, "v_job").select("job_id", R.fresh_strict_reason(F.when(j % 3 != 0, j % 150), F.when(j % 6 != 0, F.lit(4199999000) + j * 10)).alias("reason"))


@query("p11_name_reason", f"WITH n AS (SELECT p_partkey AS job_id, p_name AS a, CASE p_partkey % 7 WHEN 0 THEN ' ' WHEN 1 THEN p_type ELSE {_NAMED} END AS b, p_partkey % 14 = 1 AS o FROM part), m AS (SELECT job_id, b, o, {_NORM.format('a')} AS x, {_NORM.format('b')} AS y FROM n) SELECT job_id, CASE WHEN trim(b) = '' THEN 'no_hiring_org' WHEN NOT (regexp_replace(x, 's$', '') = regexp_replace(y, 's$', '') OR o) THEN 'name_mismatch (''' || x || ''' != ''' || y || ''')' END AS reason FROM m")
def p11(spark, d):
    n = table(spark, d, "part").select(F.col("p_partkey").alias("job_id"), "p_name", F.expr(f"CASE p_partkey % 7 WHEN 0 THEN ' ' WHEN 1 THEN p_type ELSE {_NAMED} END").alias("org"), (F.col("p_partkey") % 14 == 1).alias("o"))
    return n.select("job_id", R.name_reason(F.col("p_name"), F.col("org"), F.col("o")).alias("reason"))


@query("p12_subdomain", rf"WITH u AS (SELECT p_partkey AS job_id, p_size % 2 = 0 AS own, {_JOB_URL} AS url FROM part) SELECT job_id, CASE WHEN regexp_extract(url, '://([^.]+)\.', 1) = 'ie' OR (own AND regexp_extract(url, '://([^.]+)\.', 1) = 'www') THEN NULL ELSE 'wrong_subdomain (' || regexp_extract(url, '://([^.]+)\.', 1) || '.linkedin.com)' END AS reason FROM u")
def p12(spark, d):
    u = table(spark, d, "part").select(F.col("p_partkey").alias("job_id"), (F.col("p_size") % 2 == 0).alias("own"), F.expr(_JOB_URL).alias("url"))
    return u.select("job_id", R.subdomain_reason("url", F.col("own")).alias("reason"))


@query("p13_url_allowed", r"SELECT page_id, regexp_matches(url, '/en/\d+') AND NOT regexp_matches(url, '(?i)[?&](utm_source|ref)=') AS allowed FROM pages")
def p13(spark, d):
    return table(spark, d, "pages").select("page_id", R.url_allowed("url", r"/en/\d+", r"(?i)[?&](utm_source|ref)=").alias("allowed"))


_FINAL = "CASE page_id % 5 WHEN 0 THEN url WHEN 1 THEN 'https://x.org/careers/login' WHEN 2 THEN 'https://x.org/en/' WHEN 3 THEN 'https://x.org' ELSE 'https://x.org/jobs?page=2' END"


@query("p14_usable_page", "SELECT page_id, page_id % 5 IN (0, 4) AS usable FROM pages")
def p14(spark, d):
    return table(spark, d, "pages").select("page_id", R.usable_page(F.expr(_FINAL)).alias("usable"))


@query("p15_split_valid", over("v_job", "SELECT CASE WHEN location_raw IS NULL THEN 'error' ELSE 'valid' END AS part, count(*) AS n FROM v_job GROUP BY 1"))
def p15(spark, d):
    good, bad = P.split_valid(view(spark, d, "v_job"), ["url", "title", "location_raw"])
    return good.groupBy(F.lit("valid").alias("part")).agg(F.count("*").alias("n")).unionByName(bad.groupBy(F.lit("error").alias("part")).agg(F.count("*").alias("n")))


@query("p16_location_ok", over("v_job", f"SELECT job_id, CASE WHEN location_raw IS NULL THEN true ELSE {any_of('location_raw', W.DIGEST_INCLUDE)} AND NOT {any_of('location_raw', W.DIGEST_EXCLUDE)} END AS digest, CASE WHEN location_raw IS NULL THEN false ELSE {any_of('location_raw', W.BOARD_INCLUDE)} END AS include_only FROM v_job"))
def p16(spark, d):
    return view(spark, d, "v_job").select("job_id", R.location_ok("location_raw", W.DIGEST_INCLUDE, W.DIGEST_EXCLUDE).alias("digest"), R.location_ok("location_raw", W.BOARD_INCLUDE, [], False, "include_only").alias("include_only"))


@query("p17_board_filter", over("v_job", f"SELECT job_id, (location_raw IS NULL OR ({any_of('location_raw', W.BOARD_INCLUDE)} AND NOT {any_of('location_raw', W.BOARD_EXCLUDE)})) AND ({any_of('company', SPORTS)} OR {any_of('title', ['metal', 'gree'])}) AS kept FROM v_job"))
def p17(spark, d):
    jobs = view(spark, d, "v_job").withColumnRenamed("location_raw", "location")
    kept, dropped = P.filter_board_rows(jobs, SPORTS, ["metal", "gree"])
    return kept.select("job_id", F.lit(True).alias("kept")).unionByName(dropped.select("job_id", F.lit(False).alias("kept")))


@query("p18_filter_quality", over("v_job", f"SELECT job_id FROM v_job WHERE {any_of('company', CORE)} OR relevancy = 'high'"))
def p18(spark, d):
    return P.filter_quality(view(spark, d, "v_job"), CORE).select("job_id")


@query("p19_score_at_least", over("v_news", "SELECT seq FROM v_news WHERE seq % 10 <> 0 AND score >= 3"))
def p19(spark, d):
    text = F.when(F.col("seq") % 10 == 0, "n/a").otherwise(F.col("score").cast("string"))
    return P.score_at_least(view(spark, d, "v_news").withColumn("score", text)).select("seq")


_JUNIOR = "CASE job_id % 7 WHEN 0 THEN 'Junior ' WHEN 1 THEN 'Internal ' ELSE '' END || title"
RULES_SQL = f"""j AS (SELECT job_id, {_JUNIOR} AS title, location_raw, url, is_fdi, is_irish_founded, allowlisted FROM v_job LEFT JOIN v_company USING (company_id)),
    g AS (SELECT job_id, regexp_matches(title, '(?i)\\b(junior|intern|internship|entry level|entry-level|trainee|apprentice)\\b') AS junior,
                 CASE WHEN is_fdi AND NOT is_irish_founded THEN CASE WHEN allowlisted THEN {GEO_WIDE} ELSE {GEO} END ELSE 'n/a' END AS geo FROM j)"""


@query("p20_run_rules", over("v_job", "SELECT 1").rsplit(" SELECT 1", 1)[0] + ", v_company AS (SELECT n_nationkey AS company_id, (n_regionkey % 2 = 1) AS is_fdi, (n_nationkey % 5 = 0) AS is_irish_founded, (n_nationkey % 3 = 0) AS allowlisted FROM nation), " + RULES_SQL + " SELECT job_id, junior OR geo = 'reject' AS rejected, CASE WHEN junior THEN 'too_junior' WHEN geo = 'reject' THEN 'fdi_geography' END AS reason, CASE WHEN junior THEN 'n/a' ELSE geo END AS geo_check FROM g")
def p20(spark, d):
    from sievework.operators.joins import with_company

    jobs = with_company(view(spark, d, "v_job").withColumn("title", F.expr(_JUNIOR)), view(spark, d, "v_company"))
    return P.run_rules(jobs).select("job_id", "rules.rejected", "rules.reason", "rules.geo_check")


@query("p21_eligible", over("v_job", "SELECT job_id FROM v_job WHERE length(summary) >= 30 AND job_function IS NULL AND status = 'pending'"))
def p21(spark, d):
    return P.eligible(view(spark, d, "v_job"), "summary", "job_function", 30, "pending").select("job_id")


@query("p22_select_recheck", over("v_source", "SELECT source_id FROM v_source WHERE (ats_platform = 'none_found' OR source_id % 3 <> 0) AND company_id NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 0)"))
def p22(spark, d):
    results = view(spark, d, "v_source").withColumn("confidence", F.when(F.col("source_id") % 3 == 0, "high").otherwise("low"))
    protected = table(spark, d, "nation").filter("n_regionkey = 0").select(F.col("n_nationkey").alias("company_id"))
    return P.select_recheck(results, protected).select("source_id")


@query("p23_valid_url", "SELECT page_id, page_id % 3 = 0 AS valid FROM pages")
def p23(spark, d):
    raw = F.expr("CASE page_id % 3 WHEN 0 THEN url WHEN 1 THEN 'ftp://x.org/' ELSE 'https:///x' END")
    return table(spark, d, "pages").select("page_id", R.valid_http_url(raw).alias("valid"))


@query("p24_company_like", over("v_source", "SELECT source_id FROM v_source WHERE contains(lower(name), '01')"))
def p24(spark, d):
    return P.company_like(view(spark, d, "v_source"), "01").select("source_id")
