"""Queries of the table operators: dedupe, joins, aggregates, sorts, sets, updates, discovery, enrichment, sources, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievework.functions import rules as R
from sievework.functions import wordlists as W
from sievework.functions.text import norm_key
from sievework.operators import dedupe as Q
from sievework.operators import discovery as DI
from sievework.operators import enrich as E
from sievework.operators import filters as P
from sievework.operators import joins as J
from sievework.operators import metrics as A
from sievework.operators import ranking as O
from sievework.operators import upsert as M
from sievework.plans.query_functions import CORE, GEO, GEO_WIDE, MAIN_TEXT, RULES_SQL, SPORTS, any_of, hits, lit, score_sql  # noqa: F401
from sievework.plans.registry import query
from sievework.plans.views import VIEWS, over, over_all, table, view
from sievework.sources import feeds as S
from sievework.sources import payloads as PL
from sievework.streaming import streams as T

NEWS_NOW = "TIMESTAMP '2024-01-31 00:00:00'"


def at(text: str):
    return F.lit(text).cast("timestamp")


NOW, SEEN_NOW, TODAY = "2024-01-31 00:00:00", "2001-11-05 00:00:00", "1998-01-01"
_KEY = r"trim(regexp_replace(lower({}), '\s+', ' ', 'g'))"

# Dedupe and windows --------------------------------------------------------------------------------


@query("w1_collapse_identical", over("v_job", f"SELECT job_id FROM v_job QUALIFY row_number() OVER (PARTITION BY source_id, {_KEY.format('title')}, nullif({_KEY.format('location_raw')}, '') ORDER BY seq) = 1"))
def w1(spark, d):
    return Q.collapse_identical(view(spark, d, "v_job")).select("job_id")


@query("w2_first_by_key", over("v_article", "SELECT min(seq) AS seq, link FROM v_article GROUP BY link"))
def w2(spark, d):
    return Q.first_by_key(view(spark, d, "v_article"), "link").select("seq", "link")


@query("w3_title_company", over("v_job", "SELECT min(job_id) AS job_id FROM v_job GROUP BY lower(trim(title)), lower(trim(company))"))
def w3(spark, d):
    return Q.first_by_title_company(view(spark, d, "v_job"), "job_id").select("job_id")


_CAPS = {"src0": 15, "src1": 10, "src2": 5, "src3": 3}


@query("w4_cap_per_group", over("v_article", "SELECT seq, source FROM v_article QUALIFY row_number() OVER (PARTITION BY source ORDER BY seq) <= CASE source WHEN 'src0' THEN 15 WHEN 'src1' THEN 10 WHEN 'src2' THEN 5 WHEN 'src3' THEN 3 ELSE 8 END"))
def w4(spark, d):
    return Q.cap_per_group(view(spark, d, "v_article"), "source", _CAPS, default=8).select("seq", "source")


@query("w5_first_by_priority", over("v_article", "SELECT seq, link FROM (SELECT *, CASE lang WHEN 'en' THEN 0 WHEN 'de' THEN 1 ELSE 2 END AS p FROM v_article) QUALIFY row_number() OVER (PARTITION BY link ORDER BY p, seq) = 1"))
def w5(spark, d):
    return Q.first_by_priority(view(spark, d, "v_article"), "link", {"en": 0, "de": 1}, source="lang").select("seq", "link")


@query("w6_best_of_group", over("v_news", "SELECT seq FROM v_news QUALIFY row_number() OVER (PARTITION BY coalesce(story_key, 'row ' || seq) ORDER BY score DESC, contains(url, 'news.google.com'), seq) = 1"))
def w6(spark, d):
    return Q.best_of_group(view(spark, d, "v_news"), "story_key").select("seq")


_SERIES = "status = 'pending' AND event_date IS NOT NULL AND recurrence IS NOT NULL"


@query("w7_superseded", over("v_event", f"SELECT event_id, 'recurring_series_superseded' AS reason FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY event_date, event_id) AS k FROM v_event WHERE {_SERIES}) WHERE k > 1"))
def w7(spark, d):
    return Q.superseded_in_series(view(spark, d, "v_event")).select("event_id", "reason")


_PICK = """r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, published_at DESC, seq) = 1 AND row_number() OVER (PARTITION BY story_key ORDER BY score DESC, published_at DESC, seq) = 1 AS f FROM v_news),
    k AS (SELECT *, row_number() OVER (ORDER BY f DESC, score DESC, published_at DESC, seq) AS place FROM r)"""


_NULLED = "v_nulled AS (SELECT seq, score, published_at, CASE WHEN seq % 50 <> 7 THEN source END AS source, CASE WHEN seq % 40 <> 3 THEN story_key END AS story_key FROM v_news)"


@query("w8_weekly_pick", over("v_news", "SELECT 1").rsplit(" SELECT 1", 1)[0] + f", {_NULLED}, {_PICK.replace('FROM v_news', 'FROM v_nulled')} SELECT seq, place <= 5 AS picked, CASE WHEN place <= 5 THEN place END AS place FROM k")
def w8(spark, d):
    news = view(spark, d, "v_news").withColumn("source", F.when(F.col("seq") % 50 != 7, F.col("source"))).withColumn("story_key", F.when(F.col("seq") % 40 != 3, F.col("story_key")))
    return O.weekly_pick(news).select("seq", "picked", F.col("place").cast("bigint").alias("place"))


@query("w9_latest_by", over("v_news", "SELECT url, seq FROM v_news QUALIFY row_number() OVER (PARTITION BY url ORDER BY published_at DESC, seq DESC) = 1"))
def w9(spark, d):
    return Q.latest_by(view(spark, d, "v_news"), "url", "published_at", "seq").select("url", "seq")


@query("w10_in_window", over("v_news", "SELECT seq FROM v_news WHERE published_at BETWEEN TIMESTAMP '2024-01-20' - INTERVAL 7 DAY AND TIMESTAMP '2024-01-20' + INTERVAL 2 DAY"))
def w10(spark, d):
    return Q.in_window(view(spark, d, "v_news"), "published_at", F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"), 7, 2).select("seq")


@query("w11_assign_batches", over("v_article", "SELECT seq, source, n // 15 AS batch, n % 15 AS idx FROM (SELECT seq, source, row_number() OVER (PARTITION BY source ORDER BY seq) - 1 AS n FROM v_article)"))
def w11(spark, d):
    return Q.assign_batches(view(spark, d, "v_article"), bucket="source").select("seq", "source", "batch", F.col("idx").cast("bigint").alias("idx"))


@query("w12_failure_runs", over("v_fetch", """SELECT 1""").rsplit(" SELECT 1", 1)[0] + """, i AS (SELECT *, sum(CASE WHEN outcome = 'success' THEN 1 ELSE 0 END) OVER (PARTITION BY source_id ORDER BY seq) AS island FROM v_fetch),
    f AS (SELECT *, row_number() OVER (PARTITION BY source_id, island ORDER BY seq) AS k FROM i WHERE outcome = 'failure')
    SELECT source_id, min(seq) AS began, min(CASE WHEN k = 3 THEN seq END) AS abort_at, count(*) AS length FROM f GROUP BY source_id, island HAVING count(*) >= 3""")
def w12(spark, d):
    return O.failure_runs(view(spark, d, "v_fetch"))


@query("w13_hero", over("v_news", "SELECT seq, row_number() OVER (ORDER BY source <> 'purchase', seq) AS place FROM v_news ORDER BY place LIMIT 5"))
def w13(spark, d):
    return O.order_hero(view(spark, d, "v_news"), F.col("source") == "purchase").select("seq", F.col("place").cast("bigint").alias("place"))


@query("w14_stale_sources", over("v_fetch", f"SELECT source_id, max(CASE WHEN upserted > 0 THEN ts END) AS last_success FROM v_fetch GROUP BY source_id HAVING last_success IS NULL OR last_success < {NEWS_NOW} - INTERVAL 8 DAY"))
def w14(spark, d):
    return O.stale_sources(view(spark, d, "v_fetch"), at(NOW)).select("source_id", F.col("last_success").cast("timestamp_ntz").alias("last_success"))


# Joins ---------------------------------------------------------------------------------------------


@query("j1_active_sources", over_all(["v_source", "v_company"], "SELECT source_id, coalesce(c.name, '') AS company_name, coalesce(is_fdi, false) AS is_fdi FROM v_source s LEFT JOIN v_company c USING (company_id) WHERE is_active"))
def j1(spark, d):
    return J.active_sources(view(spark, d, "v_source"), view(spark, d, "v_company")).select("source_id", "company_name", "is_fdi")


@query("j2_with_company", over_all(["v_job", "v_company"], "SELECT job_id, name, is_fdi FROM v_job LEFT JOIN v_company USING (company_id)"))
def j2(spark, d):
    return J.with_company(view(spark, d, "v_job"), view(spark, d, "v_company")).select("job_id", "name", "is_fdi")


_BUCKET = "CASE WHEN last_success IS NULL THEN 'no_history' WHEN last_success < TIMESTAMP '2001-11-05' - INTERVAL 8 DAY THEN 'unhealthy' WHEN last_seen IS NULL OR last_seen >= last_success - INTERVAL 8 DAY THEN 'not_stale' ELSE 'archive' END"
_SEEN = ["v_seen_job", "v_source_health"]


@query("j3_source_health", over_all(_SEEN, f"SELECT {_BUCKET} AS bucket, count(*) AS n FROM v_seen_job LEFT JOIN v_source_health USING (source_id) GROUP BY 1"))
def j3(spark, d):
    return J.with_source_health(view(spark, d, "v_seen_job"), view(spark, d, "v_source_health"), at(SEEN_NOW)).groupBy("bucket").agg(F.count("*").alias("n"))


_CUT = "TIMESTAMP '2024-01-16 00:00:00'"


def _halves(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    news = view(spark, d, "v_news")
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    return news.filter(F.col("published_at") < cut), news.filter(F.col("published_at") >= cut)


@query("j4_not_seen", over("v_news", f"SELECT seq FROM v_news WHERE published_at >= {_CUT} AND url NOT IN (SELECT url FROM v_news WHERE published_at < {_CUT})"))
def j4(spark, d):
    old, new = _halves(spark, d)
    return J.not_seen(new, old, "url").select("seq")


@query("j5_match_company", over("v_job", f"SELECT job_id FROM v_job WHERE {any_of('company', CORE)}"))
def j5(spark, d):
    return J.match_company(view(spark, d, "v_job"), CORE).select("job_id")


@query("j6_resolve_included", "SELECT l_orderkey AS payload_id, l_linenumber AS line, CAST(l_partkey AS VARCHAR) AS rel_id, CASE WHEN l_linenumber < 3 THEN p_name END AS rel_name FROM lineitem LEFT JOIN part ON l_partkey = p_partkey")
def j6(spark, d):
    items = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("payload_id"), F.col("l_linenumber").alias("line"), F.lit("parts").alias("rel_type"), F.col("l_partkey").cast("string").alias("rel_id"))
    named = items.filter("line < 3").join(table(spark, d, "part"), F.col("rel_id").cast("bigint") == F.col("p_partkey"))
    included = named.select("payload_id", F.col("rel_type").alias("type"), F.col("rel_id").alias("id"), F.col("p_name").alias("name"), "line")
    out = J.resolve_included(items.filter("line < 3").withColumn("k", F.col("line")), included.select("payload_id", "type", "id", "name").distinct())
    rest = items.filter("line >= 3").withColumn("rel_name", F.lit(None).cast("string"))
    return out.select("payload_id", "line", "rel_id", "rel_name").unionByName(rest.select("payload_id", "line", "rel_id", "rel_name"))


@query("j7_attach_assets", over("v_news", "SELECT 1").rsplit(" SELECT 1", 1)[0] + ", n AS (SELECT url AS news_url, min(seq) AS news_id FROM v_news GROUP BY url), a AS (SELECT l_orderkey AS news_id, arg_min('asset/' || l_partkey, l_linenumber * 1000000 + l_partkey) AS asset_url FROM lineitem WHERE l_linenumber % 2 = 1 GROUP BY l_orderkey) SELECT seq, asset_url FROM v_news LEFT JOIN n ON url = news_url LEFT JOIN a USING (news_id)")
def j7(spark, d):
    news = view(spark, d, "v_news")
    items = news.groupBy(F.col("url").alias("news_url")).agg(F.min("seq").alias("news_id"))
    assets = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("news_id"), (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("asset_id"), F.concat(F.lit("asset/"), F.col("l_partkey")).alias("asset_url"), F.when(F.col("l_linenumber") % 2 == 1, "news").otherwise("job").alias("kind"))
    return J.attach_assets(news.select("seq", F.col("url").alias("news_url")), items, assets).select("seq", "asset_url")


# Addresses that are met, and the publishers that they stand for: known hosts, hosts of several-part domains, and others.
_HOSTS = [
    ("www.rte.ie", "RTÉ"), ("sub.example.co.uk", "Sub.Example"), ("siliconrepublic.com", "Silicon Republic"), ("sbcnews.co.uk", "SBC News"), ("www.mshale.com", "Mshale"),
    ("sustainhealth.fit", "Sustain Health Magazine"), ("sportstourismnews.com", "Sports Tourism News"), ("ft.com", "Financial Times"), ("the-daily-run.com.au", "The Daily Run"), ("news.org", "News"),
]


@query("j8_with_publisher", "SELECT page_id, CASE page_id % 10 " + " ".join(f"WHEN {k} THEN {lit(name)}" for k, (_, name) in enumerate(_HOSTS)) + " END AS publisher FROM pages")
def j8(spark, d):
    met = F.element_at(F.array(*(F.lit(f"https://{h}/x") for h, _ in _HOSTS)), (F.col("page_id") % 10 + 1).cast("int"))
    return J.with_publisher(table(spark, d, "pages").select("page_id", met.alias("url"))).select("page_id", "publisher")


@query("j9_attach_scores", over("v_article", "SELECT seq, CASE WHEN n % 15 = 3 THEN NULL ELSE n % 5 + 1 END AS score FROM (SELECT seq, row_number() OVER (PARTITION BY source ORDER BY seq) - 1 AS n FROM v_article)"))
def j9(spark, d):
    batches = Q.assign_batches(view(spark, d, "v_article").select("seq", "source"), bucket="source")
    replies = batches.filter("idx <> 3").select("bucket", "batch", "idx", ((F.col("batch") * 15 + F.col("idx")) % 5 + 1).alias("score"))
    stray = replies.withColumn("idx", F.col("idx") + 100)
    scored, unscored = J.attach_scores(batches, replies.unionByName(stray))
    return scored.select("seq", F.col("score").cast("bigint").alias("score")).unionByName(unscored.select("seq", F.lit(None).cast("bigint").alias("score")))


@query("j10_diff_by_key", over("v_news", f"SELECT 1").rsplit(" SELECT 1", 1)[0] + f", o AS (SELECT DISTINCT url FROM v_news WHERE published_at < {_CUT}), n AS (SELECT DISTINCT url FROM v_news WHERE published_at >= {_CUT}) SELECT url, CASE WHEN o.url IS NULL THEN 'inserted' WHEN n.url IS NULL THEN 'stored' ELSE 'updated' END AS change FROM o FULL JOIN n USING (url)")
def j10(spark, d):
    old, new = (x.select("url").distinct() for x in _halves(spark, d))
    return J.diff_by_key(old, new, "url").select("url", "change")


@query("j11_build_queries", "SELECT c_custkey AS company_id, k AS template_no, CASE k WHEN 0 THEN 'https://a/?q=' ELSE 'https://b/search?t=news&q=' END || replace(replace(c_name, ' ', '%20'), '#', '%23') AS query_url FROM customer, (SELECT unnest([0, 1]) AS k)")
def j11(spark, d):
    companies = table(spark, d, "customer").select(F.col("c_custkey").alias("company_id"), F.col("c_name").alias("name"))
    return J.build_queries(companies, ["https://a/?q={q}", "https://b/search?t=news&q={q}"]).select("company_id", "template_no", "query_url")


@query("j12_attach_detail", "SELECT p_partkey AS job_id, md5(html) AS description FROM part LEFT JOIN pages ON page_id = p_partkey")
def j12(spark, d):
    jobs = table(spark, d, "part").select(F.col("p_partkey").alias("job_id"), F.col("p_partkey").alias("url"))
    return J.attach_detail(jobs, table(spark, d, "pages").select(F.col("page_id").alias("url"), F.col("html").alias("description"))).select("job_id", F.md5("description").alias("description"))


@query("j13_attach_outcome", over("v_fetch", "SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN seq % 4 = 0 THEN 'failed' WHEN upserted = 1 THEN 'inserted' ELSE 'updated' END AS outcome FROM v_fetch) GROUP BY 1"))
def j13(spark, d):
    log = view(spark, d, "v_fetch")
    outcomes = log.filter("seq % 4 <> 0").select("seq", F.when(F.col("upserted") == 1, "inserted").otherwise("updated").alias("outcome"))
    return J.attach_outcome(log.select("seq"), outcomes, "seq").groupBy("outcome").agg(F.count("*").alias("n"))


# Aggregates ----------------------------------------------------------------------------------------


@query("a1_job_snapshot", over_all(["v_job", "v_source", "v_source_health"], "SELECT * FROM (SELECT count(*) FILTER (status = 'approved') AS approved, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'rejected') AS rejected, count(*) FILTER (status = 'archived') AS archived, count(*) FILTER (status = 'pending' AND job_function IS NULL) AS pending_without_function FROM v_job), (SELECT coalesce(string_agg(DISTINCT name, ', ' ORDER BY name), '') AS never_scraped, count(*) AS n_never_scraped FROM v_source LEFT JOIN v_source_health USING (source_id) WHERE is_active AND last_success IS NULL)"))
def a1(spark, d):
    sources = view(spark, d, "v_source").join(view(spark, d, "v_source_health"), "source_id", "left")
    return A.job_snapshot(view(spark, d, "v_job"), sources)


@query("a2_event_snapshot", over("v_event", "SELECT count(*) FILTER (status = 'verified' AND event_date >= DATE '1998-01-01') AS verified_upcoming, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'rejected') AS rejected FROM v_event"))
def a2(spark, d):
    return A.event_snapshot(view(spark, d, "v_event"), F.lit(TODAY).cast("date"))


@query("a3_status_distribution", over("v_event", "SELECT status, coalesce(recurrence, '—') AS reason, count(*) AS n FROM v_event GROUP BY ALL"))
def a3(spark, d):
    return A.status_distribution(view(spark, d, "v_event").withColumnRenamed("recurrence", "reason"))


_LOG = "SELECT CAST(user_id % 7 AS STRING) AS step, user_id AS source_id, CAST(event_id % 5 AS BIGINT) AS jobs_found, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS inserted, CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS updated, CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS reactivated, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS errors FROM events"
_STEP = "CAST(sum(jobs_found) AS BIGINT) AS scraped, CAST(sum(inserted) AS BIGINT) AS new, CAST(sum(updated + reactivated) AS BIGINT) AS updated, count(*) AS sources, count(*) FILTER (errors > 0) AS sources_with_errors"


def _log(spark: SparkSession, d: str) -> DataFrame:
    table(spark, d, "events").createOrReplaceTempView("events")
    return spark.sql(_LOG)


@query("a4_step_summary", f"WITH l AS ({_LOG}), g AS (SELECT step, {_STEP} FROM l GROUP BY step) SELECT *, CASE WHEN sources_with_errors = sources THEN 'failed' WHEN scraped = 0 THEN 'warning' ELSE 'success' END AS status FROM g")
def a4(spark, d):
    return A.step_summary(_log(spark, d))


@query("a5_tier_counts", over("v_news", "SELECT count(*) FILTER (score = 5) AS tier5, count(*) FILTER (score = 4) AS tier4, count(*) FILTER (score = 3) AS tier3, count(*) FILTER (score BETWEEN 1 AND 2) AS low, count(*) AS total FROM v_news"))
def a5(spark, d):
    return A.tier_counts(view(spark, d, "v_news").withColumn("score", F.col("score").cast("string")))


@query("a6_source_mix", "SELECT source, count(*) AS n FROM documents GROUP BY source")
def a6(spark, d):
    return A.source_mix(table(spark, d, "documents"))


_STAGE = """f AS (SELECT *, source AS feed, CASE WHEN NOT (published_on IS NULL OR published_on >= DATE '2024-01-31' - CASE feed_type WHEN 'site_rss' THEN 35 ELSE 40 END) THEN 'date_dropped' END AS s1 FROM v_article),
    c AS (SELECT *, row_number() OVER (PARTITION BY feed, s1 ORDER BY seq) AS k FROM f), u AS (SELECT *, CASE WHEN s1 IS NOT NULL THEN s1 WHEN k > 10 THEN 'cap_dropped' END AS s2 FROM c),
    v AS (SELECT *, row_number() OVER (PARTITION BY link, s2 ORDER BY seq) AS j FROM u), st AS (SELECT *, CASE WHEN s2 IS NOT NULL THEN s2 WHEN j > 1 THEN 'duplicate' ELSE 'kept' END AS stage FROM v)"""


def staged(articles: DataFrame, now=None, cap: int = 10) -> DataFrame:
    """Articles with the stage that each reaches: date_dropped, cap_dropped, duplicate or kept."""
    limit = F.when(F.col("feed_type") == "site_rss", 35).otherwise(40)
    dated = F.col("published_on").isNull() | (F.col("published_on") >= F.date_sub(F.lit("2024-01-31").cast("date"), limit))
    rows = articles.withColumn("feed", F.col("source")).withColumn("published", F.col("published_on")).withColumn("stage", F.when(~dated, "date_dropped"))
    k = F.row_number().over(Window.partitionBy("feed", "stage").orderBy("seq"))
    rows = rows.withColumn("_k", k).withColumn("stage", F.coalesce("stage", F.when(F.col("_k") > cap, "cap_dropped")))
    first = F.min("seq").over(Window.partitionBy("link", "stage"))
    return rows.withColumn("_f", first).withColumn("stage", F.coalesce("stage", F.when(F.col("seq") > F.col("_f"), "duplicate"), F.lit("kept"))).drop("_k", "_f")


@query("a7_feed_stats", over("v_article", "SELECT 1").rsplit(" SELECT 1", 1)[0] + f", {_STAGE} SELECT feed, count(*) AS total, count(*) FILTER (stage = 'date_dropped') AS date_dropped, count(*) FILTER (published_on IS NULL) AS unknown_date, count(*) FILTER (stage = 'kept') AS kept, count(*) FILTER (stage = 'cap_dropped') AS cap_dropped, min(published_on) AS oldest, max(published_on) AS newest FROM st GROUP BY feed")
def a7(spark, d):
    return A.feed_stats(staged(view(spark, d, "v_article")))


@query("a8_intake_funnel", over("v_article", "SELECT 1").rsplit(" SELECT 1", 1)[0] + f", {_STAGE} SELECT count(*) AS fetched, count(*) FILTER (stage <> 'date_dropped') AS after_date, count(*) FILTER (stage NOT IN ('date_dropped', 'cap_dropped')) AS after_cap, count(*) FILTER (stage = 'kept') AS after_dedupe, count(*) FILTER (stage = 'kept') AS final FROM st")
def a8(spark, d):
    return A.intake_funnel(staged(view(spark, d, "v_article")))


@query("a9_archive_breakdown", over_all(_SEEN, f"SELECT source_id, count(*) AS n FROM (SELECT *, {_BUCKET} AS bucket FROM v_seen_job LEFT JOIN v_source_health USING (source_id)) WHERE bucket = 'archive' GROUP BY source_id"))
def a9(spark, d):
    return A.archive_breakdown(J.with_source_health(view(spark, d, "v_seen_job"), view(spark, d, "v_source_health"), at(SEEN_NOW)), "source_id")


@query("a10_extraction_report", over("v_event", "SELECT status AS outcome, recurrence AS category, count(*) AS n, CAST(grouping(status, recurrence) AS BIGINT) AS level FROM v_event GROUP BY ROLLUP (status, recurrence)"))
def a10(spark, d):
    return A.extraction_report(view(spark, d, "v_event").select(F.col("status").alias("outcome"), F.col("recurrence").alias("category")))


@query("a11_discovery_breakdown", over("v_source", "SELECT 'ats_platform' AS dimension, ats_platform AS value, count(*) AS n FROM v_source GROUP BY ats_platform UNION ALL SELECT 'confidence', CASE WHEN source_id % 3 = 0 THEN 'high' ELSE 'low' END, count(*) FROM v_source GROUP BY 2 UNION ALL SELECT 'scrapability', CASE WHEN is_active THEN 'easy' ELSE 'hard' END, count(*) FROM v_source GROUP BY 2"))
def a11(spark, d):
    return A.discovery_breakdown(_results(spark, d))


def _results(spark: SparkSession, d: str) -> DataFrame:
    s = view(spark, d, "v_source")
    return s.withColumn("confidence", F.when(F.col("source_id") % 3 == 0, "high").otherwise("low")).withColumn("scrapability", F.when(F.col("is_active"), "easy").otherwise("hard"))


@query("a12_job_mix", over("v_job", "SELECT source, relevancy, count(*) AS n FROM v_job GROUP BY ALL"))
def a12(spark, d):
    return A.job_mix(view(spark, d, "v_job"))


@query("a13_rejection_audit", over("v_job", "WITH a AS (SELECT source_id, CASE WHEN job_id % 3 = 0 THEN NULL ELSE job_id % 150 END AS days, CASE WHEN job_id % 6 = 0 THEN NULL ELSE 4199999000 + job_id * 10 END AS number FROM v_job), r AS (SELECT source_id, CASE WHEN days > 90 THEN 'posted_too_old' WHEN days IS NULL AND number IS NULL THEN 'posted_age_unknown' WHEN days IS NULL AND number < 4200000000 THEN 'stale_id' ELSE 'accepted' END AS reason FROM a) SELECT source_id, count(*) FILTER (reason = 'accepted') AS accepted, count(*) FILTER (reason = 'posted_too_old') AS posted_too_old, count(*) FILTER (reason = 'posted_age_unknown') AS posted_age_unknown, count(*) FILTER (reason = 'stale_id') AS stale_id FROM r GROUP BY source_id").replace("FROM part) WITH a", "FROM part), a"))
def a13(spark, d):
    j = F.col("job_id")
    reason = R.fresh_strict_reason(F.when(j % 3 != 0, j % 150), F.when(j % 6 != 0, F.lit(4199999000) + j * 10))
    return A.rejection_audit(view(spark, d, "v_job").withColumn("reason", reason), ["posted_too_old", "posted_age_unknown", "stale_id"])


@query("a14_freshness", "SELECT max(ts) AS newest, CAST(floor(epoch(TIMESTAMP '2024-03-01 00:00:00' - max(ts)) / 3600) AS BIGINT) AS hours_since FROM events")
def a14(spark, d):
    return A.freshness(table(spark, d, "events"), "ts", at("2024-03-01 00:00:00")).withColumn("newest", F.col("newest").cast("timestamp_ntz"))


@query("a15_run_totals", f"SELECT CAST(sum(jobs_found) AS BIGINT) AS jobs_found, CAST(sum(inserted) AS BIGINT) AS inserted, CAST(sum(updated) AS BIGINT) AS updated, CAST(sum(reactivated) AS BIGINT) AS reactivated, CAST(sum(errors) AS BIGINT) AS errors, count(*) AS sources FROM ({_LOG})")
def a15(spark, d):
    return A.run_totals(_log(spark, d))


@query("a16_backfill_estimate", "SELECT count(*) AS total, count(*) FILTER (length(text) < 500) AS skippable, count(*) FILTER (length(text) >= 500) AS processable, count(*) FILTER (length(text) >= 500) * 100 AS cost_micro FROM documents")
def a16(spark, d):
    return A.backfill_estimate(table(spark, d, "documents"), min_chars=500)


@query("a17_status_mix", over("v_event", "SELECT status, count(*) AS n FROM v_event GROUP BY status"))
def a17(spark, d):
    return A.status_mix(view(spark, d, "v_event"))


@query("a18_silent_sources", over("v_fetch", "SELECT source_id, CASE WHEN NOT bool_or(ok) THEN 'failed' ELSE 'silent' END AS kind FROM v_fetch GROUP BY source_id HAVING NOT bool_or(ok) OR sum(upserted) = 0"))
def a18(spark, d):
    log = view(spark, d, "v_fetch")
    return A.silent_sources(log.groupBy("source_id").agg(F.bool_or("ok").alias("ok")), log.select("source_id", F.col("upserted").alias("n")))


@query("a19_classifier_tally", over_all(["v_job", "v_company"], "SELECT 1").rsplit(" SELECT 1", 1)[0] + f", {RULES_SQL} SELECT CASE WHEN junior THEN 'too_junior' WHEN geo = 'reject' THEN 'fdi_geography' ELSE 'passed' END AS outcome, count(*) AS n FROM g GROUP BY 1")
def a19(spark, d):
    from sievework.plans.query_functions import _JUNIOR

    jobs = P.run_rules(J.with_company(view(spark, d, "v_job").withColumn("title", F.expr(_JUNIOR)), view(spark, d, "v_company")))
    return A.classifier_tally(jobs.select(F.coalesce("rules.reason", F.lit("passed")).alias("outcome")))


@query("a20_group_sizes", over("v_news", "SELECT source, score, count(*) AS n FROM v_news GROUP BY ALL"))
def a20(spark, d):
    return A.group_sizes(view(spark, d, "v_news"), ["source", "score"])


# Sorts, limits and sets ----------------------------------------------------------------------------

_BAND = "CASE relevancy WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END"
_LEVEL = "CASE seniority WHEN 'executive' THEN 1 WHEN 'lead' THEN 2 WHEN 'senior' THEN 3 WHEN 'mid' THEN 4 ELSE 5 END"


@query("o1_top_jobs", over("v_job", f"SELECT job_id FROM v_job ORDER BY {any_of('company', CORE)} DESC, {_BAND}, job_id LIMIT 30"))
def o1(spark, d):
    return O.top_jobs(view(spark, d, "v_job"), CORE).select("job_id")


@query("o2_order_for_csv", over("v_job", f"SELECT job_id, source FROM v_job ORDER BY source = 'LinkedIn', {_BAND}, job_id"))
def o2(spark, d):
    return O.order_for_csv(view(spark, d, "v_job")).select("job_id", "source")


@query("o3_order_news", over("v_news", "SELECT seq, score FROM v_news ORDER BY score DESC, published_at DESC, seq"))
def o3(spark, d):
    return O.order_news(view(spark, d, "v_news")).select("seq", "score")


@query("o4_order_by_seniority", over("v_job", f"SELECT job_id, seniority FROM v_job ORDER BY {_LEVEL}, coalesce(seniority, 'Other'), company, job_id"))
def o4(spark, d):
    return O.order_by_seniority(view(spark, d, "v_job")).select("job_id", "seniority")


@query("o5_order_events", over("v_event", "SELECT event_id FROM v_event ORDER BY coalesce(event_date, DATE '9999-12-31'), event_id"))
def o5(spark, d):
    return O.order_events(view(spark, d, "v_event")).select("event_id")


@query("o6_order_by_count", "SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source")
def o6(spark, d):
    return O.order_by_count(A.source_mix(table(spark, d, "documents")), ["source"])


@query("o7_first_n_text", over("v_source", "SELECT ats_platform, string_agg(name, ', ' ORDER BY name) FILTER (k <= 12) AS text, greatest(count(*) - 12, 0) AS more FROM (SELECT ats_platform, name, row_number() OVER (PARTITION BY ats_platform ORDER BY name) AS k FROM v_source) GROUP BY ats_platform"))
def o7(spark, d):
    return O.first_n_text(view(spark, d, "v_source"), "name", 12, ["ats_platform"])


@query("o8_cap_rows", "SELECT c_custkey AS company_id, c_name AS name FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10")
def o8(spark, d):
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("company_id"), F.col("c_name").alias("name"), "c_acctbal")
    return O.cap_rows(customers, [F.desc("c_acctbal"), "company_id"], 10).select("company_id", "name")


@query("u1_append_all", over("v_article", "SELECT seq, CASE WHEN feed_type = 'site_rss' THEN link END AS link FROM v_article"))
def u1(spark, d):
    v = view(spark, d, "v_article")
    return O.append_all([v.filter("feed_type = 'site_rss'").select("seq", "link"), v.filter("feed_type <> 'site_rss'").select("seq")])


@query("u2_minus", over("v_news", f"SELECT DISTINCT url FROM v_news WHERE published_at >= {_CUT} EXCEPT SELECT url FROM v_news WHERE published_at < {_CUT}"))
def u2(spark, d):
    old, new = _halves(spark, d)
    return O.minus(new.select("url").distinct(), old, "url")


@query("u3_distinct_ids", over("v_job", "SELECT DISTINCT company_id FROM v_job WHERE company_id IS NOT NULL"))
def u3(spark, d):
    return O.distinct_ids(view(spark, d, "v_job"), "company_id")


@query("u4_replace_rows", over("v_source", "SELECT source_id, CASE WHEN source_id % 4 = 0 THEN 'rechecked' ELSE ats_platform END AS ats_platform FROM v_source"))
def u4(spark, d):
    base = view(spark, d, "v_source").select("source_id", "ats_platform")
    return O.replace_rows(base, base.filter("source_id % 4 = 0").withColumn("ats_platform", F.lit("rechecked")), "source_id")


# Keyed updates -------------------------------------------------------------------------------------

_ONE = "SELECT url, arg_max(score, published_at) AS score"


def _stored(old: DataFrame) -> DataFrame:
    return Q.latest_by(old, "url", "published_at", "seq")


@query("m1_upsert_news", over("v_news", "SELECT 1").rsplit(" SELECT 1", 1)[0] + f""", o AS (SELECT * FROM v_news WHERE published_at < {_CUT} QUALIFY row_number() OVER (PARTITION BY url ORDER BY published_at DESC, seq DESC) = 1),
    n AS (SELECT * FROM v_news WHERE published_at >= {_CUT} QUALIFY row_number() OVER (PARTITION BY url ORDER BY score DESC, seq) = 1)
    SELECT url, CASE WHEN o.url IS NULL THEN n.seq WHEN n.score > o.score THEN n.seq ELSE o.seq END AS seq, CASE WHEN o.url IS NULL THEN n.score WHEN n.score > o.score THEN n.score ELSE o.score END AS score, coalesce(o.status, n.status) AS status,
           CASE WHEN o.url IS NULL THEN 'inserted' WHEN n.url IS NULL THEN 'stored' WHEN n.score > o.score THEN 'updated' ELSE 'skipped' END AS change FROM o FULL JOIN n USING (url)""")
def m1(spark, d):
    old, new = _halves(spark, d)
    return M.upsert_news(_stored(old), new).select("url", "seq", "score", "status", "change")


@query("m2_upsert_events", over("v_event", "SELECT event_id AS url, CASE WHEN event_id % 3 = 0 THEN 'pending' ELSE status END AS status, CASE WHEN event_id % 3 = 0 OR (event_id % 3 = 1 AND status = 'pending') THEN 'new ' || name ELSE name END AS name, CASE WHEN event_id % 3 = 0 THEN 'inserted' WHEN event_id % 3 = 2 THEN 'stored' WHEN status = 'pending' THEN 'updated' ELSE 'seen' END AS change FROM v_event"))
def m2(spark, d):
    e = view(spark, d, "v_event").withColumn("url", F.col("event_id"))
    old = e.filter("event_id % 3 <> 0").select("url", "status", "name", F.lit(None).cast("timestamp").alias("last_seen_at"), F.lit(None).cast("timestamp").alias("first_seen_at"))
    new = e.filter("event_id % 3 <> 2").select("url", F.concat(F.lit("new "), F.col("name")).alias("name"))
    return M.upsert_events(old, new, at(NOW)).select("url", "status", "name", "change")


@query("m3_upsert_jobs", over("v_job", "SELECT url, CASE job_id % 3 WHEN 0 THEN 'pending' WHEN 1 THEN CASE WHEN status = 'archived' THEN 'pending' ELSE status END ELSE status END AS status, CASE WHEN job_id % 3 = 2 THEN NULL WHEN job_id % 3 = 0 THEN 'inserted' WHEN status = 'archived' THEN 'reactivated' ELSE 'updated' END AS outcome FROM v_job"))
def m3(spark, d):
    jobs = view(spark, d, "v_job").select("job_id", "url", "title", "status", F.lit(None).cast("timestamp").alias("last_seen"))
    out, outcomes = M.upsert_jobs(jobs.filter("job_id % 3 <> 0").drop("job_id"), jobs.filter("job_id % 3 <> 2").select("url", "title"), at(NOW))
    return out.join(outcomes, "url", "left").select("url", "status", "outcome")


@query("m4_stamp_sources", over_all(["v_source", "v_fetch"], f"SELECT source_id, CASE WHEN f.u IS NOT NULL THEN {NEWS_NOW} END AS last_attempt, CASE WHEN f.u > 0 THEN {NEWS_NOW} END AS last_success, e AS last_error FROM v_source LEFT JOIN (SELECT source_id, sum(upserted) AS u, arg_max(CASE WHEN NOT ok THEN 'error ' || seq END, seq) AS e FROM v_fetch GROUP BY source_id) f USING (source_id)"))
def m4(spark, d):
    none = F.lit(None).cast("timestamp")
    sources = view(spark, d, "v_source").select("source_id", none.alias("last_attempt"), none.alias("last_success"), F.lit(None).cast("string").alias("last_error"))
    log = view(spark, d, "v_fetch").withColumn("error", F.when(~F.col("ok"), F.concat(F.lit("error "), F.col("seq"))))
    # the last error, not the last row's: rows without one are left out of the maximum
    out = M.stamp_sources(sources, log.withColumn("seq", F.when(F.col("error").isNotNull(), F.col("seq"))), at(NOW))
    return out.select("source_id", F.col("last_attempt").cast("timestamp_ntz").alias("last_attempt"), F.col("last_success").cast("timestamp_ntz").alias("last_success"), "last_error")


@query("m5_sweep_buckets", over_all(_SEEN, f"SELECT CASE WHEN status IN ('approved', 'pending') THEN {_BUCKET} ELSE 'not_swept' END AS bucket, count(*) AS n FROM v_seen_job LEFT JOIN v_source_health USING (source_id) GROUP BY 1"))
def m5(spark, d):
    return M.sweep_jobs(view(spark, d, "v_seen_job"), view(spark, d, "v_source_health"), at(SEEN_NOW))[1]


@query("m5_sweep_table", over_all(_SEEN, f"SELECT job_id, source_id, CASE WHEN status IN ('approved', 'pending') AND {_BUCKET} = 'archive' THEN 'archived' ELSE status END AS status FROM v_seen_job LEFT JOIN v_source_health USING (source_id)"))
def m5_table(spark, d):
    return M.sweep_jobs(view(spark, d, "v_seen_job"), view(spark, d, "v_source_health"), at(SEEN_NOW))[0].select("job_id", "source_id", "status")


_PAST = "status = 'pending' AND event_date < DATE '1998-01-01'"


@query("m6_sweep_events", over("v_event", f"SELECT event_id, CASE WHEN {_PAST} THEN 'rejected' ELSE status END AS status, CASE WHEN {_PAST} THEN 'event_date_passed' END AS reason FROM v_event"))
def m6(spark, d):
    return M.sweep_events(view(spark, d, "v_event"), F.lit(TODAY).cast("date")).select("event_id", "status", "reason")


@query("m7_auto_reject", over("v_event", "SELECT event_id, CASE WHEN status = 'pending' AND event_id % 2 = 0 THEN 'rejected' ELSE status END AS status, CASE WHEN status = 'pending' AND event_id % 2 = 0 THEN 'off_topic' END AS reason FROM v_event"))
def m7(spark, d):
    e = view(spark, d, "v_event")
    return M.auto_reject(e, e.filter("event_id % 2 = 0").select("event_id"), "off_topic").select("event_id", "status", "reason")


@query("m8_series_collapse", over("v_event", "SELECT 1").rsplit(" SELECT 1", 1)[0] + f", s AS (SELECT event_id FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY event_date, event_id) AS k FROM v_event WHERE {_SERIES}) WHERE k > 1) SELECT e.event_id, CASE WHEN s.event_id IS NOT NULL THEN 'rejected' ELSE status END AS status FROM v_event e LEFT JOIN s USING (event_id)")
def m8(spark, d):
    return M.apply_series_collapse(view(spark, d, "v_event")).select("event_id", "status")


@query("m9_apply_classification", over_all(["v_job", "v_company"], "SELECT 1").rsplit(" SELECT 1", 1)[0] + f", {RULES_SQL} SELECT job_id, CASE WHEN junior THEN 'too_junior' WHEN geo = 'reject' THEN 'fdi_geography' WHEN job_id % 10 = 0 THEN 'scorer_error' WHEN job_id % 10 = 1 THEN 'not_relevant' ELSE 'passed' END AS outcome, CASE WHEN junior OR geo = 'reject' OR job_id % 10 = 1 THEN 'rejected' WHEN job_id % 10 = 0 THEN v_job.status ELSE 'pending' END AS new_status FROM g JOIN v_job USING (job_id)")
def m9(spark, d):
    from sievework.plans.query_functions import _JUNIOR

    jobs = P.run_rules(J.with_company(view(spark, d, "v_job").withColumn("title", F.expr(_JUNIOR)), view(spark, d, "v_company")))
    reply = F.when(F.col("job_id") % 10 != 0, F.struct((F.col("job_id") % 10 != 1).alias("relevant")))
    return M.apply_classification(jobs.withColumn("reply", reply), at(NOW)).select("job_id", "outcome", "new_status")


@query("m10_import_sources", over("v_source", "SELECT source_id, is_active AND company_id % 4 <> 0 AS is_active, ats_platform FROM v_source UNION ALL SELECT source_id + 1000000, true, 'lever' FROM v_source WHERE company_id % 4 = 0"))
def m10(spark, d):
    old = view(spark, d, "v_source").withColumn("discovered_at", F.lit(None).cast("timestamp"))
    fresh = old.filter("company_id % 4 = 0").select((F.col("source_id") + 1000000).alias("source_id"), "company_id", "name", F.lit("lever").alias("ats_platform"))
    return M.import_sources(old, fresh, at(NOW)).select("source_id", "is_active", "ats_platform")


@query("m11_backfill_null", over("v_job", "SELECT job_id, coalesce(job_function, CASE WHEN job_id % 12 = 0 THEN 'Other' END) AS job_function FROM v_job"))
def m11(spark, d):
    jobs = view(spark, d, "v_job")
    return M.backfill_null(jobs, jobs.filter("job_id % 12 = 0 OR job_id % 5 = 0").select("job_id", F.when(F.col("job_id") % 12 == 0, "Other").alias("job_function")), "job_id", "job_function").select("job_id", "job_function")


@query("m12_add_seen", over("v_news", f"SELECT DISTINCT url FROM v_news WHERE published_at < {_CUT} OR score >= 3"))
def m12(spark, d):
    old, new = _halves(spark, d)
    return M.add_seen(old, P.score_at_least(new))


@query("m13_changes_only", over("v_event", f"SELECT event_id, 'rejected' AS status FROM v_event WHERE {_PAST}"))
def m13(spark, d):
    e = view(spark, d, "v_event")
    return M.changes_only(e, M.sweep_events(e, F.lit(TODAY).cast("date")).drop("reason"), "event_id").select("event_id", "status")


# Discovery -----------------------------------------------------------------------------------------


def _probes(spark: SparkSession, d: str) -> DataFrame:
    s = view(spark, d, "v_source").select("company_id", "source_id", F.lower(F.replace("name", F.lit("#"), F.lit("-"))).alias("slug"))
    p = DI.expand_urls(s)
    k = F.col("source_id") + F.col("platform_rank")
    return p.withColumn("slug_rank", F.col("source_id")).withColumn("status", F.when(k % 3 == 0, 200).otherwise(404)).withColumn("body", F.when(k % 6 == 0, '{"jobs": []}').otherwise('{"error": 1}'))


_PROBES = "p AS (SELECT company_id, source_id, t.r AS r, t.p AS platform FROM v_source, (VALUES " + ", ".join(f"({i}, '{p}')" for i, (p, _) in enumerate(W.API_TEMPLATES)) + ") AS t(r, p))"
_VALID = "(source_id + r) % 3 = 0 AND CASE WHEN platform IN ('greenhouse', 'workable', 'ashby', 'teamtailor') THEN (source_id + r) % 6 = 0 WHEN platform = 'smartrecruiters' THEN false ELSE true END"


@query("d1_best_api_hit", over("v_source", "SELECT 1").rsplit(" SELECT 1", 1)[0] + f", {_PROBES} SELECT company_id, platform FROM p WHERE {_VALID} QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY source_id, r) = 1")
def d1(spark, d):
    return DI.best_api_hit(_probes(spark, d)).select("company_id", "platform")


def _landed(spark: SparkSession, d: str) -> DataFrame:
    """Pages as landed career pages of 50 companies."""
    n = F.col("page_id") % 5
    link = F.when(n == 0, "https://boards.greenhouse.io/acme").when(n == 1, "https://t.wd3.myworkdayjobs.com/en-US/jobsite").otherwise("")
    return table(spark, d, "pages").select(
        (F.col("page_id") % 50).alias("company_id"), F.col("page_id").alias("page_rank"), F.when(F.col("page_id") % 4 == 0, 200).otherwise(404).alias("status"),
        F.when(F.col("page_id") % 8 == 0, F.lit("https://x.org/login")).otherwise(F.lit("https://x.org/careers")).alias("final_url"), F.concat_ws(" ", "html", link).alias("html"),
    )


_LANDED = "l AS (SELECT page_id % 50 AS company_id, page_id, page_id % 5 AS n FROM pages WHERE page_id % 4 = 0)"


@query("d2_first_pass", over("v_company", "SELECT 1").rsplit(" SELECT 1", 1)[0] + f", {_LANDED}, b AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY page_id) = 1) SELECT company_id, CASE WHEN company_id % 6 = 0 THEN 'lever' WHEN n = 0 THEN 'greenhouse' WHEN n IS NOT NULL THEN 'custom_html' ELSE 'none_found' END AS ats_platform, CASE WHEN company_id % 6 = 0 OR (n = 0 AND company_id % 2 = 0) THEN 'high' WHEN n = 0 THEN 'medium' WHEN n IS NOT NULL THEN 'low' ELSE 'none' END AS confidence FROM v_company LEFT JOIN b USING (company_id)")
def d2(spark, d):
    companies = view(spark, d, "v_company")
    hits = companies.filter("company_id % 6 = 0").select("company_id", F.lit("lever").alias("platform"))
    return DI.decide_first_pass(companies, hits, _landed(spark, d), companies.filter("company_id % 2 = 0")).select("company_id", "ats_platform", "confidence")


@query("d3_second_pass", over("v_company", "SELECT 1").rsplit(" SELECT 1", 1)[0] + f", {_LANDED}, u AS (SELECT company_id, min(CASE n WHEN 1 THEN 1 WHEN 0 THEN 2 ELSE 4 END) AS stage FROM l WHERE page_id % 8 <> 0 GROUP BY company_id) SELECT company_id, coalesce(stage, CASE WHEN company_id % 3 = 0 THEN 3 ELSE 5 END) AS stage, CASE coalesce(stage, CASE WHEN company_id % 3 = 0 THEN 3 ELSE 5 END) WHEN 1 THEN 'workday' WHEN 2 THEN 'greenhouse' WHEN 3 THEN 'ashby' WHEN 4 THEN 'custom_html' ELSE 'none_found' END AS ats_platform FROM v_company LEFT JOIN u USING (company_id)")
def d3(spark, d):
    companies = view(spark, d, "v_company")
    hits = companies.filter("company_id % 3 = 0").select("company_id", F.lit("ashby").alias("platform"), F.lit("s").alias("slug"))
    return DI.decide_second_pass(companies, _landed(spark, d), hits).select("company_id", "stage", "ats_platform")


@query("d4_apply_known", over("v_source", "SELECT source_id, CASE WHEN company_id < 5 THEN 'workday' ELSE ats_platform END AS ats_platform, CASE WHEN company_id < 5 THEN 'known' ELSE 'probed' END AS source FROM v_source"))
def d4(spark, d):
    known = view(spark, d, "v_company").filter("company_id < 5").select("company_id", F.lit("workday").alias("ats_platform"))
    return DI.apply_known(view(spark, d, "v_source"), known).select("source_id", "ats_platform", "source")


@query("d5_settle_probes", over("v_fetch", "SELECT source_id AS probe_id, arg_max(ok, seq) AS hit, max(seq) AS attempts FROM v_fetch GROUP BY source_id"))
def d5(spark, d):
    log = view(spark, d, "v_fetch").select(F.col("source_id").alias("probe_id"), F.col("seq").alias("attempt"), F.when(F.col("ok"), 200).otherwise(0).alias("status"))
    return DI.settle_probes(log).select("probe_id", "hit", "attempts")


# Enrichment ----------------------------------------------------------------------------------------


X1_SQL = over("v_article", "SELECT seq, CAST(CASE WHEN " + any_of("title", W.NOISE_TOPICS) + f" THEN 1 ELSE least(5, 1 + {hits('title', W.SALVAGE_SIGNALS)}) END AS BIGINT) AS score FROM v_article")


@query("x1_score_batches", X1_SQL)
def x1(spark, d):
    articles = view(spark, d, "v_article").select("seq", "title", F.lit(None).cast("string").alias("snippet"))
    scored, missing = E.score_batches(articles, E.with_retry(E.RuleNewsScorer()))
    return scored.select("seq", F.col("score").cast("bigint").alias("score")).unionByName(missing.select("seq", F.lit(None).cast("bigint").alias("score")))


class _Faltering:
    """Rules that fail at the first call in each task."""

    def __init__(self) -> None:
        self.rules, self.calls = E.RuleNewsScorer(), 0

    def score(self, rows):
        self.calls += 1
        if self.calls == 1:
            raise OSError("not yet")
        return self.rules.score(rows)


@query("x7_with_retry", X1_SQL)
def x7(spark, d):
    articles = view(spark, d, "v_article").select("seq", "title", F.lit(None).cast("string").alias("snippet"))
    scored, missing = E.score_batches(articles, E.Retry(_Faltering(), 3, 0.01))
    return scored.select("seq", F.col("score").cast("bigint").alias("score")).unionByName(missing.select("seq", F.lit(None).cast("bigint").alias("score")))


_SENIOR = "CASE " + " ".join(f"WHEN contains(lower(title), '{k}') THEN '{k}'" for k in W.SENIORITY) + " ELSE 'mid' END"
_FUNCTION = "CASE " + " ".join(f"WHEN contains(lower(title), '{f.split(' ')[0].lower()[:6]}') THEN '{f}'" for f in W.FUNCTIONS) + " ELSE 'Other' END"


@query("x2_classify_rows", over("v_job", f"SELECT job_id, {_SENIOR} AS seniority, {_FUNCTION} AS job_function, NOT {any_of('title', W.SCORE_UNRELATED)} AS relevant FROM v_job"))
def x2(spark, d):
    return E.classify_rows(view(spark, d, "v_job")).select("job_id", "reply.seniority", "reply.job_function", "reply.relevant")


@query("x3_extract_events", f"""
    SELECT page_id, left(regexp_replace(regexp_extract(html, '<h1>(.*?)</h1>', 1), '^\\s+|\\s+$', '', 'g'), 120) AS name, NULL::VARCHAR AS date, NULL::VARCHAR AS location, left(main, 300) AS description,
           CASE WHEN {any_of('main', W.SALVAGE_SIGNALS)} THEN 'relevant' ELSE 'not_relevant' END AS relevance_category, 'low' AS extraction_confidence
    FROM (SELECT page_id, html, {MAIN_TEXT} AS main FROM pages)""")
def x3(spark, d):
    from sievework.functions.pages import main_content

    pages = table(spark, d, "pages").select("page_id", F.regexp_extract("html", "<h1>(.*?)</h1>", 1).alias("title"), main_content("html").alias("text"))
    return E.extract_events(pages).drop("reply_error")


@query("x4_enrich_rows", over("v_article", r"SELECT seq, left(regexp_replace(lower(title), '^\s+|\s+$', '', 'g'), 150) AS summary FROM v_article"))
def x4(spark, d):
    return E.enrich_rows(view(spark, d, "v_article").select("seq", "title", F.lit("").alias("snippet"))).select("seq", "summary")


@query("x5_excerpt_rows", r"SELECT doc_id, nullif(regexp_replace(regexp_replace(left(text, 400), '\.[^.]*$', ''), '^\s+|\s+$', '', 'g'), '') AS excerpt FROM documents")
def x5(spark, d):
    return E.excerpt_rows(table(spark, d, "documents")).drop("reply_error")


_STORIES = over("v_article", "SELECT 1").rsplit(" SELECT 1", 1)[0].replace("WITH", "WITH RECURSIVE", 1) + r""", t AS (SELECT seq, string_split(regexp_replace(regexp_replace(lower(coalesce(title, '')), '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g'), ' ') AS w FROM v_article),
    s AS (SELECT seq, list_distinct([array_to_string(w[i : i + least(len(w), 5) - 1], ' ') FOR i IN range(1, len(w) - least(len(w), 5) + 2)]) AS g FROM t),
    d AS (SELECT g, min(seq) AS seq, len(g) AS n FROM s GROUP BY g), x AS (SELECT seq, n, unnest(g) AS h FROM d),
    p AS (SELECT a.seq AS a, b.seq AS b FROM x a JOIN x b ON a.h = b.h AND a.seq <> b.seq GROUP BY a.seq, b.seq, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*))),
    e AS MATERIALIZED (SELECT * FROM p), r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
    m AS (SELECT d.seq, least(d.seq, coalesce(min(r.b), d.seq)) AS story FROM d LEFT JOIN r ON r.a = d.seq GROUP BY d.seq)
    SELECT s.seq, m.story FROM s JOIN d ON s.g = d.g JOIN m ON m.seq = d.seq"""


@query("x6_group_stories", _STORIES)
def x6(spark, d):
    return Q.group_stories(view(spark, d, "v_article"), "title").select("seq", "story")


# Sources -------------------------------------------------------------------------------------------


FEED_ITEMS, PAYLOAD_ITEMS = 256, 1000  # of a landed feed or payload page, at most


def _page(items: int):
    """A number that at most so many rows share: of a run of rows in one partition. A source is landed page by page."""
    return F.floor(F.monotonically_increasing_id() / items)


def _xml_text(name: str):
    """Text as XML holds it: marks escaped, characters that XML doesn't allow replaced."""
    text = F.regexp_replace(F.coalesce(F.col(name), F.lit("")), "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\uFFFE\\uFFFF]", "\ufffd")
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


@query("s1_read_feed_items", over("v_article", "SELECT source AS feed, count(*) AS n, min(link) AS first_link FROM v_article WHERE seq % 20 <> 0 GROUP BY source"))
def s1(spark, d):
    a = view(spark, d, "v_article").withColumn("t", _xml_text("title")).withColumn("page", _page(FEED_ITEMS))
    item = F.concat(F.lit("<item><title>"), F.col("t"), F.lit("</title>"), F.when(F.col("seq") % 20 != 0, F.concat(F.lit("<link>"), _xml_text("link"), F.lit("</link>"))).otherwise(""), F.lit("</item>"))
    xml = a.groupBy(F.col("source").alias("feed"), "page").agg(F.concat(F.lit("<rss><channel>"), F.array_join(F.collect_list(item), ""), F.lit("</channel></rss>")).alias("xml"))
    return S.read_feed_items(xml).groupBy("feed").agg(F.count("*").alias("n"), F.min("link").alias("first_link"))


@query("s2_first_nonempty", over("v_article", "SELECT seq, CASE WHEN source IN ('src0', 'src1') THEN 'feed' ELSE 'page' END AS method FROM v_article WHERE (source IN ('src0', 'src1') AND lang = 'en') OR source NOT IN ('src0', 'src1')"))
def s2(spark, d):
    a = view(spark, d, "v_article").withColumn("feed", F.col("source"))
    return S.first_nonempty([a.filter("lang = 'en' AND source IN ('src0', 'src1')"), a], names=["feed", "page"]).select("seq", "method")


_HEAD = "'The story of ' || trim(replace(regexp_extract(html, '<title>(.*?)</title>', 1), '&', 'and'))"
_ROOT = "regexp_extract(url, '^([a-zA-Z]+://[^/?#]+)', 1)"
# Listing pages in three layouts, out of the pages' titles.
_LISTED = f"""CASE page_id % 3
    WHEN 0 THEN '<article>none</article><article><h2>no link</h2><h3><a href="/p/' || CAST(page_id AS STRING) || '">' || {_HEAD} || '</a></h3><time datetime="2024-01-05">x</time><p>Snip <b>' || CAST(page_id AS STRING)
        || '</b></p></article><article><a href="q?a=1">Second</a><i class="my-Post-Date">5 Jan 2024</i></article><li><a href="/no">No</a></li>'
    WHEN 1 THEN '<div><a href="/en/news/' || CAST(page_id AS STRING) || '">x</a><h4>' || {_HEAD} || '</h4><i>on 16th April 2026 </i><p>Text</p></div><div><a href="/en/news/' || CAST(page_id AS STRING) || '">again here</a></div><a href="/about/us">About us</a>'
    ELSE '<section><a href="/tech/story-' || CAST(page_id AS STRING) || '">Read</a><h3>' || {_HEAD} || '</h3><time>2024-02-01</time></section><ul><li><a href="/tech/ab">too short a path</a></li></ul>' END"""
_LISTED_AT = "CASE page_id % 3 WHEN 0 THEN 'https://any.example.org/list/' WHEN 1 THEN 'https://www.enterprise-ireland.com/en/news' ELSE 'https://www.businesspost.ie/tech/' END"


@query("s3_extract_listing", f"""
    SELECT page_id, 0 AS seq, {_HEAD} AS title,
           CASE page_id % 3 WHEN 0 THEN 'https://any.example.org/p/' WHEN 1 THEN 'https://www.enterprise-ireland.com/en/news/' ELSE 'https://www.businesspost.ie/tech/story-' END || page_id AS link,
           CASE page_id % 3 WHEN 0 THEN '2024-01-05' WHEN 1 THEN '16th April 2026' ELSE '2024-02-01' END AS date, CASE page_id % 3 WHEN 0 THEN 'Snip ' || page_id WHEN 1 THEN 'Text' ELSE '' END AS snippet
    FROM pages
    UNION ALL SELECT page_id, 1, 'Second', 'https://any.example.org/list/q?a=1', '5 Jan 2024', 'Second5 Jan 2024' FROM pages WHERE page_id % 3 = 0""")
def s3(spark, d):
    return S.extract_listing(table(spark, d, "pages").select("page_id", F.expr(_LISTED_AT).alias("url"), F.expr(_LISTED).alias("html")))


@query("x8_lateral_listing", f"""
    SELECT page_id, 0 AS seq, {_HEAD} AS title,
           CASE page_id % 3 WHEN 0 THEN 'https://any.example.org/p/' WHEN 1 THEN 'https://www.enterprise-ireland.com/en/news/' ELSE 'https://www.businesspost.ie/tech/story-' END || page_id AS link
    FROM pages
    UNION ALL SELECT page_id, 1, 'Second', 'https://any.example.org/list/q?a=1' FROM pages WHERE page_id % 3 = 0""")
def x8_listing(spark, d):
    from sievework.sources.lateral import register_html_tables

    register_html_tables(spark)
    table(spark, d, "pages").select("page_id", F.expr(_LISTED_AT).alias("url"), F.expr(_LISTED).alias("html")).createOrReplaceTempView("listed_pages")
    return spark.sql("SELECT p.page_id, r.seq, r.title, r.link FROM listed_pages p, LATERAL listing_rows(p.html, p.url) r")


@query("x8_lateral_links", f"""
    WITH h AS (SELECT page_id, {_ROOT} AS root, regexp_extract_all(html, 'href="([^"]*)"', 1) AS hs FROM pages)
    SELECT page_id, CAST(generate_subscripts(hs, 1) - 1 AS INTEGER) AS seq, root || unnest(hs) AS link FROM h""")
def x8_links(spark, d):
    from sievework.sources.lateral import register_html_tables

    register_html_tables(spark)
    table(spark, d, "pages").createOrReplaceTempView("pages")
    return spark.sql("SELECT p.page_id, r.seq, r.link FROM pages p, LATERAL page_links(p.html, p.url) r")


@query("s4_discover_links", f"""
    WITH h AS (SELECT page_id, {_ROOT} AS root, regexp_extract_all(html, 'href="([^"]*)"', 1) AS hs FROM pages),
    l AS (SELECT page_id, root || unnest(hs) AS link, generate_subscripts(hs, 1) - 1 AS seq FROM h),
    k AS (SELECT page_id, link, min(seq) AS seq, CASE WHEN regexp_matches(link, '/(the|de|la|der)$') THEN 1 ELSE 2 END AS tier FROM l
          WHERE NOT regexp_matches(link, '/(about|contact|login)(/|$)', 'i') AND regexp_matches(link, '/[a-z]+$') GROUP BY page_id, link),
    b AS (SELECT *, min(tier) OVER (PARTITION BY page_id) AS best FROM k)
    SELECT page_id, CAST(seq AS INTEGER) AS seq, tier, link FROM b WHERE tier = best QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY seq) <= 30""")
def s4(spark, d):
    return S.discover_links(table(spark, d, "pages"), r"/(?:the|de|la|der)$", r"(?i)/(?:about|contact|login)(?:/|$)", r"/[a-z]+$", 30)


def _payloads(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Payloads of each platform, built from the jobs, and their landed detail pages."""
    jobs = view(spark, d, "v_job").withColumn("platform", F.element_at(F.array(*(F.lit(p) for p in _PLATFORMS)), (F.col("job_id") % len(_PLATFORMS) + 1).cast("int")))
    c = {n: F.col(n) for n in ("title", "url", "location_raw", "summary", "job_id")}
    s = lambda **k: F.struct(*(v.alias(n) for n, v in k.items()))
    item = {
        "greenhouse": s(absolute_url=c["url"], title=c["title"], location=s(name=c["location_raw"]), content=c["summary"]),
        "lever": s(hostedUrl=c["url"], text=c["title"], categories=s(location=c["location_raw"]), descriptionPlain=c["summary"]),
        "ashby": s(jobUrl=c["url"], title=c["title"], location=c["location_raw"], descriptionPlain=c["summary"]),
        "personio": s(id=c["job_id"], name=c["title"], office=c["location_raw"]),
        "breezy": s(url=c["url"], name=c["title"], location=s(city=c["location_raw"]), description=c["summary"]),
        "bamboohr": s(id=c["job_id"], jobOpeningName=c["title"], location=s(city=c["location_raw"])),
        "teamtailor": s(id=c["job_id"], attributes=s(title=c["title"], status=F.lit("open"), body=c["summary"])),
        "workday": s(title=c["title"], externalPath=F.concat(F.lit("/job/"), c["job_id"]), locationsText=c["location_raw"]),
        "rippling": s(id=c["job_id"], url=c["url"], name=c["title"], locations=F.array(s(name=c["location_raw"]))),
        "phenom": s(id=c["job_id"], applyUrl=c["url"], title=c["title"], locationName=c["location_raw"], description=c["summary"]),
    }
    wrap = {"greenhouse": '{"jobs": %s}', "ashby": '{"jobs": %s}', "bamboohr": '{"result": %s}', "teamtailor": '{"data": %s, "included": []}', "workday": '{"jobPostings": %s}', "rippling": '{"items": %s}', "phenom": '{"status": "success", "data": {"results": %s}}'}
    case = lambda of: F.coalesce(*(F.when(F.col("platform") == p, of(p)) for p in _PLATFORMS))
    paged = jobs.withColumn("page", _page(PAYLOAD_ITEMS)).withColumn("item", case(lambda p: F.to_json(item[p])))
    made = paged.groupBy("source_id", "platform", "page").agg(F.concat(F.lit("["), F.array_join(F.collect_list("item"), ","), F.lit("]")).alias("items"))
    made = made.withColumn("payload", case(lambda p: F.format_string(wrap.get(p, "%s"), "items")))
    out = made.select("source_id", "platform", F.lit("acme").alias("slug"), F.lit("https://acme.example.org").alias("base_url"), "payload")
    own = jobs.filter("platform IN ('personio', 'workday')")
    page = F.concat(F.lit('<script type="application/ld+json">'), F.to_json(s(**{"@type": F.lit("JobPosting"), "description": c["summary"]})), F.lit("</script>"))
    where = F.when(F.col("platform") == "personio", F.concat(F.lit("https://acme.jobs.personio.com/job/"), F.col("job_id"))).otherwise(F.concat(F.lit("https://acme.example.org/job/"), F.col("job_id")))
    return out, own.select(where.alias("url"), page.alias("html"))


_PLATFORMS = ["greenhouse", "lever", "ashby", "personio", "breezy", "bamboohr", "teamtailor", "workday", "rippling", "phenom"]
_PLATFORM = "CASE job_id % 10 " + " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(_PLATFORMS)) + " END"


@query("s5_normalise_payloads", over("v_job", f"SELECT {_PLATFORM} AS platform, source_id, trim(title) AS title, CASE WHEN job_id % 10 = 6 THEN NULL ELSE location_raw END AS location_raw, CASE WHEN job_id % 10 IN (5, 8) THEN NULL ELSE summary END AS summary FROM v_job"))
def s5(spark, d):
    landed, details = _payloads(spark, d)
    return PL.normalise_payloads(landed, details).select("platform", "source_id", "title", "location_raw", "summary")


@query("s5k_search_items", over("v_job", "SELECT trim(title) AS title, CASE WHEN job_id % 4 = 0 THEN 'no_hiring_org' WHEN job_id % 4 = 1 AND (job_id % 9) * 7 > 30 THEN 'stale (' || (job_id % 9) * 7 || 'd)' END AS reason FROM v_job"))
def s5k(spark, d):
    jobs = view(spark, d, "v_job")
    item = F.to_json(F.array(F.struct(F.concat(F.lit("https://www.linkedin.com/jobs/view/j-"), F.col("job_id")).alias("link"), "title", F.when(F.col("job_id") % 4 == 0, "").otherwise("Acme Ltd").alias("companyName"), F.when(F.col("job_id") % 4 == 1, F.concat(F.col("job_id") % 9, F.lit(" weeks ago"))).otherwise("Today").alias("postedAt"))))
    payloads = jobs.select(F.col("job_id").cast("string").alias("source_id"), F.lit("search").alias("platform"), F.lit("ACME").alias("slug"), item.alias("payload"))
    return PL.from_search_items(payloads, now=at(NOW)).select("title", "reason")


@query("s5l_job_page", over("v_job", "SELECT job_id, title, CASE WHEN job_id % 100 > 90 THEN 'posted_too_old (' || job_id % 100 || 'd)' END AS reason FROM v_job"))
def s5l(spark, d):
    jobs = view(spark, d, "v_job")
    html = F.concat(F.lit("<h1>"), F.col("title"), F.lit("</h1> Posted "), F.col("job_id") % 100, F.lit(" days ago"))
    pages = jobs.select(F.concat(F.lit("https://ie.linkedin.com/jobs/view/x-"), F.col("job_id")).alias("url"), html.alias("html"))
    return PL.from_job_page(pages, at(NOW)).select("job_id", "title", "reason")


@query("s6_board_results", over("v_job", "SELECT title, company, coalesce(location_raw, '') AS location FROM v_job"))
def s6(spark, d):
    item = F.struct("title", F.struct(F.col("company").alias("display_name")).alias("company"), F.struct(F.col("location_raw").alias("display_name")).alias("location"))
    pages = view(spark, d, "v_job").groupBy("source_id", _page(PAYLOAD_ITEMS).alias("page")).agg(F.concat(F.lit('{"results": ['), F.array_join(F.collect_list(F.to_json(item)), ","), F.lit("]}")).alias("payload"))
    return S.normalise_board_results(pages).select("title", "company", "location")


# A result page of each board for each job; a job without a place shows none.
_CARDS = {
    "linkedin": """'<div class="base-card big"><h3 class="base-search-card__title"> ' || title || ' </h3><h4 class="base-search-card__subtitle"><a href="#">' || company || '</a></h4>'
        || coalesce('<span class="job-search-card__location">' || location_raw || '</span>', '') || '<a class="base-card__full-link" href="/jobs/view/' || CAST(job_id AS STRING) || '">x</a></div>'""",
    "lever": """'<a class="posting-title" href="/l/' || CAST(job_id AS STRING) || '"><h5>' || title || '</h5>' || coalesce('<span class="sort-by-location">' || location_raw || '</span>', '') || '</a>'""",
    "workable": """'<ul><li class="job"><h3>' || title || '</h3>' || coalesce('<span class="location">' || location_raw || '</span>', '') || '<a href="j/' || CAST(job_id AS STRING) || '">x</a></li></ul>'""",
    "indeed": """'<div class="job_seen_beacon"><h2 class="jobTitle"><a class="jcs-JobTitle" href="/rc/' || CAST(job_id AS STRING) || '">' || title || '</a></h2>' || coalesce('<div class="companyLocation">' || location_raw || '</div>', '') || '</div>'""",
    "careers": """'<div class="Position-card"><h4>' || title || '</h4>' || coalesce('<p class="the-Location">' || location_raw || '</p>', '') || '</div><div class="job"><a>Apply</a></div>'""",
}


@query("s7_job_cards", over("v_job", r"""
    SELECT job_id AS page_id, 0 AS seq, regexp_replace(title, '^\s+|\s+$', '', 'g') AS title, CASE job_id % 5 WHEN 0 THEN company WHEN 3 THEN 'Company Not Listed' WHEN 4 THEN company ELSE '' END AS company,
           coalesce(location_raw, CASE job_id % 5 WHEN 1 THEN 'Location TBD' WHEN 2 THEN 'Northern Ireland' ELSE 'Ireland' END) AS location,
           CASE job_id % 5 WHEN 0 THEN 'https://www.linkedin.com/jobs/view/' || job_id WHEN 1 THEN 'https://acme.example/l/' || job_id WHEN 2 THEN 'https://acme.example/a/j/' || job_id
                WHEN 3 THEN 'https://ie.indeed.com/rc/' || job_id ELSE 'https://acme.example/a/' END AS link,
           '' AS summary, CASE job_id % 5 WHEN 0 THEN 'linkedin' WHEN 1 THEN 'lever' WHEN 2 THEN 'workable' WHEN 3 THEN 'indeed' ELSE 'careers' END AS platform
    FROM v_job"""))
def s7(spark, d):
    jobs, found = view(spark, d, "v_job"), []
    for k, (platform, html) in enumerate(_CARDS.items()):
        pages = jobs.filter(F.col("job_id") % 5 == k).select(F.col("job_id").alias("page_id"), F.lit("https://acme.example/a/").alias("url"), F.expr(html).alias("html"), "company")
        found.append(S.extract_job_cards(pages, platform, "company" if platform == "careers" else None))
    return O.append_all(found)


@query("s10_resolve_columns", over("v_job", "SELECT title, company AS employer, NULL::VARCHAR AS salary FROM v_job"))
def s10(spark, d):
    return P.resolve_columns(view(spark, d, "v_job"), {"title": ["Title", "title"], "employer": ["employer", "company"], "salary": ["salary"]})


@query("s12_scan", over("v_news", "SELECT seq, url FROM v_news WHERE score >= 4 AND source IN ('purchase', 'click') ORDER BY score DESC, seq LIMIT 50"))
def s12(spark, d):
    return P.scan(view(spark, d, "v_news"), ["seq", "url"], [F.col("score") >= 4, F.col("source").isin("purchase", "click")], [F.desc("score"), "seq"], 50)


@query("s17_publish", over("v_news", f"{_ONE} FROM v_news GROUP BY url").replace("arg_max(score, published_at)", "max(score)"))
def s17(spark, d):
    from uuid import uuid4

    from sievework.operators.graphs import folder
    from sievework.sources.sinks import publish_version, read_version

    place = f"{folder(spark)}/table-{uuid4().hex}"
    publish_version(view(spark, d, "v_news").groupBy("url").agg(F.max("score").alias("score")), place)
    return read_version(spark, place)


@query("s18_import_sheet", over("v_article", "SELECT seq, CASE seq % 4 WHEN 0 THEN 'no_url' WHEN 1 THEN 'bad_scheme' WHEN 2 THEN 'no_title' END AS reason FROM v_article"))
def s18(spark, d):
    k = F.col("seq") % 4
    sheet = view(spark, d, "v_article").select("seq", F.when(k == 0, " ").when(k == 1, F.lit("www.x.org")).otherwise(F.concat(F.col("link"), F.lit("\nhttps://second"))).alias("url"), F.when(k == 2, "Unknown").otherwise(F.lit("A  title")).alias("title"))
    rows, rejects = S.import_sheet(sheet)
    return rows.select("seq", F.lit(None).cast("string").alias("reason")).unionByName(rejects.select("seq", "reason"))


# Streams, run to the end over the table's rows ------------------------------------------------------


def _drained(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """A stream's rows once all its input is read, in the shared checkpoint folder."""
    from uuid import uuid4

    from sievework.operators.graphs import folder

    spark = stream.sparkSession
    place = f"{folder(spark)}/{name}-{uuid4().hex}"

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{place}/rows/batch={number}")

    query_ = stream.writeStream.foreachBatch(keep).outputMode(mode).option("checkpointLocation", f"{place}/state").trigger(availableNow=True).start()
    query_.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{place}/rows").select(*stream.columns)


def _event_stream(spark: SparkSession, d: str) -> DataFrame:
    """The events' file as a stream."""
    return T.stream_landing(spark, f"{d}/events.parquet*", table(spark, d, "events").schema)


@query("t1_stream_landing", "SELECT event_id, user_id FROM events")
def t1(spark, d):
    return _drained(_event_stream(spark, d).select("event_id", "user_id"), "t1")


@query("t2_stream_new_urls", over("v_news", "SELECT DISTINCT url FROM v_news"))
def t2(spark, d):
    stream = _event_stream(spark, d).select(F.expr("'https://news.example.org/' || CAST(user_id AS STRING) || '/' || CAST(event_id % 50 AS STRING)").alias("url"), "ts")
    return _drained(T.stream_new_urls(stream, "ts", "url", delay="3650 days").select("url"), "t2")


_SPANS = [(1, 5), (15, 16), (17, 17), (25, 31)]  # days of January that arrive one after the other; the third brings other addresses


@query("t2_new_urls_72h", over("v_news", r"""SELECT 1""").rsplit(" SELECT 1", 1)[0] + r""", n AS (SELECT CASE WHEN day(published_at) = 17 THEN 'tick/' ELSE '' END || url AS url, day(published_at) AS d FROM v_news WHERE month(published_at) = 1 AND year(published_at) = 2024),
    a AS (SELECT DISTINCT url FROM n WHERE d BETWEEN 1 AND 5), m AS (SELECT DISTINCT url FROM n WHERE d BETWEEN 15 AND 16 AND url NOT IN (SELECT url FROM a)), t AS (SELECT DISTINCT url FROM n WHERE d = 17),
    b AS (SELECT DISTINCT url FROM n WHERE d BETWEEN 25 AND 31 AND url NOT IN (SELECT url FROM m))
    SELECT 'a' AS part, count(*) AS n FROM a UNION ALL SELECT 'm', count(*) FROM m UNION ALL SELECT 't', count(*) FROM t UNION ALL SELECT 'b', count(*) FROM b""")
def t2_72h(spark, d):
    """An address is new again once its first sight is 72 hours behind the newest time seen."""
    place, counts = _place(spark, "t2"), []
    news = view(spark, d, "v_news").select("url", F.col("published_at").cast("timestamp").alias("ts"), F.dayofmonth("published_at").alias("d"), F.month("published_at").alias("m"), F.year("published_at").alias("y")).filter("m = 1 AND y = 2024")
    for k, (first, last) in enumerate(_SPANS):
        rows = news.filter(F.col("d").between(first, last)).select(F.when(F.col("d") == 17, F.concat(F.lit("tick/"), "url")).otherwise(F.col("url")).alias("url"), "ts")
        rows.write.mode("append").parquet(f"{place}/in")
        stream = T.stream_new_urls(T.stream_landing(spark, f"{place}/in", rows.schema), "ts", "url")
        keep = lambda batch, number, k=k: batch.select("url").write.mode("append").parquet(f"{place}/out/part={'amtb'[k]}")
        stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{place}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("url string, part string").parquet(f"{place}/out").groupBy("part").agg(F.count("*").alias("n"))


def _fetch_stream(spark: SparkSession, d: str) -> DataFrame:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    _event_stream(spark, d).createOrReplaceTempView("events")
    return spark.sql(VIEWS["v_fetch"])


@query("t4_stream_liveness", over("v_fetch", "SELECT source_id, CAST(floor(epoch(max(ts))) AS BIGINT) AS last_attempt, coalesce(CAST(floor(epoch(max(CASE WHEN upserted > 0 THEN ts END))) AS BIGINT), 0) AS last_success FROM v_fetch GROUP BY source_id"))
def t4(spark, d):
    found = _drained(T.stream_liveness(_fetch_stream(spark, d)), "t4", "update")
    return found.groupBy("source_id").agg(F.max("last_attempt").alias("last_attempt"), F.max("last_success").alias("last_success"))


@query("t5_stream_breaker", over("v_fetch", "SELECT 1").rsplit(" SELECT 1", 1)[0] + """, i AS (SELECT *, sum(CASE WHEN outcome = 'success' THEN 1 ELSE 0 END) OVER (PARTITION BY source_id ORDER BY seq) AS island FROM v_fetch),
    f AS (SELECT *, row_number() OVER (PARTITION BY source_id, island ORDER BY seq) AS k FROM i WHERE outcome = 'failure') SELECT source_id, seq AS abort_at FROM f WHERE k = 3""")
def t5(spark, d):
    return _drained(T.stream_breaker(_fetch_stream(spark, d)), "t5")


@query("t6_intake_day", "SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, count(*) AS n FROM events GROUP BY 1")
def t6(spark, d):
    return T.intake_counts(table(spark, d, "events"), "ts").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("t6_intake_rolling", "SELECT date_trunc('day', ts)::TIMESTAMP - k * INTERVAL 1 DAY AS window_start, count(*) AS n FROM events, (SELECT unnest(range(7)) AS k) GROUP BY 1")
def t6_rolling(spark, d):
    return T.intake_counts(table(spark, d, "events"), "ts", "7 days", "1 day").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("t7_split_late", "SELECT CASE WHEN ts < (SELECT max(ts) FROM events) - INTERVAL 72 HOUR THEN 'late' ELSE 'on_time' END AS part, count(*) AS n FROM events GROUP BY 1")
def t7(spark, d):
    events = table(spark, d, "events")
    newest = events.agg(F.max(F.col("ts").cast("timestamp")).alias("newest"))
    on_time, late = T.split_late(events.crossJoin(newest), "ts", 72, F.col("newest"))  # one row beside each
    return on_time.groupBy(F.lit("on_time").alias("part")).agg(F.count("*").alias("n")).unionByName(late.groupBy(F.lit("late").alias("part")).agg(F.count("*").alias("n")))


def _place(spark: SparkSession, name: str) -> str:
    from uuid import uuid4

    from sievework.operators.graphs import folder

    return f"{folder(spark)}/{name}-{uuid4().hex}"


@query("s8_read_csv", over("v_source", "SELECT CAST(source_id AS VARCHAR) AS source_id, name FROM v_source"))
def s8(spark, d):
    place = _place(spark, "csv")
    view(spark, d, "v_source").select("source_id", "name").write.csv(place, header=True)
    return S.read_csv_table(spark, place)


@query("s9_read_latest", over("v_source", "SELECT CAST(source_id AS VARCHAR) AS source_id FROM v_source"))
def s9(spark, d):
    place = _place(spark, "latest")
    sources = view(spark, d, "v_source").select(F.col("source_id").cast("string").alias("source_id"))
    sources.limit(1).write.parquet(f"{place}/run_1")
    sources.repartition("source_id").write.parquet(f"{place}/run_2")
    return S.read_latest(spark, f"{place}/*/part-*.parquet", "parquet", folders=True)


@query("s13_seen_state", over("v_news", "SELECT DISTINCT url FROM v_news"))
def s13(spark, d):
    from sievework.sources.sinks import load_seen, save_seen

    place, (old, new) = _place(spark, "seen"), _halves(spark, d)
    save_seen(old, place)
    save_seen(M.add_seen(load_seen(spark, place), new), place)
    return load_seen(spark, place)


@query("s14_article_doc", over("v_article", "SELECT link, '2024-01' AS month FROM v_article"))
def s14(spark, d):
    from sievework.sources.sinks import write_article_doc

    place = _place(spark, "doc")
    articles = view(spark, d, "v_article").select("title", "link")
    write_article_doc(articles, articles.limit(0), place, "2024-01-31T00:00:00")
    return spark.read.schema("link string, month string").json(f"{place}/articles").select("link", "month")


@query("s11_article_folder", over("v_article", f", v_fetch AS ({VIEWS['v_fetch']}) SELECT 'article' AS kind, link AS what, title AS detail FROM v_article UNION ALL SELECT 'failed', 'https://feeds.example/' || source_id, 'status ' || seq FROM v_fetch WHERE NOT ok"))
def s11(spark, d):
    from sievework.sources.sinks import write_article_doc

    place = _place(spark, "doc")
    url, error = (F.concat(F.lit(a), F.col(b).cast("string")) for a, b in (("https://feeds.example/", "source_id"), ("status ", "seq")))
    failed = view(spark, d, "v_fetch").filter("NOT ok").select(F.col("source_id").cast("string").alias("source"), url.alias("url"), error.alias("error"))
    write_article_doc(view(spark, d, "v_article").select("title", "link"), failed, place, "2024-01-31T00:00:00")
    articles, missed = S.read_article_folder(spark, place)
    return articles.select(F.lit("article").alias("kind"), F.col("link").alias("what"), F.col("title").alias("detail")).unionByName(
        missed.select(F.lit("failed").alias("kind"), F.col("url").alias("what"), F.col("error").alias("detail"))
    )


@query("s15_jobs_csv", over("v_job", "SELECT CAST(job_id AS VARCHAR) AS job_id, source FROM v_job"))
def s15(spark, d):
    from sievework.sources.sinks import write_jobs_csv

    place = _place(spark, "jobs")
    write_jobs_csv(view(spark, d, "v_job").select("job_id", "source", "relevancy"), place)
    return S.read_csv_table(spark, place).select("job_id", "source")


@query("s16_unsent", over("v_news", "SELECT seq, DATE '2024-01-31' AS day FROM v_news WHERE score < 2"))
def s16(spark, d):
    from sievework.sources.sinks import write_unsent

    place = _place(spark, "unsent")
    write_unsent(view(spark, d, "v_news").filter("score < 2").select("seq"), place, "2024-01-31")
    return spark.read.parquet(place).select("seq", F.col("day").cast("date").alias("day"))


@query("t3_stream_upsert", over("v_news", f"SELECT url, greatest(coalesce(max(score) FILTER (published_at >= {_CUT}), 0), coalesce(arg_max(score, published_at) FILTER (published_at < {_CUT}), 0)) AS score FROM v_news GROUP BY url"))
def t3(spark, d):
    """The later half of the news, as a stream, is merged into the earlier half."""
    from sievework.sources.sinks import publish_version, read_version

    place, (old, _) = _place(spark, "hub"), _halves(spark, d)
    columns = ["seq", "url", "source", "published_at", "story_key", "score", "status"]
    publish_version(_stored(old).select(*columns), f"{place}/table")
    events = _event_stream(spark, d)
    events.createOrReplaceTempView("events")
    later = spark.sql(VIEWS["v_news"]).filter(F.col("published_at") >= F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")).select(*columns)
    T.stream_upsert(later, f"{place}/table", lambda e, i: M.upsert_news(e, i).drop("change"), f"{place}/state").awaitTermination()
    return read_version(spark, f"{place}/table").select("url", "score")


# Flagship ------------------------------------------------------------------------------------------


@query("flagship", over("v_job", f"SELECT 1").rsplit(" SELECT 1", 1)[0] + f", u AS (SELECT * FROM v_job QUALIFY row_number() OVER (PARTITION BY source_id, {_KEY.format('title')}, nullif({_KEY.format('location_raw')}, '') ORDER BY seq) = 1), s AS (SELECT source, {score_sql('title', 'summary', 'company', 'source')} AS score FROM u) SELECT source, CASE WHEN score >= 10 THEN 'high' WHEN score >= 5 THEN 'medium' ELSE 'low' END AS band, count(*) AS n FROM s WHERE score > 0 GROUP BY ALL")
def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Listings, collapsed and scored, by source and band."""
    jobs = Q.collapse_identical(view(spark, d, "v_job"))
    score = R.relevance_score(*(F.col(c) for c in ("title", "summary", "company", "source")), CORE, SPORTS)
    scored = jobs.withColumn("band", R.relevance_band(score)).filter(F.col("band").isNotNull())
    return scored.groupBy("source", "band").agg(F.count("*").alias("n"))


def _spans(spark, d):
    """The news of each span of days, in the order in which the spans arrive."""
    news = view(spark, d, "v_news").select("seq", "url", F.col("published_at").cast("timestamp").alias("ts"), F.dayofmonth("published_at").alias("d"), F.month("published_at").alias("m"), F.year("published_at").alias("y")).filter("m = 1 AND y = 2024")
    for first, last in _SPANS:
        rows = news.filter(F.col("d").between(first, last))
        yield rows.select("seq", F.when(F.col("d") == 17, F.concat(F.lit("tick/"), "url")).otherwise(F.col("url")).alias("url"), "ts")


_SPANNED = "n AS (SELECT seq, CASE WHEN day(published_at) = 17 THEN 'tick/' ELSE '' END || url AS url, published_at AS ts, CASE WHEN day(published_at) <= 5 THEN 0 WHEN day(published_at) BETWEEN 15 AND 16 THEN 1 WHEN day(published_at) = 17 THEN 2 WHEN day(published_at) >= 25 THEN 3 END AS k FROM v_news WHERE month(published_at) = 1 AND year(published_at) = 2024)"


@query("t2_unseen_ever", over("v_news", "SELECT 1").rsplit(" SELECT 1", 1)[0] + f", {_SPANNED} SELECT url, CAST(min(k) AS BIGINT) AS batch FROM n WHERE k IS NOT NULL GROUP BY url")
def t2_ever(spark, d):
    """An address is new once, also where it comes back after the watermark."""
    place = _place(spark, "unseen")
    for rows in _spans(spark, d):
        rows.select("url", "ts").write.mode("append").parquet(f"{place}/in")
        keep = lambda batch, number: batch.select("url").write.mode("overwrite").parquet(f"{place}/out/batch={number}")
        T.stream_unseen(T.stream_landing(spark, f"{place}/in", rows.select("url", "ts").schema), "ts", "url", place, keep, words=64).awaitTermination()
    found = spark.read.schema("url string, batch bigint").parquet(f"{place}/out")
    # a watermark that moves makes one more batch without rows, so the place among batches with rows counts
    order = found.select("batch").distinct().withColumn("k", F.row_number().over(Window.orderBy("batch")) - 1)
    return found.join(F.broadcast(order), "batch").select("url", F.col("k").cast("bigint").alias("batch"))


@query("t5_breaker_runs", over("v_fetch", "SELECT 1").rsplit(" SELECT 1", 1)[0] + """, i AS (SELECT *, sum(CASE WHEN outcome = 'success' THEN 1 ELSE 0 END) OVER (PARTITION BY source_id ORDER BY seq) AS island FROM v_fetch),
    f AS (SELECT *, row_number() OVER (PARTITION BY source_id, island ORDER BY seq) AS k FROM i WHERE outcome = 'failure') SELECT source_id, seq AS abort_at FROM f WHERE k = 3""")
def t5_runs(spark, d):
    """The log arrives in three parts; runs go on from one to the next."""
    place, log = _place(spark, "breaker"), view(spark, d, "v_fetch").select("source_id", "seq", "outcome")
    top = log.agg(F.max("seq")).first()[0] or 0
    for k in range(3):
        log.filter(F.floor(F.col("seq") * 3 / (top + 1)) == k).write.mode("append").parquet(f"{place}/in")
        T.stream_breaker_runs(T.stream_landing(spark, f"{place}/in", log.schema), place).awaitTermination()
    return spark.read.schema("source_id bigint, abort_at bigint, batch bigint").parquet(f"{place}/opened").select("source_id", "abort_at")


@query("t7_stream_split_late", over("v_news", "SELECT 1").rsplit(" SELECT 1", 1)[0] + f""", {_SPANNED}, r AS (SELECT *, 3 - k AS turn FROM n WHERE k IS NOT NULL), b AS (SELECT turn, max(ts) AS newest FROM r GROUP BY turn),
    w AS (SELECT turn, max(newest) OVER (ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM b)
    SELECT seq, CASE WHEN ts < newest - INTERVAL 72 HOUR THEN 'late' ELSE 'on_time' END AS part, CAST(turn AS BIGINT) AS batch FROM r JOIN w USING (turn)""")
def t7_stream(spark, d):
    """The spans arrive from the newest to the oldest."""
    place = _place(spark, "late")
    for rows in reversed(list(_spans(spark, d))):
        rows.select("seq", "ts").write.mode("append").parquet(f"{place}/in")

        def sink(part):
            return lambda batch, number: batch.select("seq").write.mode("overwrite").parquet(f"{place}/out/part={part}/batch={number}")

        T.stream_split_late(T.stream_landing(spark, f"{place}/in", rows.select("seq", "ts").schema), "ts", 72, place, sink("on_time"), sink("late")).awaitTermination()
    return spark.read.schema("seq bigint, part string, batch bigint").parquet(f"{place}/out").select("seq", "part", "batch")


# Keyed updates where keys are null and repeat --------------------------------------------------------

_ODD_NEWS = "n AS (SELECT seq, CASE WHEN seq % 17 = 0 THEN NULL ELSE url END AS url, score, status, published_at FROM v_news)"
_ODD_JOBS = "j AS (SELECT job_id, CASE WHEN job_id % 11 = 0 THEN NULL ELSE 'u' || CAST(job_id % 500 AS VARCHAR) END AS url, title, status, job_function FROM v_job)"


def _odd(name: str, ctes: str, sql: str) -> str:
    return over(name, "SELECT 1").rsplit(" SELECT 1", 1)[0] + f", {ctes} {sql}"


def _odd_news(spark, d):
    news = view(spark, d, "v_news").withColumn("url", F.when(F.col("seq") % 17 != 0, F.col("url")))
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    return news.filter(F.col("published_at") < cut), news.filter(F.col("published_at") >= cut)


def _odd_jobs(spark, d):
    url = F.when(F.col("job_id") % 11 != 0, F.concat(F.lit("u"), (F.col("job_id") % 500).cast("string")))
    return view(spark, d, "v_job").withColumn("url", url).select("job_id", "url", "title", "status", "job_function")


@query("m1_upsert_odd_keys", _odd("v_news", _ODD_NEWS, f"""
    , o AS (SELECT * FROM n WHERE published_at < {_CUT} QUALIFY row_number() OVER (PARTITION BY url ORDER BY score DESC, seq) = 1),
    i AS (SELECT * FROM n WHERE published_at >= {_CUT} QUALIFY row_number() OVER (PARTITION BY url ORDER BY score DESC, seq) = 1)
    SELECT coalesce(o.url, i.url) AS url, CASE WHEN o.seq IS NULL OR i.score > o.score THEN i.seq ELSE o.seq END AS seq,
           CASE WHEN o.seq IS NULL THEN 'inserted' WHEN i.seq IS NULL THEN 'stored' WHEN i.score > o.score THEN 'updated' ELSE 'skipped' END AS change
    FROM o FULL JOIN i ON o.url IS NOT DISTINCT FROM i.url"""))
def m1_odd(spark, d):
    old, new = _odd_news(spark, d)
    return M.upsert_news(old, new).select("url", "seq", "change")


@query("m3_upsert_odd_keys", _odd("v_job", _ODD_JOBS, """
    , o AS (SELECT url, title, status FROM j WHERE job_id % 3 <> 0 QUALIFY row_number() OVER (PARTITION BY url ORDER BY title, status) = 1),
    i AS (SELECT url, min(title) AS title FROM j WHERE job_id % 3 <> 2 GROUP BY url)
    SELECT coalesce(o.url, i.url) AS url, coalesce(i.title, o.title) AS title, CASE WHEN o.title IS NULL OR (i.title IS NOT NULL AND o.status = 'archived') THEN 'pending' ELSE o.status END AS status
    FROM o FULL JOIN i ON o.url IS NOT DISTINCT FROM i.url"""))
def m3_odd(spark, d):
    jobs = _odd_jobs(spark, d)
    old = jobs.filter("job_id % 3 <> 0").select("url", "title", "status", F.lit(None).cast("timestamp").alias("last_seen"))
    return M.upsert_jobs(old, jobs.filter("job_id % 3 <> 2").select("url", "title"), at(NOW))[0].select("url", "title", "status")


@query("m11_backfill_odd_keys", _odd("v_job", _ODD_JOBS, """
    , v AS (SELECT url, min(job_function) AS f FROM j WHERE job_id % 5 = 0 GROUP BY url)
    SELECT job_id, coalesce(job_function, f) AS job_function FROM j LEFT JOIN v ON j.url IS NOT DISTINCT FROM v.url"""))
def m11_odd(spark, d):
    jobs = _odd_jobs(spark, d)
    return M.backfill_null(jobs, jobs.filter("job_id % 5 = 0").select("url", "job_function"), "url", "job_function").select("job_id", "job_function")


@query("j4_not_seen_odd_keys", _odd("v_news", _ODD_NEWS, f"SELECT seq FROM n WHERE published_at >= {_CUT} AND NOT EXISTS (SELECT 1 FROM n AS o WHERE o.published_at < {_CUT} AND o.url IS NOT DISTINCT FROM n.url)"))
def j4_odd(spark, d):
    old, new = _odd_news(spark, d)
    return J.not_seen(new, old, "url").select("seq")


@query("j10_diff_odd_keys", _odd("v_news", _ODD_NEWS, f"""
    , o AS (SELECT url, min(seq) AS seq FROM n WHERE published_at < {_CUT} GROUP BY url), i AS (SELECT url, min(seq) AS seq FROM n WHERE published_at >= {_CUT} GROUP BY url)
    SELECT coalesce(o.url, i.url) AS url, o.seq AS old_seq, i.seq AS new_seq, CASE WHEN o.seq IS NULL THEN 'inserted' WHEN i.seq IS NULL THEN 'stored' ELSE 'updated' END AS change
    FROM o FULL JOIN i ON o.url IS NOT DISTINCT FROM i.url"""))
def j10_odd(spark, d):
    old, new = (x.select("url", "seq") for x in _odd_news(spark, d))
    return J.diff_by_key(old, new, "url").select("url", F.col("old.seq").alias("old_seq"), F.col("new.seq").alias("new_seq"), "change")


@query("j13_outcome_odd_keys", _odd("v_job", _ODD_JOBS, """
    , o AS (SELECT url, min(CASE WHEN status = 'approved' THEN 'inserted' ELSE 'updated' END) AS outcome FROM j WHERE job_id % 4 = 0 GROUP BY url)
    SELECT job_id, coalesce(o.outcome, 'failed') AS outcome FROM j LEFT JOIN o ON j.url IS NOT DISTINCT FROM o.url"""))
def j13_odd(spark, d):
    jobs = _odd_jobs(spark, d)
    outcomes = jobs.filter("job_id % 4 = 0").select("url", F.when(F.col("status") == "approved", "inserted").otherwise("updated").alias("outcome"))
    return J.attach_outcome(jobs, outcomes).select("job_id", "outcome")


@query("u4_replace_odd_keys", _odd("v_job", _ODD_JOBS, """
    , u AS (SELECT url, job_id + 1000000 AS job_id FROM j WHERE job_id % 9 = 0)
    SELECT url, job_id FROM j WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.url IS NOT DISTINCT FROM j.url) UNION ALL SELECT url, job_id FROM u"""))
def u4_odd(spark, d):
    jobs = _odd_jobs(spark, d).select("url", "job_id")
    return O.replace_rows(jobs, jobs.filter("job_id % 9 = 0").withColumn("job_id", F.col("job_id") + 1000000), "url")
