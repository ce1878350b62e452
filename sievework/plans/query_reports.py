"""Queries of the reports (R)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.operators import filters as P
from sievework.operators import joins as J
from sievework.operators import metrics as A
from sievework.operators import upsert as M
from sievework.plans import reports as R
from sievework.plans.query_functions import _JUNIOR, CORE, RULES_SQL, any_of
from sievework.plans.query_operators import NOW, SEEN_NOW, TODAY, _BAND, _BUCKET, _CUT, _LOG, _PICK, _STAGE, _STEP, _halves, _log, _results, at, staged
from sievework.plans.registry import query
from sievework.plans.views import over, over_all, view


def head(views: list[str]) -> str:
    return over_all(views, "SELECT 1").rsplit(" SELECT 1", 1)[0]


def facts(section: str, source: str, names: list[str]) -> str:
    """SQL: a one-row relation as lines."""
    return " UNION ALL ".join(f"SELECT '{section}', CAST({i + 1} AS BIGINT), '{n}: ' || coalesce(CAST({n} AS VARCHAR), '—') FROM {source}" for i, n in enumerate(names))


_TIERS = "count(*) FILTER (score = 5) AS tier5, count(*) FILTER (score = 4) AS tier4, count(*) FILTER (score = 3) AS tier3, count(*) FILTER (score BETWEEN 1 AND 2) AS low, count(*) AS total"


@query("r1_research_digest", head(["v_news", "v_job", "v_fetch"]) + f""", t AS (SELECT {_TIERS} FROM v_news), top AS (SELECT * FROM v_job ORDER BY {any_of('company', CORE)} DESC, {_BAND}, job_id LIMIT 30)
    SELECT CASE WHEN score >= 3 THEN 'tier ' || score ELSE 'low' END AS section, row_number() OVER (PARTITION BY CASE WHEN score >= 3 THEN 'tier ' || score ELSE 'low' END ORDER BY published_at DESC, seq) AS place, score || ' | ' || source || ' | ' || url AS line FROM v_news
    UNION ALL SELECT 'jobs', row_number() OVER (ORDER BY job_id), title || ' | ' || company || ' | ' || coalesce(location_raw, '') FROM top
    UNION ALL {facts('statistics', 't', ['tier5', 'tier4', 'tier3', 'low', 'total'])}
    UNION ALL SELECT 'sources', row_number() OVER (ORDER BY n DESC, source), source || ': ' || n FROM (SELECT source, count(*) AS n FROM v_news GROUP BY source)
    UNION ALL SELECT 'failed', row_number() OVER (ORDER BY source_id), CAST(source_id AS VARCHAR) FROM (SELECT DISTINCT source_id FROM v_fetch WHERE NOT ok)""")
def r1(spark, d):
    return R.research_digest(view(spark, d, "v_news"), view(spark, d, "v_job"), view(spark, d, "v_fetch").filter(~F.col("ok")), CORE)


@query("r2_newsletter_source", head(["v_news", "v_job", "v_event"]) + """
    SELECT 'score ' || score AS section, row_number() OVER (PARTITION BY score ORDER BY published_at DESC, seq) AS place, source || ' · ' || strftime(published_at, '%Y-%m-%d') || ' · ' || url AS line FROM v_news WHERE score >= 3 AND published_at BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-31'
    UNION ALL SELECT 'jobs ' || coalesce(seniority, 'Other'), row_number() OVER (PARTITION BY seniority ORDER BY company, job_id), company || ' · ' || title || CASE WHEN location_raw IS NULL THEN '' ELSE ' · ' || location_raw END FROM v_job WHERE status = 'approved'
    UNION ALL SELECT 'events ' || strftime(event_date, '%B %Y'), row_number() OVER (PARTITION BY strftime(event_date, '%B %Y') ORDER BY event_date, event_id), strftime(event_date, '%a %d %b') || ' ' || name FROM v_event WHERE status = 'verified' AND event_date BETWEEN DATE '1998-01-01' AND DATE '1998-01-01' + 90""")
def r2(spark, d):
    now = F.lit(NOW).cast("timestamp_ntz")
    return R.newsletter_source(view(spark, d, "v_news"), view(spark, d, "v_job"), view(spark, d, "v_event"), now, F.lit(TODAY).cast("date"))


@query("r3_weekly_pick_report", head(["v_news"]).replace("v_news AS (", "all_news AS (", 1) + f""", v_news AS (SELECT * FROM all_news WHERE published_at BETWEEN TIMESTAMP '2024-01-13' AND TIMESTAMP '2024-01-20'), {_PICK}, c AS (SELECT count(*) AS in_window, count(*) FILTER (place <= 5) AS picked FROM k)
    SELECT CASE WHEN place <= 5 THEN 'picked' ELSE 'alternates' END AS section, CASE WHEN place <= 5 THEN place ELSE row_number() OVER (PARTITION BY place <= 5 ORDER BY score DESC, published_at DESC, seq) END AS place, source || ' · ' || score || ' · ' || url AS line FROM k
    UNION ALL {facts('totals', 'c', ['in_window', 'picked'])}""")
def r3(spark, d):
    return R.weekly_pick_report(view(spark, d, "v_news"), F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))


@query("r4_jobs_run_report", head(["v_job", "v_company", "v_seen_job", "v_source_health"]) + f""", {RULES_SQL}, l AS ({_LOG}), st AS (SELECT step, {_STEP} FROM l GROUP BY step),
    o AS (SELECT CASE WHEN junior THEN 'too_junior' WHEN geo = 'reject' THEN 'fdi_geography' ELSE 'passed' END AS outcome, count(*) AS n FROM g GROUP BY 1),
    b AS (SELECT CASE WHEN status IN ('approved', 'pending') THEN {_BUCKET} ELSE 'not_swept' END AS bucket, count(*) AS n FROM v_seen_job LEFT JOIN v_source_health USING (source_id) GROUP BY 1),
    s AS (SELECT count(*) FILTER (status = 'approved') AS approved, count(*) FILTER (status = 'pending') AS pending FROM v_job)
    SELECT 'steps' AS section, row_number() OVER (ORDER BY step) AS place, step || ' | ' || CASE WHEN sources_with_errors = sources THEN 'failed' WHEN scraped = 0 THEN 'warning' ELSE 'success' END || ' | ' || scraped || ' | ' || new || ' | ' || updated || ' | ' || sources || ' | ' || sources_with_errors AS line FROM st
    UNION ALL SELECT 'classifier', row_number() OVER (ORDER BY n DESC, outcome), outcome || ': ' || n FROM o
    UNION ALL SELECT 'sweep', row_number() OVER (ORDER BY n DESC, bucket), bucket || ': ' || n FROM b
    UNION ALL {facts('state', 's', ['approved', 'pending'])}""")
def r4(spark, d):
    jobs = P.run_rules(J.with_company(view(spark, d, "v_job").withColumn("title", F.expr(_JUNIOR)), view(spark, d, "v_company")))
    sweep = M.sweep_jobs(view(spark, d, "v_seen_job"), view(spark, d, "v_source_health"), at(SEEN_NOW))[1]
    state = view(spark, d, "v_job").agg(A.n_if(F.col("status") == "approved", "approved"), A.n_if(F.col("status") == "pending", "pending"))
    return R.jobs_run_report(_log(spark, d), jobs.select(F.coalesce("rules.reason", F.lit("passed")).alias("outcome")), sweep, state)


_PAST = "status = 'pending' AND event_date < DATE '1998-01-01'"


@query("r5_events_run_report", head(["v_event", "v_fetch"]) + f""", e AS (SELECT status AS outcome, recurrence AS category, count(*) AS n, grouping(status, recurrence) AS level FROM v_event GROUP BY ROLLUP (status, recurrence)),
    w AS (SELECT CASE WHEN {_PAST} THEN 'rejected' ELSE status END AS status, CASE WHEN {_PAST} THEN 'event_date_passed' ELSE '—' END AS reason, count(*) AS n FROM v_event GROUP BY ALL),
    s AS (SELECT count(*) FILTER (status = 'verified' AND event_date >= DATE '1998-01-01') AS verified_upcoming, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'rejected') AS rejected FROM v_event),
    q AS (SELECT kind, count(*) AS n FROM (SELECT source_id, CASE WHEN NOT bool_or(ok) THEN 'failed' ELSE 'silent' END AS kind FROM v_fetch GROUP BY source_id HAVING NOT bool_or(ok) OR sum(upserted) = 0) GROUP BY kind)
    SELECT 'extraction ' || level AS section, row_number() OVER (PARTITION BY level ORDER BY n DESC, outcome NULLS FIRST, category NULLS FIRST) AS place, coalesce(outcome, '—') || ' / ' || coalesce(category, '—') || ' / ' || n AS line FROM e
    UNION ALL SELECT 'sweep', row_number() OVER (ORDER BY n DESC, status, reason), status || ' / ' || reason || ' / ' || n FROM w
    UNION ALL {facts('state', 's', ['verified_upcoming', 'pending', 'rejected'])}
    UNION ALL SELECT 'sources', row_number() OVER (ORDER BY kind), kind || ': ' || n FROM q""")
def r5(spark, d):
    events, log = view(spark, d, "v_event"), view(spark, d, "v_fetch")
    today = F.lit(TODAY).cast("date")
    silent = A.silent_sources(log.groupBy("source_id").agg(F.bool_or("ok").alias("ok")), log.select("source_id", F.col("upserted").alias("n")))
    return R.events_run_report(events.select(F.col("status").alias("outcome"), F.col("recurrence").alias("category")), M.sweep_events(events, today), A.event_snapshot(events, today), silent)


@query("r6_intake_report", head(["v_article"]) + f""", {_STAGE}, f2 AS (SELECT feed, count(*) AS total, count(*) FILTER (stage = 'date_dropped') AS a, count(*) FILTER (published_on IS NULL) AS b, count(*) FILTER (stage = 'kept') AS c, count(*) FILTER (stage = 'cap_dropped') AS e, min(published_on) AS x, max(published_on) AS y FROM st GROUP BY feed),
    n AS (SELECT count(*) AS fetched, count(*) FILTER (stage <> 'date_dropped') AS after_date, count(*) FILTER (stage NOT IN ('date_dropped', 'cap_dropped')) AS after_cap, count(*) FILTER (stage = 'kept') AS after_dedupe, count(*) FILTER (stage = 'kept') AS final FROM st)
    SELECT 'feeds' AS section, row_number() OVER (ORDER BY feed) AS place, feed || ' | ' || total || ' | ' || a || ' | ' || b || ' | ' || c || ' | ' || e || ' | ' || coalesce(CAST(x AS VARCHAR), '—') || ' | ' || coalesce(CAST(y AS VARCHAR), '—') AS line FROM f2
    UNION ALL {facts('funnel', 'n', ['fetched', 'after_date', 'after_cap', 'after_dedupe', 'final'])}""")
def r6(spark, d):
    return R.intake_report(staged(view(spark, d, "v_article")))


@query("r7_discovery_report", head(["v_source"]) + """, a AS (SELECT 'ats_platform' AS dimension, ats_platform AS value, count(*) AS n FROM v_source GROUP BY 2 UNION ALL SELECT 'confidence', CASE WHEN source_id % 3 = 0 THEN 'high' ELSE 'low' END, count(*) FROM v_source GROUP BY 2 UNION ALL SELECT 'scrapability', CASE WHEN is_active THEN 'easy' ELSE 'hard' END, count(*) FROM v_source GROUP BY 2),
    r AS (SELECT name, row_number() OVER (ORDER BY name) AS k, count(*) OVER () AS c FROM (SELECT DISTINCT name FROM v_source WHERE source_id % 3 <> 0))
    SELECT dimension AS section, row_number() OVER (PARTITION BY dimension ORDER BY n DESC, value) AS place, value || ': ' || n AS line FROM a
    UNION ALL SELECT 'review', 1, string_agg(name, ', ' ORDER BY name) || CASE WHEN max(c) > 12 THEN ' (+' || (max(c) - 12) || ' more)' ELSE '' END FROM r WHERE k <= 12""")
def r7(spark, d):
    return R.discovery_report(_results(spark, d))


@query("r8_monitor_report", over("v_news", "SELECT 1").rsplit(" SELECT 1", 1)[0] + f", o AS (SELECT DISTINCT url FROM v_news WHERE published_at < {_CUT}), n AS (SELECT v_news.*, o.url IS NOT NULL AS seen, published_at >= TIMESTAMP '2024-01-20' AS recent FROM v_news LEFT JOIN o USING (url) WHERE published_at >= {_CUT}) SELECT count(*) AS fetched, count(*) FILTER (recent) AS after_lookback, count(*) FILTER (recent AND score >= 3) AS scored, count(*) FILTER (recent AND score >= 3 AND seen) AS already_seen, count(DISTINCT CASE WHEN recent AND score >= 3 AND NOT seen THEN story_key END) AS after_story_dedupe FROM n")
def r8(spark, d):
    old, new = _halves(spark, d)
    seen = old.select("url").distinct().withColumn("seen", F.lit(True))
    stages = new.join(seen, "url", "left").withColumn("seen", F.coalesce("seen", F.lit(False))).withColumn("recent", F.col("published_at") >= F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
    return R.monitor_report(stages)
