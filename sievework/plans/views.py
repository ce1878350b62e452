"""Views that stand for listings, news, sources and events over the given tables.

The texts are the common subset of Spark SQL and DuckDB, so queries and their SQL read the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

VIEWS = {
    "v_article": """
        SELECT doc_id AS seq, 'https://' || source || '.example.org/a/' || CAST(doc_id % 300 AS STRING) AS link,
               text AS title, source, lang, CASE WHEN doc_id % 3 = 0 THEN 'site_rss' ELSE 'google_news' END AS feed_type,
               CASE WHEN doc_id % 11 = 0 THEN NULL ELSE DATE '2024-01-31' - CAST(doc_id % 60 AS INTEGER) END AS published_on
        FROM documents""",
    "v_company": """
        SELECT n_nationkey AS company_id, n_name AS name, r_name AS vertical, (n_regionkey % 2 = 1) AS is_fdi,
               (n_nationkey % 5 = 0) AS is_irish_founded, (n_nationkey % 3 = 0) AS allowlisted
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "v_source": """
        SELECT s_suppkey AS source_id, s_nationkey AS company_id, s_name AS name, (s_acctbal > 0) AS is_active,
               CASE s_suppkey % 5 WHEN 0 THEN 'greenhouse' WHEN 1 THEN 'lever' WHEN 2 THEN 'ashby' WHEN 3 THEN 'none_found' ELSE 'linkedin_only' END AS ats_platform
        FROM supplier""",
    "v_job": """
        SELECT p_partkey AS job_id, p_partkey AS seq, p_name AS title, p_brand AS company, p_partkey % 25 AS company_id,
               CASE p_partkey % 12 WHEN 0 THEN NULL WHEN 1 THEN 'Dublin, Ireland' WHEN 2 THEN 'Boston, MA' WHEN 3 THEN '6 Locations' WHEN 4 THEN 'Multiple'
                    WHEN 5 THEN 'Remote - EMEA' WHEN 6 THEN 'London, United Kingdom' WHEN 7 THEN 'Remote' WHEN 8 THEN 'Tokyo' ELSE p_type END AS location_raw,
               'https://x.wd1.myworkdayjobs.com/en-US/site/job/' || CASE p_partkey % 4 WHEN 0 THEN 'Dublin-IE' WHEN 1 THEN 'Remote---Bulgaria' WHEN 2 THEN 'Leeds-UK' ELSE 'HQ' END
                   || '/' || CAST(p_partkey AS STRING) AS url,
               p_partkey % 100 AS source_id, p_size AS seniority_rank,
               CASE p_size % 6 WHEN 0 THEN 'senior' WHEN 1 THEN 'mid' WHEN 2 THEN 'lead' WHEN 3 THEN 'executive' WHEN 4 THEN 'graduate' END AS seniority,
               CASE p_partkey % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS relevancy,
               CASE p_partkey % 5 WHEN 0 THEN 'LinkedIn' ELSE 'site' END AS source,
               CASE p_partkey % 4 WHEN 0 THEN 'approved' WHEN 1 THEN 'pending' WHEN 2 THEN 'rejected' ELSE 'archived' END AS status,
               CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE p_type END AS job_function, p_name || ' ' || p_type AS summary
        FROM part""",
    "v_news": """
        SELECT event_id AS seq, 'https://news.example.org/' || CAST(user_id AS STRING) || '/' || CAST(event_id % 50 AS STRING) AS url,
               event_type AS source, ts AS published_at, props AS story_key, CAST(floor(value) AS BIGINT) % 5 + 1 AS score,
               CASE event_id % 7 WHEN 0 THEN 'approved' ELSE 'pending' END AS status
        FROM events""",
    "v_seen_job": """
        SELECT l_partkey AS job_id, l_suppkey AS source_id, CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE max(l_shipdate) END AS last_seen,
               CASE l_partkey % 4 WHEN 0 THEN 'rejected' WHEN 1 THEN 'pending' ELSE 'approved' END AS status
        FROM lineitem GROUP BY l_partkey, l_suppkey""",
    "v_source_health": "SELECT l_suppkey AS source_id, max(l_shipdate) AS last_success FROM lineitem WHERE l_suppkey % 9 <> 0 GROUP BY l_suppkey",
    "v_event": """
        SELECT o_orderkey AS event_id, 'series ' || CAST(o_custkey AS STRING) AS name,
               CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS event_date,
               CASE o_orderstatus WHEN 'O' THEN 'verified' WHEN 'P' THEN 'pending' ELSE 'rejected' END AS status,
               CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS recurrence
        FROM orders""",
    "v_fetch": """
        SELECT event_id AS seq, user_id AS source_id, ts, (event_type <> 'error') AS ok, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS upserted,
               CASE event_type WHEN 'error' THEN 'failure' WHEN 'purchase' THEN 'success' WHEN 'view' THEN 'success' ELSE 'neutral' END AS outcome
        FROM events""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view's rows. The tables that its text names are temporary views of this folder."""
    text = VIEWS[name]
    for t in TABLES:
        if t in text:
            table(spark, sf_dir, t).createOrReplaceTempView(t)
    return spark.sql(text)


def over(name: str, query: str) -> str:
    """SQL of a query over a view."""
    return f"WITH {name} AS ({VIEWS[name]}) {query}"


def over_all(names: list[str], query: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n]})" for n in names) + " " + query
