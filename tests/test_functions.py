import pytest
from pyspark.sql import functions as F

from sievework.functions import dates as D
from sievework.functions import jsonx as J
from sievework.functions import pages as H
from sievework.functions import rules as R
from sievework.functions import text as X


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(f(F.col("v")).alias("out")).collect()]


def check(spark, cases, f, kind="string"):
    assert column(spark, list(cases), f, kind) == list(cases.values())


def test_norm_key_and_place(spark):
    assert column(spark, ["  Senior  Data\tEngineer ", None, " "], X.norm_key) == ["senior data engineer", "", ""]
    assert column(spark, [" Dublin ", None, " "], X.norm_place) == ["dublin", None, None]


def test_company_names(spark):
    cases = {"Electronic Arts (EA)": "electronic arts", "Acme Ltd": "acme", "Acme, Inc.": "acme", "Group Co.": "group", "Big  Company": "big", "Limited": "limited"}
    check(spark, cases, X.norm_company)
    same = lambda a, b: spark.range(1).select(X.names_match(X.norm_company(F.lit(a)), X.norm_company(F.lit(b)))).first()[0]
    assert same("Danu Sport", "Danu Sports Ltd") and not same("Danu Sport", "Other")


def test_job_addresses(spark):
    ids = {
        "https://ie.linkedin.com/jobs/view/4400000000/": 4400000000, "https://www.linkedin.com/jobs/view/engineer-at-acme-4400000001": 4400000001,
        "https://www.linkedin.com/jobs/view/x-44/?refId=abc123": 44, "https://www.linkedin.com/jobs/view/x-45#top9": 45, "https://www.linkedin.com/jobs/view/no-id/": None,
    }
    check(spark, ids, X.job_id)
    check(spark, {"https://am.linkedin.com/jobs/view/a-1?x=2": "https://www.linkedin.com/jobs/view/a-1/", "https://x.org/a/?b=1": "https://x.org/a/"}, X.canonical_job_url)
    check(spark, {"https://IE.linkedin.com/jobs": "ie", "https://x.org": "www"}, X.subdomain)


def test_tracking_and_relative_addresses(spark):
    check(spark, {"https://a/b?utm_source=x&id=1&gclid=2#f": "https://a/b?id=1#f", "https://a/b": "https://a/b", "https://a/?utm_a=1": "https://a/"}, X.strip_tracking)
    base = "https://a.org/x/y?q=1"
    cases = {"/z": "https://a.org/z", "z": "https://a.org/x/z", "//b.org/c": "https://b.org/c", "http://c.org": "http://c.org", "?p=2": "https://a.org/x/y?p=2", "#t": "https://a.org/x/y?q=1#t"}
    check(spark, cases, lambda c: X.absolute_url(c, F.lit(base)))


def test_publishers_and_slugs(spark):
    check(spark, {"https://www.irish-news.co.uk/x": "Irish News", "https://3d-print.ie": "3D Print", "nonsense": ""}, X.publisher_stem)
    assert column(spark, ["Kitman Labs"], lambda c: X.slug_variants(c, F.lit("https://www.kitman-labs.com"))) == [["kitmanlabs", "kitman-labs"]]
    found = column(spark, ['<a href="https://jobs.lever.co/acme/1">', "https://jobs.lever.co/jobs https://acme.breezy.hr"], lambda c: X.board_slug(c, F.lit("")))
    assert [(f.platform, f.slug) for f in found] == [("lever", "acme"), ("breezy", "acme")]


def test_feed_dates(spark):
    cases = {
        "Mon, 15 Jan 2024 10:30:00 GMT": "2024-01-15 10:30:00", "15 Jan 2024 10:30:00 +0200": "2024-01-15 08:30:00", "2024-01-15T10:30:00Z": "2024-01-15 10:30:00",
        "2024-01-15T10:30:00+01:00": "2024-01-15 09:30:00", "2024-01-15": "2024-01-15 00:00:00", "soon": None, None: None,
    }
    check(spark, cases, lambda c: D.parse_feed_date(c).cast("string"))


def test_sheet_and_ordinal_dates(spark):
    cases = {"03/04/2024": "2024-04-03", "2024-04-03": "2024-04-03", "12/25/2024": "2024-12-25", "April 3, 2024": "2024-04-03", "3 Apr 2024": "2024-04-03", "03-04-24": "2024-04-03", "x": None}
    check(spark, cases, lambda c: D.parse_sheet_date(c).cast("date").cast("string"))
    check(spark, {"16th April 2026": "2026-04-16", "1st May 2026": "2026-05-01", "soon": None}, lambda c: D.parse_ordinal_date(c).cast("string"))


def test_ages(spark):
    now = F.lit("2024-01-31 12:00:00").cast("timestamp")
    cases = {"Today": 0, "Yesterday": 1, "Just now": 0, "3 days ago": 3, "2 weeks ago": 14, "1 month ago": 30, "1 year ago": 365, "5 hours ago": 0, "2024-01-30T11:00:00Z": 1, "2024-02-05": 0, "n/a": None}
    check(spark, cases, lambda c: D.days_ago(c, now))
    check(spark, {"Reposted 5 days ago": 5, "5 days ago": None}, lambda c: D.days_ago(c, now, posted=True))
    assert column(spark, ["2024-02-05"], lambda c: D.days_ago(c, now, clamp=False)) == [-5]


def test_ages_count_parts_of_seconds(spark):
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    cases = {"2024-01-11T00:00:00.250000Z": 19, "2024-01-11T00:00:00Z": 20, "2024-01-10T23:59:59.999999Z": 20}
    check(spark, cases, lambda c: D.days_ago(c, now))
    assert column(spark, ["2024-01-31T00:00:00.000001Z"], lambda c: D.days_ago(c, now, clamp=False)) == [-1]


def test_display_texts(spark):
    day = lambda a: F.lit(a).cast("date")
    row = spark.range(1).select(D.event_date_text(day("2026-05-14"), day("2026-05-16")), D.event_date_text(day("2026-05-14"), day("2026-05-14")), D.month_bucket(F.lit(None).cast("date")), D.runtime_text(F.lit(3725)), D.runtime_text(F.lit(59))).first()
    assert tuple(row) == ("14-16 May", "Thu 14 May", "Unknown date", "1h 02m 05s", "59s")


@pytest.mark.parametrize(
    ("place", "verdict"),
    [("Dublin, IE", "pass"), ("6 Locations", "reject"), ("Multiple Locations", "reject"), ("multiple", "pending"), ("Boston, MA", "reject"), (None, "pending"), ("Atlantis", "pending"), ("Remote - EMEA", "pass"), ("London", "reject")],
)
def test_geo_verdict(spark, place, verdict):
    assert spark.range(1).select(R.geo_verdict(F.lit(place).cast("string"))).first()[0] == verdict


@pytest.mark.parametrize(
    ("place", "url", "verdict"),
    [("London", None, "pass"), ("6 Locations", "https://x/job/Remote---Bulgaria/1", "reject"), ("6 Locations", "https://x/job/Dublin-IE/1", "pass"), ("6 Locations", "https://x/job/Leeds-UK/1", "pass"), ("Multiple", None, "pending"), ("Tokyo", None, "reject")],
)
def test_geo_verdict_wide(spark, place, url, verdict):
    assert spark.range(1).select(R.geo_verdict_wide(F.lit(place), F.lit(url).cast("string"))).first()[0] == verdict


def test_titles(spark):
    cases = {"Junior Analyst": True, "Internal Auditor": False, "Data Intern": True, "Entry-Level Dev": True, "Associate": False}
    check(spark, cases, R.matches_word)
    cases = {"Street Team Member": "relevance_noise (street team)", "Customer Support Agents": "relevance_noise (customer support agents)", "Backend Developer": None, None: None}
    check(spark, cases, lambda c: R.relevance_reason(c, F.lit("s")))
    assert column(spark, ["Cashier"], lambda c: R.relevance_reason(c, F.lit("s"), ["s"])) == [None]


def test_gates(spark):
    age = lambda d, j: spark.range(1).select(R.fresh_strict_reason(F.lit(d).cast("bigint"), F.lit(j).cast("bigint"))).first()[0]
    assert [age(91, 1), age(90, 1), age(None, None), age(None, 5), age(None, 4_200_000_000)] == ["posted_too_old (91d)", None, "posted_age_unknown", "stale_id (5)", None]
    name = lambda a, b, o, m: spark.range(1).select(R.name_reason(F.lit(a), F.lit(b), F.lit(o), m)).first()[0]
    assert name("Acme", " ", True, "page") == "no_hiring_org" and name("Acme", "Other", True, "page") is None
    assert name("Acme", "Other", True, "actor") == "name_mismatch ('acme' != 'other')"


def test_replies(spark):
    cases = {'```json\n{"score": 3}\n```': 3, 'Sure {"score": 4} ok': 4, '{"score": 5': None, "": None}
    check(spark, cases, lambda c: J.repair_json(c, "score int")["score"])
    check(spark, {'{"a": 1, "b": 2}': True, '{"a": 1}': False, "x": False}, lambda c: J.has_fields(c, ["a", "b"]))
    assert column(spark, ['PICKS_JSON: [{"company": "A", "slug": "a", "news_url": "u"}]', "none"], J.embedded_picks)[0][0].company == "A"


def test_linked_data(spark):
    page = '<script type="application/ld+json">{"@type": "JobPosting", "title": "Dev", "hiringOrganization": {"name": "A"}, "baseSalary": {"currency": "EUR", "value": {"minValue": 1}}}</script>'
    got = column(spark, [page, "<p>none</p>", '<script type="application/ld+json">{oops</script>'], J.job_posting)
    assert got[0].title == "Dev" and got[0].org == "A" and got[0].salary_min == "1" and got[1] is None and got[2] is None


def test_page_functions(spark):
    page = '<html><head><meta property="og:title" content="T &amp; U"><meta property="og:image" content="/i.png"></head><body><nav>menu</nav><main><p>One</p><script>x</script><p>two</p></main></body></html>'
    row = spark.range(1).select(H.main_content(F.lit(page)), H.html_to_text(F.lit(page), 8, True), H.page_meta(F.lit(page), F.lit("https://a.org/x"))).first()
    assert row[0] == "One two" and row[1] == "menu ..." and row[2].og_title == "T & U" and row[2].image_url == "https://a.org/i.png"


@pytest.mark.parametrize("name", ["f4_main_content", "f5_page_meta", "x3_extract_events", "x8_html_udfs"])
def test_titles_cut_within_references_agree_with_sql(spark, tmp_path, name):
    import duckdb

    from __spark_entry__ import oracle_sql, queries

    titles = ["Tom &amp; Ann&amp", "5 &lt; 6 &lt", "6 &gt; 5 &gt", "say &quot;yes&quot; &quot", "a&amp;amp; b&am", "plain"]
    page = "<html><head><title>{0}</title></head><body><nav>menu</nav><article><h1>{0}</h1><p>{0}</p><p>more &amp;lt; text</p></article></body></html>"
    rows = [(i, f"https://a.org/{i}", page.format(t)) for i, t in enumerate(titles * 4)]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
        want = db.execute(oracle_sql()[name]).fetchall()
    assert sorted(map(repr, map(tuple, queries()[name](spark, str(tmp_path)).collect()))) == sorted(map(repr, want))


@pytest.mark.parametrize("name", ["x3_extract_events"])
def test_long_pages_agree_with_sql_up_to_their_end(spark, tmp_path, name):
    import duckdb

    from __spark_entry__ import oracle_sql, queries

    page = "<html><body><nav>menu</nav><article><h1>T {0}</h1><p>{1}</p><p>{2}</p></article><footer>end</footer></body></html>"
    bodies = ["ab " * 9_000, "ab " * 10_000 + "c", "ab " * 40_000, "\U0001f600b " * 12_000, "ab &amp; c&lt;" * 20_000]
    rows = [(i, f"https://a.org/{i}", page.format(i, b, last)) for i, (b, last) in enumerate((b, last) for b in bodies for last in ("Summit", "none"))]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
        want = db.execute(oracle_sql()[name]).fetchall()
    got = sorted(map(tuple, queries()[name](spark, str(tmp_path)).collect()))
    assert got == sorted(want)
    assert [r[5] for r in got] == ["relevant", "not_relevant"] * len(bodies)


def test_main_content_is_the_whole_text(spark, tmp_path):
    import duckdb

    from __spark_entry__ import oracle_sql, queries

    words = [f"{mark}{i}" for mark in ("w", "\u00e9", "\U0001f600") for i in range(20_000)]
    texts = {0: "short", 1: "a" * 29_999, 2: "a" * 30_001, 3: " ".join(words), 4: " ".join(words * 20) + " & end"}
    pages = [(i, f"https://a.org/{i}", f"<body><nav>menu</nav><article><p>{t.replace('&', '&amp;')}</p></article><footer>no</footer></body>") for i, t in texts.items()]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
        assert dict(db.execute(oracle_sql()["f4_main_content"]).fetchall()) == texts
    assert {r.page_id: r.main for r in queries()["f4_main_content"](spark, str(tmp_path)).collect()} == texts
    body = spark.range(1).select(H.main_content(F.lit("<body><nav>menu</nav><p>" + texts[3] + "</p></body>"))).first()[0]
    assert body == texts[3]


def test_relevance(spark):
    s = R.relevance_score(F.lit("Software Engineer"), F.lit("python"), F.lit("CoreCo"), F.lit("site"), ["coreco"], ["coreco"])
    assert spark.range(1).select(s, R.relevance_band(s)).first()[:] == (8 + 10 + 2 * 2 + 1 + 5, "high")
