import os

from pyspark.sql import functions as F

from sievework.functions import rules as R
from sievework.operators import dedupe as Q
from sievework.operators import enrich as E
from sievework.operators import ranking as O
from sievework.operators import upsert as M
from sievework.operators.graphs import connected
from sievework.plans.views import view
from sievework.sources import feeds as S
from sievework.sources import payloads as P
from sievework.sources import sinks as K
from sievework.streaming import streams as T

def now():
    return F.lit("2024-01-31 00:00:00").cast("timestamp")


def test_collapse_is_idempotent_and_keeps_missing_places_apart(spark):
    rows = [(1, "s", "Dev", "Dublin"), (2, "s", " dev ", "DUBLIN"), (3, "s", "Dev", None), (4, "s", "Dev", " "), (5, "t", "Dev", "Dublin")]
    df = spark.createDataFrame(rows, "seq int, source_id string, title string, location_raw string")
    once = Q.collapse_identical(df)
    assert sorted(r.seq for r in once.collect()) == [1, 3, 5] == sorted(r.seq for r in Q.collapse_identical(once).collect())


def test_weekly_pick_loses_nothing_and_fills_up(spark, sf_dir):
    news = view(spark, sf_dir, "v_news")
    out = O.weekly_pick(news).collect()
    assert len(out) == news.count() and sum(r.picked for r in out) == 5
    few = spark.createDataFrame([(1, "a", "x", 5, "2024-01-01"), (2, "a", "y", 4, "2024-01-01"), (3, "a", "x", 3, "2024-01-01")], "seq bigint, source string, story_key string, score int, published_at string")
    assert sorted((r.place, r.seq) for r in O.weekly_pick(few, 2).collect() if r.picked) == [(1, 1), (2, 2)]


def test_failure_runs(spark):
    rows = [(1, k, o) for k, o in enumerate("ffnfsffsfff", 1)]
    names = {"f": "failure", "s": "success", "n": "neutral"}
    log = spark.createDataFrame([(s, k, names[o]) for s, k, o in rows], "source_id bigint, seq bigint, outcome string")
    assert sorted((r.began, r.abort_at, r.length) for r in O.failure_runs(log).collect()) == [(1, 4, 3), (9, 11, 3)]


def test_failure_runs_deal_a_hot_source_in_ranges(spark, monkeypatch):
    import random

    from sievework.operators import graphs

    rng, written, cut = random.Random(2), [], graphs.cut
    monkeypatch.setattr(graphs, "cut", lambda df: written.append(cut(df)) or written[-1])
    rows = [(1, k, rng.choice(["failure"] * 5 + ["success", "neutral"])) for k in range(3000)] + [(2, k, "failure") for k in range(3000)] + [(None, k, "failure") for k in range(5)]
    want, run = [], {}
    for source, k, outcome in rows + [(s, None, "success") for s in (1, 2, None)]:
        if outcome == "failure":
            run.setdefault(source, []).append(k)
        elif outcome == "success":
            done = run.pop(source, [])
            want += [(source, done[0], done[2], len(done))] if len(done) >= 3 else []
    rng.shuffle(rows)
    log = spark.createDataFrame(rows, "source_id bigint, seq bigint, outcome string")
    got = O.failure_runs(log).select("source_id", "began", "abort_at", "length").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        again = O.failure_runs(log).select("source_id", "began", "abort_at", "length").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(map(repr, map(tuple, again))) == sorted(map(repr, want))
    assert written[-1].filter("source_id = 2").select("_range").distinct().count() > 1


def test_upserting_twice_is_upserting_once(spark, sf_dir):
    news = view(spark, sf_dir, "v_news")
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    old, new = Q.latest_by(news.filter(F.col("published_at") < cut), "url", "published_at", "seq"), news.filter(F.col("published_at") >= cut)
    once = M.upsert_news(old, new).drop("change")
    again = M.upsert_news(once, new)
    assert again.filter("change IN ('inserted', 'updated')").count() == 0
    assert again.drop("change").exceptAll(once).count() == 0


def test_sweep_buckets_add_up(spark, sf_dir):
    jobs, sources = view(spark, sf_dir, "v_seen_job"), view(spark, sf_dir, "v_source_health")
    table, buckets = M.sweep_jobs(jobs, sources, F.lit("2001-11-05").cast("timestamp"))
    assert sum(r.n for r in buckets.collect()) == jobs.count() == table.count()


def test_events_keep_reviewed_content(spark):
    old = spark.createDataFrame([("a", "pending", "A"), ("b", "verified", "B")], "url string, status string, name string").withColumn("last_seen_at", F.lit(None).cast("timestamp"))
    new = spark.createDataFrame([("a", "A2"), ("b", "B2"), ("c", "C")], "url string, name string")
    out = {r.url: (r.status, r.name, r.change) for r in M.upsert_events(old, new, now()).collect()}
    assert out == {"a": ("pending", "A2", "updated"), "b": ("verified", "B", "seen"), "c": ("pending", "C", "inserted")}


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 102)], "a bigint, b bigint")
    roots = {r.node: r.root for r in connected(edges).collect()}
    assert roots == {i: 1 for i in range(1, 41)} | {i: 100 for i in (100, 101, 102)}


def test_stories_match_brute_force(spark):
    base = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").limit(150).collect()] + ["", "one two", "one two", None]
    df = spark.createDataFrame(list(enumerate(base)), "seq bigint, title string")

    def grams(t):
        w = " ".join((t or "").lower().split()).split(" ")
        return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    sets, root = [grams(t) for t in base], list(range(len(base)))
    for i in range(len(base)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    assert {r.seq: r.story for r in Q.group_stories(df, "title").collect()} == dict(enumerate(root))


def test_stories_of_a_crowd_make_few_pairs(spark, monkeypatch):
    import random

    from sievework.operators import graphs

    rng = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    crowd = [" ".join(base[:k] + [f"x{i}"] + base[k + 1 :]) for i, k in enumerate(rng.choices(range(200), k=300))]
    chain = [" ".join(f"c{k}" for k in range(i, i + 60)) for i in range(0, 60, 3)]  # neighbours resemble one another, the ends don't
    alone = [" ".join(f"y{rng.random()}" for _ in range(50)) for _ in range(30)]
    made, keep = [], graphs.Scratch.keep

    def counted(scratch, df, name):
        out = keep(scratch, df, name)
        if out.columns == ["x", "y"]:
            made.append(out.count())
        return out

    monkeypatch.setattr(graphs.Scratch, "keep", counted)
    df = spark.createDataFrame(list(enumerate(crowd + chain + alone)), "seq bigint, title string")
    got = {r.seq: r.story for r in Q.group_stories(df, "title").collect()}
    assert got == {i: 0 for i in range(300)} | {i: 300 for i in range(300, 320)} | {i: i for i in range(320, 350)}
    assert made and sum(made) < 300 * 299 // 8
    # each shares a passage with all, none resembles another
    made.clear()
    passage = " ".join(f"p{k}" for k in range(64))
    near = [passage + " " + " ".join(f"z{i}x{k}" for k in range(40)) for i in range(200)]
    monkeypatch.setattr(Q, "_SAMPLE", 1 << 40)  # so that the order doesn't know the passage
    got = {r.seq: r.story for r in Q.group_stories(spark.createDataFrame(list(enumerate(near)), "seq bigint, title string"), "title").collect()}
    assert got == {i: i for i in range(200)} and sum(made) < 2 * 200
    twice = [(7, alone[0]), (7, alone[1]), (8, alone[0] + " z"), (None, alone[1] + " z"), (9, alone[2]), (None, alone[3]), (None, alone[3] + " z")]
    got = [r.story for r in Q.group_stories(spark.createDataFrame(twice, "seq bigint, title string"), "title").orderBy("title").collect()]
    assert got == [r[1] for r in sorted((t, 7 if t[:40] in (alone[0][:40], alone[1][:40]) else k) for k, t in twice)]


def test_scorers_report_what_is_lost(spark):
    class Half:
        def score(self, rows):
            return [{"score": 4, "reason": "r"} if "keep" in r["title"] else {"oops": 1} for r in rows]

    df = spark.createDataFrame([(i, "keep" if i % 2 else "lose", None) for i in range(40)], "seq bigint, title string, snippet string")
    scored, missing = E.score_batches(df, Half())
    assert scored.count() == 20 == missing.count()


def test_retry(spark):
    class Flaky:
        calls = 0

        def score(self, rows):
            self.calls += 1
            if self.calls < 3:
                raise RuntimeError
            return [{}] * len(rows)

    assert E.Retry(Flaky(), pause=0.0).score([{}, {}]) == [{}, {}]


def test_feeds(spark):
    rss = "<rss><channel><item><title>A</title><link>https://a</link><pubDate>x</pubDate></item><item><title>B</title></item></channel></rss>"
    atom = '<feed><entry><title>C</title><link href="https://c"/><updated>y</updated></entry></feed>'
    rows = S.read_feed_items(spark.createDataFrame([("f", rss), ("g", atom), ("h", "<broken")], "feed string, xml string")).collect()
    assert sorted((r.feed, r.title, r.link) for r in rows) == [("f", "A", "https://a"), ("g", "C", "https://c")]


def test_listing_pages(spark):
    card = '<article><a href="/zero"></a><h2>none</h2><h3><a href="/one">First <b>one</b></a></h3><time datetime="2024-01-01"></time><p>Text</p></article>'
    pages = [
        (1, "https://a.org/x/", card * 50), (2, "https://a.org", None), (3, "https://a.org/x/", '<div class="post big"><a href="two">Second</a><i class="Entry-Date"> May 1 </i></div>'), (4, "https://a.org", "<ul><li><a href=x>y</a></li></ul>"),
        (5, "https://www.businesspost.ie/tech/", '<li><a href="/news/abcdef">long enough text</a><a href="/news/abcdef">again, long enough</a><a href="/tech/abcdef">short</a></li>'), (6, "https://b.org", "<div>" * 30_000 + "</ul>" * 30_000),
    ]
    rows = S.extract_listing(spark.createDataFrame(pages, "page_id bigint, url string, html string")).orderBy("page_id", "seq").collect()
    assert len([r for r in rows if r.page_id == 1]) == 40
    assert [tuple(r) for r in rows if r.seq == 0] == [
        (1, 0, "First one", "https://a.org/one", "2024-01-01", "Text"), (3, 0, "Second", "https://a.org/x/two", "May 1", "Second May 1"), (5, 0, "long enough text", "https://www.businesspost.ie/news/abcdef", None, "")
    ]
    assert len(rows) == 42


def test_job_cards_fall_back_from_selector_to_selector(spark):
    pages = [
        (1, '<li><h2>Late</h2></li><div class="result-card"><h3 class="job-search-card__title">Dev</h3><a href="//x.org/1">go</a></div>'), (2, "<li><h2>Only <i> this </i></h2></li><li></li>"), (3, None),
    ]
    frame = spark.createDataFrame([(k, "https://p.org/jobs", h) for k, h in pages], "page_id bigint, url string, html string")
    rows = S.extract_job_cards(frame, "linkedin").orderBy("page_id").collect()
    assert [(r.page_id, r.title, r.company, r.location, r.link) for r in rows] == [(1, "Dev", "", "Ireland", "https://x.org/1"), (2, "Onlythis", "", "Ireland", "")]
    careers = '<article><a href="/jobs/9">Apply</a></article><article><h3>Engineer</h3><p class="Location">Cork</p><a href="/jobs/9">x</a></article>'
    rows = S.extract_job_cards(spark.createDataFrame([(1, "https://p.org/jobs", careers, "Acme")], "page_id bigint, url string, html string, org string"), "careers", "org").collect()
    assert [(r.title, r.company, r.location, r.link) for r in rows] == [("Engineer", "Acme", "Cork", "https://p.org/jobs/9")]


def test_payload_shapes(spark):
    rows = [
        ("1", "greenhouse", '{"jobs": [{"absolute_url": "u", "title": " T ", "location": "Cork", "content": "&lt;p&gt;Hi&lt;/p&gt;"}, {"absolute_url": "v", "title": "W", "location": {"name": "Galway"}}]}'),
        ("2", "lever", '{"oops": 1}'),
        ("3", "lever", '[{"hostedUrl": "l", "text": "L", "descriptionPlain": "a", "descriptionBodyPlain": "b", "salaryRange": {"currency": "EUR", "min": 1, "max": 2, "interval": "year"}}]'),
        ("4", "teamtailor", '{"items": [{"title": "F", "url": "f", "_jobposting": {"jobLocation": [{"address": {"addressLocality": "Cork"}}]}}]}'),
        ("5", "teamtailor", '{"data": [{"id": "9", "attributes": {"title": "G", "status": "open"}, "relationships": {"location": {"data": {"type": "locations", "id": "3"}}}}, {"id": "8", "attributes": {"title": "H", "status": "closed"}}], "included": [{"type": "locations", "id": "3", "attributes": {"city": "Dublin", "country-name": "Ireland"}}]}'),
        ("6", "phenom", '{"status": "failure"}'), ("7", "rippling", '{"items": [{"id": "5", "name": "R", "locations": [{"state": "S", "country": "C"}]}]}'),
        ("8", "bamboohr", '{"result": [{"id": 4, "jobOpeningName": "B", "isRemote": true}]}'), ("9", "ashby", "not json"),
    ]
    df = spark.createDataFrame([(i, p, "slug", "https://b", x) for i, p, x in rows], "source_id string, platform string, slug string, base_url string, payload string")
    details = spark.createDataFrame([], "url string, html string")
    got = {(r.source_id, r.title): (r.url, r.location_raw, r.summary, r.salary_range) for r in P.normalise_payloads(df, details).collect()}
    assert got == {
        ("1", "T"): ("u", "Cork", "Hi", None), ("1", "W"): ("v", "Galway", None, None), ("3", "L"): ("l", None, "a\n\nb", "EUR 1 - 2 year"), ("4", "F"): ("f", "Cork", None, None),
        ("5", "G"): ("https://b/jobs/9", "Dublin, Ireland", None, None), ("7", "R"): ("https://ats.rippling.com/slug/jobs/5", "S, C", None, None), ("8", "B"): ("https://slug.bamboohr.com/careers/4", "Remote", None, None),
    }
    assert {(r.source_id, r.reason) for r in P.payload_errors(df).collect()} == {("2", "unexpected_shape"), ("6", "status failure"), ("9", "not_json")}


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a",), ("b",), ("a",)], "url string")
    assert K.load_seen(spark, f"{tmp_path}/seen").count() == 0
    K.save_seen(rows, f"{tmp_path}/seen")
    K.save_seen(rows.union(spark.createDataFrame([("c",)], "url string")), f"{tmp_path}/seen")
    assert sorted(r.url for r in K.load_seen(spark, f"{tmp_path}/seen").collect()) == ["a", "b", "c"]
    K.write_unsent(rows, f"{tmp_path}/unsent", "2024-01-01")
    assert spark.read.parquet(f"{tmp_path}/unsent").filter("day = '2024-01-01'").count() == 3
    articles = spark.createDataFrame([("t", "l")], "title string, link string")
    K.write_article_doc(articles, rows, f"{tmp_path}/doc", "2024-01-31T00:00:00")
    assert spark.read.json(f"{tmp_path}/doc/articles").first().month == "2024-01"
    jobs = spark.createDataFrame([(1, "LinkedIn", "high"), (2, "site", "low"), (3, "site", "high")], "job_id int, source string, relevancy string")
    K.write_jobs_csv(jobs, f"{tmp_path}/csv")
    assert [r.job_id for r in S.read_csv_table(spark, f"{tmp_path}/csv").collect()] == ["3", "2", "1"]


def test_a_scorer_that_fails_loses_no_row(spark):
    class Picky:
        """Fails for batches that hold a title with x, and replies to too few rows where one holds y."""

        def score(self, rows):
            if any("x" in r["title"] for r in rows):
                raise KeyError("x")
            return [{"excerpt": r["title"], "relevant": True} for r in rows if "y" not in r["title"]]

    rows = spark.createDataFrame([(i, t, "old") for i, t in enumerate(["a", "b", "x", "c", "y", "d", "e"])], "job_id int, title string, reply string").coalesce(1)
    got = E.carried(rows, ["title"], Picky(), size=2)
    assert got.columns == ["job_id", "title", "reply", "reply_error"] and "Exchange" not in got._jdf.queryExecution().executedPlan().toString().replace("Exchange SinglePartition", "")
    found = {r.job_id: (r.reply is None, r.reply_error and r.reply_error.kind) for r in got.collect()}
    assert found == {0: (False, None), 1: (False, None), 2: (True, "KeyError"), 3: (True, "KeyError"), 4: (True, "ValueError"), 5: (True, "ValueError"), 6: (False, None)}
    jobs = E.classify_rows(rows, Picky()).collect()  # one batch of 15
    assert len(jobs) == 7 and all(r.reply is None and r.reply_error.kind == "KeyError" for r in jobs)
    for frame in (E.classify_rows(rows), E.extract_events(rows.withColumn("text", F.lit("t")), key="job_id"), E.enrich_rows(rows.withColumn("snippet", F.lit(None).cast("string")), key="job_id"), E.excerpt_rows(rows.withColumn("text", F.lit("A. b")), key="job_id")):
        assert frame.count() == 7 and frame.filter("reply_error IS NOT NULL").count() == 0
        assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()


def test_table_functions(spark):
    from sievework.functions.text import absolute_url, strip_tracking
    from sievework.sources import lateral

    lateral.register_html_tables(spark)
    page = '<article><h2><a href="/a?utm_x=1&b=2#c">T</a></h2></article><a href="q">Q</a><a href="">same</a><a href="//o.org/z">o</a><a href="../up">u</a>'
    pages = spark.createDataFrame([(1, page, "https://h.org/d/e/p.html"), (2, None, "https://h.org/"), (3, "", None), (4, '<a href="/k">', None)], "page_id bigint, html string, url string")
    pages.createOrReplaceTempView("lateral_pages")
    links = spark.sql("SELECT page_id, r.* FROM lateral_pages p, LATERAL page_links(p.html, p.url) r").collect()
    assert [(r.page_id, r.seq, r.link) for r in sorted(links)] == [
        (1, 0, "https://h.org/a?b=2#c"), (1, 1, "https://h.org/d/e/q"), (1, 2, "https://h.org/d/e/p.html"), (1, 3, "https://o.org/z"), (1, 4, "https://h.org/d/up"), (4, 0, "/k"),
    ]
    hrefs = ["/a", "b?c=d", "?q=1", "#f", "http://x.org", "//y.org/z", "../../../w", "a/./b/../c", "  /sp  ", "", "mailto:a@b"]
    cases = spark.createDataFrame([(h, b) for h in hrefs for b in ("https://h.org", "https://h.org/", "https://h.org/a/b.html?x=y#z")], "href string, base string")
    for r in cases.select("href", "base", strip_tracking(absolute_url("href", "base")).alias("link")).collect():
        if r.href not in ("?q=1", "#f", "mailto:a@b"):
            assert lateral.untracked(lateral.resolved(r.href, r.base)) == r.link, r
    cards = S.extract_job_cards(pages.limit(1), "careers").select("seq", "title", "company", "location", "link").collect()
    assert spark.sql("SELECT r.* FROM lateral_pages p, LATERAL card_rows(p.html, p.url, 'careers') r WHERE p.page_id = 1").collect() == cards
    listed = S.extract_listing(pages.filter("url IS NOT NULL")).collect()
    assert sorted(spark.sql("SELECT p.page_id, r.* FROM lateral_pages p, LATERAL listing_rows(p.html, p.url) r WHERE p.url IS NOT NULL").collect()) == sorted(listed) and listed


def test_documents_and_tables(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"articles": [{"title": "A", "link": "l"}], "failed_sources": [], "run_date": "2024-01"}')
    articles, failed = S.read_article_doc(spark, f"{tmp_path}/d.json")
    assert articles.first().title == "A" and failed.count() == 0
    (tmp_path / "e.json").write_text('{"failed_sources": [{"source": "s", "url": "u", "error": "e"}, {"source": "t"}], "run_date": "2024-01"}')
    articles, failed = S.read_article_doc(spark, f"{tmp_path}/e.json")
    assert articles.count() == 0 and [(r.seq, r.source, r.error) for r in failed.collect()] == [(0, "s", "e"), (1, "t", None)]
    K.write_article_doc(articles.select("title", "link"), failed.select("source", "url", "error"), f"{tmp_path}/both", "2024-02-01T00:00:00")
    articles, failed = S.read_article_folder(spark, f"{tmp_path}/both")
    assert articles.count() == 0 and failed.filter("month = '2024-02'").count() == 2
    for name in ("jobs_1.csv", "jobs_2.csv"):
        (tmp_path / name).write_text(f"﻿title,n\n{name},1\n")
    assert S.read_latest(spark, f"{tmp_path}/jobs_*.csv", header=True).count() == 1
    assert S.read_csv_table(spark, f"{tmp_path}/jobs_2.csv").columns == ["title", "n"]


def test_weekly_pick_keeps_rows_without_source_or_story(spark):
    rows = [(1, None, "x", 5, "t"), (2, "a", None, 4, "t"), (3, None, None, 9, None), (4, None, "y", 1, "t")]
    out = O.weekly_pick(spark.createDataFrame(rows, "seq bigint, source string, story_key string, score int, published_at string"), 2).collect()
    assert sorted((r.seq, r.place, r.picked) for r in out) == [(1, 2, True), (2, None, False), (3, 1, True), (4, None, False)]


def test_no_terms_match_nothing(spark):
    assert spark.createDataFrame([("a",), (None,)], "t string").filter(R.contains_any("t", [])).count() == 0


def test_versions_that_are_written_again(spark, tmp_path):
    table = f"{tmp_path}/t"
    frame = lambda *v: spark.createDataFrame([(x,) for x in v], "x int")
    K.publish_version(frame(1), table, "batch-0")
    K.publish_version(frame(1, 2), table, "batch-1")
    base = K.read_version(spark, table, other_than="batch-1")
    K.publish_version(base.union(frame(3)), table, "batch-1")
    assert sorted(r.x for r in K.read_version(spark, table).collect()) == [1, 3]
    assert [r.x for r in K.read_version(spark, table, other_than="batch-1").collect()] == [1]


def _drain(stream, place, mode="append"):
    stream.writeStream.outputMode(mode).format("memory").queryName(place).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.table(place)


def test_stream_of_new_urls_equals_the_batch(spark, tmp_path):
    rows = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("a", "2024-01-02 00:00:00"), ("b", None), ("c", "2024-01-01 05:00:00")], "url string, ts string")
    rows.write.parquet(f"{tmp_path}/in")
    stream = T.stream_new_urls(T.stream_landing(spark, f"{tmp_path}/in", rows.schema), "ts", "url", arrival=F.lit("2024-01-02").cast("timestamp"))
    assert sorted(r.url for r in _drain(stream.select("url"), "new_urls").collect()) == ["a", "b", "c"]


def test_continuous_upsert(spark, tmp_path):
    old = spark.createDataFrame([(0, "a", 3, "approved")], "seq int, url string, score int, status string")
    K.publish_version(old, f"{tmp_path}/table")
    spark.createDataFrame([(1, "a", 5, "pending"), (2, "b", 2, "pending")], old.schema).write.parquet(f"{tmp_path}/in")
    stream = T.stream_landing(spark, f"{tmp_path}/in", old.schema)
    T.stream_upsert(stream, f"{tmp_path}/table", lambda e, i: M.upsert_news(e, i).drop("change"), f"{tmp_path}/state").awaitTermination()
    assert sorted((r.url, r.score, r.status) for r in K.read_version(spark, f"{tmp_path}/table").collect()) == [("a", 5, "approved"), ("b", 2, "pending")]


def test_breaker_and_liveness_streams(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    log = spark.createDataFrame([(1, k, "failure" if o == "f" else "success", f"2024-01-{k:02d} 00:00:00", int(k == 1)) for k, o in enumerate("sffff", 1)] + [(2, 1, "failure", "2024-01-12 00:00:00", 0)], "source_id bigint, seq bigint, outcome string, ts string, upserted int")
    log.write.parquet(f"{tmp_path}/in")
    stream = T.stream_landing(spark, f"{tmp_path}/in", log.schema)
    assert [(r.source_id, r.abort_at) for r in _drain(T.stream_breaker(stream), "breaker").collect()] == [(1, 4)]
    alive = {r.source_id: r for r in _drain(T.stream_liveness(stream), "alive", "update").collect()}
    assert alive[1].last_success < alive[1].last_attempt and alive[2].last_success == 0 and alive[2].alert


def test_hot_sources_land_in_pages_with_whole_titles(spark, tmp_path, monkeypatch):
    import duckdb

    from __spark_entry__ import oracle_sql
    from sievework.plans import query_operators as plans

    titles = {i: f"<b> & \x01 ]]> {i} " + "whole title " * 40 + "end" for i in range(1, 3001)}
    docs = spark.createDataFrame([(i, t, "en", "hot" if i % 3 else f"src{i % 4}") for i, t in titles.items()], "doc_id bigint, text string, lang string, source string")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    names = spark.range(1, 10_001).selectExpr("id * 100 AS p_partkey", "'name ' || id AS p_name", "'b' AS p_brand", "'t' AS p_type", "CAST(id % 50 AS INT) AS p_size")  # all of source 0
    names.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    seen = {}

    def spy(module, name):
        run = getattr(module, name)
        monkeypatch.setattr(module, name, lambda df, *a: seen.setdefault(name, (df, run(df, *a)))[1])

    spy(plans.S, "read_feed_items"), spy(plans.S, "normalise_board_results"), spy(plans.PL, "normalise_payloads")
    with duckdb.connect() as db:
        for name in ("documents", "part"):
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
        for name, query in (("s1_read_feed_items", plans.s1), ("s5_normalise_payloads", plans.s5), ("s6_board_results", plans.s6)):
            want = db.execute(oracle_sql()[name]).fetchall()
            assert sorted(map(repr, map(tuple, query(spark, str(tmp_path)).collect()))) == sorted(map(repr, want))
    feeds, items = seen["read_feed_items"]
    assert {r.title.replace("\ufffd", "\x01") for r in items.collect()} <= set(titles.values())
    assert max(r.xml.count("<item>") for r in feeds.collect()) <= plans.FEED_ITEMS
    for name, mark in (("normalise_board_results", '"title":'), ("normalise_payloads", "name ")):
        assert max(r.payload.count(mark) for r in seen[name][0].collect()) <= 2 * plans.PAYLOAD_ITEMS


def test_payloads_are_read_once_and_places_looked_up(spark, tmp_path):
    api = (
        '{"data": [{"id": "7", "attributes": {"title": "Coach", "status": "open", "body": "<p>Run</p>"}, "relationships": {"location": {"data": {"type": "locations", "id": "1"}}}},'
        ' {"id": "8", "attributes": {"title": "Cook", "status": "draft", "body": ""}}, {"id": "9", "attributes": {"title": "Medic", "status": "open", "body": null}}],'
        ' "included": [{"type": "locations", "id": "1", "attributes": {"city": "Cork", "country-name": "Ireland"}}, {"type": "users", "id": "1", "attributes": {"city": "Nowhere"}}]}'
    )
    rows = [("s1", "teamtailor", "a", "https://a.example.org", api), ("s2", "greenhouse", "b", "", '{"jobs": [{"absolute_url": "u", "title": "T", "location": "Bray", "content": "&lt;b&gt;x&lt;/b&gt;"}]}'),
            ("s3", "teamtailor", "c", "", "not json"), ("s4", None, "d", "", "{}"), ("s5", "lever", "e", "", "{}"), ("s6", "bamboohr", "f", "", None)]
    spark.createDataFrame(rows, "source_id string, platform string, slug string, base_url string, payload string").write.parquet(f"{tmp_path}/landed")
    details = spark.createDataFrame([], "url string, html string")
    out = P.normalise_payloads(spark.read.parquet(f"{tmp_path}/landed"), details)
    got = sorted((r.source_id, r.url, r.title, r.location_raw, r.summary) for r in out.collect())
    assert got == [("s1", "https://a.example.org/jobs/7", "Coach", "Cork, Ireland", "Run"), ("s1", "https://a.example.org/jobs/9", "Medic", None, None), ("s2", "u", "T", "Bray", "x")]
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("Generate explode") == 1


def test_weekly_pick_shuffles_no_whole_news(spark, tmp_path):
    rows = [(i, f"s{i % 7}", f"t{i % 11}", i % 5, "2024-01-01", "x" * 20) for i in range(200)]
    spark.createDataFrame(rows, "seq bigint, source string, story_key string, score int, published_at string, body string").write.parquet(f"{tmp_path}/news")
    news = spark.read.parquet(f"{tmp_path}/news")
    out = O.weekly_pick(news, 4)
    exchanges = [line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and all("body" not in line and ("source#" in line or "story_key#" in line or "k#" in line) for line in exchanges)
    order = sorted(rows, key=lambda r: (-r[3], r[0]))
    best = [{r[c]: r for r in reversed(order)} for c in (1, 2)]
    both = [r for r in order if best[0][r[1]] is r and best[1][r[2]] is r]
    want = (both + [r for r in order if r not in both])[:4]
    assert [r.seq for r in out.filter("picked").orderBy("place").collect()] == [r[0] for r in want] and out.count() == 200


def test_late_rows(spark):
    rows = spark.createDataFrame([(1, "2024-01-10 00:00:00"), (2, "2024-01-01 00:00:00"), (3, None)], "k int, ts string")
    fine, late = T.split_late(rows, "ts", 72, F.lit("2024-01-10").cast("timestamp"))
    assert [r.k for r in late.collect()] == [2] and sorted(r.k for r in fine.collect()) == [1, 3]


def test_entry_survives_without_the_other_subpackage():
    import subprocess
    import sys

    code = "import sys; sys.modules['sievework.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; q = e.queries(); assert 'w1_collapse_identical' in q and not any(k.startswith('op') and k[2].isdigit() for k in q); assert set(e.oracle_sql()) <= set(q)"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root)
