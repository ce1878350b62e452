"""Bucketed versions, the seen set, run summaries and late rows."""

import os
import random

import pytest
from pyspark.sql import functions as F

from sievework.operators import bloom, runs
from sievework.operators import ranking as O
from sievework.operators import upsert as M
from sievework.sources import sinks as K
from sievework.streaming import streams as T


def test_a_batch_rewrites_only_its_buckets(spark, tmp_path):
    table = f"{tmp_path}/table"
    news = spark.range(2000).selectExpr("id AS seq", "'u' || id AS url", "id % 5 AS score", "'pending' AS status")
    K.publish_buckets(news, table, "url")
    before = K.manifest(spark, table)
    batch = spark.createDataFrame([(9000 + i, f"u{i * 7}", 9, "new") for i in range(9)] + [(9100, None, 9, "new")], "seq bigint, url string, score bigint, status string")
    update = lambda old, new: M.upsert_news(old, new).drop("change")
    K.merge_buckets(batch, table, "url", update, version="batch-0")
    after = K.manifest(spark, table)
    changed = [b for b in after if after[b] != before[b]]
    assert len(before) == 64 and 1 <= len(changed) <= 10
    written = {after[b] for b in changed}
    assert len(written) == 1 and len([n for n in os.listdir(f"{table}/{written.pop()}") if n.startswith("bucket=")]) == len(changed)
    want = sorted((r.url or "", r.seq, r.score) for r in M.upsert_news(news, batch).collect())
    assert sorted((r.url or "", r.seq, r.score) for r in K.read_version(spark, table).collect()) == want
    K.merge_buckets(batch, table, "url", update, version="batch-0")  # run again: merged into the version before its own
    assert sorted((r.url or "", r.seq, r.score) for r in K.read_version(spark, table).collect()) == want
    gone = K.drop_old_versions(spark, table, keep=1)
    assert gone and sorted((r.url or "", r.seq, r.score) for r in K.read_version(spark, table).collect()) == want
    K.merge_buckets(batch.limit(0), table, "url", update)
    assert K.read_version(spark, table).count() == len(want)


def test_buckets_of_an_empty_table(spark, tmp_path):
    empty = spark.createDataFrame([], "url string, seq bigint, score bigint, status string")
    K.publish_buckets(empty, f"{tmp_path}/t", "url")
    assert K.read_version(spark, f"{tmp_path}/t").count() == 0
    rows = spark.createDataFrame([("a", 1, 2, "x"), ("a", 2, 3, "y")], empty.schema)
    K.merge_buckets(rows, f"{tmp_path}/t", "url", lambda old, new: M.upsert_news(old, new).drop("change"))
    assert [tuple(r) for r in K.read_version(spark, f"{tmp_path}/t").collect()] == [("a", 2, 3, "y")]


def test_bloom_filters_lose_nothing_and_merge(spark):
    keys = spark.range(3000).selectExpr("CASE WHEN id = 7 THEN NULL ELSE 'k' || id END AS k")
    parts = [bloom.build(keys.filter(F.pmod(F.xxhash64("k"), F.lit(3)) == i), 512, "k") for i in range(3)]
    whole, merged = bloom.build(keys, 512, "k"), bloom.unite(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, merged.collect())) and whole.count() <= 512
    assert bloom.may_hold(keys, whole, 512, "k").count() == 3000
    foreign = spark.range(20_000).selectExpr("'x' || id AS k", "id AS bits", "id AS word")
    let = bloom.may_hold(foreign, whole, 512, "k")
    rate = whole.agg(bloom.error_rate(512)).first()[0]
    assert let.columns == foreign.columns and abs(let.count() / 20_000 - rate) < 0.02 < 0.2
    assert bloom.may_hold(keys, whole.limit(0), 512, "k").count() == 0


def _alerts(spark, place):
    return sorted(((r.url or "", r.batch) for r in spark.read.schema("url string, batch bigint").parquet(f"{place}/out").collect()))


def test_unseen_keys_over_any_gap(spark, tmp_path):
    place, seen, want = str(tmp_path), set(), set()
    rng = random.Random(3)
    for day in (1, 8, 15, 22):
        urls = [f"u{rng.randrange(150)}" for _ in range(120)] + [None, None]
        rows = spark.createDataFrame([(u, f"2024-01-{day:02d} 00:00:{i % 60:02d}") for i, u in enumerate(urls)], "url string, ts string")
        rows.write.mode("append").parquet(f"{place}/in")
        want |= set(urls) - seen
        seen |= set(urls)
        keep = lambda batch, number: batch.select("url").write.mode("overwrite").parquet(f"{place}/out/batch={number}")
        T.stream_unseen(T.stream_landing(spark, f"{place}/in", rows.schema), "ts", "url", place, keep, words=4).awaitTermination()
    alerts = [u for u, _ in _alerts(spark, place)]
    assert sorted(alerts) == sorted(u or "" for u in want)  # each once
    about = spark.read.json(f"{place}/about").orderBy(F.desc("batch")).first()
    assert about["keys"] == len(want) and about.words > 4 and about.error_rate <= T.SEEN_ERROR and about.bytes == about.words * 16


def test_unseen_keys_without_a_filter(spark, tmp_path, monkeypatch):
    """A filter that is too large to broadcast leaves the exact anti join."""
    monkeypatch.setattr(T, "SEEN_MOST", 1)
    place = str(tmp_path)
    for day, urls in ((1, ["a", "b"]), (20, ["b", "c"])):
        rows = spark.createDataFrame([(u, f"2024-01-{day:02d} 00:00:00") for u in urls], "url string, ts string")
        rows.write.mode("append").parquet(f"{place}/in")
        keep = lambda batch, number: batch.select("url").write.mode("overwrite").parquet(f"{place}/out/batch={number}")
        T.stream_unseen(T.stream_landing(spark, f"{place}/in", rows.schema), "ts", "url", place, keep).awaitTermination()
    assert [u for u, _ in _alerts(spark, place)] == ["a", "b", "c"]


def brute_runs(rows, n):
    found, openings = [], []
    for source in {r[0] for r in rows}:
        run = []
        for _, seq, outcome in sorted((r for r in rows if r[0] == source and r[1] is not None), key=lambda r: r[1]):
            if outcome == "failure":
                run.append(seq)
                if len(run) == n:
                    openings.append((source, seq))
            elif outcome == "success":
                found.append((source, run))
                run = []
        found.append((source, run))
    return sorted(((s or -1), r[0], r[n - 1], len(r)) for s, r in found if len(r) >= n), sorted((s or -1, x) for s, x in openings)


@pytest.fixture(scope="module")
def log():
    rng = random.Random(8)
    rows = [(1, k, rng.choices(["failure", "success", "neutral"], [6, 1, 2])[0]) for k in range(3000)]  # one source holds most rows
    rows += [(s, k, rng.choice(["failure", "success", "neutral", None])) for s in (2, 3, None) for k in range(150)]
    return rows + [(4, k, "failure") for k in range(500)] + [(5, None, "failure"), (6, 0, "neutral")]


@pytest.mark.parametrize("n", [1, 3, 5])
def test_runs_over_ranges_match_brute_force(spark, log, n):
    df = spark.createDataFrame(log, "source_id bigint, seq bigint, outcome string").repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        pieces = runs.summed_up(df, n).filter("_range IS NOT NULL AND source_id = 1").count()
        got = sorted((r.source_id or -1, r.began, r.abort_at, r.length) for r in O.failure_runs(df, n).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert pieces >= 1 and got == brute_runs(log, n)[0]
    assert O.failure_runs(df.limit(0), n).count() == 0


def test_summaries_merge_in_any_cut(log):
    import pyarrow as pa

    own = [(s, q, o == "failure") for s, q, o in log if s == 1 and o in ("failure", "success")]
    rng = random.Random(1)
    for _ in range(20):
        cuts = sorted(rng.sample(range(1, len(own)), rng.randint(1, 40)))
        made = []
        for k, (i, j) in enumerate(zip([0, *cuts], [*cuts, len(own)], strict=True)):
            part = pa.table({"s": [r[0] for r in own[i:j]], "q": [r[1] for r in own[i:j]], "f": [r[2] for r in own[i:j]], "r": [k] * (j - i)})
            made += pa.Table.from_batches(runs._sum_up(3)(part.to_batches(max_chunksize=7))).to_pylist()
        inside = [(p["lead"][0], p["lead"][2], p["lead_n"]) for p in made if p["_range"] is None]
        pieces = [{k: v for k, v in p.items() if k != "source_id"} for p in made if p["_range"] is not None]
        kinds = pa.schema([("s", pa.int64()), ("b", pa.int64()), ("p", pa.list_(pa.struct([("_range", pa.int64()), ("won", pa.bool_()), ("lead", pa.list_(pa.int64())), ("lead_n", pa.int64()), ("trail", pa.list_(pa.int64())), ("trail_n", pa.int64())])))])
        out = pa.Table.from_batches(runs._merge(3)(pa.Table.from_pylist([{"s": 1, "b": 0, "p": pieces}], kinds).to_batches())).to_pylist()
        got = sorted(inside + [(r["began"], r["abort_at"], r["length"]) for r in out if r["length"]])
        assert got == [r[1:] for r in brute_runs([r for r in log if r[0] == 1], 3)[0]]


def test_breaker_carries_runs_from_batch_to_batch(spark, log, tmp_path):
    place, rows = str(tmp_path), [r for r in log if r[1] is not None]
    for low, high in ((0, 2), (2, 60), (60, 10_000)):
        df = spark.createDataFrame([r for r in rows if low <= r[1] < high], "source_id bigint, seq bigint, outcome string")
        df.write.mode("append").parquet(f"{place}/in")
        T.stream_breaker_runs(T.stream_landing(spark, f"{place}/in", df.schema), place).awaitTermination()
    opened = spark.read.schema("source_id bigint, abort_at bigint").parquet(f"{place}/opened").collect()
    assert sorted((r.source_id or -1, r.abort_at) for r in opened) == brute_runs(rows, 3)[1]


def test_late_rows_of_a_stream(spark, tmp_path):
    place = str(tmp_path)
    for rows in ([(1, "2024-01-01 00:00:00"), (2, None)], [(3, "2024-01-20 00:00:00"), (4, "2023-01-01 00:00:00")], [(5, "2024-01-02 00:00:00"), (6, None), (7, "2024-01-18 00:00:00")], [(8, "2024-01-16 00:00:00")]):
        df = spark.createDataFrame(rows, "k int, ts string")
        df.write.mode("append").parquet(f"{place}/in")

        def sink(part):
            return lambda batch, number: batch.select("k").write.mode("overwrite").parquet(f"{place}/out/part={part}/batch={number}")

        T.stream_split_late(T.stream_landing(spark, f"{place}/in", df.schema), "ts", 72, place, sink("fine"), sink("late")).awaitTermination()
    found = spark.read.schema("k int, part string, batch bigint").parquet(f"{place}/out").collect()
    assert sorted(r.k for r in found if r.part == "late") == [4, 5, 8] and len(found) == 8


def test_keyed_updates_with_null_and_repeated_keys(spark):
    old = spark.createDataFrame([(1, "a", 3, "x"), (2, "a", 5, "y"), (3, None, 1, "z")], "seq int, url string, score int, status string")
    new = spark.createDataFrame([(4, "a", 5, "n"), (5, None, 2, "n"), (6, None, 2, "n")], old.schema)
    once = M.upsert_news(old, new)
    assert sorted((r.url or "", r.seq, r.change) for r in once.collect()) == [("", 5, "updated"), ("a", 2, "skipped")]
    again = M.upsert_news(once.drop("change"), new)
    assert sorted((r.url or "", r.seq, r.change) for r in again.collect()) == [("", 5, "skipped"), ("a", 2, "skipped")]
    values = spark.createDataFrame([("a", "v"), ("a", "u"), (None, "w")], "url string, kind string")
    filled = M.backfill_null(old.withColumn("kind", F.lit(None).cast("string")), values, "url", "kind")
    assert sorted((r.seq, r.kind) for r in filled.collect()) == [(1, "u"), (2, "u"), (3, "w")]
