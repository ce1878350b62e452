from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sievework.llm import packing, quality, queries, secrets, simhash, toxicity
from sievework.llm.queries import QUERIES, vocabulary
from tests_helpers import brute_components, brute_fingerprint


@pytest.fixture(scope="module")
def odd_dir(spark, odd_docs, tmp_path_factory):
    """A folder with odd documents, pages and labels: nulls, repeats, clashing columns."""
    place = str(tmp_path_factory.mktemp("odd"))
    odd_docs.write.parquet(f"{place}/documents.parquet")
    pages = [(1, "u", "<article><p>Text.</p></article>"), (1, "u", "<article><p>Text.</p></article>"), (2, None, None), (None, "u", "<p>x"), (3, "u", "")]
    spark.createDataFrame([(*p, "t", 1) for p in pages], "page_id bigint, url string, html string, text string, n_chars int").write.parquet(f"{place}/pages.parquet")
    vectors = [(0, [0.5, 1.0], 1, "s"), (50, [0.5, 1.0], 1, "s"), (50, [0.5, 1.0], 1, "s"), (3, [0.5, 0.25], 2, "s"), (4, None, 1, "s"), (None, [0.1], None, "s")]
    spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>, label int, score string").write.parquet(f"{place}/embeddings.parquet")
    labels = [(1, 1, 0), (1, 0, 1), (2, 1, None), (None, 1, 1), (9, None, 0), (77, 1, 1)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    return place


@pytest.fixture(scope="module")
def empty_dir(spark, odd_dir, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "embeddings", "pages", "labels"):
        spark.read.parquet(f"{odd_dir}/{name}.parquet").limit(0).write.parquet(f"{place}/{name}.parquet")
    return place


PER_DOCUMENT = ["op3_secret_scan", "op4_quality_rules", "op5_media_columns", "op7_simhash_near_dedup", "op8_bpe", "op9_license_scan", "op10_toxicity", "op11_jaccard_join"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_on_odd_and_empty_tables(spark, odd_dir, empty_dir, odd_docs, name):
    rows = QUERIES[name](spark, odd_dir).collect()
    if name in PER_DOCUMENT:
        assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in odd_docs.collect())
    elif name in ("op1_html_extraction", "op6_warc"):
        assert len(rows) == 5
    assert QUERIES[name](spark, empty_dir).count() == 0


def test_held_out_is_the_contracts(spark, sf_dir):
    import zlib

    rows = queries.op10_toxicity(spark, sf_dir).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)


def test_archive_query_matches_its_sql(spark, sf_dir):
    import duckdb

    db = duckdb.connect()
    db.sql(f"CREATE VIEW pages AS SELECT * FROM '{sf_dir}/pages.parquet'")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    want = db.sql(queries.ORACLES["op6_warc"]).select(*names).fetchall()
    assert Counter(map(tuple, queries.op6_warc(spark, sf_dir).select(*names).collect())) == Counter(want)


def test_pipeline_against_brute_force(spark, sf_dir, tmp_path):
    """Each stage takes all that its predecessor kept; decisions are checked one by one."""
    extra = [(10**6 + i, f"the password=abcdef{i:04d}x is here, in a text of more than ten plain words for row {'abcdefgh'[i]} {'zyxwvuts'[i] * 5}", "en", f"src{i}", i) for i in range(4)]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").unionByName(spark.createDataFrame(extra, "doc_id bigint, text string, lang string, source string, n_chars bigint"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.read.parquet(f"{tmp_path}/labels.parquet")
    place = str(tmp_path)
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "quality_rules", "simhash_near_dedup", "secret_scan", "best_fit_packing"]

    calm = stages["toxicity"](spark, docs, place)
    scores = toxicity.score(docs, toxicity.train(docs, labels), into="s")
    assert calm.columns == docs.columns and ids(calm) == ids(scores.filter(f"s < {toxicity.THRESHOLD}"))
    good = stages["quality_rules"](spark, calm, place)
    judged = quality.judge(calm, quality.train(docs, labels), into="q")
    assert good.columns == docs.columns and ids(good) == ids(judged.filter("q.kept"))
    single = stages["simhash_near_dedup"](spark, good, place)
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in good.collect()]
    assert single.columns == docs.columns and ids(single) == sorted(set(brute_components(rows).values()))
    masked = stages["secret_scan"](spark, single, place)
    texts = {r.doc_id: r.text for r in single.collect()}
    owners = {}
    for r in single.collect():
        for _, _, _, value in secrets.base_spans(r.text) + secrets.wider_spans(r.text):
            owners.setdefault(value, set()).add(r.source)
    for r in masked.collect():
        spans = [(a, b, k) for k, a, b, v in secrets.base_spans(texts[r.doc_id]) + secrets.wider_spans(texts[r.doc_id]) if len(owners[v]) < secrets.EXAMPLE_OWNERS]
        assert r.text == secrets.mask(texts[r.doc_id], [{"first": a, "last": b, "kind": k} for a, b, k in sorted(spans)])
    assert masked.columns == docs.columns and ids(masked) == ids(single)
    packed = stages["best_fit_packing"](spark, masked, place)
    path = vocabulary("byte_bpe_50k.json")
    lengths = {r.doc_id: len(packing.token_ids(r.text, path)) + 1 for r in masked.collect()}
    got = Counter()
    for r in packed.collect():
        got[r.doc_id] += r.length
    assert got == Counter(lengths)
    whole = corpus_pipeline.run(spark, place)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(map(tuple, whole.select(*columns).collect())) == Counter(map(tuple, packed.select(*columns).collect()))


def test_hot_groups_are_split(spark):
    """A quarter value that most fingerprints share is compared in pairs of tiles, with the links of brute force."""
    rng = np.random.default_rng(8)
    values = sorted({int(v) & ~0xFFFF | 0x1234 for v in rng.integers(-(2**63), 2**63 - 1, 150)} | {(int(rng.integers(0, 2**3)) << 20) | 0x1234 for _ in range(60)})
    pairs = simhash.links(spark.createDataFrame([(v,) for v in values], "fp bigint"), tile=8)
    roots = {r.fp: r.root for r in simhash.components(pairs, spark).collect()}
    want = brute_components([(v, v & (2**64 - 1)) for v in values])
    assert {v: roots.get(v, v) for v in values} == {v: want[i] for i, v in enumerate(values)}
    assert pairs.count() < len(values) * 8


def test_labels_of_documents_are_not_read_twice(spark):
    """The least label of a document counts for quality, the greatest for toxicity."""
    docs = spark.createDataFrame([(i, f"word{i % 7} plain text {i}") for i in range(60)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(i, 0, 1) for i in range(0, 60, 2)], "doc_id bigint, quality int, toxic int")
    assert toxicity.train(docs, labels).bias != 0
    assert quality.train(docs, labels).slope >= 0
    assert docs.filter(F.col("doc_id") < 0).count() == 0
