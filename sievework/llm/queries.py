"""One query for each operator, over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm import bpe, divergence, html_extract, licenses, media, negatives, packing, quality, secrets, setrelation, simhash, toxicity, warc
from sievework.llm.skew import shared_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html_extract.extract(pages, into="text").select("page_id", "url", "text")
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    found = secrets.scan(docs, ["doc_id"], ["source"], ["lang"])
    one = F.array().cast(found.schema["spans"].dataType)

    def count(kind: str):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["first"].cast("string"), x["last"].cast("string"))), ",")

    base = F.filter("spans", lambda x: x["kind"].isin(*secrets.KINDS))
    return found.withColumn("spans", F.coalesce("spans", one)).select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda x: x["live"])).cast("bigint").alias("n_live"),
        F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["n_owners"].cast("string"), x["n_repositories"].cast("string"))), ",").alias("owners_repositories"),
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    return quality.judge(docs, model, into="rules").select("doc_id", "rules.*")


def op5_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files are stored as a Parquet column in the shared folder; all that is returned comes from the stored column."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = f"{shared_folder(spark)}/media-{uuid4().hex}"
    sized = docs.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint"))
    media.store(sized).select("doc_id", "n_bytes", "media").write.parquet(folder)
    return media.load(spark.read.parquet(folder)).select("doc_id", "n_bytes", "loaded.*")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", simhash.as_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digest(docs, vocabulary("word_bpe_49k.json")).select("doc_id", "digest.*")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs, into="found").select("doc_id", "found.*")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, into="score").select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    )


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setrelation.join(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(_table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents").select("text", "lang", "source"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_html_extraction, op2_best_fit_packing, op3_secret_scan, op4_quality_rules, op5_media_columns, op6_warc,
        op7_simhash_near_dedup, op8_bpe, op9_license_scan, op10_toxicity,
        op11_jaccard_join, op12_hard_negatives, op13_source_divergence,
    )
}
ORACLES: dict[str, str] = {
    "op6_warc": """
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages
        ), m AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM p)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
               CASE WHEN n >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 100 AND page_id > first THEN first END AS refers_to
        FROM m
    """,
    "op11_jaccard_join": setrelation.brute_sql(),
    "op12_hard_negatives": negatives.brute_sql(),
    "op13_source_divergence": divergence.brute_sql(),
}
