"""A corpus pipeline: five stages, each an operator of ``sievework.llm`` applied to all that is left.

Toxic documents go, then documents that fail the quality rules, then all but one document of each
group of near copies; live-looking secrets are then masked in the texts, and what remains is packed
into sequences. No stage is expressible in SQL, so ``ORACLE_SQL`` is None.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from sievework.llm import packing, quality, secrets, simhash, toxicity
from sievework.llm.queries import vocabulary
from sievework.llm.skew import remove, shared_folder


def _labelled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity.train(*_labelled(spark, sf_dir)))


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.train(*_labelled(spark, sf_dir)))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs, ["source"], ["lang"])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", apply_quality_rules),
    ("simhash_near_dedup", drop_near_copies),
    ("secret_scan", mask_secrets),
    ("best_fit_packing", pack_sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Between stages the documents are Parquet in the shared checkpoint folder; a stage's
    output is deleted when its successor's is written, so only what the last stage reads stays."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = f"{shared_folder(spark)}/pipeline-{uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{root}/{k}-{name}")
            docs = spark.read.parquet(f"{root}/{k}-{name}")
            if k:
                remove(spark, f"{root}/{k - 1}-{STAGES[k - 1][0]}")
    return docs
