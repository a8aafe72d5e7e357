"""From raw documents to token ids: quality, near-duplicates, secrets, mixture, encoding.

``STAGES`` lists the stages in order. A stage gets the session, the documents that the stage
before it kept, and the folder of the tables. All but the last return the columns they got.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnwise.llm import bpe, chosenpath, mixing, quality, secrets
from turnwise.session import store


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8) stays."""
    return chosenpath.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; every document stays."""
    return secrets.mask_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stand as often as the mixture takes them, zero to two times."""
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the token ids and their number; the text is what the ids decode to."""
    coded = bpe.encode(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, decoded="text"
    )
    decoded = {"text": F.col("text").cast("string"), "n_tokens": F.size("token_ids").cast("bigint")}
    kept = [c for c in docs.columns if c not in ("token_ids", "n_tokens")]
    return coded.withColumns(decoded).select(*kept, "token_ids", "n_tokens")


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_dedup),
    ("secret scans", secret_scan),
    ("mixing sources", mix_sources),
    ("byte-level BPE", encode),
]

# Neither the classifier nor the hash-driven rounding can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
