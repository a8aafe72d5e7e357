"""The operators of this package as queries on the driver tables, with SQL where it can say
the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from turnwise.llm import (
    bpe, chat, chosenpath, covertree, merkle, mixing, oracles, packing, pii, quality, secrets, spelling, styletree,
    winnowing,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {
    "op2_scan_secrets": oracles.SECRETS,
    "op3_embedding_duplicates": oracles.EMBEDDINGS,
    "op5_format_chats": oracles.CHATS,
    "op8_near_duplicates": oracles.NEAR_DUPLICATES,
    "op11_merkle_manifest": oracles.MERKLE,
    "op12_spelling_variants": oracles.SPELLING,
}
RANKS = "byte_bpe_50k.tiktoken"
# Documents of a source with consecutive ids that count as one repository.
RANGE = 100
# The two highest ids of 16 bits, above the vocabulary: they end a document and fill up a row.
END, PAD = 65_534, 65_535


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    rows = mixing.mixed_rows(mixing.mix_copies(table(spark, sf, "documents")))
    return rows.select(
        "doc_id", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"), "source", "copies",
    )


@query
def op2_scan_secrets(spark: SparkSession, sf: str) -> DataFrame:
    # A repository is a stretch of a source's documents: RANGE consecutive ids.
    docs = table(spark, sf, "documents").withColumn("_repository", F.floor(F.col("doc_id") / RANGE))
    found = secrets.scan(docs, repository=("source", "_repository"))
    return found.select(
        "doc_id",
        *[secrets.count_kind(F.col("base"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secrets.spans_text(F.col("base")), 256).alias("base_sha256"),
        secrets.spans_text(F.col("spans")).alias("spans"),
        F.col("live").alias("n_live"), F.col("copied").alias("n_copied"),
    )


@query
def op4_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    coded = bpe.encode(
        table(spark, sf, "documents").select("doc_id", "text"),
        public_tokenizers.path(RANKS), public_tokenizers.PATTERN, decoded="decoded",
    )
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("bigint").alias("n_tokens"),
        F.sha2(bpe.ids_text("token_ids"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op5_format_chats(spark: SparkSession, sf: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.sql(
        f"SELECT -7L AS conv_id, 0L AS turn, 'user' AS role, '{said}' AS text"
        f" UNION ALL SELECT -7L, 1L, 'assistant', '{said}'"
    )
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    made = chat.format_conversations(turns.unionByName(more))
    back = made.withColumn("t", chat.read_turns(F.col("formatted"))).withColumn(
        "learned", chat.learned_text(F.col("segments"))
    )
    lines = F.transform("t", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("t").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        F.col("valid").alias("valid_order"),
    )


@query
def op9_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return winnowing.compare_edited(table(spark, sf, "documents"))


@query
def op10_quality(spark: SparkSession, sf: str) -> DataFrame:
    scored = quality.score_documents(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return scored.drop("_row")


@query
def op8_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return chosenpath.near_duplicates(table(spark, sf, "documents"), size=4)


@query
def op3_embedding_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return covertree.near_duplicates(table(spark, sf, "embeddings"))


@query
def op6_pack_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_tokens(
        table(spark, sf, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN, END, PAD
    )


@query
def op7_extract_html(spark: SparkSession, sf: str) -> DataFrame:
    found = styletree.extract_text(table(spark, sf, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@query
def op11_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    made = merkle.manifest(table(spark, sf, "documents"), tampered)
    return merkle.verify(made.withColumn("leaf_now", F.coalesce("tampered", "digest")))


@query
def op12_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.group_variants(spelling.vocabulary(table(spark, sf, "documents")))


@query
def op13_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.find(table(spark, sf, "documents").select("doc_id", "text")).drop("text")
    return found.select(
        "doc_id",
        *[pii.count_base(F.col("pii"), k).alias(f"n_{k}") for k in pii.BASE],
        F.sha2(pii.spans_text(F.filter("pii", lambda s: s["base"])), 256).alias("base_sha256"),
        pii.spans_text(F.col("pii")).alias("spans"),
        F.size(F.filter("pii", lambda s: ~s["base"])).cast("bigint").alias("n_added"),
    )


@query
def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf)
