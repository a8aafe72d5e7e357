"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import RECORDINGS, TURNS, derive, query, table
from registry.jsons import CONTEXT, UNPACKED_ANNOTATION, ANNOTATIONS
from turnwise.functions import jsons
from turnwise.operators import columns, joins

RESULTS = """
SELECT replace(replace(url, '?', '/'), '#', '/') || CASE page_id % 4 WHEN 0 THEN '/u-' || CAST(page_id AS STRING) || '.wav'
  WHEN 1 THEN '/v-' || CAST(page_id - page_id % 12 AS STRING) || '.flac?x=1' ELSE '/x-' || CAST(page_id - page_id % 12 AS STRING) || '.mp3' END AS filename,
  '[[{"transcript": "page ' || CAST(page_id AS STRING) || '"}]]' AS asr_predictions, page_id AS run, 'r' AS page_id
FROM {pages}
"""


@query("overlay_predictions", f"""
WITH base AS (SELECT page_id, audio_url, regexp_replace(split_part(split_part(audio_url, '?', 1), '/', -1),
  '\\.(flac|mp3)$', '.wav') AS f FROM ({RECORDINGS})),
preds AS (SELECT run, regexp_replace(split_part(split_part(filename, '?', 1), '/', -1), '\\.(flac|mp3)$', '.wav') AS f,
  replace(asr_predictions, '": "', '":"') AS alternatives, page_id FROM ({RESULTS}))
SELECT base.page_id, preds.page_id AS page_id_sqlite, run, f AS filename, alternatives FROM base JOIN preds USING (f)
""")
def _(spark, sf):
    base = derive(spark, sf, RECORDINGS).withColumn("alternatives", F.lit("old"))
    joined = joins.overlay_predictions(base, derive(spark, sf, RESULTS))
    return joined.select("page_id", "page_id_sqlite", "run", "filename", "alternatives")


@query("join_annotations_context", f"""
SELECT a.event_id AS event_id_x, c.event_id AS event_id_y, c.conversation_uuid, c.call_uuid, c.call_url_id, a.tag
FROM ({UNPACKED_ANNOTATION}) a JOIN ({CONTEXT}) c USING (conversation_uuid)
""")
def _(spark, sf):
    ann = derive(spark, sf, ANNOTATIONS).withColumn(
        "tag", jsons.unpack_annotation(F.col("annotation_result"))["tag"]
    )
    joined = joins.join_annotations_context(
        ann.select("event_id", "conversation_uuid", "call_uuid", "reftime", "tag"),
        derive(spark, sf, CONTEXT),
    )
    return joined.select(
        "event_id_x", "event_id_y", "conversation_uuid", "call_uuid", "call_url_id", "tag"
    )


@query("join_documents_labels", """
SELECT d.doc_id, d.lang, l.quality, l.toxic FROM {documents} d JOIN {labels} l USING (doc_id)
""")
def _(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("conversation_uuid"), "lang", F.lit("x").alias("call_uuid")
    )
    labels = table(spark, sf, "labels").withColumnRenamed("doc_id", "conversation_uuid")
    joined = joins.join_annotations_context(docs, labels.withColumn("call_uuid", F.lit("y")))
    return joined.select(F.col("conversation_uuid").alias("doc_id"), "lang", "quality", "toxic")


@query("keep_with_valid_audio", f"""
SELECT conversation_uuid, audio_url FROM ({TURNS}) WHERE audio_url IS NOT NULL
  AND split_part(split_part(audio_url, '/', -1), '.', 1) || '.wav' IN (
    SELECT 't-' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) || '.wav' FROM {{conversations}}
    WHERE length(text) > 300)
""")
def _(spark, sf):
    turns = derive(spark, sf, TURNS)
    listing = table(spark, sf, "conversations").where(F.length("text") > 300).select(
        F.concat(F.lit("t-"), "conv_id", F.lit("-"), "turn", F.lit(".wav")).alias("file_name")
    )
    return joins.keep_with_valid_audio(turns, listing).select("conversation_uuid", "audio_url")


@query("semi_join_orders", """
SELECT o_orderkey FROM {orders} WHERE o_orderkey IN (SELECT l_orderkey FROM {lineitem} WHERE l_quantity >= 45)
""")
def _(spark, sf):
    link = lambda c: F.concat(F.lit("https://h/"), F.col(c).cast("string"), F.lit(".tar.gz"))
    orders = table(spark, sf, "orders").withColumn("audio_url", link("o_orderkey"))
    files = table(spark, sf, "lineitem").where("l_quantity >= 45").select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit(".wav")).alias("file_name")
    )
    return joins.keep_with_valid_audio(orders, files).select("o_orderkey")


@query("attach_documents", """
SELECT 'about ' || n_name AS situation_str, r_name AS scenario, upper(r_name) AS scenario_category, c_name AS call
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey JOIN {customer} ON c_nationkey = n_nationkey
""")
def _(spark, sf):
    situations = (
        table(spark, sf, "nation")
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_nationkey").alias("situation_id"),
            F.concat(F.lit("about "), "n_name").alias("situation"),
            F.col("r_name").alias("scenario"),
            F.upper("r_name").alias("scenario_category"),
        )
    )
    docs = table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("situation_id"), F.col("c_name").alias("content")
    )
    return joins.attach_documents(situations, docs)


@query("attach_results", """
SELECT o_orderkey, o_orderstatus, coalesce(n, 0) AS lines, coalesce(top, 'N/A') AS top_flag
FROM {orders} LEFT JOIN (SELECT l_orderkey, count(*) AS n, max(l_returnflag) AS top FROM {lineitem}
  WHERE l_discount >= 0.08 GROUP BY l_orderkey) ON l_orderkey = o_orderkey
""")
def _(spark, sf):
    results = (
        table(spark, sf, "lineitem")
        .where("l_discount >= 0.08")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count("*").alias("lines"), F.max("l_returnflag").alias("top_flag"))
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return joins.attach_results(orders, results, "o_orderkey", {"lines": 0, "top_flag": "N/A"})


@query("remove_words", """
SELECT DISTINCT word, p_brand FROM (SELECT unnest(string_split(p_name, ' ')) AS word, p_brand FROM {part})
WHERE word NOT IN (SELECT split_part(p_name, ' ', 1) FROM {part} WHERE p_size > 48)
""")
def _(spark, sf):
    parts = table(spark, sf, "part")
    lexicon = parts.select(F.explode(F.split("p_name", " ")).alias("word"), "p_brand").distinct()
    gone = parts.where("p_size > 48").select(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("word"))
    return joins.remove_words(lexicon, gone)
