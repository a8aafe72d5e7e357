"""Composed jobs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from registry.base import RECORDINGS, TAGS, TURNS, derive, query, table
from registry.calls import TRANSCRIPTS
from registry.datasets import split_sql
from registry.dimensions import KNOWN
from registry.evaluation import HEARD, DISTANCE_SQL, heard, report_sql, rounded
from registry.inference import (
    DATED, INTENT_ANSWER, PROMPTS, TEMPLATE, TRUTH, entity_service, intent_service, tagged_rows,
)
from registry.joins import RESULTS
from registry.jsons import ANNOTATIONS, CONTEXT, FIRST_TAG, UNPACKED_ANNOTATION, UNPACKED_PREDICTION
from registry.sources import RUN, conversation_files, write_files
from registry.text import BUCKET, NOW, ZONE, redacted_sql
from turnwise.plans import jobs
from turnwise.session import scratch_path


@query("sample_calls_job", f"""
WITH t AS (SELECT * FROM ({TURNS}) WHERE call_time BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-25 23:59:59'
  AND language = 'en-US' AND call_type IN ('inbound', 'outbound')),
s AS (SELECT call_id FROM (SELECT DISTINCT call_id FROM t) ORDER BY md5(CAST(call_id AS VARCHAR) || '|1'), call_id LIMIT 15)
SELECT conversation_uuid, intent FROM t WHERE call_id IN (SELECT call_id FROM s) AND intent IN ('_confirm_', 'other')
  AND audio_url IS NOT NULL AND (call_id + conversation_id) % 3 <> 0
""")
def _(spark, sf):
    turns = derive(spark, sf, TURNS)
    listing = turns.where("(call_id + conversation_id) % 3 <> 0").select(
        F.concat(F.lit("t-"), "call_id", F.lit("-"), "conversation_id", F.lit(".wav")).alias("file_name")
    )
    sampled = jobs.sample_calls_job(
        turns, 10, dict(start=datetime(2024, 1, 5), end=datetime(2024, 1, 25)),
        dict(lang="en-US"), ["_confirm_", "other"], listing, buffer=5, seed=1,
    )
    return sampled.select("conversation_uuid", "intent")


PREDICTED_TURNS = f"""
SELECT t.conversation_uuid, t.intent, CASE WHEN length(prompt) % 10 <> 0 THEN trim({INTENT_ANSWER}) ELSE 'N/A' END AS gpt_intent,
  CASE WHEN length(prompt) % 10 <> 0 THEN exp(-0.25 - length(prompt) / 1000) ELSE 0 END AS gpt_prob,
  CASE WHEN length(prompt) % 10 <> 0 THEN length(prompt) // 4 ELSE 0 END AS tokens
FROM ({TURNS}) t JOIN ({PROMPTS}) p USING (conversation_uuid)
UNION ALL SELECT conversation_uuid, intent, 'N/A', 0, 0 FROM ({TURNS})
WHERE conversation_uuid NOT IN (SELECT conversation_uuid FROM ({PROMPTS}))
"""


@query("tag_turns_job", f"""
SELECT conversation_uuid, project_id, 'Live' AS data_label, gpt_intent, round(gpt_prob, 6) AS gpt_prob, tokens,
  CASE WHEN intent = gpt_intent THEN 'yes' ELSE 'no' END AS use_gpt_intent
FROM ({PREDICTED_TURNS}), (SELECT unnest(['21', '22']) AS project_id)
""")
def _(spark, sf):
    out = jobs.tag_turns_and_calls_job(
        derive(spark, sf, TURNS), ["21", "22"], ["31"], "https://s.example.com", "en",
        template=TEMPLATE, infer_fn=intent_service(),
    )
    return out["turn_tasks"].select(
        "conversation_uuid", "project_id", "data_label", "gpt_intent",
        F.round("gpt_prob", 6).alias("gpt_prob"),
        F.col("gpt3-tokens-consumed").alias("tokens"), "use_gpt_intent",
    )


@query("tag_turns_job_failed", f"""
SELECT DISTINCT prompt, 'no answer for ' || CAST(length(prompt) AS VARCHAR) || ' characters' AS error
FROM ({PROMPTS}) WHERE length(prompt) % 10 = 0
""")
def _(spark, sf):
    out = jobs.tag_turns_and_calls_job(
        derive(spark, sf, TURNS), ["21"], ["31"], "https://s.example.com", "en",
        template=TEMPLATE, infer_fn=intent_service(),
    )
    return out["failed"]


@query("tag_calls_job", f"""
SELECT call_uuid, 'en' AS language, substr(min(reftime), 1, 10) AS date, '31' AS project_id, 'UAT' AS data_label
FROM ({TURNS}) GROUP BY call_uuid
""")
def _(spark, sf):
    out = jobs.tag_turns_and_calls_job(
        derive(spark, sf, TURNS), ["21"], ["31"], "https://s.example.com", "en", "UAT"
    )
    return out["call_tasks"].select("call_uuid", "language", "date", "project_id", "data_label")


@query("tag_counts_job", f"""
SELECT project_id, count(*) AS rows, 'turn' AS level FROM ({TURNS}), (SELECT unnest(['21', '22']) AS project_id) GROUP BY ALL
UNION ALL SELECT '31', count(DISTINCT call_uuid), 'call' FROM ({TURNS})
""")
def _(spark, sf):
    out = jobs.tag_turns_and_calls_job(
        derive(spark, sf, TURNS), ["21", "22"], ["31"], "https://s.example.com", "en"
    )
    return out["counts"]


@query("tagged_dataset_job", """
SELECT event_id, event_type, value FROM {events} WHERE event_type IN ('view', 'signup')
  AND ts BETWEEN TIMESTAMP '2024-01-03 00:00:00' AND TIMESTAMP '2024-01-09 12:00:00'
""")
def _(spark, sf):
    rows = table(spark, sf, "events").withColumnsRenamed({"event_type": "job_id", "ts": "tagged_at"})
    path = jobs.tagged_dataset_job(
        rows, "view, signup", scratch_path(spark, "tagged"), RUN,
        start=datetime(2024, 1, 3), end=datetime(2024, 1, 9, 12),
    )
    return spark.read.parquet(path).select("event_id", F.col("job_id").alias("event_type"), "value")


@query("label_store_job", f"""
WITH a AS (SELECT * FROM ({UNPACKED_ANNOTATION}) WHERE ts BETWEEN TIMESTAMP '2024-01-02 00:00:00' AND TIMESTAMP '2024-01-28 23:59:59'
  AND flow_id = '1' AND data_label IN ('Live') ORDER BY md5(conversation_uuid || '|0.5'), conversation_uuid LIMIT 400)
SELECT conversation_uuid, a.tag, a.ls_entities, a.ls_transcription, c.intent, coalesce(c.intent_score, -1) AS intent_score, c.slots,
  c.original_intent, 'https://a.example.com/' || audio_base_path || '/' || call_uuid || '/' || audio_path AS audio_url,
  coalesce(nullif(call_url, ''), 'https://c.example.com/' || call_url_id || '.wav') AS call_url
FROM a JOIN ({UNPACKED_PREDICTION}) c USING (conversation_uuid)
""")
def _(spark, sf):
    ann = derive(spark, sf, ANNOTATIONS).withColumnRenamed("ts", "tagged_at")
    merged = jobs.label_store_job(
        ann.drop("event_id", "user_id", "event_type"),
        derive(spark, sf, CONTEXT).drop("event_id", "user_id", "event_type"), "1",
        dict(start=datetime(2024, 1, 2), end=datetime(2024, 1, 28)),
        "https://a.example.com", "https://c.example.com", 400, ["Live"],
    )
    return merged.select(
        "conversation_uuid", "tag", "ls_entities", "ls_transcription", "intent",
        F.coalesce("intent_score", F.lit(-1.0)).alias("intent_score"), "slots", "original_intent",
        "audio_url", "call_url",
    )


@query("entity_dataset_job", f"""
SELECT id, truth_entities_with_duckling, CASE WHEN id % 6 <> 3 THEN (SELECT count(*) FROM range(1 + CAST(id % 6 = 1 AS INTEGER))) ELSE 0 END AS predicted
FROM ({TRUTH})
""")
def _(spark, sf):
    out, _ = jobs.entity_dataset_job(
        tagged_rows(spark, sf).withColumnRenamed("event_id", "id"), "id", "labelled",
        entity_service(), ZONE,
    )
    listed = F.from_json("predicted_entities_with_modifications", "array<struct<text:string>>")
    return out.select(
        "id", "truth_entities_with_duckling",
        F.coalesce(F.size(listed), F.lit(0)).cast("bigint").alias("predicted"),
    )


@query("entity_dataset_job_failed", f"""
SELECT DISTINCT text, dim, ref_ms, locale, 'no answer' AS error FROM ({DATED}) WHERE n % 5 = 3
""")
def _(spark, sf):
    service = entity_service()

    def answer(row):
        if int(row["text"].split(" ")[1]) % 5 == 3:
            raise RuntimeError("no answer")
        return service(row)

    _, failed = jobs.entity_dataset_job(
        tagged_rows(spark, sf).withColumnRenamed("event_id", "id"), "id", "labelled", answer, ZONE,
    )
    return failed


@query("overlay_transcripts_job", f"""
SELECT page_id, audio_url, alternatives FROM (SELECT page_id, audio_url, regexp_replace(split_part(split_part(audio_url, '?', 1), '/', -1),
  '\\.(flac|mp3)$', '.wav') AS f FROM ({RECORDINGS})) JOIN (SELECT regexp_replace(split_part(split_part(filename, '?', 1), '/', -1),
  '\\.(flac|mp3)$', '.wav') AS f, replace(asr_predictions, '": "', '":"') AS alternatives FROM ({RESULTS})) USING (f)
""")
def _(spark, sf):
    overlaid, _ = jobs.overlay_transcripts_job(
        derive(spark, sf, RECORDINGS), derive(spark, sf, RESULTS).drop("page_id"), F.lit(NOW), BUCKET
    )
    return overlaid.select("page_id", "audio_url", "alternatives")


@query("overlay_transcripts_job_links", f"""
SELECT DISTINCT audio_url, regexp_extract(audio_url, '^[a-z]+://[^/]*/+([^?]*)', 1) AS object_key FROM ({RECORDINGS})
WHERE audio_url LIKE '%{BUCKET}%' AND TRY_CAST(regexp_extract(audio_url, '[?&]Expires=([^&#]+)', 1) AS BIGINT) <= {NOW}
""")
def _(spark, sf):
    _, expired = jobs.overlay_transcripts_job(
        derive(spark, sf, RECORDINGS), derive(spark, sf, RESULTS).drop("page_id"), F.lit(NOW), BUCKET
    )
    return expired


@query("asr_eval_job", f"""
SELECT count(*) AS rows, CAST(sum(ref_words) AS BIGINT) AS ref_words, CAST(sum(errors) AS BIGINT) AS errors,
  round(sum(errors) / sum(ref_words), 6) AS wer FROM ({DISTANCE_SQL})
""")
def _(spark, sf):
    rows = heard(spark, sf)
    # The truth comes as JSON with a noise mark, the hypothesis inside a data cell.
    tagged = rows.select(
        F.col("id").alias("data_id"),
        F.to_json(F.struct(F.concat(F.lit("<noise> "), "transcript_y").alias("text"))).alias("tag"),
        F.col("utterances").alias("alternatives"),
    )
    report, _, _ = jobs.asr_eval_job(tagged)
    return report.withColumn("wer", F.round("wer", 6))


def audit_service():
    def answer(row):
        size = len(row["call_information"])
        if size % 9 == 0:
            raise RuntimeError("no answer")
        output = ['{"breach": true} as told', '{"breach": false}', "cannot tell"][size % 3]
        return {"compliance_output": output, "tokens_consumed": size // 4}

    return answer


AUDITED = f"""
SELECT * FROM (SELECT call_id, reftime, {redacted_sql('transcript')} AS info FROM ({TRANSCRIPTS}))
WHERE length(info) % 9 <> 0 AND length(info) % 3 < 2
"""


@query("compliance_job", f"""
SELECT 'call-' || CAST(call_id AS VARCHAR) AS call_uuid, length(info) % 3 = 0 AS is_breach, CAST(length(info) // 4 AS INTEGER) AS tokens_consumed,
  md5(info) AS information FROM ({AUDITED}) WHERE length(info) <= 10000
""")
def _(spark, sf):
    accepted, *_ = jobs.compliance_job(derive(spark, sf, TURNS), audit_service())
    return accepted.select(
        "call_uuid", "is_breach", "tokens_consumed", F.md5("call_information").alias("information")
    )


@query("compliance_job_breaches", f"""
SELECT count(*) AS breaches FROM ({AUDITED}) WHERE length(info) % 3 = 0 AND length(info) <= 10000
""")
def _(spark, sf):
    _, _, breaches, _ = jobs.compliance_job(derive(spark, sf, TURNS), audit_service())
    return breaches


ALIAS = {"act": ["click", "view"], "view": ["signup"]}
# Train: renamed, then removed. Test: removed, then renamed.
RENAMED = "CASE tag WHEN 'click' THEN 'act' WHEN 'view' THEN 'act' WHEN 'signup' THEN 'view' ELSE tag END"
LABELS = f"SELECT event_id, label AS tag FROM ({FIRST_TAG})"
SPLIT_LABELS = split_sql(f"({LABELS})", "event_id", 80, "tag", "5")
TRAIN_TEST = f"""
SELECT event_id, tag, split FROM (SELECT event_id, {RENAMED} AS tag, split FROM ({SPLIT_LABELS}) WHERE split = 'train')
WHERE coalesce(tag NOT IN ('view', 'error'), TRUE)
UNION ALL SELECT event_id, {RENAMED} AS tag, split FROM ({SPLIT_LABELS}) WHERE split = 'test'
  AND coalesce(tag NOT IN ('view', 'error'), TRUE)
"""


def sides(train, test):
    named = lambda df, side: df.select("event_id", "tag", F.lit(side).alias("split"))
    return named(train, "train").unionByName(named(test, "test"))


@query("train_test_job", TRAIN_TEST)
def _(spark, sf):
    rows = derive(spark, sf, TAGS).select("event_id", "tag")
    return sides(*jobs.train_test_job(
        rows.where("event_id % 3 = 0"), rows.where("event_id % 3 <> 0"), "event_id", ALIAS,
        ["view", "error"], train_percent=80, stratify="tag", use_previous=False, seed=5,
    ))


# The older rules, with earlier sets and no use of the held-out set.
@query("train_test_job_legacy", f"""
{TRAIN_TEST} UNION ALL
SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderstatus = 'F' THEN 'train' ELSE 'test' END FROM {{orders}}
WHERE o_orderstatus IN ('F', 'O')
""")
def _(spark, sf):
    rows = derive(spark, sf, TAGS).select("event_id", "tag")
    orders = table(spark, sf, "orders")
    old = lambda status: orders.where(F.col("o_orderstatus") == status).select(
        F.col("o_orderkey").alias("event_id"), F.col("o_orderpriority").alias("tag")
    )
    return sides(*jobs.train_test_job(
        rows, None, "event_id", ALIAS, ["view", "error"], old("F"), old("O"), custom_test=rows,
        train_percent=80, stratify="tag", seed=5, legacy=True,
    ))


@query("train_test_job_held_out", f"""
SELECT event_id, tag, 'train' AS split FROM (SELECT event_id, {RENAMED} AS tag FROM ({LABELS}))
WHERE coalesce(tag NOT IN ('view', 'error'), TRUE)
UNION ALL SELECT event_id, {RENAMED} AS tag, 'test' FROM ({LABELS}) WHERE coalesce(tag NOT IN ('view', 'error'), TRUE)
""")
def _(spark, sf):
    rows = derive(spark, sf, TAGS).select("event_id", "tag")
    return sides(*jobs.train_test_job(
        rows, None, "event_id", ALIAS, ["view", "error"], custom_test=rows, initial=True,
    ))


SCORED = """
SELECT event_id, event_type AS tag, CASE WHEN value > 20 THEN 'view' WHEN user_id % 3 = 0 THEN 'act' ELSE event_type END AS intent,
  CASE WHEN value > 10 THEN 'act' WHEN user_id % 5 = 0 THEN 'late' ELSE 'purchase' END AS other
FROM {events}
"""
RELABELLED = f"SELECT event_id, {RENAMED} AS actual, intent, other FROM ({SCORED}) WHERE tag NOT IN ('error')"


@query("intent_eval_job", f"""
SELECT label, round(a.precision, 6) AS precision_1, round(b.precision, 6) AS precision_2, a.support AS support_1, b.support AS support_2
FROM ({report_sql(RELABELLED, 'intent')}) a FULL JOIN ({report_sql(RELABELLED, 'other')}) b USING (label)
""")
def _(spark, sf):
    out = jobs.intent_eval_job(derive(spark, sf, SCORED), ALIAS, ["error"], "other")
    pair = lambda m, i, side: F.round(F.col(f"{m}.{side}"), 6).alias(f"{m}_{i}")
    return out["report_comparison"].select(
        "label", *[pair(m, i, s) for m in ("precision", "support") for i, s in ((1, "first"), (2, "second"))]
    )


@query("intent_eval_job_confusion", f"""
SELECT actual, intent AS predicted, count(*) AS n FROM ({RELABELLED}) GROUP BY ALL
""")
def _(spark, sf):
    return jobs.intent_eval_job(derive(spark, sf, SCORED), ALIAS, ["error"])["confusion"]


# One row per conversation, from all of its turns.
WANTED = """
SELECT conv_id, 'Case ' || CAST(conv_id AS STRING) || ' :: other ' || role AS situation, role AS scenario, 'cat' AS scenario_category
FROM (SELECT conv_id, coalesce(max(role), 'none') AS role FROM {conversations} GROUP BY conv_id)
"""
CASES = "SELECT CAST(n_nationkey + 1 AS BIGINT) AS id, lower(n_name) AS situation, 'user' AS scenario, 'CAT' AS scenario_category, n_nationkey >= 0 AS is_valid FROM {nation}"
ASKED = f"SELECT lower(trim(unnest(string_split(situation, '::')))) AS situation, lower(scenario) AS scenario FROM ({WANTED})"
# Every case is new, so it gets an id after the known ones.
NEW_SITUATIONS = f"""
SELECT situation, scenario, (SELECT max(id) FROM ({CASES})) + row_number() OVER (
  ORDER BY md5(situation || '|' || scenario || '|CAT|'), situation, scenario) AS id FROM (SELECT DISTINCT * FROM ({ASKED}))
"""


def tagged_conversations(spark, sf, link="ASIA"):
    # Ids are given by the job, so the files carry the conversation number as id.
    root = scratch_path(spark, "generated")
    write_files(conversation_files(spark, sf), root)
    prompts = table(spark, sf, "region").select(
        (F.col("r_regionkey") + 1).cast("bigint").alias("id"), F.col("r_name").alias("links_to_prompt_in_s3"),
        F.col("r_regionkey").cast("bigint").alias("client_id"), F.lit(None).cast("bigint").alias("template_id"),
    )
    generated = table(spark, sf, "nation").select(F.col("n_nationkey").cast("bigint").alias("id"))
    return jobs.conversation_tagging_job(
        spark, derive(spark, sf, CASES), prompts, generated, derive(spark, sf, WANTED), root,
        ["41", "42"], link, {"client_id": 1, "template_id": 2, "project_name": "p"},
        prompt={"client_id": 1, "template_id": 2},
    )


@query("conversation_tagging_job", f"""
SELECT scenario, 'CAT' AS scenario_category, situation AS situation_str, call, 'Live' AS data_label, project_id
FROM ({NEW_SITUATIONS}) s JOIN (SELECT conv_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS call
  FROM {{conversations}} WHERE conv_id % 3 <> 2 GROUP BY conv_id) d ON d.conv_id = s.id
  JOIN ({ASKED}) a USING (situation, scenario), (SELECT unnest(['41', '42']) AS project_id)
""")
def _(spark, sf):
    return tagged_conversations(spark, sf)["tasks"]


@query("conversation_tagging_job_facts", f"""
SELECT id AS situation_id, CAST(r_regionkey + 1 AS BIGINT) AS prompt_id, (SELECT max(n_nationkey) FROM {{nation}}) + row_number() OVER (
  ORDER BY md5(CAST(id AS VARCHAR) || '|' || CAST(r_regionkey + 1 AS VARCHAR) || '|'), id) AS id, 'p' AS project_name
FROM ({NEW_SITUATIONS}), {{region}} WHERE r_name = 'ASIA'
""")
def _(spark, sf):
    facts = tagged_conversations(spark, sf)["generated"]
    return facts.select("situation_id", "prompt_id", "id", "project_name")


@query("conversation_tagging_job_prompts", """
SELECT CAST(r_regionkey + 1 AS BIGINT) AS id, r_name AS links_to_prompt_in_s3, CAST(r_regionkey AS BIGINT) AS client_id, CAST(NULL AS BIGINT) AS template_id
FROM {region} UNION ALL SELECT max(r_regionkey) + 2, 'prompts/new', 1, 2 FROM {region}
""")
def _(spark, sf):
    prompts = tagged_conversations(spark, sf, "prompts/new")["prompts"]
    return prompts.select("id", "links_to_prompt_in_s3", "client_id", "template_id")


@query("generation_requests_job", """
SELECT p_partkey, pos, CASE pos WHEN 0 THEN p_name ELSE p_brand END AS situation, iteration, choice
FROM {part}, (SELECT unnest([0, 1]) AS pos), (SELECT unnest([1, 2]) AS iteration), (SELECT unnest([1, 2, 3]) AS choice)
""")
def _(spark, sf):
    rows = table(spark, sf, "part").select(
        "p_partkey", F.concat_ws(" :: ", "p_name", "p_brand").alias("situations")
    )
    return jobs.generation_requests_job(rows, "situations", 2, 3)


@query("invalidate_job", f"""
SELECT id, situation, is_valid AND id NOT IN (1, 7, 12) AS is_valid FROM ({KNOWN})
""")
def _(spark, sf):
    after = jobs.invalidate_job(derive(spark, sf, KNOWN), "1, 7,,12, 99999999")
    return after.select("id", "situation", "is_valid")


SPOKEN = """
SELECT conv_id, role AS job_id, CASE WHEN turn % 2 = 0 THEN '<noise> ' || text ELSE text || ' <breath/>' END AS tag, turn FROM {conversations}
"""
LEXICON = "SELECT item_id, CASE WHEN item_id % 5 = 0 THEN '<SIL> sil' ELSE text END AS line FROM {benchmark}"


def corpus_job(spark, sf):
    words = lambda name: table(spark, sf, name)
    augment = words("part").select(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("word"))
    remove = words("part").where("p_size > 25").select(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("word"))
    extra = words("part").select(F.concat_ws(" ", F.split_part("p_name", F.lit(" "), F.lit(2)), "p_brand").alias("line"))
    return jobs.asr_corpus_job(
        derive(spark, sf, SPOKEN).withColumn("tagged_at", F.current_timestamp()), "user, assistant",
        augment, remove, derive(spark, sf, LEXICON).select("line"), extra,
    )


@query("asr_corpus_job", """
SELECT text AS line, count(*) AS n FROM (SELECT trim(text, ' ' || chr(10)) AS text FROM {conversations} WHERE role IN ('user', 'assistant')) GROUP BY text
""")
def _(spark, sf):
    return corpus_job(spark, sf)["corpus"].groupBy("line").agg(F.count("*").alias("n"))


@query("asr_corpus_job_vocabulary", """
SELECT word FROM (SELECT unnest(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) AS word FROM {conversations}
  WHERE role IN ('user', 'assistant') UNION SELECT split_part(p_name, ' ', 1) FROM {part})
WHERE word NOT IN (SELECT split_part(p_name, ' ', 2) FROM {part} WHERE p_size > 25)
""")
def _(spark, sf):
    return corpus_job(spark, sf)["vocabulary"]


@query("asr_corpus_job_lexicon", f"""
SELECT line FROM (SELECT line FROM ({LEXICON}) WHERE line NOT LIKE '%<SIL>%' UNION SELECT split_part(p_name, ' ', 2) || ' ' || p_brand FROM {{part}})
WHERE split_part(line, ' ', 1) NOT IN (SELECT split_part(p_name, ' ', 2) FROM {{part}} WHERE p_size > 25)
""")
def _(spark, sf):
    return corpus_job(spark, sf)["lexicon"]
