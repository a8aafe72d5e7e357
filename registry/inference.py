"""Requests to outside services and their results. The services are stand-ins by rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import SAFE, TURNS, derive, query, table
from registry.calls import TRANSCRIPTS
from registry.text import ZONE, redacted_sql
from turnwise.operators import calls, inference

TEMPLATE = "In state {{state}}:\n{{conversation_context}}\nAnswer:"
PROMPTS = f"""
SELECT conv_id, turn, 'turn-' || CAST(conv_id AS STRING) || '-' || CAST(turn AS STRING) AS conversation_uuid,
  'In state S' || CAST(turn % 4 AS STRING) || ':' || chr(10) || '[Bot]: state ' || CAST(turn AS STRING)
  || '?  ' || chr(10) || ' [User]: ' || {SAFE} || chr(10) || 'Answer:' AS prompt
FROM {{conversations}} WHERE role = 'user' AND turn % 5 <> 4
"""


@query("intent_requests", f"SELECT conversation_uuid, prompt FROM ({PROMPTS})")
def _(spark, sf):
    asked = inference.intent_requests(derive(spark, sf, TURNS), TEMPLATE)
    return asked.select("conversation_uuid", "prompt")


def intent_service():
    """Answers by the length of the prompt; some requests fail."""

    def answer(row):
        size = len(row["prompt"])
        if size % 10 == 0:
            raise RuntimeError(f"no answer for {size} characters")
        text = [" _confirm_", "_cancel_ ", "other"][size % 3]
        return {"text": text, "logprobs": [-0.25, -size / 1000, -1.0, -1.0, -1.0], "tokens": size // 4}

    return answer


INTENT_ANSWER = """CASE WHEN length(prompt) % 10 <> 0 THEN CASE length(prompt) % 3 WHEN 0 THEN ' _confirm_'
  WHEN 1 THEN '_cancel_ ' ELSE 'other' END END"""


@query("run_inference", f"""
SELECT DISTINCT prompt, {INTENT_ANSWER} AS text, CASE WHEN length(prompt) % 10 = 0 THEN -1 ELSE length(prompt) // 4 END AS tokens,
  CASE WHEN length(prompt) % 10 = 0 THEN 'no answer for ' || CAST(length(prompt) AS VARCHAR) || ' characters' END AS error
FROM ({PROMPTS})
""")
def _(spark, sf):
    asked = inference.intent_requests(derive(spark, sf, TURNS), TEMPLATE).select("prompt").distinct()
    answered = inference.run_inference(
        asked, intent_service(), "text string, logprobs array<double>, tokens bigint", ["prompt"]
    )
    return answered.select(
        "prompt", "text", F.coalesce("tokens", F.lit(-1)).alias("tokens"), "error"
    )


OUTPUTS = f"""
SELECT *, CASE length(call_information) % 4 WHEN 0 THEN 'Output: {{"breach": true}} because' WHEN 1 THEN '{{"breach": false}}'
  WHEN 2 THEN 'cannot tell' ELSE '{{"other": 1}}' END AS compliance_output, length(call_information) // 4 AS tokens_consumed
FROM (SELECT call_id, reftime, {redacted_sql('transcript')} AS call_information FROM ({TRANSCRIPTS}))
"""


@query("breach_results", f"""
SELECT call_id, 'call-' || CAST(call_id AS VARCHAR) AS call_uuid, reftime, compliance_output LIKE '%true%' AS is_breach,
  compliance_output, tokens_consumed, call_information FROM ({OUTPUTS}) WHERE compliance_output LIKE '%"breach"%'
""")
def _(spark, sf):
    from turnwise.functions import text

    whole = calls.render_transcript(calls.assemble_calls(derive(spark, sf, TURNS)), "call_information")
    ready = whole.drop("turns").withColumn(
        "call_information", text.redact_numbers(F.col("call_information"))
    )
    size = F.length("call_information")
    rest = size % 4
    output = (
        F.when(rest == 0, 'Output: {"breach": true} because')
        .when(rest == 1, '{"breach": false}')
        .when(rest == 2, "cannot tell")
        .otherwise('{"other": 1}')
    )
    responses = ready.select(
        "call_id", output.alias("compliance_output"),
        F.floor(size / 4).cast("bigint").alias("tokens_consumed"),
    )
    return inference.breach_results(ready, responses).select(
        "call_id", "call_uuid", "reftime", "is_breach", "compliance_output", "tokens_consumed",
        "call_information",
    )


TAGGED_ROWS = """
SELECT event_id, ts, event_type, user_id,
  replace(substr(CAST(ts AS STRING), 1, 19), ' ', 'T') || CASE WHEN event_id % 2 = 0 THEN '+05:30' ELSE 'Z' END AS reftime,
  CASE event_id % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'en-US' ELSE 'hi' END AS language,
  CASE event_id % 6
    WHEN 0 THEN '[{"labels":["Date"],"text":"~day ' || CAST(user_id % 20 AS STRING) || '"}]'
    WHEN 1 THEN '[{"labels":["Time"],"text":"at ' || CAST(user_id % 24 AS STRING) || '"},{"labels":["Number/7"],"text":"seven"}]'
    WHEN 2 THEN '[{"labels":["Name"],"text":"~Bob ' || event_type || '"}]'
    WHEN 3 THEN CAST(NULL AS STRING)
    WHEN 4 THEN '[{"text":"no label"}]'
    ELSE '[{"labels":["a/b/c"],"text":"x"}]' END AS raw_entities
FROM {events}
"""
# The tagged dates and times, the question for each, and what the stand-in service makes of it.
DATED = f"""
SELECT *, CASE n % 5 WHEN 0 THEN '"2024-02-0' || CAST(1 + n % 9 AS VARCHAR) || 'T00:00:00"'
  WHEN 1 THEN '{{"from":{{"value":"a"}},"to":{{"value":"b"}}}}'
  WHEN 2 THEN '"' || strftime(date_trunc('second', ts) + INTERVAL 3 HOUR, '%Y-%m-%dT%H:%M:%S') || '+05:30"' END AS value
FROM (SELECT event_id, ts, text, dim, CAST(split_part(text, ' ', 2) AS INTEGER) AS n,
    CAST(epoch_ms(date_trunc('second', ts)) - 19800000 AS BIGINT) AS ref_ms,
    CASE WHEN language LIKE '%US%' THEN 'en_US' WHEN language LIKE 'en%' THEN 'en_IN' ELSE language END AS locale
  FROM (SELECT *, CASE WHEN event_id % 6 = 0 THEN 'day ' || CAST(user_id % 20 AS VARCHAR)
    ELSE 'at ' || CAST(user_id % 24 AS VARCHAR) END AS text, CASE WHEN event_id % 6 = 0 THEN 'date' ELSE 'time' END AS dim
    FROM ({TAGGED_ROWS}) WHERE event_id % 6 < 2))
"""


def tagged_rows(spark, sf):
    rows = derive(spark, sf, TAGGED_ROWS)
    return rows.withColumnsRenamed({"language": "raw.language", "raw_entities": "raw.entities"})


def entity_service():
    """Answers by the number in the text."""

    def answer(row):
        n = int(row["text"].split(" ")[1])
        response = [
            f'[{{"dim":"time","value":{{"value":"2024-02-0{1 + n % 9}T00:00:00"}}}}]',
            '[{"dim":"time","value":{"to":{"value":"b"},"from":{"value":"a"},"type":"interval"}}]',
            '[{"dim":"duration","value":{"value":3,"normalized":{"value":10800,"unit":"second"}}}]',
            "[]",
            '[{"dim":"number","value":{"value":7}}]',
        ][n % 5]
        return {"response": response}

    return answer


@query("entity_requests", f"""
SELECT DISTINCT text, dim, ref_ms, locale, '{ZONE}' AS tz FROM ({DATED})
""")
def _(spark, sf):
    rows = inference.entity_rows(tagged_rows(spark, sf), "event_id", ZONE, "labelled")
    return inference.entity_requests(rows, ZONE)


def entity_answers(spark, sf):
    rows = inference.entity_rows(tagged_rows(spark, sf), "event_id", ZONE, "labelled")
    answered = inference.run_inference(
        inference.entity_requests(rows, ZONE), entity_service(), "response string",
        ["text", "dim", "ref_ms", "locale"],
    )
    return rows, inference.entity_values(answered, ZONE)


@query("entity_values", f"SELECT DISTINCT text, dim, ref_ms, locale, value FROM ({DATED})")
def _(spark, sf):
    _, values = entity_answers(spark, sf)
    return values.select("text", "dim", "ref_ms", "locale", "value")


TRUTH = f"""
SELECT r.event_id AS id, CASE WHEN r.event_id % 6 = 0 AND value IS NOT NULL
    THEN '[{{"type":"date","value":' || value || ',"text":"' || text || '"}}]'
  WHEN r.event_id % 6 = 1 THEN '[' || coalesce('{{"type":"time","value":' || value || ',"text":"' || text || '"}},', '')
    || '{{"type":"number","value":"7","text":"seven"}}]'
  WHEN r.event_id % 6 = 2 THEN '[{{"type":"name","value":"Bob ' || r.event_type || '","text":"Bob ' || r.event_type || '"}}]'
  END AS truth_entities_with_duckling
FROM ({TAGGED_ROWS}) r LEFT JOIN ({DATED}) d USING (event_id)
"""


@query("entity_truth", TRUTH)
def _(spark, sf):
    return inference.entity_truth(*entity_answers(spark, sf))


@query("generation_requests", """
SELECT p_size AS situation_id, max(p_name || ' ' || p_brand) AS situation, iteration, choice
FROM {part}, (SELECT unnest(range(1, 4)) AS iteration), (SELECT unnest(range(1, 3)) AS choice)
GROUP BY p_size, iteration, choice
""")
def _(spark, sf):
    situations = table(spark, sf, "part").select(
        F.col("p_size").alias("situation_id"), F.concat_ws(" ", "p_name", "p_brand").alias("situation")
    )
    asked = inference.generation_requests(situations, 3, 2)
    return asked.select(
        "situation_id", "situation", F.col("iteration").cast("bigint"), F.col("choice").cast("bigint")
    )
