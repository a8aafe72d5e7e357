"""Functions on JSON text."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import SAFE, TAGS, TURNS, derive, query, table
from turnwise.functions import jsons

DOUBLE = "'\"' || replace({0}, '\"', chr(92) || '\"') || '\"'"


FIRST_TAG = f"""
WITH once AS (SELECT event_id, tag, CASE WHEN json_valid(tag) THEN CAST(tag AS JSON) END AS j FROM ({TAGS})),
twice AS (SELECT event_id, tag, j, CASE WHEN json_type(j) = 'VARCHAR' THEN j ->> '$' END AS s FROM once),
value AS (SELECT event_id, coalesce(s, tag) AS raw,
  CASE WHEN s IS NULL THEN j WHEN json_valid(s) THEN CAST(s AS JSON) END AS v FROM twice)
SELECT event_id, CASE WHEN v IS NULL THEN raw WHEN json_type(v) = 'ARRAY' THEN v ->> '$[0]'
  WHEN json_type(v) = 'OBJECT' THEN v ->> '$.choices[0]' ELSE v ->> '$' END AS label FROM value
"""


@query("first_tag", FIRST_TAG)
def _(spark, sf):
    return derive(spark, sf, TAGS).select("event_id", jsons.first_tag(F.col("tag")).alias("label"))


SPOKEN = f"""
SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN '{{"text":"' || {SAFE} || '"}}'
  WHEN 1 THEN text ELSE CAST(NULL AS STRING) END AS tag FROM {{conversations}}
"""


@query("tag_text", f"""
SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN {SAFE} WHEN 1 THEN text END AS spoken
FROM {{conversations}}
""")
def _(spark, sf):
    rows = derive(spark, sf, SPOKEN)
    return rows.select("conv_id", "turn", jsons.tag_text(F.col("tag")).alias("spoken"))


DATA = f"""
SELECT event_id, CASE event_id % 7
  WHEN 0 THEN '{{"utterances":[[{{"transcript":"' || event_type || '"}}]]}}'
  WHEN 1 THEN '{{"alternatives":[1,' || CAST(user_id AS STRING) || '],"utterances":[]}}'
  WHEN 2 THEN '{{"utterances":"' || event_type || '"}}'
  WHEN 3 THEN {DOUBLE.format("('{\"alternatives\":[[\"' || event_type || '\"]]}')")}
  WHEN 4 THEN '{{}}'
  WHEN 5 THEN '{{"utterances":'
  ELSE CAST(NULL AS STRING) END AS data
FROM {{events}}
"""


@query("build_utterances", f"""
WITH d AS (SELECT event_id, CASE WHEN json_valid(data) THEN CAST(data AS JSON) END AS j FROM ({DATA})),
v AS (SELECT event_id, CASE WHEN json_type(j) = 'VARCHAR' THEN CAST(j ->> '$' AS JSON) ELSE j END AS j FROM d)
SELECT event_id, CASE WHEN coalesce(CAST(j -> '$.utterances' AS VARCHAR), '[]') NOT IN ('[]', '""', 'null')
  THEN j ->> '$.utterances' ELSE j ->> '$.alternatives' END AS utterances FROM v
""")
def _(spark, sf):
    rows = derive(spark, sf, DATA)
    return rows.select("event_id", jsons.build_utterances(F.col("data")).alias("utterances"))


ANNOTATIONS = """
SELECT event_id, user_id, event_type, ts, 'turn-' || CAST(event_id AS STRING) AS conversation_uuid,
  'call-' || CAST(event_id AS STRING) AS call_uuid, CAST(ts AS STRING) AS reftime,
  CAST(user_id % 3 AS STRING) AS flow_id,
  CASE WHEN user_id % 2 = 0 THEN 'Live' ELSE 'UAT' END AS data_label,
  CASE WHEN event_id % 7 = 0 THEN CAST(NULL AS STRING) WHEN event_id % 7 = 1 THEN '[]' ELSE
  '[{"from_name":"tag","value":{"choices":["old"]}},{"from_name":"tag","value":{"choices":["' || event_type
  || '","second"]}},{"from_name":"ls_entities","value":{"labels":["Date"],"text":"day '
  || CAST(user_id AS STRING) || '"}},{"from_name":"other","value":{}}'
  || CASE WHEN event_id % 2 = 0 THEN ',{"from_name":"ls_entities","value":{"labels":["Number"],"text":"n"}}'
  ELSE '' END
  || CASE WHEN event_id % 3 = 0 THEN ',{"from_name":"ls_transcription","value":{"text":["said ' || event_type
  || '"]}}' ELSE '' END || ']' END AS annotation_result
FROM {events}
"""
UNPACKED_ANNOTATION = f"""
SELECT event_id, event_type, user_id, conversation_uuid, flow_id, data_label, ts,
  CASE WHEN annotation_result LIKE '[{{%' THEN event_type END AS tag,
  CASE WHEN annotation_result LIKE '[{{%' THEN '["' || event_type || '","second"]' END AS ls_intent,
  CASE WHEN annotation_result LIKE '[{{%' THEN '[' || array_to_string(list_transform(list_filter(
    CAST(CAST(annotation_result AS JSON) AS JSON[]), lambda i: i ->> '$.from_name' = 'ls_entities'),
    lambda i: CAST(i -> '$.value' AS VARCHAR)), ',') || ']' END AS ls_entities,
  CASE WHEN annotation_result LIKE '%ls_transcription%' THEN 'said ' || event_type END AS ls_transcription
FROM ({ANNOTATIONS})
"""


@query("unpack_annotation", f"""
SELECT event_id, tag, ls_intent, ls_entities, ls_transcription FROM ({UNPACKED_ANNOTATION})
""")
def _(spark, sf):
    rows = derive(spark, sf, ANNOTATIONS)
    unpacked = jsons.unpack_annotation(F.col("annotation_result"))
    return rows.select("event_id", unpacked.alias("a")).select("event_id", "a.*")


CONTEXT = """
SELECT event_id, user_id, event_type, 'turn-' || CAST(event_id AS STRING) AS conversation_uuid,
  'call-' || CAST(event_id AS STRING) AS call_uuid, CAST(ts AS STRING) AS reftime,
  'base-' || CAST(user_id % 5 AS STRING) AS audio_base_path, CAST(event_id AS STRING) || '.flac' AS audio_path,
  'rec-' || CAST(event_id AS STRING) AS call_url_id,
  CASE event_id % 3 WHEN 0 THEN 'https://kept.example.com/' || CAST(event_id AS STRING) WHEN 1 THEN ''
    ELSE CAST(NULL AS STRING) END AS call_url,
  CASE WHEN event_id % 6 = 0 THEN CAST(NULL AS STRING) WHEN event_id % 6 = 1 THEN '{}' ELSE
  '{"entities":' || CASE WHEN event_id % 2 = 0 THEN '[{"type":"' || event_type || '"}]' ELSE '[]' END
  || ',"intents":[{"name":"' || event_type || '","score":0.' || CAST(10 + user_id % 90 AS STRING)
  || ',"slots":[' || CAST(user_id AS STRING) || ']},{"name":"second","score":0.1,"slots":[]}]'
  || CASE WHEN event_id % 5 = 0 THEN ',"original_intent":"first"' ELSE '' END || '}' END AS prediction
FROM {events}
"""
UNPACKED_PREDICTION = f"""
SELECT *, j ->> '$.intents[0].name' AS intent,
  CAST(j ->> '$.intents[0].score' AS DOUBLE) AS intent_score,
  coalesce(CAST(j -> '$.intents[0].slots' AS VARCHAR), '[]') AS slots,
  coalesce(CAST(j -> '$.entities' AS VARCHAR), '[]') AS entities,
  j ->> '$.original_intent' AS original_intent
FROM (SELECT *, CAST(prediction AS JSON) AS j FROM ({CONTEXT}))
"""


@query("unpack_prediction", f"""
SELECT event_id, intent, coalesce(intent_score, -1) AS intent_score, slots, entities, original_intent
FROM ({UNPACKED_PREDICTION})
""")
def _(spark, sf):
    rows = derive(spark, sf, CONTEXT)
    unpacked = rows.select("event_id", jsons.unpack_prediction(F.col("prediction")).alias("p"))
    return unpacked.select("event_id", "p.*").withColumn(
        "intent_score", F.coalesce("intent_score", F.lit(-1.0))
    )


@query("primary_transcript", f"""
SELECT conversation_uuid, CAST(utterances AS JSON) ->> '$[0][0].transcript' AS spoken,
  CASE WHEN json_valid(context) THEN CAST(context AS JSON) ->> '$.bot_response' END AS asked
FROM ({TURNS})
""")
def _(spark, sf):
    turns = derive(spark, sf, TURNS)
    return turns.select(
        "conversation_uuid",
        jsons.primary_transcript(F.col("utterances")).alias("spoken"),
        jsons.bot_response(F.col("context")).alias("asked"),
    )


ANSWERS = """
SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'Output: {"breach": true} because of ' || event_type
  WHEN 1 THEN '{"breach": false,' || chr(10) || '"why": {"n": ' || CAST(user_id AS STRING) || '}} ok'
  WHEN 2 THEN 'no answer' WHEN 3 THEN 'bad {breach} here' ELSE '} {' END AS answer FROM {events}
"""


@query("json_slice", f"""
SELECT event_id, CASE WHEN part = '' THEN '{{}}' WHEN json_valid(part) THEN CAST(json(part) AS VARCHAR) END
  AS parsed
FROM (SELECT event_id, regexp_extract(answer, '(?s)\\{{.*\\}}', 0) AS part FROM ({ANSWERS}))
""")
def _(spark, sf):
    rows = derive(spark, sf, ANSWERS)
    return rows.select("event_id", F.to_json(jsons.json_slice(F.col("answer"))).alias("parsed"))


TAGGED = """
SELECT event_id, CASE event_id % 5
  WHEN 0 THEN '[{"labels":["Date"],"text":"~day ' || CAST(user_id AS STRING) || '"},{"labels":["X"],"text":""},{"text":"t"}]'
  WHEN 1 THEN '[{"labels":["' || upper(event_type) || '","b"],"text":"' || event_type || '"}]'
  WHEN 2 THEN '[]' WHEN 3 THEN CAST(NULL AS STRING) ELSE '[{"labels":[],"text":"u"}]' END AS labelled,
  CASE WHEN event_id % 4 = 3 THEN CAST(NULL AS STRING) ELSE '[{"text":"a","type":"' || upper(event_type)
    || '/x"},{"text":"b"},{"type":"C"}]' END AS typed
FROM {events}
"""


def _pairs(column: str, kind: str) -> str:
    return f"""(SELECT array_to_string(list_transform(list_filter(CAST(CAST({column} AS JSON) AS JSON[]),
      lambda i: coalesce(i ->> '$.text', '') <> ''), lambda i: coalesce({kind}, '-') || '=' || (i ->> '$.text')),
      ';'))"""


@query("annotated_entities", f"""
SELECT event_id, coalesce({_pairs('labelled', "lower(i ->> '$.labels[0]')")}, '') AS labelled,
  coalesce({_pairs('typed', "lower(coalesce(i ->> '$.type', ''))")}, '') AS typed FROM ({TAGGED})
""")
def _(spark, sf):
    rows = derive(spark, sf, TAGGED)

    def flat(column, source):
        pairs = F.transform(
            jsons.annotated_entities(F.col(column), source),
            lambda e: F.concat(F.coalesce(e["type"], F.lit("-")), F.lit("="), e["text"]),
        )
        return F.array_join(pairs, ";").alias(column)

    return rows.select("event_id", flat("labelled", "labelled"), flat("typed", "typed"))


PREDICTED = """
SELECT event_id, user_id, event_type, CASE event_id % 8
  WHEN 0 THEN '[{"body":"' || event_type || '","entity_type":"date","type":"t","value":{"from":"a","to":"b"}}]'
  WHEN 1 THEN '[{"body":"x","type":"' || event_type || '","value":{"from":{"value":' || CAST(user_id AS STRING) || '}}},{}]'
  WHEN 2 THEN '[{"entity_type":"","type":"n","value":' || CAST(user_id AS STRING) || '}]'
  WHEN 3 THEN '[]' WHEN 4 THEN 'broken' WHEN 5 THEN CAST(NULL AS STRING)
  WHEN 6 THEN '[{"body":"y","type":"t","value":{"from":{"grain":"d"},"to":3}}]'
  ELSE '[{"body":"z","type":"t","value":{"k":1}},{"body":"w","type":"u","value":{"from":5,"to":"' || event_type || '"}}]'
  END AS predicted FROM {events}
"""
# What each kind of input must give, written out.
NORMALIZED = f"""
SELECT event_id, CASE event_id % 8
  WHEN 0 THEN '[{{"type":"date","value":{{"from":{{"value":"a"}},"to":{{"value":"b"}}}},"text":"' || event_type || '"}}]'
  WHEN 1 THEN CASE WHEN user_id = 0 THEN '[{{"type":"' || event_type || '","value":null,"text":"x"}}]' ELSE
    '[{{"type":"' || event_type || '","value":{{"from":{{"value":' || CAST(user_id AS VARCHAR) || '}}}},"text":"x"}}]' END
  WHEN 2 THEN '[{{"type":"n","value":' || CAST(user_id AS VARCHAR) || ',"text":null}}]'
  WHEN 6 THEN '[{{"type":"t","value":null,"text":"y"}}]'
  WHEN 7 THEN '[{{"type":"t","value":{{"k":1}},"text":"z"}},{{"type":"u","value":{{"to":{{"value":"' || event_type
    || '"}}}},"text":"w"}}]' END AS predicted_entities FROM ({PREDICTED})
"""


@query("normalize_predicted_entities", NORMALIZED)
def _(spark, sf):
    rows = derive(spark, sf, PREDICTED)
    out = jsons.normalize_predicted_entities(F.col("predicted"))
    return rows.select("event_id", out.alias("predicted_entities"))


SETTINGS = """
SELECT event_id, CASE event_id % 8 WHEN 0 THEN '{"link":"' || event_type || '"}' WHEN 1 THEN '{"link":0}'
  WHEN 2 THEN '{"link":[]}' WHEN 3 THEN '{"link":false}' WHEN 4 THEN '{"link":' || props || '}'
  WHEN 5 THEN '{"link":""}' WHEN 6 THEN '{"other":1}' ELSE '{"link":"0"}' END AS settings
FROM {events}
"""


@query("json_key", f"""
SELECT event_id, CASE WHEN raw NOT IN ('0', '[]', 'false', '""', '{{}}', 'null') THEN CAST(settings AS JSON) ->> '$.link' END
  AS link FROM (SELECT event_id, settings, CAST(CAST(settings AS JSON) -> '$.link' AS VARCHAR) AS raw FROM ({SETTINGS}))
""")
def _(spark, sf):
    rows = derive(spark, sf, SETTINGS)
    return rows.select("event_id", jsons.json_key(F.col("settings"), "link").alias("link"))


@query("json_key_props", "SELECT event_id, nullif(CAST(props AS JSON) ->> '$.k', '0') AS k FROM {events}")
def _(spark, sf):
    rows = table(spark, sf, "events")
    return rows.select("event_id", jsons.json_key(F.col("props"), "k").alias("k"))


ESCAPED = f"""
SELECT conv_id, turn, CASE WHEN turn % 4 = 3 THEN '"' || role || chr(92) || 'u00e9"' ELSE
  '[ {{"transcript" : "' || {SAFE} || chr(92) || 'u00e9", "confidence": 0.50 }} ]' END AS alternatives
FROM {{conversations}}
"""


@query("canonical_json", f"""
SELECT conv_id, turn, CASE WHEN turn % 4 = 3 THEN '"' || role || chr(233) || '"' ELSE
  '[{{"transcript":"' || {SAFE} || chr(233) || '","confidence":0.5}}]' END AS alternatives
FROM {{conversations}}
""")
def _(spark, sf):
    rows = derive(spark, sf, ESCAPED)
    out = jsons.canonical_json(F.col("alternatives"))
    return rows.select("conv_id", "turn", out.alias("alternatives"))
