"""Registration, table access and the input tables derived from the driver tables.

A derived table is one SELECT in the part of SQL that Spark and DuckDB share, with
``{table}`` for a driver table. So both sides of a check start from equal rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function (spark, sf_dir) and the SQL that gives the same rows."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = plain(sql)
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def plain(sql: str) -> str:
    """The SQL with driver table names in place of the braces."""
    return re.sub(r"\{([a-z]+)\}", r"\1", sql)


def derive(spark: SparkSession, sf: str, sql: str) -> DataFrame:
    """The derived table on Spark, read straight from the files."""
    return spark.sql(re.sub(r"\{([a-z]+)\}", rf"parquet.`{sf}/\1.parquet`", sql))


# A text that can stand between the quotes of JSON text as it is.
SAFE = "replace(replace(replace(text, chr(92), ' '), chr(10), ' '), '\"', ' ')"

TURNS = f"""
SELECT conv_id AS call_id, turn AS conversation_id,
  'call-' || CAST(conv_id AS STRING) AS call_uuid,
  'turn-' || CAST(conv_id AS STRING) || '-' || CAST(turn AS STRING) AS conversation_uuid,
  'flow-' || CAST(conv_id % 5 AS STRING) AS flow_uuid,
  CASE WHEN conv_id % 13 = 0 THEN NULL ELSE 'client-' || CAST(conv_id % 3 AS STRING) END AS client_uuid,
  '2024-01-' || lpad(CAST(1 + conv_id % 28 AS STRING), 2, '0') || 'T'
    || lpad(CAST(turn AS STRING), 2, '0') || ':15:30+05:30' AS reftime,
  CAST('2024-01-' || lpad(CAST(1 + conv_id % 28 AS STRING), 2, '0') || ' '
    || lpad(CAST(turn AS STRING), 2, '0') || ':15:30' AS TIMESTAMP) AS call_time,
  CASE WHEN conv_id % 11 = 0 THEN NULL ELSE 'https://rec.example.com/2024/t-' || CAST(conv_id AS STRING)
    || '-' || CAST(turn AS STRING) || '.flac?Sig=a&Expires='
    || CAST(1700000000 + conv_id * 100000 AS STRING) END AS audio_url,
  'https://calls.example.com/' || CAST(conv_id AS STRING) || '.wav' AS call_url,
  CASE WHEN role <> 'user' THEN '<speak>' || text || ' Call (555) 010-'
    || lpad(CAST(conv_id % 10000 AS STRING), 4, '0') || ' ref ' || CAST(100000 + conv_id AS STRING)
    || '.</speak>' END AS bot_response,
  CASE WHEN role = 'user' THEN text END AS primary_utterance,
  'S' || CAST(turn % 4 AS STRING) AS state,
  CASE WHEN length(text) % 3 = 0 THEN '_confirm_' WHEN length(text) % 3 = 1 THEN '_cancel_'
    ELSE 'other' END AS intent,
  CASE WHEN role = 'user' THEN '[[{{"transcript":"' || {SAFE} || '"}}]]' END AS utterances,
  CASE WHEN turn % 5 = 4 THEN 'broken' ELSE '{{"bot_response":"state ' || CAST(turn AS STRING) || '?"}}' END AS context,
  CASE conv_id % 4 WHEN 0 THEN 'inbound' WHEN 3 THEN 'test' ELSE 'outbound' END AS call_type,
  CASE conv_id % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'hi' ELSE 'en-US' END AS language,
  CASE WHEN conv_id % 2 = 0 THEN 'USER' ELSE 'BOT' END AS call_end_status,
  CAST(NULL AS STRING) AS disposition, CAST(NULL AS STRING) AS previous_disposition,
  CAST(NULL AS STRING) AS blocking_disposition,
  conv_id % 5 AS flow_id, 'v' || CAST(conv_id % 2 AS STRING) AS flow_version,
  'flow ' || CAST(conv_id % 5 AS STRING) AS flow_name,
  CAST(length(text) % 300 AS DOUBLE) AS call_duration,
  conv_id % 7 AS template_id, conv_id % 6 AS org_id,
  CASE WHEN conv_id % 9 = 0 THEN NULL ELSE '+1555' || CAST(conv_id % 8 AS STRING) END AS caller,
  conv_id % 10 = 1 AS reported, 'collect' AS use_case,
  CASE WHEN conv_id % 2 = 0 THEN 'asr-a' ELSE 'asr-b' END AS asr_provider
FROM {{conversations}}
"""

# ISO texts with different offsets, and a language, from the event times.
MOMENTS = """
SELECT event_id, user_id, event_type, ts,
  replace(substr(CAST(ts AS STRING), 1, 19), ' ', 'T')
    || CASE event_id % 3 WHEN 0 THEN '+05:30' WHEN 1 THEN '-04:00' ELSE 'Z' END AS reftime,
  CASE event_id % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'en-US' WHEN 2 THEN 'hi' END AS language,
  user_id % 7200 AS seconds
FROM {events}
"""

# Links of recordings, some signed.
RECORDINGS = """
SELECT page_id, replace(replace(url, '?', '/'), '#', '/') || CASE page_id % 4
  WHEN 0 THEN '/u-' || CAST(page_id AS STRING) || '.flac?Sig=a%2Fb&Expires='
    || CAST(1600000000 + (page_id % 100) * 1000000 AS STRING)
  WHEN 1 THEN '/v-' || CAST(page_id - page_id % 12 AS STRING) || '.mp3'
  WHEN 2 THEN '/w.tar-' || CAST(page_id AS STRING) || '.gz?Expires=&Expires=soon'
  ELSE '/x-' || CAST(page_id - page_id % 12 AS STRING) || '.wav' END AS audio_url
FROM {pages}
"""

# Labels as people and tools write them: lists, objects, encoded twice, plain, broken, missing.
TAGS = """
SELECT event_id, user_id, event_type, CASE event_id % 9
  WHEN 0 THEN '["' || event_type || '","x"]'
  WHEN 1 THEN '{"choices":["' || event_type || '"]}'
  WHEN 2 THEN '"[' || chr(92) || '"' || event_type || chr(92) || '"]"'
  WHEN 3 THEN event_type
  WHEN 4 THEN '[]'
  WHEN 5 THEN CAST(NULL AS STRING)
  WHEN 6 THEN '"' || event_type || '"'
  WHEN 7 THEN CAST(user_id AS STRING)
  ELSE '{"choices":["' || event_type END AS tag
FROM {events}
"""
