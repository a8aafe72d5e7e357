"""Calls made of turns."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import TURNS, derive, query, table
from registry.text import BLANKS, redacted_sql
from turnwise.functions import text
from turnwise.operators import calls
from turnwise.session import scratch_path
from turnwise.sources import writers

CLEANED = f"""
SELECT call_id, conversation_id, reftime,
  coalesce(trim(regexp_replace(bot_response, '<[^<]+?>', '', 'g'), '{BLANKS}'), 'NA') AS bot,
  coalesce(trim(regexp_replace(primary_utterance, '<[^<]+?>', '', 'g'), '{BLANKS}'), 'NA') AS person
FROM ({TURNS})
"""
TRANSCRIPTS = f"""
SELECT call_id, '<call>' || chr(10) || string_agg('BOT: ' || bot || chr(10) || 'USER: ' || person, chr(10)
  ORDER BY conversation_id) || chr(10) || '</call>' AS transcript, min(reftime) AS reftime, count(*) AS n
FROM ({CLEANED}) GROUP BY call_id
"""


@query("assemble_calls", f"""
SELECT call_id, 'call-' || CAST(call_id AS VARCHAR) AS call_uuid, reftime, 2 * n AS turns,
  split_part(split_part(transcript, chr(10), 2), 'BOT: ', 2) AS first_line FROM ({TRANSCRIPTS})
""")
def _(spark, sf):
    whole = calls.assemble_calls(derive(spark, sf, TURNS))
    first = F.get(F.col("turns"), 0)["utterance"]
    return whole.select(
        "call_id", "call_uuid", "reftime", F.size("turns").cast("bigint").alias("turns"),
        F.split_part(first, F.lit("\n"), F.lit(1)).alias("first_line"),
    )


@query("render_transcript", f"SELECT call_id, transcript FROM ({TRANSCRIPTS})")
def _(spark, sf):
    whole = calls.assemble_calls(derive(spark, sf, TURNS))
    return calls.render_transcript(whole).select("call_id", "transcript")


@query("call_transcripts", f"""
SELECT call_id, {redacted_sql('transcript')} AS transcript FROM ({TRANSCRIPTS})
""")
def _(spark, sf):
    whole = calls.render_transcript(calls.assemble_calls(derive(spark, sf, TURNS)))
    return whole.select("call_id", text.redact_numbers(F.col("transcript")).alias("transcript"))


# Written in order, with calls that go on from file to file, and read again.
@query("call_lines", f"""
SELECT call_id, conversation_id AS id, FALSE AS is_user, bot AS utterance, 'BOT: ' || bot AS line FROM ({CLEANED})
UNION ALL SELECT call_id, conversation_id, TRUE, person, 'USER: ' || person FROM ({CLEANED})
""")
def _(spark, sf):
    path = writers.write_call_lines(calls.call_lines(derive(spark, sf, TURNS)), scratch_path(spark, "lines"))
    return spark.read.parquet(path).withColumn("line", calls.transcript_line())


@query("call_heads", f"""
SELECT call_id, min(call_uuid) AS call_uuid, min(reftime) AS reftime, first(audio_url ORDER BY conversation_id) AS audio_url,
  2 * count(*) AS n_turns FROM ({TURNS}) GROUP BY call_id
""")
def _(spark, sf):
    heads = calls.call_heads(derive(spark, sf, TURNS))
    return heads.select("call_id", "call_uuid", "reftime", "audio_url", "n_turns")


@query("first_per_key", """
SELECT event_id, user_id, event_type, value FROM (SELECT *, row_number() OVER (
  PARTITION BY user_id ORDER BY ts, event_id) AS r FROM {events}) WHERE r = 1
""")
def _(spark, sf):
    first = calls.first_per_key(table(spark, sf, "events"), "user_id", ["ts", "event_id"])
    return first.select("event_id", "user_id", "event_type", "value")


@query("sample_calls", """
SELECT conv_id, turn, role FROM {conversations} WHERE conv_id IN (SELECT conv_id FROM (
  SELECT DISTINCT conv_id FROM {conversations}) ORDER BY md5(CAST(conv_id AS VARCHAR) || '|7'), conv_id LIMIT 25)
""")
def _(spark, sf):
    turns = table(spark, sf, "conversations")
    return calls.sample_calls(turns, 20, 5, seed=7, call="conv_id").select("conv_id", "turn", "role")


@query("limit_seeded", """
SELECT event_id, event_type, value FROM {events} ORDER BY md5(CAST(event_id AS VARCHAR) || '|0.5'), event_id LIMIT 500
""")
def _(spark, sf):
    rows = calls.limit_seeded(table(spark, sf, "events"), "event_id", 500)
    return rows.select("event_id", "event_type", "value")


@query("count_breaches", """
SELECT count(*) AS breaches FROM {events} WHERE event_type = 'error' AND value > 5
""")
def _(spark, sf):
    rows = table(spark, sf, "events")
    judged = rows.withColumn(
        "is_breach", F.when(F.col("value") > 5, F.col("event_type") == "error")
    )
    return calls.count_breaches(judged)
