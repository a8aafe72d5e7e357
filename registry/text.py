"""String, date and number functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import MOMENTS, RECORDINGS, TURNS, derive, query, table
from turnwise.functions import text, times
from turnwise.operators.dimensions import situation_rows

BLANKS = text.WHITESPACE
NOW = 1_650_000_000
BUCKET = "example.com"
ZONE = "Asia/Kolkata"

MARKED = """
SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN NULL ELSE '<speak>' || text || ' (<b>' || lang
  || '</b>) <noise ' || source || '></speak>' || chr(160) END AS marked FROM {documents}
"""


@query("strip_transcript_marks", f"""
SELECT page_id, trim(regexp_replace(html, '<[^)]*?>', '', 'g'), '{BLANKS}') AS clean FROM {{pages}}
""")
def _(spark, sf):
    pages = table(spark, sf, "pages")
    return pages.select("page_id", text.strip_transcript_marks(F.col("html")).alias("clean"))


@query("strip_transcript_marks_documents", f"""
SELECT doc_id, coalesce(trim(regexp_replace(marked, '<[^)]*?>', '', 'g'), '{BLANKS}'), '') AS clean
FROM ({MARKED})
""")
def _(spark, sf):
    rows = derive(spark, sf, MARKED)
    return rows.select("doc_id", text.strip_transcript_marks(F.col("marked")).alias("clean"))


@query("clean_utterance", f"""
SELECT doc_id, coalesce(trim(regexp_replace(marked, '<[^<]+?>', '', 'g'), '{BLANKS}'), 'NA') AS clean
FROM ({MARKED})
""")
def _(spark, sf):
    rows = derive(spark, sf, MARKED)
    return rows.select("doc_id", text.clean_utterance(F.col("marked")).alias("clean"))


@query("audio_filename", rf"""
SELECT page_id, regexp_replace(split_part(split_part(audio_url, '?', 1), '/', -1),
  '\.(flac|mp3)$', '.wav') AS filename FROM ({RECORDINGS})
""")
def _(spark, sf):
    rows = derive(spark, sf, RECORDINGS)
    return rows.select("page_id", text.audio_filename(F.col("audio_url")).alias("filename"))


@query("audio_stem_wav", f"""
SELECT page_id, split_part(split_part(audio_url, '/', -1), '.', 1) || '.wav' AS stem
FROM ({RECORDINGS})
""")
def _(spark, sf):
    rows = derive(spark, sf, RECORDINGS)
    return rows.select("page_id", text.audio_stem_wav(F.col("audio_url")).alias("stem"))


@query("url_expiry", f"""
SELECT page_id, coalesce(TRY_CAST(regexp_extract(audio_url, '[?&]Expires=([^&#]+)', 1) AS BIGINT), -1)
  AS expires FROM ({RECORDINGS})
""")
def _(spark, sf):
    rows = derive(spark, sf, RECORDINGS)
    expires = F.coalesce(text.url_expiry(F.col("audio_url")), F.lit(-1))
    return rows.select("page_id", expires.alias("expires"))


@query("expired_links", f"""
SELECT page_id, regexp_extract(audio_url, '^[a-z]+://[^/]*/+([^?]*)', 1) AS object_key
FROM ({RECORDINGS})
WHERE audio_url LIKE '%?%' AND audio_url LIKE '%Expires%' AND audio_url LIKE '%{BUCKET}%'
  AND TRY_CAST(regexp_extract(audio_url, '[?&]Expires=([^&#]+)', 1) AS BIGINT) <= {NOW}
""")
def _(spark, sf):
    rows = derive(spark, sf, RECORDINGS)
    expired = rows.where(text.is_expired(F.col("audio_url"), F.lit(NOW), BUCKET))
    return expired.select("page_id", text.url_object_key(F.col("audio_url")).alias("object_key"))


@query("call_link", """
SELECT o_orderkey, 'https://s.example.com/clients/' || CAST(o_custkey AS VARCHAR) || '/voice-agents/'
  || nullif(o_orderpriority, '5-LOW') || '/calls/' || CAST(o_orderkey AS VARCHAR) AS link
FROM {orders}
""")
def _(spark, sf):
    link = text.call_link(
        "https://s.example.com",
        F.col("o_custkey").cast("string"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")),
        F.col("o_orderkey").cast("string"),
    )
    return table(spark, sf, "orders").select("o_orderkey", link.alias("link"))


PHONE_SQL = text.PHONE.replace("'", "''")


def redacted_sql(column: str) -> str:
    held = f"regexp_replace({column}, '{PHONE_SQL}', chr(64976), 'g')"
    masked = f"regexp_replace({held}, '\\p{{Nd}}{{4}}', '1111', 'g')"
    return f"replace({masked}, chr(64976), '5555555555')"


@query("redact_numbers", f"""
SELECT doc_id, {redacted_sql('text')} AS redacted FROM {{documents}}
""")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", text.redact_numbers(F.col("text")).alias("redacted"))


@query("redact_numbers_turns", f"""
SELECT conversation_uuid, {redacted_sql('bot_response')} AS redacted FROM ({TURNS})
""")
def _(spark, sf):
    turns = derive(spark, sf, TURNS)
    return turns.select(
        "conversation_uuid", text.redact_numbers(F.col("bot_response")).alias("redacted")
    )


LISTS = """
SELECT p_partkey, p_name || ', ,' || p_brand || ' , ' || CAST(p_size AS STRING) || ',' AS listed,
  CAST(p_size AS STRING) || '; ' || CAST(p_partkey AS STRING) || ';;x ' AS numbers FROM {part}
"""


@query("split_list", f"""
SELECT p_partkey, array_to_string(list_filter(list_transform(string_split(listed, ','),
    lambda s: trim(s)), lambda s: s <> ''), '|') AS items,
  CAST(list_sum(list_transform(string_split(numbers, ';'), lambda s: TRY_CAST(trim(s) AS INTEGER)))
    AS BIGINT) AS total
FROM ({LISTS})
""")
def _(spark, sf):
    rows = derive(spark, sf, LISTS)
    numbers = F.filter(text.split_list(F.col("numbers"), ";", "int"), lambda n: n.isNotNull())
    total = F.aggregate(numbers, F.lit(0).cast("bigint"), lambda a, n: a + n)
    return rows.select(
        "p_partkey",
        F.array_join(text.split_list(F.col("listed")), "|").alias("items"),
        total.alias("total"),
    )


SITUATIONS = """
SELECT p_partkey, p_name || ' :: ' || upper(p_type) || '::' || p_brand AS situations,
  p_brand AS scenario, p_type AS scenario_category FROM {part}
"""


@query("normalize_situations", f"""
SELECT p_partkey, lower(trim(unnest(string_split(situations, '::')))) AS situation,
  lower(scenario) AS scenario, upper(scenario_category) AS scenario_category FROM ({SITUATIONS})
""")
def _(spark, sf):
    rows = derive(spark, sf, SITUATIONS)
    return situation_rows(rows, "situations", "scenario", "scenario_category")


TEMPLATE = "State {{state}}:\n{{conversation_context}}\nAnswer:"


@query("fill_prompt", """
SELECT conv_id, turn, 'State S' || CAST(turn AS VARCHAR) || ':' || chr(10) || '[Bot]: ' || role
  || '  ' || chr(10) || ' [User]: ' || text || chr(10) || 'Answer:' AS prompt
FROM {conversations}
""")
def _(spark, sf):
    state = F.concat(F.lit("S"), F.col("turn").cast("string"))
    prompt = text.fill_prompt(TEMPLATE, F.col("role"), F.col("text"), state)
    return table(spark, sf, "conversations").select("conv_id", "turn", prompt.alias("prompt"))


ENTITIES = """
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'date' WHEN 1 THEN 'number/' || CAST(p_size AS STRING)
  WHEN 2 THEN lower(p_type) ELSE 'datetime' END AS kind, '~' || p_name || '~ ' || p_brand AS tagged
FROM {part}
"""


@query("entity_type_value", f"""
SELECT p_partkey, split_part(kind, '/', 1) AS type,
  CASE WHEN kind IN ('date', 'time', 'datetime') THEN NULL
    WHEN kind LIKE '%/%' THEN split_part(kind, '/', 2) ELSE replace(tagged, '~', '') END AS value,
  replace(tagged, '~', '') AS text
FROM ({ENTITIES})
""")
def _(spark, sf):
    rows = derive(spark, sf, ENTITIES)
    entity = text.entity_type_value(F.col("kind"), F.col("tagged"))
    return rows.select("p_partkey", entity.alias("e")).select("p_partkey", "e.*")


ADDRESSES = """
SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN p_name ELSE 's3://' || p_brand || '/' || p_type
  || '/' || p_name || '.csv' END AS address FROM {part}
"""


@query("split_uri", f"""
SELECT p_partkey, CASE WHEN address LIKE 's3://%/%' THEN split_part(address, '/', 3) END AS bucket,
  CASE WHEN address LIKE 's3://%/%' THEN split_part(address, '/', 4) || '/' || split_part(address, '/', 5)
  END AS key FROM ({ADDRESSES})
""")
def _(spark, sf):
    rows = derive(spark, sf, ADDRESSES)
    return rows.select("p_partkey", text.split_uri(F.col("address")).alias("a")).select(
        "p_partkey", "a.*"
    )


@query("local_day", f"""
SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM ({MOMENTS})
""")
def _(spark, sf):
    rows = derive(spark, sf, MOMENTS)
    return rows.select("event_id", times.local_day(F.col("reftime")).alias("day"))


# The zone is five and a half hours ahead of UTC all year.
REF_MS = "CAST(epoch_ms(date_trunc('second', ts)) - 19800000 AS BIGINT)"


@query("ref_epoch_ms", f"SELECT event_id, {REF_MS} AS ref_ms FROM ({MOMENTS})")
def _(spark, sf):
    rows = derive(spark, sf, MOMENTS)
    return rows.select("event_id", times.ref_epoch_ms(F.col("reftime"), ZONE).alias("ref_ms"))


@query("duration_end", f"""
SELECT event_id, strftime(date_trunc('second', ts) + to_seconds(seconds), '%Y-%m-%dT%H:%M:%S')
  || '+05:30' AS ends FROM ({MOMENTS})
""")
def _(spark, sf):
    rows = derive(spark, sf, MOMENTS)
    ends = times.duration_end(times.ref_epoch_ms(F.col("reftime"), ZONE), F.col("seconds"), ZONE)
    return rows.select("event_id", ends.alias("ends"))


@query("entity_locale", f"""
SELECT event_id, CASE WHEN language LIKE '%US%' THEN 'en_US' WHEN language LIKE 'en%' THEN 'en_IN'
  ELSE language END AS home, CASE WHEN language IS NOT NULL THEN 'en_US' END AS abroad
FROM ({MOMENTS})
""")
def _(spark, sf):
    rows = derive(spark, sf, MOMENTS)
    return rows.select(
        "event_id",
        times.entity_locale(F.col("language"), ZONE).alias("home"),
        times.entity_locale(F.col("language"), "America/New_York").alias("abroad"),
    )


@query("sequence_probability", """
SELECT vec_id, round(exp(list_sum(list_transform(embedding[1:len(embedding) - 3],
  lambda x: CAST(x AS DOUBLE)))), 6) AS probability FROM {embeddings}
""")
def _(spark, sf):
    rows = table(spark, sf, "embeddings")
    p = times.sequence_probability(F.col("embedding"))
    return rows.select("vec_id", F.round(p, 6).alias("probability"))
