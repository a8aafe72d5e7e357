"""Filters and projections."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from registry.base import TURNS, derive, query, table
from registry.jsons import CONTEXT, DATA
from turnwise.functions import jsons
from turnwise.operators import columns, filters


@query("date_window", """
SELECT event_id, event_type FROM {events}
WHERE ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-20 23:59:59'
""")
def _(spark, sf):
    rows = filters.date_window(
        table(spark, sf, "events"), "ts", start=datetime(2024, 1, 10), end=datetime(2024, 1, 20)
    )
    return rows.select("event_id", "event_type")


@query("date_window_offsets", """
SELECT event_id, event_type FROM {events}
WHERE ts BETWEEN TIMESTAMP '2024-01-22 06:00:00' AND TIMESTAMP '2024-01-24 22:59:59.999999'
""")
def _(spark, sf):
    rows = filters.date_window(
        table(spark, sf, "events"), "ts", today=date(2024, 1, 25),
        start_days=-3, start_hours=6, end_days=-1, end_hours=-1,
    )
    return rows.select("event_id", "event_type")


FILTERED = """
language = 'en-US' AND org_id IN (2, 5) AND call_type IN ('inbound', 'outbound')
  AND coalesce(caller NOT IN ('+15551', '+15552'), TRUE) AND asr_provider = 'asr-b' AND use_case = 'collect'
  AND call_duration >= 20 AND state IN ('S0', 'S1', 'S2')
"""


@query("filter_calls", f"""
SELECT conversation_uuid, call_type, caller, call_duration FROM ({TURNS}) WHERE {FILTERED}
""")
def _(spark, sf):
    kept = filters.filter_calls(
        derive(spark, sf, TURNS), lang="en-US", org_ids=[2, 5], asr_provider="asr-b",
        ignore_callers=["+15551", "+15552"], use_case="collect", min_duration=20.0,
        states=["S0", "S1", "S2"],
    )
    return kept.select("conversation_uuid", "call_type", "caller", "call_duration")


@query("filter_calls_orders", """
SELECT o_orderkey, o_orderstatus FROM {orders}
WHERE o_orderstatus IN ('F', 'O') AND o_totalprice >= 100000 AND o_orderpriority = '1-URGENT'
""")
def _(spark, sf):
    orders = table(spark, sf, "orders").withColumnsRenamed(
        {"o_orderstatus": "call_type", "o_totalprice": "call_duration", "o_orderpriority": "flow_name"}
    )
    kept = filters.filter_calls(
        orders, call_type=["F", "O"], min_duration=100000.0, flow_name="1-URGENT"
    )
    return kept.select("o_orderkey", F.col("call_type").alias("o_orderstatus"))


LABELLED = """
SELECT event_id, CASE WHEN event_id % 10 = 0 THEN CAST(NULL AS STRING) ELSE event_type END AS tag FROM {events}
"""


@query("drop_labels", f"""
SELECT event_id, tag FROM ({LABELLED}) WHERE tag IS NULL OR tag NOT IN ('error', 'view')
""")
def _(spark, sf):
    return filters.drop_labels(derive(spark, sf, LABELLED), ["error", "view"])


# More labels than a literal list should hold: the list becomes a joined table.
NAMED = """
SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN CAST(NULL AS STRING) ELSE p_brand || '/' || CAST(p_size AS STRING) END AS tag
FROM {part}
"""


@query("drop_labels_long_list", f"""
SELECT p_partkey, tag FROM ({NAMED})
WHERE tag IS NULL OR NOT (split_part(tag, '#', 2) IN ('1/1') OR (
  CAST(split_part(split_part(tag, '#', 2), '/', 1) AS INTEGER) BETWEEN 1 AND 20
  AND CAST(split_part(tag, '/', 2) AS INTEGER) BETWEEN 1 AND 20))
""")
def _(spark, sf):
    listed = [f"Brand#{b}/{s}" for b in range(1, 21) for s in range(1, 21)]
    return filters.drop_labels(derive(spark, sf, NAMED), listed)


@query("require_present", f"""
SELECT conversation_uuid FROM ({TURNS}) WHERE utterances IS NOT NULL AND context IS NOT NULL
  AND client_uuid IS NOT NULL
""")
def _(spark, sf):
    turns = derive(spark, sf, TURNS)
    kept = filters.require_present(turns, ["utterances", "context", "client_uuid"])
    return kept.select("conversation_uuid")


RECORDS = """
SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'soon' WHEN 1 THEN '2023-13-01' WHEN 2 THEN CAST(NULL AS STRING)
    ELSE substr(CAST(ts AS STRING), 1, 10) END AS start_date,
  CASE event_id % 4 WHEN 0 THEN 'xx' WHEN 1 THEN 'en-US' WHEN 2 THEN 'hi' ELSE CAST(NULL AS STRING) END AS lang,
  CASE event_id % 3 WHEN 0 THEN 'Live' ELSE event_type END AS data_label,
  event_type AS job, CASE WHEN event_id % 5 < 2 THEN 'repo' END AS repo_name,
  CASE WHEN event_id % 7 < 2 THEN '1' END AS turn_project, CASE WHEN event_id % 11 < 3 THEN '2' END AS call_project
FROM {events}
"""


@query("validate_rows", f"""
SELECT event_id, concat_ws('; ',
  CASE WHEN TRY_CAST(start_date AS DATE) IS NULL AND start_date IS NOT NULL
    THEN 'start_date is not a yyyy-MM-dd date: ' || start_date END,
  CASE WHEN date_diff('day', TRY_CAST(start_date AS DATE), DATE '2024-10-15') > 270
    THEN 'start_date is older than 270 days: ' || start_date END,
  CASE WHEN lang NOT IN ('en-US', 'en', 'hi', 'ta', 'te', 'ma', 'gu', 'mr') THEN 'lang is not supported: ' || lang END,
  CASE WHEN data_label NOT IN ('Live', 'view', 'click') THEN 'data_label is not supported: ' || data_label END,
  CASE WHEN job = 'error' AND repo_name IS NULL THEN 'error needs repo_name' END,
  CASE WHEN job = 'view' AND turn_project IS NULL AND call_project IS NULL
    THEN 'view needs turn_project or call_project' END) AS errors
FROM ({RECORDS})
""")
def _(spark, sf):
    checked = filters.validate_rows(
        derive(spark, sf, RECORDS), date(2024, 10, 15), data_labels=["Live", "view", "click"],
        required={"error": [["repo_name"]], "view": [["turn_project", "call_project"]]},
    )
    return checked.select("event_id", F.array_join("errors", "; ").alias("errors"))


MARKS = """
SELECT item_id, CASE item_id % 4 WHEN 0 THEN '<SIL> ' WHEN 1 THEN 'a<UNK> ' ELSE '' END || text AS line FROM {benchmark}
"""


@query("drop_marked_lines", f"""
SELECT item_id, line FROM ({MARKS}) WHERE line NOT LIKE '%<SIL>%' AND line NOT LIKE '%<UNK>%'
""")
def _(spark, sf):
    return filters.drop_marked_lines(derive(spark, sf, MARKS), "line")


@query("filter_turns_by_intent", f"""
SELECT conversation_uuid, intent FROM ({TURNS}) WHERE intent IN ('_confirm_', '_cancel_')
""")
def _(spark, sf):
    turns = derive(spark, sf, TURNS)
    kept = filters.filter_turns_by_intent(turns, ["_confirm_", "_cancel_"])
    return kept.select("conversation_uuid", "intent")


ALIAS = {"act": ["click", "view"], "view": ["error"], "late": ["click"]}
ALIASED = "CASE tag WHEN 'click' THEN 'late' WHEN 'view' THEN 'act' WHEN 'error' THEN 'view' ELSE tag END"


@query("alias_labels", f"SELECT event_id, {ALIASED} AS tag FROM ({LABELLED})")
def _(spark, sf):
    return columns.alias_labels(derive(spark, sf, LABELLED), ALIAS)


# The mapping is a table that grows with the data: one row per part.
@query("alias_labels_table", """
SELECT l_orderkey, l_linenumber, l_quantity, coalesce(p_name || ' ' || p_brand, label) AS label FROM (
  SELECT l_orderkey, l_linenumber, l_quantity, 'part-' || CAST(l_partkey AS VARCHAR) AS label FROM {lineitem}) l
LEFT JOIN (SELECT 'part-' || CAST(p_partkey AS VARCHAR) AS source, p_name, p_brand FROM {part}
  WHERE p_size > 10) ON label = source
""")
def _(spark, sf):
    key = lambda c: F.concat(F.lit("part-"), F.col(c).cast("string"))
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", key("l_partkey").alias("label")
    )
    mapping = table(spark, sf, "part").where("p_size > 10").select(
        key("p_partkey").alias("source"), F.concat_ws(" ", "p_name", "p_brand").alias("target")
    )
    return columns.alias_labels(lines, mapping, "label")


@query("ensure_intent", """
SELECT event_id, event_type AS intent, '' AS empty_intent FROM {events}
""")
def _(spark, sf):
    rows = table(spark, sf, "events")
    renamed = columns.ensure_intent(
        rows.select("event_id", F.col("event_type").alias("raw.intent"))
    )
    with_both = renamed.withColumnRenamed("intent", "kept")
    return columns.ensure_intent(with_both).select(
        "event_id", F.col("kept").alias("intent"), F.col("intent").alias("empty_intent")
    )


@query("ensure_id", "SELECT event_id AS id, event_id AS data_id FROM {events}")
def _(spark, sf):
    rows = table(spark, sf, "events")
    return columns.ensure_id(rows.select(F.col("event_id").alias("data_id")))


@query("ensure_utterances", f"""
SELECT event_id, 'x' AS a, CASE event_id % 7 WHEN 0 THEN '[[{{"transcript":"' || event_type || '"}}]]'
  WHEN 1 THEN '[1,' || CAST(user_id AS VARCHAR) || ']' WHEN 2 THEN event_type
  WHEN 3 THEN '[["' || event_type || '"]]' END AS utterances
FROM (SELECT d.event_id, d.data, e.event_type, e.user_id FROM ({DATA}) d JOIN {{events}} e USING (event_id))
WHERE data IS NOT NULL
""")
def _(spark, sf):
    rows = columns.ensure_utterances(derive(spark, sf, DATA)).withColumn("a", F.lit("x"))
    return rows.select("event_id", "a", "utterances")


@query("call_level_view", f"""
SELECT call_uuid, call_type, 'en-US' AS language, flow_id, client_uuid, substr(reftime, 1, 10) AS date,
  'https://s.example.com/clients/' || client_uuid || '/voice-agents/' || flow_uuid || '/calls/' || call_uuid AS call_link,
  call_duration
FROM (SELECT *, row_number() OVER (PARTITION BY call_uuid ORDER BY reftime, call_duration) AS r FROM ({TURNS}))
WHERE r = 1
""")
def _(spark, sf):
    view = columns.call_level_view(derive(spark, sf, TURNS), "https://s.example.com", "en-US")
    return view.select(
        "call_uuid", "call_type", "language", "flow_id", "client_uuid", "date", "call_link",
        "call_duration",
    )


@query("with_defaults", f"""
SELECT conversation_uuid, coalesce(caller, 'N/A') AS caller, 0 AS tokens FROM ({TURNS})
""")
def _(spark, sf):
    turns = derive(spark, sf, TURNS).select("conversation_uuid", "caller")
    return columns.with_defaults(turns, {"caller": "N/A", "tokens": 0})


PAIRS = """
SELECT event_id, event_type AS a, CASE event_id % 4 WHEN 0 THEN ' ' || event_type || ' ' WHEN 1 THEN event_type
  WHEN 2 THEN CAST(NULL AS STRING) ELSE 'click' END AS b FROM {events}
"""


@query("agreement_flag", f"""
SELECT event_id, CASE WHEN a = trim(b) THEN 'yes' ELSE 'no' END AS agree FROM ({PAIRS})
""")
def _(spark, sf):
    rows = columns.agreement_flag(derive(spark, sf, PAIRS), "a", "b", "agree")
    return rows.select("event_id", "agree")


@query("fill_urls", f"""
SELECT event_id, 'https://audio.example.com/' || audio_base_path || '/' || call_uuid || '/' || audio_path AS audio_url,
  coalesce(nullif(call_url, ''), 'https://cdn.example.com/' || call_url_id || '.wav') AS call_url
FROM ({CONTEXT})
""")
def _(spark, sf):
    rows = columns.fill_urls(
        derive(spark, sf, CONTEXT), "https://audio.example.com", "https://cdn.example.com"
    )
    return rows.select("event_id", "audio_url", "call_url")


@query("serialize_nested", """
SELECT o_orderkey, '[' || CAST(o_custkey AS VARCHAR) || ',' || CAST(o_orderkey AS VARCHAR) || ']' AS listed,
  '{"status":"' || o_orderstatus || '","keys":[' || CAST(o_orderkey AS VARCHAR) || ']}' AS nested
FROM {orders}
""")
def _(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        F.array("o_custkey", "o_orderkey").alias("listed"),
        F.struct(F.col("o_orderstatus").alias("status"), F.array("o_orderkey").alias("keys")).alias(
            "nested"
        ),
    )
    return columns.serialize_nested(rows)
