"""Training and test sets, word lists, snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.base import TAGS, derive, query, table
from registry.jsons import FIRST_TAG
from turnwise.operators import datasets
from turnwise.session import scratch_path
from turnwise.sources import readers


@query("merge_tagged_sources", f"""
SELECT event_id, label AS tag, CASE WHEN event_id % 2 = 0 THEN event_id END AS extra FROM ({FIRST_TAG})
""")
def _(spark, sf):
    rows = derive(spark, sf, TAGS).select("event_id", "tag")
    annotated = rows.where("event_id % 2 = 0").withColumn("extra", F.col("event_id"))
    merged = datasets.merge_tagged_sources(annotated, rows.where("event_id % 2 = 1"))
    return merged.select("event_id", "tag", "extra")


def split_sql(rows: str, key: str, percent: int, strata: str | None, seed: str) -> str:
    """Exact split by rank in hash order, over the whole table."""
    part = f"PARTITION BY {strata}" if strata else ""
    return f"""SELECT *, CASE WHEN r <= n * {percent} // 100 THEN 'train' ELSE 'test' END AS split FROM (
  SELECT *, row_number() OVER ({part} ORDER BY md5(CAST({key} AS VARCHAR) || '|{seed}'), {key}) AS r,
  count(*) OVER ({part}) AS n FROM {rows})"""


@query("split_train_test", f"""
SELECT event_id, event_type, split FROM ({split_sql('{events}', 'event_id', 85, None, '3')})
""")
def _(spark, sf):
    parts = datasets.split_train_test(table(spark, sf, "events"), "event_id", 85, seed=3)
    return parts.select("event_id", "event_type", "split")


HOT = """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'hot' WHEN event_id % 101 = 1 THEN CAST(NULL AS STRING)
  ELSE event_type || CAST(user_id % 4 AS STRING) END AS tag FROM {events}
"""


@query("split_train_test_stratified", f"""
SELECT event_id, tag, split FROM ({split_sql(f'({HOT})', 'event_id', 70, 'tag', '0')})
""")
def _(spark, sf):
    parts = datasets.split_train_test(derive(spark, sf, HOT), "event_id", 70, "tag")
    return parts.select("event_id", "tag", "split")


@query("split_by_bucket", """
SELECT o_orderkey, CASE WHEN CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|0'), 1, 8) AS BIGINT) % 10000 < 8500
  THEN 'train' ELSE 'test' END AS split FROM {orders}
""")
def _(spark, sf):
    parts = datasets.split_by_bucket(table(spark, sf, "orders"), "o_orderkey", 85)
    return parts.select("o_orderkey", "split")


OLD, NEW = "event_id % 2 = 0", "event_id % 2 = 1"
NEW_SPLIT = split_sql(f"(SELECT * FROM {{events}} WHERE {NEW})", "event_id", 85, "event_type", "0")


def both(train, test):
    side = lambda df, name: df.select("event_id", "event_type", F.lit(name).alias("side"))
    return side(train, "train").unionByName(side(test, "test"))


@query("combine_train_test", f"""
SELECT event_id, event_type, split AS side FROM ({NEW_SPLIT})
UNION ALL SELECT event_id, event_type, CASE WHEN value < 10 THEN 'train' ELSE 'test' END FROM {{events}} WHERE {OLD}
""")
def _(spark, sf):
    events = table(spark, sf, "events")
    old = events.where(OLD)
    return both(*datasets.combine_train_test(
        events.where(NEW), "event_id", old.where("value < 10"), old.where("value >= 10"),
        train_percent=85, stratify="event_type",
    ))


@query("combine_train_test_held_out", f"""
SELECT event_id, event_type, 'train' AS side FROM {{events}} WHERE {NEW} OR value < 10
UNION ALL SELECT event_id, event_type, 'test' FROM {{events}} WHERE event_type = 'view'
""")
def _(spark, sf):
    events = table(spark, sf, "events")
    old = events.where(OLD)
    return both(*datasets.combine_train_test(
        events.where(NEW), "event_id", old.where("value < 10"), old.where("value >= 10"),
        custom_test=events.where("event_type = 'view'"), train_percent=50,
    ))


@query("latest_snapshot", """
SELECT o_orderkey, o_custkey, o_totalprice FROM {orders}
WHERE o_orderdate = (SELECT max(o_orderdate) FROM {orders})
  AND o_orderpriority = (SELECT max(o_orderpriority) FROM {orders} WHERE o_orderdate = (SELECT max(o_orderdate) FROM {orders}))
""")
def _(spark, sf):
    newest = datasets.latest_snapshot(table(spark, sf, "orders"), "o_orderdate", "o_orderpriority")
    return newest.select("o_orderkey", "o_custkey", "o_totalprice")


# The same rows by the names of folders: a run per priority in a folder per year and month.
@query("newest_run", """
WITH o AS (SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority AS run FROM {orders})
SELECT * FROM o WHERE month = (SELECT max(month) FROM o) AND run = (SELECT max(run) FROM o WHERE month = (SELECT max(month) FROM o))
""")
def _(spark, sf):
    path = scratch_path(spark, "runs")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.col("o_orderpriority").alias("run")
    )
    orders.write.partitionBy("month", "run").parquet(path)
    return readers.read_newest_run(spark, path)


WORDS = "unnest(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''))"


@query("vocabulary", f"""
SELECT word FROM (SELECT {WORDS} AS word FROM {{documents}} UNION SELECT p_name FROM {{part}})
WHERE word NOT IN (SELECT {WORDS} FROM {{benchmark}})
""")
def _(spark, sf):
    parts = table(spark, sf, "part").select(F.col("p_name").alias("word"))
    gone = datasets.vocabulary(table(spark, sf, "benchmark"), "text")
    return datasets.vocabulary(table(spark, sf, "documents"), "text", parts, gone)


@query("merge_lexicons", f"""
SELECT word, kind FROM (SELECT {WORDS} AS word, 'w' AS kind FROM {{benchmark}}
  UNION SELECT {WORDS}, 'w' FROM {{conversations}})
""")
def _(spark, sf):
    words = lambda name: datasets.vocabulary(table(spark, sf, name), "text").withColumn(
        "kind", F.lit("w")
    )
    return datasets.merge_lexicons(words("benchmark"), words("conversations"))
