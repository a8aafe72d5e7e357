"""Sources and sinks: what is written is read back and compared with the source table."""

from __future__ import annotations

from datetime import date, datetime
from urllib.parse import urlparse

from pyspark.sql import functions as F

from registry.base import TURNS, derive, query, table
from turnwise.operators import columns
from turnwise.session import scratch_path
from turnwise.sources import readers, writers

RUN = datetime(2024, 5, 6, 7, 8, 9)


@query("read_csv_union", """
SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderstatus AS status, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS priority
FROM {orders}
""")
def _(spark, sf):
    root = scratch_path(spark, "csv")
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
    )
    # The same columns in another order, and one of them missing.
    orders.where("status <> 'F'").select("priority", "key", "status").write.csv(f"{root}/a", header=True)
    orders.where("status = 'F'").select("status", "key").write.csv(f"{root}/b", header=True)
    return readers.read_csv_union(spark, f"{root}/a, {root}/b,").select("key", "status", "priority")


@query("read_csv_union_texts", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text FROM {documents}")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    path = writers.write_dataset(docs, scratch_path(spark, "texts"), "a,b", "tagged", RUN, "csv")
    return readers.read_csv_union(spark, path)


@query("read_csv_union_headers", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text FROM {documents}")
def _(spark, sf):
    # One folder with two orders of columns, and cells with line breaks.
    root = scratch_path(spark, "csv")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    whole = dict(header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    docs.where("doc_id % 2 = 0").write.csv(root, **whole)
    docs.where("doc_id % 2 = 1").select("text", "doc_id").write.mode("append").csv(root, **whole)
    return readers.read_csv_union(spark, root).select("doc_id", "text")


@query("read_text_documents", """
SELECT conv_id AS situation_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS content
FROM {conversations} WHERE conv_id % 3 <> 2 GROUP BY conv_id
""")
def _(spark, sf):
    root = scratch_path(spark, "files")
    write_files(conversation_files(spark, sf), root)
    return readers.read_text_documents(spark, root).select("situation_id", "content")


def conversation_files(spark, sf):
    """(name, value): one text per conversation; every third name has too few parts."""
    line = F.struct("turn", F.concat_ws(": ", "role", "text").alias("line"))
    rows = table(spark, sf, "conversations").groupBy("conv_id").agg(
        F.array_sort(F.collect_list(line)).alias("lines")
    )
    ending = F.when(F.col("conv_id") % 3 == 2, "_a_b.txt").otherwise("_a_b_c.txt")
    return rows.select(
        F.concat(F.col("conv_id").cast("string"), ending).alias("name"),
        F.array_join(F.col("lines.line"), "\n").alias("value"),
    )


def write_files(named, root: str) -> None:
    """One text file per row, written by the tasks; a task that runs again writes the same."""

    def save(batches):
        import pandas as pd
        from pyarrow import fs

        store, folder = fs.FileSystem.from_uri(root)
        store.create_dir(folder, recursive=True)
        for batch in batches:
            for name, value in zip(batch["name"], batch["value"]):
                with store.open_output_stream(f"{folder}/{name}") as out:
                    out.write(value.encode())
            yield pd.DataFrame({"n": [len(batch)]})

    named.mapInPandas(save, "n bigint").agg(F.sum("n")).collect()


@query("read_table", """
SELECT l_orderkey, l_linenumber, l_quantity FROM {lineitem}
WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00' AND l_returnflag = 'R'
""")
def _(spark, sf):
    return readers.read_table(
        spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_quantity"],
        (F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")) & (F.col("l_returnflag") == "R"),
    )


def write_shards(rows, root: str) -> None:
    """The rows as SQLite files ``orders``, one per task, in a folder that all tasks can open;
    a task that runs again replaces its file."""
    if not root.startswith(("file:", "/")):
        raise ValueError("SQLite files need a shared folder that is a path")
    folder = urlparse(root).path

    def save(batches):
        import os
        import sqlite3
        import uuid

        from pyspark import TaskContext

        os.makedirs(folder, exist_ok=True)
        made = f"{folder}/.{uuid.uuid4().hex}"
        con = sqlite3.connect(made)
        con.execute("CREATE TABLE orders (o_orderkey INTEGER PRIMARY KEY, o_orderstatus TEXT, o_totalprice REAL)")
        for batch in batches:
            con.executemany("INSERT INTO orders VALUES (?, ?, ?)", zip(*(c.to_pylist() for c in batch.columns)))
            yield batch
        con.commit()
        con.close()
        os.replace(made, f"{folder}/{TaskContext.get().partitionId()}.db")

    rows.mapInArrow(save, rows.schema).write.format("noop").mode("overwrite").save()


@query("read_table_sqlite", """
SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_orderkey >= 1000 AND o_orderkey < 9000 AND o_orderstatus <> 'F'
""")
def _(spark, sf):
    root = scratch_path(spark, "shards")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    write_shards(orders.repartition(4, "o_orderkey"), root)
    key = F.col("o_orderkey")
    return readers.read_table(
        spark, "orders", ["o_orderkey", "o_totalprice"],
        (key >= 1000) & (key < 9000) & (F.col("o_orderstatus") != "F"),
        sqlite={"path": root, "key": "o_orderkey", "partitions": "4"},
    )


@query("read_annotation_jobs", """
SELECT o_orderkey, o_orderpriority FROM {orders} WHERE o_orderpriority IN ('1-URGENT', '5-LOW')
  AND o_orderdate >= TIMESTAMP '1997-01-01 00:00:00' AND o_orderdate <= TIMESTAMP '1998-12-31 00:00:00'
""")
def _(spark, sf):
    rows = readers.read_annotation_jobs(
        table(spark, sf, "orders"), "1-URGENT, 5-LOW", datetime(1997, 1, 1), datetime(1998, 12, 31),
        job="o_orderpriority", ts="o_orderdate",
    )
    return rows.select("o_orderkey", "o_orderpriority")


@query("read_annotation_jobs_offsets", """
SELECT event_id, event_type FROM {events} WHERE event_type IN ('view', 'error')
  AND ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '2024-01-14 23:59:59.999999'
""")
def _(spark, sf):
    rows = readers.read_annotation_jobs(
        table(spark, sf, "events"), ["view", "error"], datetime(2020, 1, 1), datetime(2020, 1, 2),
        start_days=-5, end_days=-1, today=date(2024, 1, 15), job="event_type", ts="ts",
    )
    return rows.select("event_id", "event_type")


@query("read_columns", f"""
SELECT call_uuid, reftime, call_type, language, call_end_status, disposition, previous_disposition,
  blocking_disposition, flow_id, flow_version, flow_name, call_duration, flow_uuid, client_uuid, template_id
FROM ({TURNS})
""")
def _(spark, sf):
    return columns.read_columns(derive(spark, sf, TURNS))


@query("write_dataset", """
SELECT o_orderkey, o_totalprice, 'project/11_12/2024-05-06/11_12-07-08-09-tagged' AS path FROM {orders}
""")
def _(spark, sf):
    root = scratch_path(spark, "dataset")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    path = writers.write_dataset(orders, root, "11,12", "tagged", RUN)
    return spark.read.parquet(path).withColumn("path", F.lit(path[len(root) + 1:]))


@query("write_text_lines", """
SELECT line, count(*) AS n FROM (SELECT CASE WHEN item_id % 4 = 0 THEN '' ELSE replace(text, chr(10), ' ') END AS line FROM {benchmark})
GROUP BY line
""")
def _(spark, sf):
    lines = table(spark, sf, "benchmark").select(
        F.when(F.col("item_id") % 4 != 0, F.replace("text", F.lit("\n"), F.lit(" "))).alias("line")
    )
    path = writers.write_text_lines(lines, "line", scratch_path(spark, "lines"))
    read = spark.read.text(path)
    return read.groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


ROWS = """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN CAST(NULL AS STRING) ELSE 'call-' || CAST(o_orderkey AS STRING) END AS call_uuid,
  repeat('u', CAST(o_orderkey % 600 AS INTEGER)) AS audio_url, 'c' AS call_url, 'f' AS flow_uuid, CAST(NULL AS STRING) AS client_uuid,
  CASE WHEN o_orderkey % 11 = 0 THEN 'someday' ELSE CAST(o_orderdate AS STRING) END AS reftime,
  CASE o_orderkey % 5 WHEN 0 THEN 'true' WHEN 1 THEN 'maybe' ELSE 'false' END AS is_breach,
  o_orderpriority AS compliance_output, CASE WHEN o_orderkey % 13 = 0 THEN '12x' ELSE CAST(o_custkey AS STRING) END AS tokens_consumed,
  CAST(NULL AS STRING) AS call_information
FROM {orders}
"""
ERRORS = f"""
SELECT *, concat_ws('; ', CASE WHEN call_uuid IS NULL THEN 'call_uuid is missing' END,
  CASE WHEN length(audio_url) > 511 THEN 'audio_url is longer than 511' END,
  CASE WHEN TRY_CAST(reftime AS TIMESTAMP) IS NULL THEN 'reftime is no timestamp' END,
  CASE WHEN is_breach = 'maybe' THEN 'is_breach is no boolean' END,
  CASE WHEN tokens_consumed = '12x' THEN 'tokens_consumed is no int' END) AS errors FROM ({ROWS})
"""


@query("validated_append", f"""
SELECT call_uuid, is_breach = 'true' AS is_breach, CAST(tokens_consumed AS INTEGER) AS tokens_consumed, length(audio_url) AS size
FROM ({ERRORS}) WHERE errors = ''
""")
def _(spark, sf):
    accepted, _ = writers.validated_append(derive(spark, sf, ROWS))
    path = scratch_path(spark, "breaches")
    accepted.write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    return stored.select(
        "call_uuid", "is_breach", "tokens_consumed", F.length("audio_url").cast("bigint").alias("size")
    )


@query("validated_append_rejected", f"SELECT o_orderkey, errors FROM ({ERRORS}) WHERE errors <> ''")
def _(spark, sf):
    _, rejected = writers.validated_append(derive(spark, sf, ROWS))
    return rejected.select("o_orderkey", F.array_join("errors", "; ").alias("errors"))


@query("append_batch", f"""
SELECT CAST(o_orderkey % 2 AS VARCHAR) AS batch, errors = '' AS accepted, count(*) AS rows FROM ({ERRORS}) GROUP BY ALL
""")
def _(spark, sf):
    root = scratch_path(spark, "batches")
    rows = derive(spark, sf, ROWS)
    for batch in ("0", "1", "0"):
        accepted, rejected = writers.append_batch(rows.where(F.col("o_orderkey") % 2 == int(batch)), root, batch)
    both = accepted.select("batch", F.lit(True).alias("accepted")).unionByName(
        rejected.select("batch", F.lit(False).alias("accepted"))
    )
    return both.groupBy("batch", "accepted").agg(F.count("*").alias("rows"))


@query("tagging_fanout", """
SELECT o_orderkey, 'Live' AS data_label, unnest(['11', '12', '13']) AS project_id FROM {orders}
""")
def _(spark, sf):
    tasks, _ = writers.tagging_fanout(table(spark, sf, "orders"), ["11", "12", "13"])
    return tasks.select("o_orderkey", "data_label", "project_id")


@query("tagging_fanout_counts", """
SELECT project_id, count(*) AS rows FROM {orders}, (SELECT unnest(['11', '12', '13']) AS project_id) GROUP BY project_id
""")
def _(spark, sf):
    _, counts = writers.tagging_fanout(table(spark, sf, "orders"), [11, 12, 13], "UAT")
    return counts
