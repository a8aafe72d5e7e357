"""Physical plans that must not change unnoticed."""

from datetime import datetime

from pyspark.sql import functions as F

from registry.base import TURNS, derive
from registry.jobs import audit_service
from turnwise.functions import text
from turnwise.operators import calls, datasets, evaluation, filters
from turnwise.plans import jobs

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_window_and_columns_reach_the_scan(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    text = plan(filters.date_window(events, "ts", start=datetime(2024, 1, 10), end=datetime(2024, 1, 20)).select("event_id"))
    assert "GreaterThanOrEqual(ts" in text and "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_first_row_is_limited_before_the_shuffle(spark):
    text = plan(calls.first_per_key(spark.read.parquet(f"{SF}/events.parquet"), "user_id", ["ts"]))
    assert "WindowGroupLimit" in text and text.count("Exchange hashpartitioning") == 1


def test_samples_are_a_filter(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    for sample in (calls.sample_calls(turns, 5, call="conv_id"), calls.limit_seeded(turns.dropDuplicates(["conv_id"]), "conv_id", 5)):
        text = plan(sample)
        assert "TakeOrderedAndProject" not in text and "Subquery" not in text and "Join" not in text
    assert "Exchange" not in plan(calls.sample_calls(turns, 5, call="conv_id"))


def test_split_does_not_shuffle_the_rows(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    whole = plan(datasets.split_train_test(events, "event_id", 85))
    assert "Exchange" not in whole and "Subquery" not in whole
    strata = plan(datasets.split_train_test(events, "event_id", 85, "event_type"))
    assert "SortMergeJoin" not in strata and "Exchange hashpartitioning" not in strata and strata.count("Scan parquet") == 2


def test_counts_are_combined_before_the_shuffle(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    text = plan(evaluation.confusion_matrix(lines, "l_returnflag", "l_linestatus"))
    assert text.count("HashAggregate") == 2 and "partial_count" in text


def test_no_cross_joins_and_no_python_in_plain_operators(spark):
    from registry import QUERIES

    python = {"run_inference", "entity_values", "entity_truth", "asr_operations", "asr_breakdown", "asr_report"}
    for name, query in QUERIES.items():
        if name.endswith("_job") or "_job_" in name or name.startswith(("get_or", "read_", "write_", "validated")):
            continue
        text = plan(query(spark, SF))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        assert name in python or "InPandas" not in text, name


def test_calls_are_assembled_without_a_join(spark):
    turns = spark.range(10).select(
        (F.col("id") % 2).alias("call_id"), F.col("id").alias("conversation_id"),
        F.lit("x").alias("bot_response"), F.lit("y").alias("primary_utterance"),
    )
    assert "Join" not in plan(calls.assemble_calls(turns))


def test_failed_requests_are_an_output_of_the_audit(spark):
    turns = derive(spark, SF, TURNS)
    service = audit_service()
    accepted, rejected, _, failed = jobs.compliance_job(turns, service)
    whole = calls.render_transcript(calls.assemble_calls(turns), "info").select(
        "call_id", F.length(text.redact_numbers(F.col("info"))).alias("n")
    ).collect()
    rows = failed.collect()
    assert sorted(r.call_id for r in rows) == sorted(r.call_id for r in whole if r.n % 9 == 0) != []
    assert {r.error for r in rows} == {"no answer"}
    # Every call with a verdict or an error is in one of the outputs.
    told = sum(r.n % 9 == 0 or r.n % 3 < 2 for r in whole)
    assert accepted.count() + rejected.count() + len(rows) == told
