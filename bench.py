"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set data and cores;
BENCH_QUERIES names other queries (comma-separated, or "all").
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from registry import QUERIES
from turnwise.session import local_session

HEADLINES = [
    # calls and transcripts
    "assemble_calls", "render_transcript", "call_transcripts", "first_per_key", "sample_calls",
    "limit_seeded",
    # text and JSON
    "strip_transcript_marks", "redact_numbers", "first_tag", "build_utterances",
    "unpack_annotation", "unpack_prediction", "normalize_predicted_entities",
    # filters, projections, joins
    "filter_calls_orders", "alias_labels_table", "validate_rows", "overlay_predictions",
    "join_annotations_context", "semi_join_orders", "attach_results",
    # reports
    "classification_report_lines", "confusion_matrix", "compare_classification_reports",
    "asr_report",
    # data sets and dimensions
    "split_train_test", "split_train_test_stratified", "combine_train_test", "vocabulary",
    "allocate_ids_lineitem", "get_or_create", "record_generated", "invalidate_table",
    # sources, sinks, services
    "read_csv_union", "validated_append", "tagging_fanout", "run_inference", "entity_truth",
    # jobs
    "sample_calls_job", "tag_turns_job", "label_store_job", "entity_dataset_job",
    "compliance_job", "train_test_job", "intent_eval_job", "asr_eval_job",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if asked == "all" else asked.split(",") if asked else HEADLINES
    spark = local_session("bench", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    # Start-up of the session and of the Python workers is not part of any query.
    spark.range(8).mapInPandas(lambda batches: batches, "id bigint").count()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    line = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
