"""Composed jobs. Each one is a lazy plan over the operators; nothing passes the driver."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnwise.functions import jsons, text, times
from turnwise.operators import (
    calls, columns, datasets, dimensions, evaluation, filters, inference, joins,
)
from turnwise.operators.answers import PerTask
from turnwise.session import answer_log, store
from turnwise.sources import readers, writers

# Fixed value: calls drawn beyond the wanted number, as some have no usable recording.
SAMPLE_BUFFER = 200


def sample_calls_job(
    turns: DataFrame,
    n: int,
    window: Mapping[str, object] | None = None,
    call_filters: Mapping[str, object] | None = None,
    intents: Sequence[str] | None = None,
    valid_files: DataFrame | None = None,
    buffer: int = SAMPLE_BUFFER,
    seed: object = 0,
) -> DataFrame:
    """Turns of randomly chosen calls that pass the date window and the call filters."""
    rows = filters.date_window(turns, "call_time", **(window or {})) if window else turns
    rows = filters.filter_calls(rows, **(call_filters or {}))
    rows = calls.sample_calls(rows, n, buffer, seed)
    rows = filters.filter_turns_by_intent(rows, intents)
    return joins.keep_with_valid_audio(rows, valid_files) if valid_files is not None else rows


def predict_intents(
    turns: DataFrame,
    template: str,
    infer_fn: Callable[[dict], dict] | PerTask,
    tasks: int | None = None,
    log: str | None = None,
    **calls_options,
) -> tuple[DataFrame, DataFrame]:
    """(turns, failed): the turns with the predicted intent, its probability, tokens and the
    agreement flag, and (prompt, error) of the requests that failed.

    Every distinct prompt is asked once, whatever is made of the result: the answers are
    logged as they come and then written to the shared folder. ``infer_fn`` gives text,
    logprobs and tokens; ``calls_options`` are those of ``run_inference``.
    """
    request_id = F.sha2("prompt", 256)
    asked = inference.intent_requests(turns.select("utterances", "context", "state"), template)
    answers = store(inference.run_inference(
        asked.select(request_id.alias("request_id"), "prompt").distinct(),
        infer_fn,
        "text string, logprobs array<double>, tokens bigint",
        ["request_id", "prompt"],
        tasks,
        log or answer_log(turns.sparkSession),
        **calls_options,
    ), "answers")
    results = answers.where("error is null").select(
        "request_id",
        F.col("text").alias("gpt_intent"),
        times.sequence_probability(F.col("logprobs")).alias("gpt_prob"),
        F.col("tokens").alias("gpt3-tokens-consumed"),
    )
    # The short hash, not the long prompt, is shuffled with the turns.
    keyed = turns.withColumn("prompt", inference.intent_prompt(template)).withColumn(
        "request_id", request_id
    )
    joined = joins.attach_results(
        keyed.drop("prompt"), results, "request_id", columns.INTENT_DEFAULTS
    ).drop("request_id")
    stripped = joined.withColumn("gpt_intent", text.strip(F.col("gpt_intent")))
    flagged = columns.agreement_flag(stripped, "intent", "gpt_intent")
    return flagged, answers.where("error is not null").select("prompt", "error")


def tag_turns_and_calls_job(
    turns: DataFrame,
    turn_projects: Sequence[int | str],
    call_projects: Sequence[int | str],
    base_url: str,
    language: str,
    data_label: str = writers.DEFAULT_DATA_LABEL,
    template: str | None = None,
    infer_fn: Callable[[dict], dict] | PerTask | None = None,
    **calls_options,
) -> dict[str, DataFrame]:
    """Sampled turns to turn projects (with predicted intents where a service is given),
    and one row per call to call projects. With a service, ``failed`` has its failed requests."""
    tagged, failed = turns, None
    if infer_fn and template:
        tagged, failed = predict_intents(turns, template, infer_fn, **calls_options)
    turn_tasks, turn_counts = writers.tagging_fanout(tagged, turn_projects, data_label)
    view = columns.call_level_view(turns, base_url, language)
    call_tasks, call_counts = writers.tagging_fanout(view, call_projects, data_label)
    outputs = {
        "turn_tasks": turn_tasks,
        "call_tasks": call_tasks,
        "counts": turn_counts.withColumn("level", F.lit("turn")).unionByName(
            call_counts.withColumn("level", F.lit("call"))
        ),
    }
    return outputs | ({"failed": failed} if failed is not None else {})


def tagged_dataset_job(
    jobs: DataFrame, job_ids: str, root: str, run_time: datetime, **dates
) -> str:
    """Annotated rows of the jobs, written as one dataset; gives its path."""
    rows = readers.read_annotation_jobs(jobs, job_ids, **dates)
    return writers.write_dataset(rows, root, job_ids, "tagged", run_time)


def label_store_job(
    annotations: DataFrame,
    context: DataFrame,
    flow_id: str,
    window: Mapping[str, object],
    domain: str,
    call_base: str,
    limit: int | None,
    data_labels: Sequence[str] | None = None,
    seed: object = 0.5,
) -> DataFrame:
    """A random sample of annotations (all of them for a limit of None), unpacked, with the
    unpacked context of their turn."""
    rows = filters.date_window(annotations, "tagged_at", **window)
    rows = rows.where(F.col("flow_id") == flow_id)
    if data_labels:
        rows = rows.where(F.col("data_label").isin(list(data_labels)))
    picked = rows if limit is None else calls.limit_seeded(rows, "conversation_uuid", limit, seed)
    ann = picked.withColumn("_a", jsons.unpack_annotation(F.col("annotation_result")))
    ann = ann.select("*", "_a.*").drop("_a", "annotation_result")
    # Only turns that were picked are unpacked.
    wanted = context.join(picked.select("conversation_uuid"), "conversation_uuid", "left_semi")
    ctx = columns.fill_urls(wanted, domain, call_base)
    ctx = ctx.withColumn("_p", jsons.unpack_prediction(F.col("prediction")))
    ctx = ctx.select("*", "_p.*").drop("_p", "prediction")
    return columns.serialize_nested(joins.join_annotations_context(ann, ctx))


def entity_dataset_job(
    rows: DataFrame,
    id: str,
    source: str,
    infer_fn: Callable[[dict], dict] | PerTask,
    tz: str = "Asia/Kolkata",
    tasks: int | None = None,
    log: str | None = None,
    **calls_options,
) -> tuple[DataFrame, DataFrame]:
    """(rows, failed): the rows with the tagged entities with resolved values and the
    predicted ones, reshaped, and the requests that failed, with their error. A date whose
    request failed has no value.

    ``infer_fn`` gives ``response``, the JSON list of the entity service; the answers are
    logged as they come and written to the shared folder, so each request is asked once.
    """
    tagged = inference.entity_rows(rows, id, tz, source)
    asked = inference.entity_requests(tagged, tz)
    key = ["text", "dim", "ref_ms", "locale"]
    answered = store(inference.run_inference(
        asked, infer_fn, "response string", key, tasks, log or answer_log(rows.sparkSession), **calls_options
    ), "answers")
    truth = inference.entity_truth(tagged, inference.entity_values(answered.where("error is null"), tz))
    predicted = jsons.normalize_predicted_entities(F.col("`raw.entities`"))
    whole = rows.join(truth.withColumnRenamed("id", id), id, "left").withColumn(
        "predicted_entities_with_modifications", predicted
    )
    return whole, answered.where("error is not null").select(*key, "error")


def overlay_transcripts_job(
    base: DataFrame, preds: DataFrame, now: Column, bucket: str
) -> tuple[DataFrame, DataFrame]:
    """(rows with new transcripts, links that must be signed anew)."""
    expired = base.where(text.is_expired(F.col("audio_url"), now, bucket)).select(
        "audio_url", text.url_object_key(F.col("audio_url")).alias("object_key")
    )
    return joins.overlay_predictions(base, preds), expired.distinct()


def asr_eval_job(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Word error report of a tagged dataset: (report, breakdown, operations)."""
    rows = columns.ensure_id(columns.ensure_utterances(df))
    truth = text.strip_transcript_marks(jsons.tag_text(F.col("tag")))
    return evaluation.asr_report(rows.withColumn("transcript_y", truth))


def compliance_job(
    turns: DataFrame, infer_fn: Callable[[dict], dict] | PerTask, tasks: int | None = None, log: str | None = None,
    **calls_options,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Audit of calls: (accepted rows, rejected rows, number of breaches, failed requests).

    Failed requests are rows (call_id, error), one per call that the service did not answer.

    ``infer_fn`` gives compliance_output and tokens_consumed for a call_information. The
    answers are logged as they come and written once to the shared folder, and all four
    results come from them, so each call is asked once and the results agree.
    """
    whole = calls.render_transcript(calls.assemble_calls(turns), "call_information")
    ready = whole.drop("turns").withColumn(
        "call_information", text.redact_numbers(F.col("call_information"))
    )
    answers = inference.run_inference(
        ready.select("call_id", "call_information"),
        infer_fn,
        "compliance_output string, tokens_consumed bigint",
        ["call_id"],
        tasks,
        log or answer_log(turns.sparkSession),
        **calls_options,
    )
    answers = store(answers, "answers")
    failed = answers.where("error is not null").select("call_id", "error")
    judged = inference.breach_results(ready, answers.where("error is null"))
    accepted, rejected = writers.validated_append(judged)
    return accepted, rejected, calls.count_breaches(accepted), failed


def train_test_job(
    annotated: DataFrame | None,
    uploaded: DataFrame | None,
    key: str,
    alias: Mapping[str, Sequence[str]],
    remove: Sequence[str],
    old_train: DataFrame | None = None,
    old_test: DataFrame | None = None,
    custom_test: DataFrame | None = None,
    use_previous: bool = True,
    train_percent: int = 85,
    stratify: str | None = None,
    initial: bool = False,
    seed: object = 0,
    legacy: bool = False,
    tag: str = "tag",
) -> tuple[DataFrame, DataFrame | None]:
    """(train, test). Train labels are renamed, then removed; test labels are removed, then
    renamed. The legacy rules know no held-out test set."""
    custom_test = None if legacy else custom_test
    new = datasets.merge_tagged_sources(annotated, uploaded, tag)
    if train_percent < 100 and custom_test is None:
        # The split reads the labels several times; parsing them once is enough.
        new = store(new, "labelled")
    held_out = (
        custom_test.withColumn(tag, jsons.first_tag(F.col(tag))) if custom_test is not None else None
    )
    train, test = datasets.combine_train_test(
        new, key, old_train, old_test, held_out, use_previous, train_percent, stratify, initial, seed
    )
    train = filters.drop_labels(columns.alias_labels(train, alias, tag), remove, tag)
    if test is not None:
        test = columns.alias_labels(filters.drop_labels(test, remove, tag), alias, tag)
    return train, test


def intent_eval_job(
    df: DataFrame,
    alias: Mapping[str, Sequence[str]],
    remove: Sequence[str],
    other: str | None = None,
    tag: str = "tag",
    predicted: str = "intent",
) -> dict[str, DataFrame]:
    """Reports on the predictions in ``predicted``, beside those in ``other`` if given."""
    rows = columns.alias_labels(filters.drop_labels(df, remove, tag), alias, tag)
    rows = columns.ensure_intent(rows)
    report = evaluation.classification_report(rows, tag, predicted)
    confusion = evaluation.confusion_matrix(rows, tag, predicted)
    report2 = evaluation.classification_report(rows, tag, other) if other else None
    confusion2 = evaluation.confusion_matrix(rows, tag, other) if other else None
    return {
        "report": report,
        "confusion": confusion,
        "report_comparison": evaluation.compare_classification_reports(report, report2),
        "confusion_comparison": evaluation.compare_confusion(confusion, confusion2),
    }


def generation_requests_job(
    situations: DataFrame, column: str, n_iter: int, n_choice: int
) -> DataFrame:
    """Requests for sample conversations, from ``::`` lists of situations.

    The id of a situation is its place in the list of its row."""
    listed = F.transform(F.split(F.col(column), "::"), text.strip)
    rows = situations.select(
        *[c for c in situations.columns if c != column],
        F.posexplode(listed).alias("pos", "situation"),
    )
    return rows.select("*", F.explode(F.sequence(F.lit(1), F.lit(n_iter))).alias("iteration")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(n_choice))).alias("choice")
    )


def conversation_tagging_job(
    spark: SparkSession,
    dim: DataFrame,
    prompts: DataFrame,
    generated: DataFrame,
    wanted: DataFrame,
    folder: str,
    project_ids: Sequence[int | str],
    prompt_link: str,
    facts: Mapping[str, object],
    now: Column | None = None,
    prompt: Mapping[str, object] | None = None,
) -> dict[str, DataFrame]:
    """Situations get ids, their conversation files become tagging tasks, and one fact row
    per situation is recorded. ``wanted``: situation, scenario, scenario_category. A new
    prompt is stored with the values of ``prompt`` (client, template)."""
    key = ["situation", "scenario", "scenario_category"]
    rows = dimensions.situation_rows(wanted, *key).select(*key)
    ids, situations = dimensions.get_or_create(dim, rows, key, now=now)
    ids = ids.withColumnRenamed("id", "situation_id")
    docs = readers.read_text_documents(spark, folder)
    tasks, counts = writers.tagging_fanout(joins.attach_documents(ids, docs), project_ids)
    about = {"links_to_prompt_in_s3": prompt_link, **(prompt or {})}
    link = spark.range(1).select(*[F.lit(v).alias(c) for c, v in about.items()])
    prompt_ids, prompts_after = dimensions.get_or_create(
        prompts, link, ["links_to_prompt_in_s3"], now=now
    )
    rows = dimensions.constant_columns(
        ids.select("situation_id").distinct(), facts
    ).withColumn("prompt_id", prompt_ids.select("id").scalar())
    return {
        "tasks": tasks,
        "counts": counts,
        "situations": situations,
        "prompts": prompts_after,
        "generated": dimensions.record_generated(generated, situations, prompts_after, rows),
    }


def invalidate_job(dim: DataFrame, ids: str) -> DataFrame:
    """Soft delete of a comma-separated list of ids."""
    listed = [int(i) for i in readers.split_paths(ids)]
    return dimensions.invalidate(dim, listed)


def asr_corpus_job(
    jobs: DataFrame,
    job_ids: str,
    augment: DataFrame,
    remove: DataFrame,
    lexicon: DataFrame,
    extra: DataFrame,
    **dates,
) -> dict[str, DataFrame]:
    """Corpus lines, vocabulary and lexicon for tuning a recogniser."""
    rows = readers.read_annotation_jobs(jobs, job_ids, **dates)
    lines = rows.select(
        text.strip_transcript_marks(jsons.tag_text(F.col("tag"))).alias("line")
    )
    clean = filters.drop_marked_lines(lexicon, "line")
    merged = datasets.merge_lexicons(clean, extra)
    words = merged.withColumn("word", F.substring_index("line", " ", 1))
    return {
        "corpus": lines,
        "vocabulary": datasets.vocabulary(lines, "line", augment, remove),
        "lexicon": joins.remove_words(words, remove).select("line"),
    }
