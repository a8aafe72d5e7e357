"""The table work around calls to outside services: requests, batches, results."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from turnwise.functions import jsons, let, text, times
from turnwise.operators.answers import BUCKETS, BucketLog, Pace, PerTask, ask_patiently
from turnwise.operators.filters import require_present

# Output columns of the breach audit, in their order.
BREACH_COLUMNS = (
    "call_id", "call_uuid", "audio_url", "call_url", "flow_uuid", "client_uuid", "reftime",
    "is_breach", "compliance_output", "tokens_consumed", "call_information",
)


def intent_prompt(template: str) -> Column:
    """The prompt of a turn; null where the utterance or the context cannot be read."""
    return text.fill_prompt(
        template,
        jsons.bot_response(F.col("context")),
        jsons.primary_transcript(F.col("utterances")),
        F.col("state"),
    )


def intent_requests(df: DataFrame, template: str, name: str = "prompt") -> DataFrame:
    """INF-1: adds the prompt; rows without utterance or context, or with bad JSON, go."""
    present = require_present(df, ["utterances", "context"])
    return require_present(present.withColumn(name, intent_prompt(template)), [name])


def run_inference(
    requests: DataFrame,
    infer_fn: Callable[[dict], dict] | PerTask,
    schema: str | StructType,
    keep: Sequence[str],
    tasks: int | None = None,
    log: str | None = None,
    at_once: int = 1,
    per_second: float | None = None,
    retries: int = 0,
    backoff: float = 0.5,
) -> DataFrame:
    """INF-2: calls ``infer_fn`` for every request row; adds its results and ``error``.

    ``infer_fn`` takes a row as a dict and gives a dict with the fields of ``schema``; a
    ``PerTask`` makes one client in each task. A request that fails gets null results and
    its message; the batch goes on. ``tasks`` limits how many tasks call the service at
    once; without it there is one per core of the cluster, a number that AQE does not merge.

    Rows are dealt by the hash of the request, so a task that runs again has the same ones,
    and equal requests are asked once. With ``log``, a folder that all tasks can open, every
    answer is written there when it comes, and what stands there is not asked again, by
    another run of the task or of the job; failed requests are. Answers must then be JSON.
    ``at_once`` requests of a task run side by side, ``per_second`` is the rate of all tasks
    together, and a failed request is tried ``retries`` times more, after growing pauses.
    """
    fields = requests.sparkSession.createDataFrame([], schema).schema
    names = fields.fieldNames()
    kept = list(keep)
    asked = requests.columns
    count = tasks or requests.sparkSession.sparkContext.defaultParallelism

    out = StructType([requests.schema[c] for c in kept] + list(fields.fields)).add("error", "string")

    def call(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(f.dataType) for f in out.fields[len(kept) :]]
        ask = infer_fn.make() if isinstance(infer_fn, PerTask) else infer_fn
        pace = Pace(per_second / count if per_second else None)
        bucket, known, book = None, {}, None

        def answer(key: str, row: dict) -> tuple[str, list]:
            try:
                found = ask_patiently(ask, row, pace, retries, backoff)
                values = [found.get(n) for n in names]
                if book:
                    book.add(key, values)
                return key, values + [None]
            except Exception as problem:
                return key, [None] * len(names) + [str(problem)]

        with ThreadPoolExecutor(at_once) as threads:
            for batch in batches:
                numbers = batch.column("_bucket").to_numpy()
                cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), batch.num_rows]
                for first, end in zip(cuts, cuts[1:]):
                    if end == first:
                        continue
                    if numbers[first] != bucket:
                        bucket = numbers[first]
                        if book:
                            book.close()
                        book = BucketLog(log, bucket) if log else None
                        known = {k: v + [None] for k, v in book.read().items()} if book else {}
                    part = batch.slice(first, end - first)
                    keys = part.column("_request").to_pylist()
                    open_ = dict(zip(keys[::-1], part.select(asked).to_pylist()[::-1]))
                    open_ = {k: open_[k] for k in dict.fromkeys(keys) if k not in known}
                    way = threads.map if at_once > 1 else map
                    known.update(way(lambda item: answer(*item), open_.items()))
                    columns = list(zip(*[known[k] for k in keys]))
                    # Kept columns pass as they came, whatever nulls they hold.
                    arrays = [part.column(c) for c in kept] + [pa.array(c, k) for c, k in zip(columns, kinds)]
                    yield pa.RecordBatch.from_arrays(arrays, out.fieldNames())
        if book:
            book.close()

    request = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in asked])), 256)
    dealt = requests.withColumn("_request", request).withColumn(
        "_bucket", F.pmod(F.xxhash64("_request"), F.lit(BUCKETS)).cast("int")
    )
    spread = dealt.repartition(count, "_bucket").sortWithinPartitions("_bucket", "_request")
    return spread.mapInArrow(call, out)


def breach_results(
    calls: DataFrame, responses: DataFrame, key: str | list[str] = "call_id"
) -> DataFrame:
    """INF-3: the audit table. A response without a ``breach`` flag gives no row.

    ``calls`` has the call metadata and ``call_information``; ``responses`` has
    ``compliance_output`` and ``tokens_consumed``.
    """
    flag = F.try_variant_get(jsons.json_slice(F.col("compliance_output")), "$.breach", "boolean")
    judged = responses.withColumn("is_breach", flag).where("is_breach is not null")
    return calls.join(judged, key, "inner").select(*BREACH_COLUMNS)


def _dated(kind: Column) -> Column:
    return F.coalesce(kind.isin(*text.RESOLVED_TYPES), F.lit(False))


def entity_rows(df: DataFrame, id: str, tz: str, source: str) -> DataFrame:
    """Tagged entities of every row: (id, reference ms, locale, entities)."""
    column = {"labelled": "raw.entities", "typed": "tag"}[source]
    return df.select(
        F.col(id).alias("id"),
        times.ref_epoch_ms(F.col("reftime"), tz).alias("ref_ms"),
        times.entity_locale(F.col("`raw.language`"), tz).alias("locale"),
        jsons.annotated_entities(F.col(f"`{column}`"), source).alias("entities"),
    )


def entity_requests(rows: DataFrame, tz: str) -> DataFrame:
    """INF-4: the distinct questions for the entity service: every tagged date, time or
    datetime once per (text, dimension, reference time, locale)."""
    # No array, no rows: a filter on ref_ms would work the time out twice.
    dated = F.when(
        F.col("ref_ms").isNotNull(), F.filter("entities", lambda e: _dated(e["type"]))
    )
    return (
        rows.select("ref_ms", "locale", F.explode(dated).alias("e"))
        .select(
            F.replace(F.col("e.text"), F.lit("~"), F.lit("")).alias("text"),
            F.col("e.type").alias("dim"),
            "ref_ms",
            "locale",
            F.lit(tz).alias("tz"),
        )
        .distinct()
    )


def _as_moment(c: Column) -> Column:
    return c.try_cast("timestamp_ntz")


def _quoted_or_null(c: Column) -> Column:
    return F.when(c.isNotNull(), jsons.quoted(c))


def _moment_json(v: Column, tagged: Column) -> Column:
    """JSON of a value: a text must be a time, else the tagged text is tried; no integers."""
    parsed = F.date_format(_as_moment(tagged), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    readable = lambda t: F.when(_as_moment(t).isNotNull(), t).otherwise(parsed)
    return let(
        F.to_json(v),
        lambda j: F.when(
            j.startswith('"'),
            let(readable(F.try_variant_get(v, "$", "string")), _quoted_or_null),
        ).when(~j.rlike(r"^-?[0-9]+$"), j),
    )


def entity_values(responses: DataFrame, tz: str, name: str = "value") -> DataFrame:
    """INF-5: JSON value of the first entity of a response, or null.

    ``responses`` has the request columns and ``response``, the JSON list of the service.
    Values, open or closed intervals and durations (reference time plus seconds) are
    kept; whole numbers are no time; a text that is no time is tried as the tagged text.
    """

    def read(first: Column) -> Column:
        part = lambda path, kind="string": F.try_variant_get(first, f"$.{path}", kind)
        is_duration = (part("dim") == "duration") & (part("value.normalized.unit") == "second")
        ends = times.duration_end(F.col("ref_ms"), part("value.normalized.value", "bigint"), tz)
        member = lambda key: F.concat(
            F.lit(f'"{key}":'), F.to_json(part(f"value.{key}", "variant"))
        )
        interval = let(
            F.concat_ws(",", member("from"), member("to")),
            lambda m: F.when(m != "", F.concat(F.lit("{"), m, F.lit("}"))),
        )
        return F.when(is_duration, let(ends, _quoted_or_null)).otherwise(
            let(
                part("value.value", "variant"),
                lambda v: F.when(v.isNull(), interval).otherwise(_moment_json(v, F.col("text"))),
            )
        )

    first = F.try_variant_get(F.try_parse_json(F.col("response")), "$[0]", "variant")
    return responses.withColumn(name, let(first, read))


def entity_truth(rows: DataFrame, values: DataFrame) -> DataFrame:
    """INF-6: (id, truth_entities_with_duckling): the tagged entities of a row with their
    values, in order, as a JSON list; null if none is left.

    ``values`` has one row per (text, dim, ref_ms, locale) with a JSON ``value``. Dates
    without a value are dropped. A row with an unusable type or time gives null.
    """
    sound = ~F.exists(
        "entities",
        lambda e: e["type"].isNull()
        | (~_dated(e["type"]) & (F.size(F.split(e["type"], "/")) > 2)),
    ) & F.col("ref_ms").isNotNull()
    shaped = F.transform("entities", lambda e: text.entity_type_value(e["type"], e["text"]))
    listed = rows.select(
        "id", "ref_ms", "locale",
        F.posexplode_outer(F.when(sound, shaped)).alias("pos", "e"),
    ).select("id", "pos", "ref_ms", "locale", F.col("e.type").alias("dim"), "e.text",
             F.col("e.value").alias("plain"))
    answers = values.select(
        F.col("text").alias("a_text"), F.col("dim").alias("a_dim"), F.col("ref_ms").alias("a_ms"),
        F.col("locale").alias("a_locale"), F.col("value").alias("answer"),
    )
    # A row without a language is asked without a locale, and gets that answer.
    asked = (
        (F.col("text") == F.col("a_text")) & (F.col("dim") == F.col("a_dim"))
        & (F.col("ref_ms") == F.col("a_ms")) & F.col("locale").eqNullSafe(F.col("a_locale"))
    )
    joined = listed.join(answers, asked, "left")
    value = F.when(_dated(F.col("dim")), F.col("answer")).otherwise(
        jsons.quoted(F.nullif(F.col("plain"), F.lit("")))
    )
    item = F.concat(
        F.lit('{"type":'), jsons.quoted(F.col("dim")),
        F.lit(',"value":'), value,
        F.lit(',"text":'), jsons.quoted(F.col("text")), F.lit("}"),
    )
    usable = (F.coalesce(F.col("dim"), F.lit("")) != "") & value.isNotNull() & (value != "null")
    # A group holds the entities of one row, which came out of one row.
    grouped = joined.groupBy("id").agg(
        F.array_sort(F.collect_list(F.when(usable, F.struct("pos", item.alias("j"))))).alias("l")
    )
    return grouped.select(
        "id",
        F.when(
            F.size("l") > 0,
            F.concat(F.lit("["), F.array_join(F.transform("l", lambda x: x["j"]), ","), F.lit("]")),
        ).alias("truth_entities_with_duckling"),
    )


def generation_requests(situations: DataFrame, n_iter: int, n_choice: int) -> DataFrame:
    """INF-7: every situation ``n_iter`` times, with ``n_choice`` texts asked for each time.

    Of two rows with one situation_id the later (by ``pos`` if there, else by text) counts.
    """
    order = F.struct("pos", "situation") if "pos" in situations.columns else F.col("situation")
    last = situations.groupBy("situation_id").agg(F.max_by("situation", order).alias("situation"))
    return last.select(
        "situation_id",
        "situation",
        F.explode(F.sequence(F.lit(1), F.lit(n_iter))).alias("iteration"),
    ).select("*", F.explode(F.sequence(F.lit(1), F.lit(n_choice))).alias("choice"))
