"""Row filters. None means "no filter" everywhere."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, time, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Call types sampled by default, accepted languages, age limit of a date.
DEFAULT_CALL_TYPES = ("inbound", "outbound")
SUPPORTED_LANGUAGES = ("en-US", "en", "hi", "ta", "te", "ma", "gu", "mr")
MAX_AGE_DAYS = 270
# Marks of lexicon lines that are no words.
LEXICON_MARKS = ("<SIL>", "<UNK>")
# Longer literal lists become a joined table instead of an expression.
LONG_LIST = 200


def date_bounds(
    start: datetime | None = None,
    end: datetime | None = None,
    start_days: int = 0,
    end_days: int = 0,
    start_hours: int = 0,
    end_hours: int = 0,
    today: date | None = None,
    zone: str | None = None,
) -> tuple[datetime, datetime]:
    """The two ends of a date window; offsets count only for an end that is not given.

    The window lies in ``zone``: today is the day there, and both ends carry the zone.
    """
    there = ZoneInfo(zone) if zone else None
    today = today or datetime.now(there).date()
    first = start or datetime.combine(today, time.min) + timedelta(
        days=start_days, hours=start_hours
    )
    if end:
        last = end + timedelta(hours=23, minutes=59, seconds=59)
    else:
        last = datetime.combine(today, time.max) + timedelta(days=end_days, hours=end_hours)
    if first > last:
        raise ValueError(f"window starts at {first}, after its end {last}")
    return (first.replace(tzinfo=there), last.replace(tzinfo=there)) if zone else (first, last)


def date_window(df: DataFrame, ts: str, **bounds) -> DataFrame:
    """FLT-1: rows of a date window; two literals, so the filter reaches the scan.

    With a ``zone`` the ends are moments of that zone; columns without one (dates, texts,
    timestamp_ntz) are taken to hold its local time.
    """
    first, last = date_bounds(**bounds)
    kind = df.schema[ts].dataType.simpleString()
    if kind != "timestamp":
        first, last = first.replace(tzinfo=None), last.replace(tzinfo=None)
    literal = lambda moment: F.lit(moment.isoformat(sep=" ")).cast(kind)
    return df.where(F.col(ts).between(literal(first), literal(last)))


def literal_table(spark: SparkSession, **lists: Sequence) -> DataFrame:
    """A table of values the caller passed in: one column per list, made inside the JVM."""
    zipped = F.arrays_zip(*[F.lit(list(v)).alias(n) for n, v in lists.items()])
    return spark.range(1).select(F.inline(zipped).alias(*lists))


def filter_calls(
    df: DataFrame,
    lang: str | None = None,
    org_ids: Sequence[int] | None = None,
    call_type: Sequence[str] | None = None,
    ignore_callers: Sequence[str] | None = None,
    reported: bool | None = None,
    template_id: int | None = None,
    use_case: str | None = None,
    flow_name: str | None = None,
    flow_ids: Sequence[int] | None = None,
    min_duration: float | None = None,
    asr_provider: str | None = None,
    states: Sequence[str] | None = None,
) -> DataFrame:
    """FLT-2: all given call predicates at once. A column is only touched by its own filter."""
    equal = {
        "language": lang,
        "template_id": template_id,
        "use_case": use_case,
        "flow_name": flow_name,
        "asr_provider": asr_provider,
    }
    listed = {
        "org_id": org_ids,
        "call_type": DEFAULT_CALL_TYPES if call_type is None else call_type,
        "flow_id": flow_ids,
        "state": states,
    }
    for name, value in equal.items():
        if value is not None:
            df = df.where(F.col(name) == value)
    for name, values in listed.items():
        if values is not None:
            df = df.where(F.col(name).isin(list(values)))
    if ignore_callers:
        df = df.where(~F.coalesce(F.col("caller").isin(list(ignore_callers)), F.lit(False)))
    if reported is not None:
        df = df.where(F.col("reported") == reported)
    if min_duration is not None:
        df = df.where(F.col("call_duration") >= min_duration)
    return df


def drop_labels(df: DataFrame, labels: Sequence[str], col: str = "tag") -> DataFrame:
    """FLT-3: remove listed labels; null labels stay."""
    labels = list(labels)
    if not labels:
        return df
    if len(labels) <= LONG_LIST:
        return df.where(~F.coalesce(F.col(col).isin(labels), F.lit(False)))
    listed = literal_table(df.sparkSession, **{col: labels})
    return df.join(listed, col, "left_anti")


def require_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """FLT-4: rows where all the named columns hold a value."""
    return df.dropna(how="any", subset=list(cols))


def validate_rows(
    df: DataFrame,
    today: date,
    max_age_days: int = MAX_AGE_DAYS,
    langs: Sequence[str] = SUPPORTED_LANGUAGES,
    data_labels: Sequence[str] | None = None,
    required: Mapping[str, Sequence[Sequence[str]]] | None = None,
    job: str = "job",
) -> DataFrame:
    """FLT-5: adds ``errors``, an array of messages, empty for a good row.

    Checked where the column exists: start_date, end_date, lang, data_label. ``required``
    maps a job name to groups of fields; one field of every group must be present.
    """
    rules: list[Column] = []
    for name in ("start_date", "end_date"):
        if name in df.columns:
            day = F.when(
                F.col(name).rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), F.col(name)
            ).try_cast("date")
            rules.append(
                F.when(
                    F.col(name).isNotNull() & day.isNull(),
                    F.concat(F.lit(f"{name} is not a yyyy-MM-dd date: "), F.col(name)),
                )
            )
            rules.append(
                F.when(
                    F.date_diff(F.lit(today), day) > max_age_days,
                    F.concat(F.lit(f"{name} is older than {max_age_days} days: "), F.col(name)),
                )
            )
    for name, allowed in (("lang", langs), ("data_label", data_labels)):
        if name in df.columns and allowed:
            rules.append(
                F.when(
                    ~F.col(name).isin(list(allowed)),
                    F.concat(F.lit(f"{name} is not supported: "), F.col(name)),
                )
            )
    for job_name, groups in (required or {}).items():
        for group in groups:
            held = [F.col(c).isNotNull() for c in group if c in df.columns]
            missing = ~F.greatest(F.lit(False), *held) if held else F.lit(True)
            rules.append(
                F.when(
                    (F.col(job) == job_name) & missing,
                    F.lit(f"{job_name} needs {' or '.join(group)}"),
                )
            )
    found = F.array_compact(F.array(*rules)) if rules else F.array()
    return df.withColumn("errors", found.cast("array<string>"))


def drop_marked_lines(
    df: DataFrame, col: str = "line", marks: Sequence[str] = LEXICON_MARKS
) -> DataFrame:
    """FLT-6: lines that hold none of the marks."""
    for mark in marks:
        df = df.where(~F.col(col).contains(mark))
    return df


def filter_turns_by_intent(df: DataFrame, intents: Sequence[str] | None) -> DataFrame:
    """FLT-7: turns of the listed intents. Apply it after calls are sampled, never before."""
    return df.where(F.col("intent").isin(list(intents))) if intents else df
