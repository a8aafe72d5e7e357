"""Projections: columns added, renamed, filled or relabelled. No shuffles but for long mappings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnwise.functions import jsons, text, times
from turnwise.operators.calls import first_per_key
from turnwise.operators.filters import LONG_LIST, literal_table
from turnwise.operators.skew import lookup_join

# The columns of the call-level view.
CALL_COLUMNS = (
    "call_uuid", "reftime", "call_type", "language", "call_end_status", "disposition",
    "previous_disposition", "blocking_disposition", "flow_id", "flow_version", "flow_name",
    "call_duration", "flow_uuid", "client_uuid", "template_id",
)
# What a row holds that got no result from the intent service.
INTENT_DEFAULTS = {"gpt_intent": "N/A", "gpt_prob": 0.0, "gpt3-tokens-consumed": 0}


def read_columns(df: DataFrame, cols: Sequence[str] = CALL_COLUMNS) -> DataFrame:
    """SRC-5: the named columns only; a missing one is an error. The scan reads no others."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*cols)


def invert_aliases(alias: Mapping[str, Sequence[str]]) -> dict[str, str]:
    """{target: [sources]} turned round; for a source listed twice the last target counts."""
    return {source: target for target, sources in alias.items() for source in sources}


def alias_labels(
    df: DataFrame, alias: Mapping[str, Sequence[str]] | DataFrame, col: str = "tag"
) -> DataFrame:
    """PRJ-1: replace labels once (not again and again); unlisted and null labels stay.

    ``alias`` is a mapping, or a table (source, target) with one row per source.
    """
    if isinstance(alias, DataFrame):
        names = df.columns
        table = alias.select(F.col("source").alias(col), F.col("target").alias("_target"))
        joined = lookup_join(df, table, col)
        replaced = joined.withColumn(col, F.coalesce("_target", F.col(col)))
        return replaced.select(*[F.col(f"`{c}`") for c in names])
    pairs = invert_aliases(alias)
    if not pairs:
        return df
    if len(pairs) > LONG_LIST:
        table = literal_table(df.sparkSession, source=list(pairs), target=list(pairs.values()))
        return alias_labels(df, table, col)
    mapping = F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs.items())])
    return df.withColumn(col, F.coalesce(F.try_element_at(mapping, F.col(col)), F.col(col)))


def ensure_intent(df: DataFrame) -> DataFrame:
    """PRJ-2: an ``intent`` column: as it is, else ``raw.intent``, else ''."""
    if "intent" in df.columns:
        return df
    if "raw.intent" in df.columns:
        return df.withColumnRenamed("raw.intent", "intent")
    return df.withColumn("intent", F.lit(""))


def ensure_id(df: DataFrame) -> DataFrame:
    """PRJ-3: ``id`` copied from ``data_id`` where it is absent."""
    if "id" not in df.columns and "data_id" in df.columns:
        return df.withColumn("id", F.col("data_id"))
    return df


def ensure_utterances(df: DataFrame) -> DataFrame:
    """PRJ-4: ``utterances`` as it is, else ``alternatives``, else taken from ``data``."""
    if "utterances" in df.columns:
        return df
    if "alternatives" in df.columns:
        return df.withColumn("utterances", F.col("alternatives"))
    return df.where(F.col("data").isNotNull()).withColumn(
        "utterances", jsons.build_utterances(F.col("data"))
    )


def call_level_view(
    df: DataFrame, base_url: str, language: str, order: Sequence[str] = ("reftime",)
) -> DataFrame:
    """PRJ-5: one row per call, with its day, its link and a constant language."""
    first = first_per_key(read_columns(df), "call_uuid", order)
    return (
        first.withColumn("date", times.local_day(F.col("reftime")))
        .withColumn(
            "call_link",
            text.call_link(base_url, F.col("client_uuid"), F.col("flow_uuid"), F.col("call_uuid")),
        )
        .withColumn("language", F.lit(language))
    )


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """PRJ-6: result columns filled where a row got no result; absent ones are added."""
    filled = {
        name: F.coalesce(F.col(f"`{name}`"), F.lit(value)) if name in df.columns else F.lit(value)
        for name, value in defaults.items()
    }
    return df.withColumns(filled)


def agreement(a: Column, b: Column) -> Column:
    """PRJ-7: "yes" if the labels are equal once the second is stripped, else "no"."""
    return F.when(F.coalesce(a == text.strip(b), F.lit(False)), "yes").otherwise("no")


def agreement_flag(df: DataFrame, a: str, b: str, name: str = "use_gpt_intent") -> DataFrame:
    return df.withColumn(name, agreement(F.col(a), F.col(b)))


def fill_urls(df: DataFrame, domain: str, call_base: str, ext: str = ".wav") -> DataFrame:
    """PRJ-8: ``audio_url`` from base path, path and call id; ``call_url`` kept or built."""
    audio = F.concat_ws(
        "/", F.lit(domain), F.col("audio_base_path"), F.col("call_uuid"), F.col("audio_path")
    )
    built = F.concat(F.lit(call_base + "/"), F.col("call_url_id"), F.lit(ext))
    kept = F.nullif(F.col("call_url"), F.lit("")) if "call_url" in df.columns else None
    return df.withColumns(
        {
            "audio_url": audio,
            "call_url": built if kept is None else F.coalesce(kept, built),
        }
    )


def serialize_nested(df: DataFrame) -> DataFrame:
    """SNK-4: every array, struct, map or variant column as JSON text; scalars stay."""
    nested = ("array", "struct", "map", "variant")
    return df.withColumns(
        {
            f.name: F.to_json(F.col(f"`{f.name}`"))
            for f in df.schema.fields
            if f.dataType.typeName() in nested
        }
    )
