"""Joins between calls, transcripts, annotations and documents. All are equi joins."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnwise.functions import jsons, text
from turnwise.operators.columns import with_defaults


def overlay_predictions(
    base: DataFrame,
    preds: DataFrame,
    key_fn: Callable[[Column], Column] = text.audio_filename,
    base_url: str = "audio_url",
) -> DataFrame:
    """JN-1: inner join of call rows and transcription results on the file name.

    ``preds`` has filename and asr_predictions. The new ``alternatives`` wins; other
    columns of ``preds`` that clash get the suffix ``_sqlite``. All matches are kept.
    """
    right = preds.withColumn("filename", key_fn(F.col("filename"))).withColumn(
        "alternatives", jsons.canonical_json(F.col("asr_predictions"))
    )
    left = base.withColumn("filename", key_fn(F.col(base_url)))
    if "alternatives" in left.columns:
        left = left.drop("alternatives")
    clashes = [c for c in right.columns if c in left.columns and c != "filename"]
    for c in clashes:
        right = right.withColumnRenamed(c, f"{c}_sqlite")
    return left.join(right, "filename", "inner")


def join_annotations_context(ann: DataFrame, ctx: DataFrame) -> DataFrame:
    """JN-2: annotations with the context of their turn; inner join on conversation_uuid.

    ``call_uuid`` and ``reftime`` come from the context; its path columns are dropped;
    other names that both sides have get ``_x`` and ``_y``.
    """
    left = ann.drop("call_uuid", "reftime")
    right = ctx.drop("audio_base_path", "audio_path")
    clashes = {c for c in left.columns if c in right.columns} - {"conversation_uuid"}
    left = left.withColumnsRenamed({c: f"{c}_x" for c in clashes})
    right = right.withColumnsRenamed({c: f"{c}_y" for c in clashes})
    return left.join(right, "conversation_uuid", "inner")


def keep_with_valid_audio(
    df: DataFrame, valid_files: DataFrame, url: str = "audio_url", file: str = "file_name"
) -> DataFrame:
    """JN-3: rows whose recording is in the listing of usable files; null links are dropped."""
    named = df.where(F.col(url).isNotNull()).withColumn("_file", text.audio_stem_wav(F.col(url)))
    listing = valid_files.select(F.col(file).alias("_file"))
    return named.join(listing, "_file", "left_semi").drop("_file")


def attach_documents(situations: DataFrame, docs: DataFrame) -> DataFrame:
    """JN-4: one row per situation and text file of that situation.

    ``situations`` has situation_id, situation, scenario, scenario_category; ``docs``
    has situation_id and content. A situation without a file gives no row.
    """
    return situations.join(docs, "situation_id", "inner").select(
        "scenario",
        "scenario_category",
        F.col("situation").alias("situation_str"),
        F.col("content").alias("call"),
    )


def attach_results(
    df: DataFrame, results: DataFrame, key: str | Sequence[str], defaults: Mapping[str, object]
) -> DataFrame:
    """JN-5: left join of results that exist for some rows only, the others keep defaults.

    ``results`` has one row per key, so the number of rows does not change.
    """
    keys = [key] if isinstance(key, str) else list(key)
    joined = df.drop(*[c for c in results.columns if c not in keys]).join(results, keys, "left")
    return with_defaults(joined, defaults)


def remove_words(lexicon: DataFrame, words: DataFrame, col: str = "word") -> DataFrame:
    """JN-9: lexicon entries whose word is not in the removal list."""
    return lexicon.join(words.select(col), col, "left_anti")
