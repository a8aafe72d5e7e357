"""Calls made of turns: sampling, first rows, assembly, transcripts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from turnwise.functions import text
from turnwise.operators.skew import cut_point, place_of

# Call metadata taken from the first turn.
CALL_META = ("call_uuid", "audio_url", "call_url", "flow_uuid", "client_uuid", "reftime")
# The turns of a call are gathered in so many parts before the whole call meets in its row.
PARTS = 32


def _comparable(f: StructField) -> Column:
    """A column to order by. Maps and variants have no order, their JSON text has."""
    unordered = any(kind in f.dataType.simpleString() for kind in ("map<", "variant"))
    return F.to_json(F.struct(F.col(f"`{f.name}`"))) if unordered else F.col(f"`{f.name}`")


def first_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """WIN-1: the first row per key by ``order``, ties broken by all columns.

    The rank limit is applied in every task before the shuffle, so a hot key sends one
    row per task.
    """
    ties = [f for f in df.schema if f.name not in order and f.name != key]
    ranked = Window.partitionBy(key).orderBy(*order, *[_comparable(f) for f in ties])
    return df.withColumn("_r", F.row_number().over(ranked)).where("_r = 1").drop("_r")


def sample_calls(
    turns: DataFrame, n: int, buffer: int = 0, seed: object = 0, call: str = "call_id"
) -> DataFrame:
    """SRT-1: all turns of ``n + buffer`` randomly chosen calls; the same ones for a seed.

    The calls are the first in hash order. Counts of ids per hash prefix tell where that order
    is cut, so a sample of any size is one filter: nothing gathers it and the turns are not
    shuffled. Turns without a call id are in no sample.
    """
    ids = turns.select(call).where(F.col(call).isNotNull()).distinct()
    cut = cut_point(ids, call, lambda calls: min(calls, n + buffer), seed)
    if cut is None:
        return turns.limit(0)
    return turns.where(F.col(call).isNotNull() & (place_of(call, seed) <= cut.place(turns.schema[call].dataType)))


def limit_seeded(df: DataFrame, key: str, limit: int, seed: object = 0.5) -> DataFrame:
    """SRT-2: at most ``limit`` rows in a repeatable random order: the first by the hash of
    ``key``, as a filter at the place where that order is cut. Nothing gathers the sample.

    Of rows that share the key of the cut, some are taken: by their other columns, and equal
    rows in any order.
    """
    cut = cut_point(df, key, lambda rows: min(rows, limit), seed)
    if cut is None:
        return df.limit(0)
    place, last = place_of(key, seed), cut.place(df.schema[key].dataType)
    if cut.take == cut.equal:
        return df.where(place <= last)
    # A null key has a place too, its hash with null.
    there = place.eqNullSafe(last)
    ties = df.where(there).orderBy(*[_comparable(f) for f in df.schema]).limit(cut.take)
    return df.where((place < last) & ~there).unionByName(ties)


def _line(is_user: bool, said: str) -> Column:
    return F.struct(
        F.col("conversation_id").alias("id"), F.lit(is_user).alias("is_user"),
        text.clean_utterance(F.col(said)).alias("utterance"),
    )


def _lines() -> Column:
    """The bot turn and the user turn of an input row."""
    return F.array(_line(False, "bot_response"), _line(True, "primary_utterance"))


def assemble_calls(turns: DataFrame) -> DataFrame:
    """AGG-1: one row per call with its turns in order, bot before user.

    Every input row gives a bot turn and a user turn. Columns: call_id, the call metadata of
    the first row, turns array<struct<id, is_user, utterance>>. Texts are cleaned row by row;
    a hot call is gathered in parts by the hash of the turn id, and only its finished list,
    which is the result, meets in one task. Turn ids must be unique within a call.
    """
    meta = [c for c in CALL_META if c in turns.columns]
    parts = (
        turns.withColumn("_part", F.pmod(F.xxhash64("conversation_id"), F.lit(PARTS)))
        .groupBy("call_id", "_part")
        .agg(
            F.collect_list(_lines()).alias("turns"),
            F.min(F.struct("conversation_id", *meta)).alias("first"),
        )
    )
    whole = parts.groupBy("call_id").agg(
        F.collect_list(F.flatten("turns")).alias("turns"), F.min("first").alias("first")
    )
    return whole.select(
        "call_id",
        *[F.col(f"first.{c}").alias(c) for c in meta],
        F.array_sort(F.flatten("turns")).alias("turns"),
    )


def call_lines(turns: DataFrame) -> DataFrame:
    """AGG-1 as a table of lines, for calls that no cell can hold: call_id, id, is_user and
    utterance, the turns of ``assemble_calls`` with a row each. A call's order is that of
    (id, is_user). Nothing is gathered or shuffled.
    """
    return turns.select("call_id", F.inline(_lines()))


def call_heads(turns: DataFrame) -> DataFrame:
    """The other half of AGG-1 for such calls: the metadata of a call's first row and
    n_turns, its number of lines. Summed up inside the tasks, so a call of any length is a row
    per task in the shuffle."""
    meta = [c for c in CALL_META if c in turns.columns]
    heads = turns.groupBy("call_id").agg(
        F.min(F.struct("conversation_id", *meta)).alias("first"), (2 * F.count("*")).alias("n_turns")
    )
    return heads.select("call_id", *[F.col(f"first.{c}").alias(c) for c in meta], "n_turns")


def transcript_line() -> Column:
    """AGG-2 for one row of ``call_lines``."""
    return F.concat(F.when(F.col("is_user"), "USER: ").otherwise("BOT: "), F.col("utterance"))


def render_transcript(calls: DataFrame, name: str = "transcript") -> DataFrame:
    """AGG-2: the turns as one text between call marks."""
    lines = F.transform(
        "turns",
        lambda t: F.concat(F.when(t["is_user"], "USER: ").otherwise("BOT: "), t["utterance"]),
    )
    return calls.withColumn(
        name, F.concat(F.lit("<call>\n"), F.array_join(lines, "\n"), F.lit("\n</call>"))
    )


def count_breaches(df: DataFrame) -> DataFrame:
    """AGG-3: number of rows whose ``is_breach`` is true."""
    return df.agg(F.count_if(F.coalesce(F.col("is_breach"), F.lit(False))).alias("breaches"))
