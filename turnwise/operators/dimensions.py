"""Small dimension tables as parquet snapshots: look up, insert, soft delete, facts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnwise.functions import text
from turnwise.operators.filters import LONG_LIST, literal_table
from turnwise.operators.skew import serial_numbers
from turnwise.session import store


def situation_rows(
    df: DataFrame, situations: str, scenario: str, scenario_category: str
) -> DataFrame:
    """STR-10 as a table: one row per situation of a ``::`` list.

    The arguments are column names. Scenario is lower-cased, category upper-cased; an
    empty one of the two is an error.
    """
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    checked = F.when(
        empty(scenario) | empty(scenario_category),
        F.raise_error(F.lit("scenario and scenario_category must not be empty")),
    ).otherwise(F.col(situations))
    others = [c for c in df.columns if c not in (situations, scenario, scenario_category)]
    return df.select(
        *others,
        F.explode(text.normalize_situations(checked)).alias("situation"),
        F.lower(scenario).alias("scenario"),
        F.upper(scenario_category).alias("scenario_category"),
    )


def next_id(dim: DataFrame, id_col: str = "id") -> Column:
    """The first free id of a table, as a scalar."""
    return dim.select(F.coalesce(F.max(id_col), F.lit(0)) + 1).scalar()


def allocate_ids(
    new: DataFrame, key: str | Sequence[str], start: Column | int = 1, name: str = "id"
) -> DataFrame:
    """WIN-3: serial ids for rows with a unique key, without a global sort."""
    first = start if isinstance(start, Column) else F.lit(start)
    return serial_numbers(new, key, first, name)


def _key_of(table: DataFrame, keys: Sequence[str], *others: str) -> tuple[DataFrame, Column]:
    """``table`` with its keys renamed, and the condition that they are those of another
    table; null is a key like any other."""
    named = [F.col(k).alias(f"_tw_key{i}") for i, k in enumerate(keys)]
    same = [F.col(k).eqNullSafe(F.col(f"_tw_key{i}")) for i, k in enumerate(keys)]
    return table.select(*named, *others), reduce(lambda a, b: a & b, same)


def get_or_create(
    dim: DataFrame,
    rows: DataFrame,
    natural_key: Sequence[str],
    id_col: str = "id",
    now: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """JN-8: (ids, dimension after the inserts).

    ``ids`` is ``rows`` with the id of every row; a key given twice gets one id. Only
    valid dimension rows match (where there is ``is_valid``); of several the lowest id
    counts. Missing keys are inserted, with what ``rows`` says about other columns of the
    dimension (the largest values where rows of a key differ). A null key part equals
    another null. Running it again inserts nothing.
    """
    keys = list(natural_key)
    live = dim.where("is_valid") if "is_valid" in dim.columns else dim
    known = live.groupBy(*keys).agg(F.min(id_col).alias(id_col))
    own = {*keys, id_col, "is_valid", "created_at", "updated_at"}
    more = [c for c in rows.columns if c in dim.columns and c not in own]
    asked = rows.select(*keys).distinct()
    if more:
        asked = rows.groupBy(*keys).agg(F.max(F.struct(*more)).alias("_more")).select(*keys, "_more.*")
    seen, same = _key_of(known, keys)
    fresh = asked.join(seen, same, "left_anti")
    # Numbering reads the new keys twice, and both results below need the same ids even if
    # the dimension has changed by then. So each is written once.
    fresh = store(fresh, "fresh")
    inserted = store(allocate_ids(fresh, keys, next_id(dim, id_col), id_col), "inserted")
    moment = now if now is not None else F.current_timestamp()
    filled = {
        "is_valid": F.lit(True),
        "created_at": moment,
        "updated_at": moment,
    }
    full = inserted.withColumns({c: v for c, v in filled.items() if c in dim.columns})
    after = dim.unionByName(full, allowMissingColumns=True)
    # One situation may be asked for very often: AQE splits its partition of this join.
    found, same = _key_of(known.unionByName(inserted.select(*keys, id_col)), keys, id_col)
    ids = rows.join(found, same, "left")
    return ids.drop(*[f"_tw_key{i}" for i in range(len(keys))]), after


def record_generated(
    generated: DataFrame,
    situations: DataFrame,
    prompts: DataFrame,
    facts: DataFrame,
    key: Sequence[str] = ("situation_id", "prompt_id"),
) -> DataFrame:
    """JN-10: new fact rows with ids. ``facts`` names a situation_id and a prompt_id that
    must both exist; rows that point nowhere are left out (the foreign keys)."""
    valid = facts.join(
        situations.select(F.col("id").alias("situation_id")), "situation_id", "left_semi"
    ).join(prompts.select(F.col("id").alias("prompt_id")), "prompt_id", "left_semi")
    return allocate_ids(valid, key, next_id(generated), "id")


def invalidate(dim: DataFrame, ids: Iterable[int] | DataFrame, id_col: str = "id") -> DataFrame:
    """MUT-1: the next snapshot, with is_valid = false for the listed ids; unknown ids
    change nothing."""
    if not isinstance(ids, DataFrame):
        listed = sorted(set(ids))
        if len(listed) <= LONG_LIST:
            hit = F.col(id_col).isin(listed) if listed else F.lit(False)
            return dim.withColumn("is_valid", F.when(hit, False).otherwise(F.col("is_valid")))
        ids = literal_table(dim.sparkSession, **{id_col: listed})
    gone = ids.select(F.col(id_col).cast(dim.schema[id_col].dataType)).distinct()
    marked = dim.join(gone.withColumn("_gone", F.lit(True)), id_col, "left")
    return marked.withColumn(
        "is_valid", F.when(F.col("_gone"), False).otherwise(F.col("is_valid"))
    ).select(*dim.columns)


def constant_columns(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})
