"""Joins and ranks that stay spread out when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from turnwise.session import store

# Digits of the hash that a histogram takes at a time: 16 ** 3 counts, per stratum.
PREFIX_DIGITS = 3
# A cut is looked for among so many places; prefixes with more are counted by further digits.
MOST_PLACES = 4096
# Strata whose edges, a hash prefix and a number each, are sent to all tasks.
MOST_STRATA = 100_000
# Serial numbers: 16 ** 4 prefixes, a table of fixed size.
SERIAL_DIGITS = 4


def hash_key(key: str | Sequence[str], seed: object) -> Column:
    """A repeatable random order: md5 of the key and the seed (not ``rand``, which
    depends on how the rows are partitioned)."""
    columns = [key] if isinstance(key, str) else list(key)
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns], F.lit(str(seed))))


def lookup_join(df: DataFrame, small: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Left join to a lookup table with one row per key; a null key finds nothing.

    A plain join: the planner broadcasts the lookup table by its measured bytes, and AQE
    splits the partition of a hot key of ``df`` (``spark.sql.adaptive.skewJoin``).
    """
    return df.join(small, [key] if isinstance(key, str) else list(key), "left")


@dataclass(frozen=True)
class Cut:
    """The last (hash, key) of the first rows in hash order, how many rows have exactly that
    place, and how many of these belong to the first ones."""

    h: str
    k: object
    equal: int
    take: int

    def place(self, kind: DataType) -> Column:
        return F.struct(F.lit(self.h).alias("h"), F.lit(self.k).cast(kind).alias("k"))


def place_of(key: str, seed: object) -> Column:
    return F.struct(hash_key(key, seed).alias("h"), F.col(key).alias("k"))


def cut_point(df: DataFrame, key: str, quota: Callable[[int], int], seed: object) -> Cut | None:
    """The cut after the first ``quota(rows)`` rows in hash order; None if there is no such row.

    A histogram of hash prefixes, summed inside the tasks, tells the prefix in which the cut
    lies. The next digits of that prefix alone are counted in the same way until few places
    are left. The driver sees at most 4,096 counts or places at a time, and no row moves.
    """
    rows = df.select(F.col(key).alias("k"), hash_key(key, seed).alias("h"))
    prefix, wanted = "", None
    while True:
        within = rows.where(F.col("h").startswith(prefix)) if prefix else rows
        digits = len(prefix) + PREFIX_DIGITS
        counts = sorted(within.groupBy(F.substring("h", 1, digits).alias("p")).agg(F.count("*").alias("n")).collect())
        if wanted is None:
            wanted = quota(sum(n for _, n in counts))
        if wanted <= 0 or not counts:
            return None
        for prefix, n in counts:
            if wanted <= n:
                break
            wanted -= n
        if n <= MOST_PLACES or digits >= 32:
            break
    places = rows.where(F.col("h").startswith(prefix)).groupBy("h", "k").agg(F.count("*").alias("n"))
    for place in sorted(places.collect(), key=lambda p: (p.h, p.k is not None, p.k)):
        if wanted <= place.n:
            return Cut(place.h, place.k, place.n, wanted)
        wanted -= place.n
    raise RuntimeError("the rows changed between two scans")


def cut_points(
    df: DataFrame, key: str, strata: str, quota: Callable[[Column], Column], seed: object
) -> DataFrame:
    """Per stratum, the (hash, key) of the last row that belongs to the first
    ``quota(rows)`` rows in hash order: a table (stratum, cut) in the shared folder.

    As ``cut_point``, for all strata at once: a histogram per stratum gives the prefix of its
    cut, and rows outside these prefixes are dropped inside the tasks. ``key`` must identify
    a row; copies of a key stay together.
    """
    rows = df.select(F.col(strata).alias("stratum"), F.col(key).alias("k"), hash_key(key, seed).alias("h"))
    edges, digits = None, 0
    while True:
        digits += PREFIX_DIGITS
        prefix = F.substring("h", 1, digits).alias("prefix")
        counted = rows if edges is None else _inside(rows, edges, few, digits - PREFIX_DIGITS)
        start = F.lit(None).cast("bigint").alias("take") if edges is None else F.col("take")
        counts = counted.groupBy("stratum", prefix, start).agg(F.count("*").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("stratum").orderBy("prefix"))
        total = F.sum("n").over(Window.partitionBy("stratum"))
        filled = counts.select("stratum", "prefix", "n", upto.alias("upto"), F.coalesce("take", quota(total)).alias("quota"))
        edges = store(
            filled.where("quota > 0 and upto >= quota and upto - n < quota").select(
                "stratum", "prefix", "n", (F.col("quota") - (F.col("upto") - F.col("n"))).alias("take")
            ),
            "edges",
        )
        most, number = edges.agg(F.max("n"), F.count("*")).first()
        few = number <= MOST_STRATA
        if (most or 0) <= MOST_PLACES or digits >= 32:
            break
    rank = F.row_number().over(Window.partitionBy("stratum").orderBy("h", "k"))
    ranked = _inside(rows, edges, few, digits).withColumn("r", rank)
    return store(ranked.where("r = take").select("stratum", F.struct("h", "k").alias("cut")), "cuts")


def _inside(rows: DataFrame, edges: DataFrame, few: bool, digits: int) -> DataFrame:
    """The rows in the prefixes of ``edges``, one per stratum, with their ``take``. A ``few``
    edges, up to MOST_STRATA, go to all tasks; more are joined as any table."""
    e = edges.select(F.col("stratum").alias("_s"), F.col("prefix").alias("_p"), "take")
    return rows.join(
        F.broadcast(e) if few else e,
        F.col("stratum").eqNullSafe(F.col("_s")) & (F.substring("h", 1, digits) == F.col("_p")),
    ).drop("_s", "_p")


def serial_numbers(df: DataFrame, key: str | Sequence[str], start: Column, name: str) -> DataFrame:
    """Number the rows start, start + 1, ... in hash order of a unique key, without a
    global sort: rank inside a hash prefix, plus the number of rows in earlier prefixes.

    The prefix table has at most 65536 rows whatever the size of ``df``.
    """
    columns = [key] if isinstance(key, str) else list(key)
    hashed = df.withColumn("_h", hash_key(columns, "")).withColumn(
        "_prefix", F.substring("_h", 1, SERIAL_DIGITS)
    )
    counts = hashed.groupBy("_prefix").agg(F.count("*").alias("_n"))
    # One task, but over the prefixes only; the filler partition key keeps the intent explicit.
    earlier = Window.partitionBy(F.lit(0)).orderBy("_prefix")
    offsets = counts.select(
        "_prefix", (F.sum("_n").over(earlier) - F.col("_n")).alias("_offset")
    )
    rank = F.row_number().over(Window.partitionBy("_prefix").orderBy("_h", *columns))
    return (
        hashed.withColumn("_r", rank)
        .join(F.broadcast(offsets), "_prefix")
        .withColumn(name, (start + F.col("_offset") + F.col("_r") - 1).cast("bigint"))
        .drop("_h", "_prefix", "_r", "_offset")
    )
