"""Mixing sources to target weights by pivotal dependent rounding (DataFrame functions only).

A document of a source whose target is ``r`` times its size is wanted ``r`` times. The whole
part of ``r`` is taken as it is; the rest is a copy probability. Within a group, two open
probabilities at a time pass words from one to the other until one of them is 0 or 1. What is
left open in a group meets the rest of the other groups on the next level, so a source of any
size is a tree of small groups and no task ever holds a source.

Words move, not copies, so the words of a source stay at its target but for the one document
that is open at the end. Groups go from the largest document to the smallest, so that one is
small as a rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnwise.functions import let
from turnwise.session import store

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
# Documents that meet in one group of the tree. Rounding a group costs its size squared.
GROUP = 128
SEED = 7
_EPS = 1e-9


def words(text: Column) -> Column:
    """Number of words; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(
    units: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP
) -> DataFrame:
    """One row per source: source, source_size, n (documents), target, ratio (target by size).

    ``units`` has source, size and m (rows of that kind). Sources in code-point order, null
    last, take the weights in turn. The targets are the level ``t * weight``, stopped at
    ``cap`` times the size of a source, at which they add up to ``share`` of all sizes: the
    sources are sorted by the level at which they stop, and running sums tell which stop.
    There is one row per source here, so the ordered windows run over the list of sources.
    """
    sums = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("m")).alias("source_size"), F.count("*").alias("n")
    )
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int")
    )
    limit = cap * F.col("source_size")
    listed = sums.withColumn("weight", weight).withColumn("stop", limit / F.col("weight"))
    by_stop = Window.orderBy("stop", F.col("source").asc_nulls_last())
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    level = (share * F.sum("source_size").over(whole) - F.coalesce(F.sum(limit).over(before), F.lit(0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    # The first source that does not stop gives the level of all that follow.
    first = F.min(
        F.when(F.col("level") <= F.col("stop"), F.struct("place", "level"))
    ).over(whole)
    levels = (
        listed.withColumn("level", level)
        .withColumn("place", F.row_number().over(by_stop))
        .withColumn("level", first["level"])
    )
    target = F.least(limit.cast("double"), F.col("weight") * F.col("level"))
    return levels.select(
        "source", "source_size", "n", F.coalesce(target, limit.cast("double")).alias("target")
    ).withColumn(
        "ratio",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0),
    )


def _chance(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the parts only."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) / F.lit(float(1 << 52))


def _round_group(items: Column, level: int) -> Column:
    """Folds an ordered array of (key, p, s) to struct(open, done): at most one open item, and
    for all others (key, copy 0 or 1).

    Two items pass words to each other: what one gains times its size the other loses times
    its own, up to where one of them is whole. The direction is drawn so that every
    probability keeps its mean.
    """
    item = "struct<key:bigint,p:double,s:double>"
    none = F.lit(None).cast(item)
    no_copies = F.array().cast("array<struct<key:bigint,copy:int>>")
    start = F.struct(none.alias("open"), no_copies.alias("done"))
    whole = lambda p: (p < _EPS) | (p > 1 - _EPS)
    closed = lambda x: F.when(
        whole(x["p"]), F.array(F.struct(x["key"].alias("key"), F.round(x["p"]).cast("int").alias("copy")))
    ).otherwise(no_copies)

    def passed(a: Column, b: Column) -> Column:
        """Both items after the words went from one to the other."""
        up = F.least((1 - a["p"]) * a["s"], b["p"] * b["s"])
        down = F.least(a["p"] * a["s"], (1 - b["p"]) * b["s"])
        u = _chance(F.lit(SEED), F.lit(level), a["key"], b["key"])
        moved = lambda m: F.when(u * (m["up"] + m["down"]) < m["down"], m["up"]).otherwise(-m["down"])
        with_p = lambda x, p: F.struct(x["key"].alias("key"), p.alias("p"), x["s"].alias("s"))
        return let(
            let(F.struct(up.alias("up"), down.alias("down")), moved),
            lambda words: F.struct(
                with_p(a, a["p"] + words / a["s"]).alias("a"), with_p(b, b["p"] - words / b["s"]).alias("b")
            ),
        )

    def step(state: Column, b: Column) -> Column:
        after = lambda x: F.struct(
            F.when(~whole(x["a"]["p"]), x["a"]).when(~whole(x["b"]["p"]), x["b"]).alias("open"),
            F.concat(state["done"], closed(x["a"]), closed(x["b"])).alias("done"),
        )
        return F.when(
            state["open"].isNull(), F.struct(b.alias("open"), state["done"].alias("done"))
        ).otherwise(let(passed(state["open"], b), after))

    return F.aggregate(items, start, step)


def round_copies(items: DataFrame) -> DataFrame:
    """Rows (source, n, key, size, p) with 0 < p < 1 and distinct keys: gives (key, copy).

    ``n`` is the number of rows of the source at most. Every level is written to the shared
    folder, so a lost executor repeats one small level only.
    """
    spark = items.sparkSession
    most = items.agg(F.max("n")).first()[0]
    done = spark.createDataFrame([], "key bigint, copy int")
    open_items, level, last = items, 0, False
    while most is not None and not last:
        last = most <= GROUP
        most = -(-most // GROUP)
        groups = F.ceil(F.col("n") / GROUP)
        grouped = (
            open_items.withColumn("groups", groups)
            .withColumn("g", F.pmod(F.xxhash64(F.lit(level), "key"), "groups"))
            .groupBy("source", "g", F.col("groups").alias("n"))
            .agg(F.array_sort(F.collect_list(F.struct((-F.col("size")).alias("s"), "key", "p"))).alias("l"))
        )
        plain = F.transform(
            "l", lambda x: F.struct(x["key"].alias("key"), x["p"].alias("p"), (-x["s"]).cast("double").alias("s"))
        )
        folded = store(
            grouped.select("source", "n", _round_group(plain, level).alias("r")).select("source", "n", "r.*"),
            "rounding",
        )
        done = done.unionByName(folded.select(F.inline("done")))
        open_items = folded.where("open is not null").select(
            "source", "n", "open.key", F.col("open.s").alias("size"), "open.p"
        )
        level += 1
    # The root of a source: one open document at most, taken by its own chance.
    root = open_items.select(
        "key", (_chance(F.lit(SEED), F.lit(-1), F.col("key")) < F.col("p")).cast("int").alias("copy")
    )
    return done.unionByName(root) if level else done


def mix_copies(
    docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, id: str = "doc_id"
) -> DataFrame:
    """How often the mix takes each document: id, source, size, m (rows), source_size, target,
    copies (of all m rows together).

    Rows alike in id, source, size and text hash are one unit of m rows, which gives floor(m
    * ratio) copies and one more by rounding. A null source is a source; a null or empty text
    has size 0 and is never taken.
    """
    units = store(
        docs.select(
            F.col(id).alias("id"), "source", words(F.col("text")).alias("size"),
            F.xxhash64("text").alias("h"),
        )
        .groupBy("id", "source", "size", "h")
        .agg(F.count("*").alias("m")),
        "units",
    )
    targets = store(source_targets(units, weights, share, cap), "targets")
    wanted = (
        units.join(targets, units["source"].eqNullSafe(targets["source"]))
        .drop(targets["source"])
        .withColumn("key", F.xxhash64("id", "source", "size", "h"))
        .withColumn("e", F.col("m") * F.col("ratio"))
        .withColumn("e", F.when(F.abs(F.col("e") - F.round("e")) < _EPS, F.round("e")).otherwise(F.col("e")))
        .withColumn("whole", F.when(F.col("size") > 0, F.floor("e")).otherwise(0))
    )
    rest = wanted.where("size > 0 and e > whole").select(
        "source", "n", "key", "size", (F.col("e") - F.col("whole")).alias("p")
    )
    rounded = round_copies(rest)
    return (
        wanted.join(rounded, "key", "left")
        .withColumn("copies", F.col("whole") + F.coalesce("copy", F.lit(0)))
        .select("id", "source", "size", "h", "m", "source_size", "target", "copies")
        .withColumnRenamed("id", id)
    )


def mixed_rows(decided: DataFrame) -> DataFrame:
    """One row per document again: the copies of a unit dealt to its m rows."""
    row = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("m") - 1)).alias("i")
    share = F.floor(F.col("copies") / F.col("m")) + (F.col("i") < F.col("copies") % F.col("m")).cast("int")
    return decided.select("*", row).withColumn("copies", share.cast("bigint"))


def mix_documents(
    docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, id: str = "doc_id"
) -> DataFrame:
    """The mix itself: every document as many times as it is taken, with its own columns."""
    decided = store(
        mix_copies(docs, weights, share, cap, id).where("copies > 0").select(
            F.col(id).alias("_tw_id"), F.col("source").alias("_tw_source"), F.col("h").alias("_tw_h"),
            F.col("m").alias("_tw_m"), F.col("copies").alias("_tw_copies"),
        ),
        "decided",
    )
    joined = docs.withColumn("_tw_hash", F.xxhash64("text")).join(
        decided,
        F.col(id).eqNullSafe(F.col("_tw_id")) & F.col("source").eqNullSafe(F.col("_tw_source"))
        & (F.col("_tw_hash") == F.col("_tw_h")),
    )
    columns = [F.col(f"`{c}`") for c in docs.columns]
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_tw_take"))).alias("_tw_copy")
    once = joined.where("_tw_m = 1").withColumn("_tw_take", F.col("_tw_copies"))
    if not decided.where("_tw_m > 1").isEmpty():
        # Repeated rows are alike, so any order deals the copies of a unit to them.
        place = F.row_number().over(Window.partitionBy("_tw_id", "_tw_source", "_tw_h").orderBy("_tw_m")) - 1
        part = F.floor(F.col("_tw_copies") / F.col("_tw_m")) + (
            place < F.col("_tw_copies") % F.col("_tw_m")
        ).cast("int")
        several = joined.where("_tw_m > 1").withColumn("_tw_take", part).where("_tw_take > 0")
        once = once.unionByName(several)
    return once.select(*columns, copies).drop("_tw_copy")
