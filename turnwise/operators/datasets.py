"""Training and test sets: stacking, splitting, combining, word lists, snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnwise.functions import jsons
from turnwise.operators.evaluation import words
from turnwise.operators.skew import cut_point, cut_points, hash_key, lookup_join, place_of


def stack(*parts: DataFrame | None) -> DataFrame:
    """All rows of all given tables, by column name; missing columns become null."""
    given = [p for p in parts if p is not None]
    if not given:
        raise ValueError("no table to stack")
    out = given[0]
    for part in given[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def merge_tagged_sources(
    annotated: DataFrame | None, uploaded: DataFrame | None, tag: str = "tag"
) -> DataFrame:
    """SET-1: the first tag of every row of both sources, stacked. One side may be None."""
    if annotated is None and uploaded is None:
        raise ValueError("annotated or uploaded rows are needed")
    tagged = [
        p.withColumn(tag, jsons.first_tag(F.col(tag)))
        for p in (annotated, uploaded)
        if p is not None
    ]
    return stack(*tagged)


def split_train_test(
    df: DataFrame,
    key: str,
    train_percent: int = 85,
    stratify: str | None = None,
    seed: object = 0,
    name: str = "split",
) -> DataFrame:
    """WIN-2: adds "train" or "test"; exactly floor(n * percent / 100) train rows, per
    label if ``stratify`` names one. Null labels are a stratum of their own.

    ``key`` identifies a row. The order is a hash, so the split does not depend on
    partitioning; ``df`` itself is not shuffled unless there are very many labels.
    """
    if not 0 <= train_percent <= 100:
        raise ValueError(f"train_percent is {train_percent}")
    place = place_of(key, seed)
    side = lambda cut: F.when(F.coalesce(place <= cut, F.lit(False)), "train").otherwise("test")
    if stratify is None:
        cut = cut_point(df, key, lambda n: n * train_percent // 100, seed)
        return df.withColumn(name, side(cut.place(df.schema[key].dataType)) if cut else F.lit("test"))
    cuts = cut_points(df, key, stratify, lambda n: F.call_function("div", n * train_percent, F.lit(100)), seed)
    # A null label joins too, under a marker that no label can be.
    marked = lambda c: F.struct(F.col(c).isNull().alias("n"), F.coalesce(
        F.col(c).cast("string"), F.lit("")).alias("v"))
    table = cuts.select(marked("stratum").alias("_stratum"), F.col("cut").alias("_cut"))
    joined = lookup_join(df.withColumn("_stratum", marked(stratify)), table, "_stratum")
    return joined.withColumn(name, side(F.col("_cut"))).drop("_stratum", "_cut")


def split_by_bucket(
    df: DataFrame, key: str, train_percent: int = 85, seed: object = 0, name: str = "split"
) -> DataFrame:
    """WIN-2, approximate: a hash threshold per row. One pass, no exact count."""
    number = F.conv(F.substring(hash_key(key, seed), 1, 8), 16, 10).cast("bigint")
    share = number % 10_000 < train_percent * 100
    return df.withColumn(name, F.when(share, "train").otherwise("test"))


def combine_train_test(
    new: DataFrame,
    key: str,
    old_train: DataFrame | None = None,
    old_test: DataFrame | None = None,
    custom_test: DataFrame | None = None,
    use_previous: bool = True,
    train_percent: int = 85,
    stratify: str | None = None,
    initial: bool = False,
    seed: object = 0,
) -> tuple[DataFrame, DataFrame | None]:
    """SET-2: (train, test) from new rows, earlier sets and an optional held-out set.

    A held-out set makes all new rows train rows and is itself the test set. A first
    training knows no earlier rows. Without a split the earlier test set is used.
    """
    if initial:
        use_previous = False
    if custom_test is not None:
        train_percent = 100
    before = old_train if use_previous else None
    if train_percent < 100:
        parts = split_train_test(new, key, train_percent, stratify, seed, "_split")
        side = lambda s: parts.where(F.col("_split") == s).drop("_split")
        train = stack(before, side("train"))
        test = stack(old_test if use_previous else None, side("test"))
    else:
        train, test = stack(before, new), None if initial else old_test
    return train, custom_test if custom_test is not None else test


def latest_snapshot(df: DataFrame, date_col: str, run_col: str) -> DataFrame:
    """WIN-4: rows of the newest run of the newest date.

    The newest pair is one value, found first; where the columns are partition columns
    the scan then reads one partition.
    """
    pair = F.max(F.struct(F.col(date_col).alias("d"), F.col(run_col).alias("r")))
    newest = df.agg(pair.alias("m"))
    day = newest.select("m.d").scalar()
    run = newest.select("m.r").scalar()
    return df.where((F.col(date_col) == day) & (F.col(run_col) == run))


def vocabulary(
    corpus: DataFrame,
    col: str,
    augment: DataFrame | None = None,
    remove: DataFrame | None = None,
) -> DataFrame:
    """AGG-7: distinct words of a corpus, plus the words of ``augment``, minus ``remove``."""
    found = corpus.select(F.explode(words(F.col(col))).alias("word"))
    if augment is not None:
        found = found.unionByName(augment.select("word"))
    unique = found.distinct()
    return unique.join(remove.select("word"), "word", "left_anti") if remove is not None else unique


def merge_lexicons(base: DataFrame, extra: DataFrame) -> DataFrame:
    """SET-4: all lexicon rows of both tables, each once."""
    return base.unionByName(extra).distinct()


def corpus_lines(df: DataFrame, col: str) -> Column:
    """The text of a line: anything that is no text becomes an empty line."""
    c = F.col(col)
    return F.coalesce(c if df.schema[col].dataType.typeName() == "string" else F.lit(""), F.lit(""))
