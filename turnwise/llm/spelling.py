"""Grouping of spelling variants by asymmetric q-chunks (DataFrame functions only).

Two words are near if one inserted, deleted or replaced code point parts them. Of such a pair
one word, the shorter one if they differ in length, contributes two disjoint chunks, its
halves; the other contributes positional grams. The one edit spoils at most one chunk, so the
other one stands in the partner as a gram, at its place or, behind an inserted code point,
one further on: the join is within shift one. Where the left chunk holds, the edit lies in the
right half, and the other way round, so that half is cut into two chunks again. Keys that
still hold many words are cut on until they do not, so no group of words is compared pair by
pair as a whole, however many words share a chunk. Matches are verified by edit distance.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnwise.session import store

LEAST_LENGTH, LEAST_COUNT = 7, 2
# A form is so many times as frequent as its variant.
RATIO = 10
# Cuts that every word gets, and the rows from which a key is cut further.
CUTS, GROUP = 2, 256


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words_of(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per occurrence: ``word``, of LEAST_LENGTH code points or more.

    A maximal run of letters, small where it was A-Z, loses the code point h % length where 31
    divides h, the CRC-32 of ``<id>:<run>``. A null id counts as an empty text there, a null
    text has no words. Each of repeated rows counts.
    """
    # A run under the least length gives no word, so only longer ones are taken out.
    runs = F.regexp_extract_all(lower_ascii(F.col(text)), F.lit(f"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}"), 0)
    found = docs.select(
        F.coalesce(F.col(id).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run")
    )
    hashed = found.select("run", F.crc32(F.concat_ws(":", "id", "run")).alias("h"))
    at = F.pmod("h", F.length("run")).cast("int")
    shorter = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    word = F.when(F.col("h") % 31 == 0, shorter).otherwise(F.col("run"))
    return hashed.select(word.alias("word")).where(F.length("word") >= LEAST_LENGTH)


def vocabulary(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): the distinct words with LEAST_COUNT occurrences or more. Occurrences are
    summed up inside the tasks first."""
    counted = words_of(docs, id, text).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def positions(words: DataFrame) -> DataFrame:
    """Every word in its roles, before any cut: with ``shift`` 0 for partners of its length
    (chunks and grams), with 1 for chunks of partners one shorter (grams only). ``len`` is the
    length of the word that gives the chunks; ``lo`` and ``hi`` bound where in it the edit lies."""
    roles = words.select("word", "n", F.explode(F.array(F.lit(0), F.lit(1))).alias("shift"))
    rows = roles.withColumn("len", F.length("word") - F.col("shift"))
    # The shortest words have no partner one shorter.
    return rows.where(F.col("len") >= LEAST_LENGTH).select(
        "word", "n", "shift", "len", F.lit(0).alias("lo"), F.col("len").alias("hi"), F.xxhash64("len").alias("key")
    )


def cut(rows: DataFrame) -> DataFrame:
    """Two rows for each: the left chunk of [lo, hi) holds and the edit lies right of it, or
    the right chunk holds. A chunk or gram enters the key with its side."""
    middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    left = F.substring(F.col("word"), F.col("lo") + 1, F.col("mid") - F.col("lo"))
    right = F.substring(F.col("word"), F.col("mid") + F.col("shift") + 1, F.col("hi") - F.col("mid"))
    sides = F.array(
        F.struct(F.xxhash64("key", F.lit(0), left).alias("key"), F.col("mid").alias("lo"), F.col("hi").alias("hi")),
        F.struct(F.xxhash64("key", F.lit(1), right).alias("key"), F.col("lo").alias("lo"), F.col("mid").alias("hi")),
    )
    each = rows.withColumn("mid", middle).select("word", "n", "shift", "len", F.explode(sides).alias("s"))
    return each.select("word", "n", "shift", "len", "s.lo", "s.hi", "s.key")


def _matched(rows: DataFrame) -> DataFrame:
    """The near pairs among rows of one key: word, n, other, other_n, each pair once."""
    chunks = rows.where("shift = 0").select("key", "word", "n", "lo", "hi", "len")
    grams = rows.select("key", F.col("word").alias("other"), F.col("n").alias("other_n"))
    head = lambda c, n: F.substring(F.col(c), F.lit(1), F.col(n))
    longer = F.length("other") - F.col("len")
    condition = (
        (chunks["key"] == grams["key"])
        & ((longer == 1) | (longer == 0) & (F.col("word") < F.col("other")))
        # An insertion can be seen at several places of a run of equal letters. Only the last
        # of them counts, where the common start of the words ends.
        & (head("word", "lo") == head("other", "lo"))
        & ((F.col("hi") == F.col("len")) | (head("word", "hi") != head("other", "hi")))
        & (F.levenshtein("word", "other", 1) == 1)
    )
    return chunks.join(grams, condition).select("word", "n", "other", "other_n")


def near_pairs(words: DataFrame, cuts: int = CUTS, group: int = GROUP) -> DataFrame:
    """All pairs of words one edit apart, each once: word, n, other, other_n. ``words`` has
    distinct words and n; words under LEAST_LENGTH have no pair.

    Keys of more than ``group`` rows are cut again, round by round, until at most one letter
    is open (two in a partner that is one longer), where a key has no more rows than the
    alphabet allows.
    """
    rows = positions(words)
    for _ in range(cuts):
        rows = cut(rows)
    pairs = None
    while True:
        # Where at most one code point is open, a cut parts nothing.
        counts = rows.groupBy("key").agg(F.count("*").alias("c"), F.max(F.col("hi") - F.col("lo")).alias("open"))
        crowded = store(counts.where((F.col("c") > group) & (F.col("open") > 1)).select("key"), "crowded")
        some = not crowded.isEmpty()
        here = _matched(rows.join(crowded, "key", "left_anti") if some else rows)
        pairs = here if pairs is None else pairs.unionByName(here)
        if not some:
            return pairs
        rows = store(cut(rows.join(crowded, "key", "left_semi")), "cut")


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """(word, root) of words with a form: forms followed to the last. A form is RATIO times as
    frequent, so a chain has few steps; each round doubles the steps that are followed."""
    steps = math.floor(math.log(max(most, RATIO) / LEAST_COUNT, RATIO)) + 1
    jumps = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps + 1))):
        onward = jumps.select(F.col("word").alias("_at"), F.col("root").alias("_to"))
        joined = jumps.join(onward, F.col("root") == F.col("_at"), "left")
        jumps = joined.select("word", F.coalesce("_to", "root").alias("root"))
    return jumps


def group_variants(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for each of (word, n).

    The form of a word is its most frequent near word, the first in code-point order among
    equals, if that is RATIO times as frequent or more; else null. The root is the end of the
    chain of forms, the word itself without one. An empty table gives no row.
    """
    words = store(words, "words")
    pairs = near_pairs(words)
    ways = F.array(
        F.struct(F.col("word").alias("of"), F.col("other").alias("near"), F.col("other_n").alias("near_n")),
        F.struct(F.col("other").alias("of"), F.col("word").alias("near"), F.col("n").alias("near_n")),
    )
    both = pairs.select(F.explode(ways).alias("p")).select("p.of", "p.near", "p.near_n")
    # The least of (-n, word) is the most frequent and then first word.
    best = both.groupBy("of").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near"))).alias("b")
    )
    joined = words.join(best, F.col("word") == F.col("of"), "left")
    chosen = -F.col("b.m") >= RATIO * F.col("n")
    formed = store(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(chosen, F.col("b.near")).alias("form"), F.when(chosen, -F.col("b.m")).alias("form_n"),
        ),
        "formed",
    )
    most = formed.agg(F.max("n")).first()[0] or 0
    roots = _roots(formed.where("form IS NOT NULL"), most).withColumnRenamed("word", "_word")
    out = formed.join(roots, F.col("word") == F.col("_word"), "left")
    return out.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
