"""Reports on predictions: classification, confusion, word errors, comparison of two models."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnwise.functions import jsons, let, text
from turnwise.operators.alignment import operations
from turnwise.operators.filters import literal_table

# Rows of a report that are no labels, in their order, and its columns.
SPECIAL_ROWS = ("accuracy", "macro avg", "weighted avg")
METRICS = ("precision", "recall", "f1-score", "support")
# Words of one pair of texts that can be written as single characters.
MAX_SYMBOLS = 1_000_000


def confusion_matrix(
    df: DataFrame, actual: str, predicted: str, abstentions: bool = False
) -> DataFrame:
    """AGG-5: (actual, predicted, n); counts are combined in every task before the shuffle.

    With ``abstentions`` rows without a prediction are counted, under a null prediction.
    """
    both = df.select(F.col(actual).alias("actual"), F.col(predicted).alias("predicted"))
    return (
        both.where("actual is not null" if abstentions else "actual is not null and predicted is not null")
        .groupBy("actual", "predicted")
        .agg(F.count("*").alias("n"))
    )


def wide_confusion(confusion: DataFrame, labels: Sequence[str]) -> DataFrame:
    """AGG-5, wide: one row per actual label, one column per predicted label of the list."""
    wide = confusion.groupBy(F.col("actual").alias("label")).pivot("predicted", list(labels))
    return wide.agg(F.sum("n")).na.fill(0)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def classification_report(
    df: DataFrame, actual: str, predicted: str, abstentions: bool = False
) -> DataFrame:
    """AGG-4: label, precision, recall, f1-score, support, and the three special rows.

    The rows are read once: pair counts, then label sums, then label rows and total in
    one rollup. ``accuracy`` stands in all three score columns of its row. With
    ``abstentions`` a row without a prediction counts in the support of its label, so it
    lowers recall and accuracy, and in no precision; else it is left out.
    """
    pairs = confusion_matrix(df, actual, predicted, abstentions)
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(
            F.col("actual").alias("label"), F.col("n").alias("support"),
            F.lit(0).cast("bigint").alias("guessed"), hit.alias("hits"),
        ),
        F.struct(
            F.col("predicted").alias("label"), F.lit(0).cast("bigint").alias("support"),
            F.col("n").alias("guessed"), F.lit(0).cast("bigint").alias("hits"),
        ),
    )
    per_label = (
        pairs.select(F.inline(sides))
        .where("label is not null")
        .groupBy("label")
        .agg(*[F.sum(c).alias(c) for c in ("support", "guessed", "hits")])
        .withColumn("precision", _ratio(F.col("hits"), F.col("guessed")))
        .withColumn("recall", _ratio(F.col("hits"), F.col("support")))
        .withColumn("f1", _ratio(2 * F.col("hits"), F.col("guessed") + F.col("support")))
    )
    scores = ("precision", "recall", "f1")
    rolled = per_label.rollup("label").agg(
        F.grouping("label").alias("total"),
        F.sum("support").alias("support"),
        _ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
        *[F.avg(c).alias(c) for c in scores],
        *[_ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(f"w_{c}")
          for c in scores],
    )
    row = lambda label, p, r, f: F.struct(
        label.alias("label"), p.alias("precision"), r.alias("recall"), f.alias("f1-score"),
        F.col("support").cast("double").alias("support"),
    )
    c = F.col
    plain = F.array(row(c("label"), c("precision"), c("recall"), c("f1")))
    special = F.array(
        row(F.lit("accuracy"), c("accuracy"), c("accuracy"), c("accuracy")),
        row(F.lit("macro avg"), c("precision"), c("recall"), c("f1")),
        row(F.lit("weighted avg"), c("w_precision"), c("w_recall"), c("w_f1")),
    )
    return rolled.select(F.inline(F.when(c("total") == 1, special).otherwise(plain)))


def order_report(df: DataFrame, label: str = "label") -> DataFrame:
    """SRT-3: labels by name, then the special rows in their order."""
    rank = F.coalesce(
        F.nullif(F.array_position(F.lit(list(SPECIAL_ROWS)), F.col(label)), F.lit(0)), F.lit(0)
    )
    return df.orderBy(rank, label)


def label_union(a: DataFrame, b: DataFrame, label: str = "label") -> DataFrame:
    """SET-3: the distinct labels of both sides."""
    return a.select(label).union(b.select(label)).distinct()


def compare_classification_reports(r1: DataFrame, r2: DataFrame | None = None) -> DataFrame:
    """JN-6: per label, struct (first, second) of every metric; a missing side is null.

    Labels of both reports, without null labels; the special rows are always there.
    Without a second report the first one is given back.
    """
    if r2 is None:
        return r1
    specials = literal_table(r1.sparkSession, label=SPECIAL_ROWS)
    tagged = (
        r1.select("label", *[F.col(f"`{m}`") for m in METRICS], F.lit(1).alias("_side"))
        .unionByName(
            r2.select("label", *[F.col(f"`{m}`") for m in METRICS], F.lit(2).alias("_side"))
        )
        .unionByName(specials, allowMissingColumns=True)
        .where("label is not null")
    )
    side = lambda m, i: F.max(F.when(F.col("_side") == i, F.col(f"`{m}`")))
    grouped = tagged.groupBy("label").agg(
        *[
            F.struct(side(m, 1).alias("first"), side(m, 2).alias("second")).alias(m)
            for m in METRICS
        ]
    )
    return order_report(grouped)


def compare_confusion(m1: DataFrame, m2: DataFrame | None = None) -> DataFrame:
    """JN-7: (actual, predicted, first, second) for every pair counted in either matrix.

    A pair that one model never produced counts 0 if that matrix knows both labels, else
    it is null. Pairs that neither produced are left out of this long form.
    """
    if m2 is None:
        m2 = m1.limit(0)
    both = m1.withColumn("_side", F.lit(1)).unionByName(m2.withColumn("_side", F.lit(2)))
    count = lambda i: F.sum(F.when(F.col("_side") == i, F.col("n")))
    pairs = both.groupBy("actual", "predicted").agg(count(1).alias("n1"), count(2).alias("n2"))
    # The labels of both matrices, from the pairs already counted.
    known = (
        pairs.select(F.explode(F.array("actual", "predicted")).alias("label"), "n1", "n2")
        .groupBy("label")
        .agg(F.max(F.col("n1").isNotNull()).alias("k1"), F.max(F.col("n2").isNotNull()).alias("k2"))
    )
    a = known.select(F.col("label").alias("actual"), F.col("k1").alias("a1"), F.col("k2").alias("a2"))
    p = known.select(
        F.col("label").alias("predicted"), F.col("k1").alias("p1"), F.col("k2").alias("p2")
    )
    full = pairs.join(a, "actual").join(p, "predicted")
    side = lambda i: F.coalesce(
        F.col(f"n{i}"), F.when(F.col(f"a{i}") & F.col(f"p{i}"), F.lit(0).cast("bigint"))
    )
    return full.select("actual", "predicted", side(1).alias("first"), side(2).alias("second"))


def words(c: Column) -> Column:
    """The words of a text, split at any blank."""
    # Splitting at one fixed character needs no regular expression per row.
    even = F.translate(F.coalesce(c, F.lit("")), text.WHITESPACE, " " * len(text.WHITESPACE))
    return F.array_remove(F.split(even, " "), "")


def _symbols(listed: Column, vocabulary: Column) -> Column:
    """A text with one character per word: the place of the word in the vocabulary."""
    number = lambda w: F.array_position(vocabulary, w) + 0xFFFF
    as_hex = F.transform(listed, lambda w: F.lpad(F.hex(number(w)), 8, "0"))
    return F.decode(F.unhex(F.array_join(as_hex, "")), "UTF-32")


def word_distance(truth: Column, hypothesis: Column) -> Column:
    """Word-level edit distance of two word arrays of at most MAX_SYMBOLS words
    together, inside the JVM."""
    return let(
        F.array_distinct(F.concat(truth, hypothesis)),
        lambda v: F.levenshtein(_symbols(truth, v), _symbols(hypothesis, v)),
    )


def asr_pairs(
    df: DataFrame, id: str = "id", truth: str = "transcript_y", hyp: str = "utterances"
) -> DataFrame:
    """Truth and best hypothesis per row; a missing hypothesis counts as an empty list."""
    listed = F.coalesce(F.col(hyp), F.lit("[]"))
    return df.select(
        F.col(id).alias("id"),
        F.coalesce(F.col(truth), F.lit("")).alias("truth"),
        F.coalesce(jsons.primary_transcript(listed), F.lit("")).alias("hypothesis"),
    )


def edit_operations(pairs: DataFrame) -> DataFrame:
    """AGG-6, operations: (id, insertions, deletions, substitutions, hits) per pair.

    The alignment has the fewest errors and, among those, the most hits. The number of errors
    is worked out inside the JVM first and bounds the band in which whole batches of pairs are
    aligned, so the work grows with length times errors.
    """

    def align(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        names = ["id", "insertions", "deletions", "substitutions", "hits"]
        for batch in batches:
            sides = [batch.column("_t"), batch.column("_h")]
            codes = pa.concat_arrays([side.flatten() for side in sides]).dictionary_encode().indices.to_numpy()
            lists = []
            for side in sides:
                ends = np.cumsum(side.value_lengths().to_numpy())
                lists.append(np.split(codes[: ends[-1]], ends[:-1]) if len(ends) else [])
                codes = codes[ends[-1] :] if len(ends) else codes
            table = operations(*lists, batch.column("_errors").to_pylist())
            columns = [pa.array(table[:, k]) for k in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names)

    kind = pairs.schema["id"].dataType.simpleString()
    listed = pairs.select(
        "id", words(F.col("truth")).alias("_t"), words(F.col("hypothesis")).alias("_h")
    )
    usual = F.size("_t") + F.size("_h") <= MAX_SYMBOLS
    distance = F.when(usual, word_distance(F.col("_t"), F.col("_h"))).cast("bigint")
    return listed.withColumn("_errors", distance).mapInArrow(
        align,
        f"id {kind}, insertions bigint, deletions bigint, substitutions bigint, hits bigint",
    )


def asr_breakdown(pairs: DataFrame) -> DataFrame:
    """AGG-6, per row: reference words, hypothesis words, word errors, error rate.

    Pairs with too many words for the in-JVM distance take the pandas path, so there is no
    limit on the length of a text.
    """
    listed = pairs.withColumns({"_t": words(F.col("truth")), "_h": words(F.col("hypothesis"))})
    # No more distinct words than words, so only a vast pair can exceed the symbols.
    vast = F.size("_t") + F.size("_h") > MAX_SYMBOLS
    usual = listed.where(~vast).select(
        "id",
        F.size("_t").cast("bigint").alias("ref_words"),
        F.size("_h").cast("bigint").alias("hyp_words"),
        word_distance(F.col("_t"), F.col("_h")).cast("bigint").alias("errors"),
    )
    ops = edit_operations(listed.where(vast).select("id", "truth", "hypothesis"))
    long = ops.select(
        "id",
        F.expr("hits + substitutions + deletions").alias("ref_words"),
        F.expr("hits + substitutions + insertions").alias("hyp_words"),
        F.expr("insertions + deletions + substitutions").alias("errors"),
    )
    return usual.unionByName(long).withColumn(
        "wer", F.when(F.col("ref_words") > 0, F.col("errors") / F.col("ref_words"))
    )


def asr_summary(breakdown: DataFrame) -> DataFrame:
    """AGG-6, corpus: rows, reference words, word errors, word error rate."""
    return breakdown.agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum("ref_words"), F.lit(0)).alias("ref_words"),
        F.coalesce(F.sum("errors"), F.lit(0)).alias("errors"),
        (F.sum("errors") / F.nullif(F.sum("ref_words"), F.lit(0))).alias("wer"),
    )


def asr_report(
    df: DataFrame, id: str = "id", truth: str = "transcript_y", hyp: str = "utterances"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """AGG-6: (report, breakdown, operations)."""
    pairs = asr_pairs(df, id, truth, hyp)
    breakdown = asr_breakdown(pairs)
    return asr_summary(breakdown), breakdown, edit_operations(pairs)
