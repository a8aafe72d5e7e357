"""Quality classifier: random Fourier features of document statistics, ridge regression by
partition-summed normal equations, isotonic calibration.

The statistics of a text are numbers about its bytes, words and lines. Cosines of random
projections of them stand for a Gaussian kernel. Each task sums its part of the normal
equations; the sums have a fixed size. The fitted score becomes a probability by isotonic
regression on scores of labelled rows by weights that were fitted without their fold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from turnwise.session import store

FEATURES = 256
GAMMA = 0.05
RIDGE = 1.0
SEED = 11
THRESHOLD = 0.7
# Bound of the labelled rows that are used to fit; a hash of the id chooses among more.
MOST_LABELLED = 200_000
# The fit runs in so many tasks, so the summed equations are a fixed number of small tables.
FIT_TASKS = 8
# The folds of crc32 modulo 4 whose labels may be seen; the other one is held out.
FOLDS = (0, 1, 3)
# Scores are counted in so many steps for the calibration.
STEPS = 2_000
STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "word_spread", "long_words", "short_words",
    "upper", "digit", "space", "newline", "stop", "comma", "exclaim", "hash_signs", "pipe",
    "other_marks", "wide", "distinct_words", "top_word", "top_pair", "line_words",
    "line_spread", "distinct_lines", "upper_words", "marked_words", "ends_stop", "entropy",
)


def _classes() -> np.ndarray:
    """The class of every byte: a row of the count table."""
    kind = np.full(256, 11, np.uint8)
    groups = (
        (range(ord("a"), ord("z") + 1), 0), (range(ord("A"), ord("Z") + 1), 1),
        (b"0123456789", 2), (b" \t\v\f\r", 3), (b"\n", 4), (b".", 5), (b",;:", 6), (b"!?", 7),
        (b"#$%&*@^~+=<>_\\", 8), (b"|", 9), (b"\"'()-/[]{}`", 10),
    )
    for chars, number in groups:
        kind[list(chars)] = number
    kind[128:] = 12
    return kind


_KIND = _classes()


def statistics(text: str | None) -> list[float]:
    """The numbers of STATISTICS; all are defined for an empty text."""
    data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    n = len(data)
    if n == 0:
        return [0.0] * len(STATISTICS)
    kind = _KIND[data]
    counts = np.bincount(kind, minlength=13)
    blank = (kind == 3) | (kind == 4)
    edges = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    words = len(starts)
    lengths = ends - starts
    # Words are compared by a hash of their bytes, made from running sums.
    weights = np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    weights ^= weights >> np.uint64(29)
    if words:
        first = np.repeat(starts, lengths)
        inside = ~blank
        place = np.flatnonzero(inside) - first
        mixed = (data[inside].astype(np.uint64) + np.uint64(1)) * (weights[place] | np.uint64(1))
        hashes = np.add.reduceat(mixed, np.cumsum(lengths) - lengths)
        same = np.unique(hashes, return_counts=True)[1]
        pairs = hashes[1:] * np.uint64(3) + hashes[:-1]
        top_pair = np.unique(pairs, return_counts=True)[1].max() / len(pairs) if len(pairs) else 0.0
        upper_start = np.add.reduceat((kind == 1).astype(np.int64), starts)
        letters = np.add.reduceat((kind == 0).astype(np.int64), starts)
        last = kind[ends - 1]
        upper_words = np.mean((upper_start > 1) & (letters == 0))
        marked = np.mean((last >= 7) & (last <= 10))
    else:
        same, top_pair, upper_words, marked = np.zeros(1), 0.0, 0.0, 0.0
    cuts = np.flatnonzero(kind == 4)
    line_starts = np.concatenate([[0], cuts + 1])
    line_starts = line_starts[line_starts < n]
    line_lengths = np.diff(np.concatenate([line_starts, [n]]))
    # A line's own sum: its bytes weighted by their place in the line.
    place = np.arange(n) - np.repeat(line_starts, line_lengths)
    line_sums = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * (weights[place] | np.uint64(1)), line_starts)
    lines = len(line_starts)
    closing = kind[np.concatenate([cuts, [n]]) - 1][np.concatenate([cuts, [n]]) > 0]
    share = counts / n
    seen = same / max(words, 1)
    entropy = float(-(seen[seen > 0] * np.log(seen[seen > 0])).sum()) / max(np.log(max(words, 2)), 1.0)
    mean = lengths.mean() if words else 0.0
    return [
        float(np.log1p(n)), float(np.log1p(words)), float(mean), float(lengths.std()) if words else 0.0,
        float(np.mean(lengths > 12)) if words else 0.0, float(np.mean(lengths < 3)) if words else 0.0,
        float(share[1]), float(share[2]), float(share[3]), float(share[4]), float(share[5]),
        float(share[6]), float(share[7]), float(share[8]), float(share[9]),
        float(share[10] + share[11]), float(share[12]),
        len(same) / max(words, 1), float(same.max()) / max(words, 1), float(top_pair),
        float(np.log1p(words / lines)), float(np.log1p(line_lengths.std())),
        len(np.unique(line_sums)) / lines, float(upper_words), float(marked),
        float(np.mean(closing == 5)),
        entropy,
    ]


def with_statistics(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns of ``keep`` and ``x``, array<double>, of every row. Null counts as empty."""
    schema = docs.select(*keep).schema.add("x", ArrayType(DoubleType()))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = [statistics(t) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(rows, pa.list_(pa.float64()))], [*keep, "x"]
            )

    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)


@dataclass(frozen=True)
class Model:
    """All that a score needs; its size does not depend on the data."""

    mean: np.ndarray
    scale: np.ndarray
    projection: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    levels: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        waves = np.cos(z @ self.projection + self.phase) * np.sqrt(2 / len(self.phase))
        return np.hstack([waves, z, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated, and still rising within a flat part of the calibration."""
        raw = self.raw(x)
        flat = np.interp(raw, self.steps, self.levels)
        return np.clip(0.999 * flat + 0.001 / (1 + np.exp(-np.clip(raw, -30, 30))), 0, 1)


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The nearest rising sequence, by pooling neighbours that fall."""
    blocks: list[list[float]] = []
    for v, w in zip(values, weights):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.concatenate([np.full(n, v) for v, _, n in blocks]) if blocks else np.empty(0)


def _fold(id: str) -> Column:
    return F.crc32(F.col(id).cast("string").cast("binary")) % 4


def held_out(id: str = "doc_id") -> Column:
    """Rows whose labels are never looked at: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(_fold(id) == 2, F.lit(False))


def _known(labels: DataFrame, id: str, label: str) -> DataFrame:
    """(id, y) of the rows to learn from: labelled ones outside the held-out fold, beyond
    MOST_LABELLED a sample by hash of about that many."""
    known = labels.where(F.col(label).isNotNull() & F.col(id).isNotNull() & ~held_out(id)).select(
        id, F.col(label).cast("double").alias("y")
    )
    n = known.count()
    return known if n <= MOST_LABELLED else known.where(F.pmod(F.xxhash64(id, F.lit(SEED)), F.lit(n)) < MOST_LABELLED)


def fit(stats: DataFrame, labels: DataFrame, id: str = "doc_id", label: str = "quality") -> Model | None:
    """Learns from at most about MOST_LABELLED labelled rows outside the held-out fold. None
    without any such row.

    ``stats`` has id and x. Rows of an id with several labels count with each of them; a null
    label is no label. The weights come from all these rows. The calibration sees each row by
    weights that were fitted without its fold, at every size; where the other folds are empty
    these are zero, and the calibration is the mean label.
    """
    known = _known(labels, id, label)
    rows = store(
        known.join(stats, id).select(_fold(id).cast("int").alias("fold"), "y", "x").repartition(FIT_TASKS),
        "labelled",
    )
    d = len(STATISTICS)
    sums = rows.select(
        F.count("*").alias("n"),
        *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(d)],
        *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(d)],
    ).first()
    if not sums["n"]:
        return None
    rng = np.random.default_rng(SEED)
    model = Model(
        np.array([sums[f"m{i}"] for i in range(d)]),
        np.array([max(sums[f"s{i}"], 1e-6) for i in range(d)]),
        rng.normal(0, np.sqrt(2 * GAMMA), (d, FEATURES)), rng.uniform(0, 2 * np.pi, FEATURES),
        np.zeros(FEATURES + d + 1), np.zeros(1), np.zeros(1),
    )
    size = FEATURES + d + 1

    def equations(batches: Iterator) -> Iterator:
        import pyarrow as pa

        a, b = np.zeros((len(FOLDS), size, size)), np.zeros((len(FOLDS), size))
        for batch in batches:
            x = np.array(batch.column("x").to_pylist()).reshape(-1, d)
            z, y = model.features(x), batch.column("y").to_numpy(zero_copy_only=False)
            folds = batch.column("fold").to_numpy()
            for k, fold in enumerate(FOLDS):
                own = folds == fold
                a[k] += z[own].T @ z[own]
                b[k] += z[own].T @ y[own]
        yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()]), pa.array([b.tobytes()])], ["a", "b"])

    partial = rows.coalesce(FIT_TASKS).mapInArrow(equations, "a binary, b binary").collect()
    a = sum(np.frombuffer(r["a"]).reshape(-1, size, size) for r in partial)
    b = sum(np.frombuffer(r["b"]).reshape(-1, size) for r in partial)
    solve = lambda a, b: np.linalg.solve(a + RIDGE * np.eye(size), b)
    weights = solve(a.sum(0), b.sum(0))
    without = [solve(a.sum(0) - a[k], b.sum(0) - b[k]) for k in range(len(FOLDS))]

    def unseen(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            z = model.features(np.array(batch.column("x").to_pylist(), float).reshape(-1, d))
            folds = batch.column("fold").to_numpy()
            raw = np.zeros(len(folds))
            for k, fold in enumerate(FOLDS):
                raw[folds == fold] = z[folds == fold] @ without[k]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(raw)], ["y", "raw"])

    step = F.floor(F.least(F.greatest(F.col("raw"), F.lit(-0.5)), F.lit(1.5)) * (STEPS // 2)).cast("int")
    counted = (
        rows.mapInArrow(unseen, "y double, raw double").groupBy(step.alias("step"))
        .agg(F.avg("y").alias("y"), F.count("*").alias("n"), F.avg("raw").alias("raw"))
        .orderBy("step").collect()
    )
    values = np.array([r["y"] for r in counted])
    levels = isotonic(values, np.array([r["n"] for r in counted], float))
    return Model(
        model.mean, model.scale, model.projection, model.phase, weights,
        np.array([r["raw"] for r in counted]), levels,
    )


def _apply(rows: DataFrame, model: Model, keep: list[str], name: str) -> DataFrame:
    """Adds the calibrated score of ``x``."""
    schema = rows.select(*keep).schema.add(name, "double")
    d = len(STATISTICS)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), float).reshape(-1, d)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(model.score(x))], [*keep, name])

    return rows.select(*keep, "x").mapInArrow(run, schema)


def score_documents(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id: str = "doc_id"
) -> DataFrame:
    """One row per document: id, held_out, score, predicted. Texts are read once; null and
    empty ones have a score like others. Without labels every score is 1: nothing is known
    against a document."""
    stats = store(with_statistics(docs.withColumn("_row", F.xxhash64("text")), [id, "_row"]), "statistics")
    model = fit(stats, labels, id)
    if model is None:
        scored = stats.select(id, "_row", F.lit(1.0).alias("score"))
    else:
        scored = _apply(stats, model, [id, "_row"], "score")
    return scored.select(
        id, "_row", held_out(id).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id: str = "doc_id") -> DataFrame:
    """The documents that the classifier does not reject, with their own columns. The first
    pass over the texts takes the statistics of the labelled ones alone."""
    # MOST_LABELLED bounds what is sent to all tasks.
    some = F.broadcast(store(_known(labels, id, "quality").select(F.col(id).alias("_id")).distinct(), "known"))
    chosen = docs.select(F.col(id).alias("_id"), F.col("text")).join(some, "_id", "left_semi")
    stats = with_statistics(chosen.withColumnRenamed("_id", id), [id])
    model = fit(stats, labels, id)
    if model is None:
        return docs

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            x = np.array([statistics(t) for t in batch.column("text").to_pylist()], float)
            good = model.score(x.reshape(-1, len(STATISTICS))) >= threshold
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
