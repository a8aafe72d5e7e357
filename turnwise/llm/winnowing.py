"""Document fingerprints by winnowing.

Every k-gram of code points gets a rolling hash; of every window of w neighbouring hashes the
smallest is kept, at the rightmost place where it stands, with its position. Two texts that
share a passage of w + k - 1 code points share a kept hash for certain.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A shared passage of K + W - 1 = 20 code points is always found: two thirds of 30.
K, W = 8, 13
# Documents in one range of ids; a range is sorted by one task, with spill.
ROWS_PER_RANGE = 1_000
MOST_RANGES = 4_096
BATCH = 256

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_LOW = np.uint64(0xFFFFFFFF)
# Powers of the base for texts up to this length; longer texts make their own.
_KEPT = 1 << 17


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, _KEPT), _powers(_INVERSE, _KEPT)


def gram_hashes(text: str, k: int = K) -> np.ndarray:
    """A 32-bit hash of every k-gram; of the whole text if it is shorter; none if empty."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    n = len(points)
    if n == 0:
        return np.empty(0, np.uint64)
    k = min(k, n)
    up, down = (_UP, _DOWN) if n < _KEPT else (_powers(_BASE, n), _powers(_INVERSE, n))
    sums = np.zeros(n + 1, np.uint64)
    # The hash rolls: what the running sum gains over k places, moved back to the start.
    np.cumsum((points + np.uint64(1)) * up[:n], out=sums[1:])
    h = (sums[k:] - sums[: n - k + 1]) * down[: n - k + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h >> np.uint64(32)


def window_minima(h: np.ndarray, w: int = W) -> np.ndarray:
    """Positions of the smallest hash of every window, rightmost on ties, each once. With
    fewer hashes than a window, they are one window."""
    n = len(h)
    if n == 0:
        return np.empty(0, np.int64)
    w = min(w, n)
    # Hash above, distance from the end below: the smallest key is the rightmost minimum.
    key = (h << np.uint64(32)) | (_LOW - np.arange(n, dtype=np.uint64))
    blocks = -(-n // w)
    padded = np.full(blocks * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = key
    grid = padded.reshape(blocks, w)
    # A window is the end of one block and the start of the next.
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    best = np.minimum(behind[: n - w + 1], ahead[w - 1 : n])
    chosen = best[np.concatenate([[True], best[1:] != best[:-1]])]
    return (_LOW - (chosen & _LOW)).astype(np.int64)


def winnow(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Kept hashes and their positions, in order of position."""
    h = gram_hashes(text or "")
    at = window_minima(h)
    return h[at], at


def fingerprint_text(h: np.ndarray, at: np.ndarray) -> str:
    """position:hash of everything kept, hash in hex, joined by commas."""
    return ",".join([f"{p}:{x:x}" for p, x in zip(at.tolist(), h.tolist())])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared hashes by all hashes of two fingerprints; 1 for two empty ones."""
    a, b = np.unique(a), np.unique(b)
    if len(a) + len(b) == 0:
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def edited(text: str, following: str) -> str:
    """The last third replaced by as much of the start of another text, or all of it."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds fingerprint, string, to every row. A null or empty text has the empty one."""
    schema = docs.select(*[c for c in docs.columns if c != "fingerprint"]).schema.add("fingerprint", "string")
    names = schema.fieldNames()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            prints = [fingerprint_text(*winnow(t)) for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:-1]), pa.array(prints, pa.string())], names)

    return docs.select(*names[:-1]).mapInArrow(run, schema)


def _ranges(docs: DataFrame, id: str) -> list:
    """Bounds that cut the ids into ranges of some thousand rows; at most MOST_RANGES."""
    rows = docs.count()
    n = min(MOST_RANGES, rows // ROWS_PER_RANGE)
    if n < 2:
        return []
    parts = [i / n for i in range(1, n)]
    found = docs.agg(F.percentile_approx(id, parts, 20 * n).alias("b")).first()["b"]
    return sorted(set(found))


def with_next(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (bucket, guest, id, text), so that a sort by bucket, guest, id descending, text
    puts each document before the one that follows it in descending order of ids.

    Ids are cut into ranges. Each range also gets, as its guest, the first document of the
    range below (the lowest range that of the highest), so no order over all rows is needed.
    Null ids come last in descending order and share the lowest range.
    """
    bounds = _ranges(docs, id)
    slim = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    if bounds:
        # Number of bounds below the id, by a look-up in two steps.
        wide = math.isqrt(len(bounds)) + 1
        groups = [bounds[i : i + wide] for i in range(0, len(bounds), wide)]
        below = lambda cuts: F.size(F.filter(cuts, lambda b: b < F.col("id")))
        full = below(F.array(*[F.lit(g[-1]) for g in groups]))
        inner = F.array(*[F.array(*[F.lit(b) for b in g]) for g in groups], F.array(F.lit(bounds[-1])))
        bucket = F.coalesce(full * wide + below(F.get(inner, full)), F.lit(0))
    else:
        bucket = F.lit(0)
    placed = slim.withColumn("bucket", bucket.cast("int"))
    # One row per range at most: its highest id, and the text that comes first among its ties.
    tops = placed.groupBy("bucket").agg(F.max("id").alias("id")).orderBy("bucket").collect()
    if not tops:
        return placed.select("bucket", F.lit(0).alias("guest"), "id", "text")
    goes = {top["id"]: tops[(i + 1) % len(tops)]["bucket"] for i, top in enumerate(tops)}
    known = {i: b for i, b in goes.items() if i is not None}
    if known:
        places = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
        firsts = placed.where(F.col("id").isin(list(known)))
        to = F.element_at(places, F.col("id"))
    else:
        firsts, to = placed, F.lit(0)
    guests = (
        firsts.groupBy("id").agg(F.min("text").alias("text")).select(
            to.cast("int").alias("bucket"), F.lit(1).alias("guest"), "id", "text"
        )
    )
    return placed.select("bucket", F.lit(0).alias("guest"), "id", "text").unionByName(guests)


EDITED = (
    "id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def compare_edited(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every document and of its edited text, and how near it is to that text
    and to the document that follows it in descending order of ids (after the last: the
    first). Rows of one id follow each other by text. A single document follows itself.

    One shuffle of the texts; a task streams over sorted rows and holds two of them.
    """
    rows = with_next(docs, id, text)
    sorted_rows = rows.repartition(
        int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "bucket"
    ).sortWithinPartitions("bucket", "guest", F.col("id").desc_nulls_last(), "text")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = ("id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        before, out = None, []

        def table():
            columns = zip(*out)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("bucket", "guest", "id", "text"))
            for bucket, guest, key, own in zip(*columns):
                kept = winnow(own)
                if before and before[0] == bucket:
                    _, last, words, (h, at) = before
                    changed = edited(words, own)
                    eh, eat = (h, at) if changed == words else winnow(changed)
                    out.append((
                        last, len(words), sha256(changed.encode()).hexdigest(),
                        fingerprint_text(h, at), fingerprint_text(eh, eat),
                        likeness(h, eh), likeness(h, kept[0]),
                    ))
                    if len(out) == BATCH:
                        yield table()
                        out = []
                before = None if guest else (bucket, key, own, kept)
        if out:
            yield table()

    return sorted_rows.mapInArrow(run, EDITED).withColumnRenamed("id", id)
