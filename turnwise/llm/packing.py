"""Packing token ids into rows of fixed length by best fit decreasing.

Documents are dealt to shards by hash; a shard is packed by one task. There, pieces go from
the longest to the shortest into the row with the least room that still holds them, which a
segment tree over the room finds in logarithmic time. A document longer than a row is cut
into pieces; every piece says where in its document it begins, so nothing is lost.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnwise.llm import bpe
from turnwise.llm.chosenpath import _runs

LENGTH = 4_096
# Tokens of a shard: what a task holds at once.
SHARD_TOKENS = 8_000_000
# Ids beyond the 256 bytes; only for byte ids, as they are tokens of other vocabularies.
END, PAD = 256, 257
# Bytes of text that are encoded at a time.
PART_BYTES = 4_000_000
PACKED = (
    "shard int, row int, n_tokens int, ids binary, cu_seqlens array<int>, position_resets array<int>, "
    "doc_ids array<bigint>, doc_starts array<bigint>"
)


class RoomTree:
    """A segment tree over the room left in open rows: the smallest room that is enough."""

    def __init__(self, most: int):
        self.size = 1 << (most + 1).bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: dict[int, list[int]] = defaultdict(list)

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        at = room + self.size
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The row with the least room of ``need`` or more, and that room; it is removed."""
        at, count = need + self.size, self.count
        while not count[at]:
            # Up to the first ancestor with something to its right.
            while at & 1:
                at >>= 1
                if at == 0:
                    return None
            if at == 0:
                return None
            at += 1
        while at < self.size:
            at <<= 1
            if not count[at]:
                at += 1
        room = at - self.size
        while at:
            count[at] -= 1
            at >>= 1
        return self.rows[room].pop(), room


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Numbers of the pieces in each row. Equal lengths keep their order; no piece may be
    longer than the capacity, and empty ones take no room."""
    rows: list[list[int]] = []
    tree = RoomTree(capacity)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[i])
        if found is None:
            rows.append([])
            found = len(rows) - 1, capacity
        row, room = found
        rows[row].append(i)
        tree.add(room - lengths[i], row)
    return rows


def byte_ids(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ids): the UTF-8 bytes of a text and the end id, 16 bits each, little end first.
    A null or empty text is the end id alone."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out = []
            for t in batch.column("text").to_pylist():
                data = np.frombuffer((t or "").encode(), np.uint8).astype("<u2")
                out.append(np.append(data, np.array(END, "<u2")).astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.binary())], ["id", "ids"])

    rows = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "id bigint, ids binary")


def token_ids(
    docs: DataFrame, path: str, pattern: str, end: int, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, ids): the token ids of a text by the rank file and the ``end`` id, 16 bits each,
    little end first. A null or empty text is the end id alone."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        with bpe.tokenizer(path, pattern) as state:
            for batch in batches:
                for part in bpe.parts(batch, "text", PART_BYTES):
                    flat, n = state.encode(part.column("text"))
                    closed = np.insert(flat, np.cumsum(n), end).astype("<u2")
                    ends = pa.array(np.concatenate([[0], np.cumsum(2 * (n + 1))]), pa.int32())
                    ids = pa.BinaryArray.from_buffers(
                        pa.binary(), part.num_rows, [None, ends.buffers()[1], pa.py_buffer(closed.tobytes())]
                    )
                    yield pa.RecordBatch.from_arrays([part.column("id"), ids], ["id", "ids"])

    rows = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "id bigint, ids binary")


def pack(coded: DataFrame, tokens: int, length: int = LENGTH, pad: int = PAD) -> DataFrame:
    """Packed rows of ``length`` ids from (id, ids), with ``tokens`` about the number of all, or more.

    ids is a matrix row in 16 bits, filled up with ``pad``; cu_seqlens are the ends of the
    segments after a first 0; position_resets the places at which positions start from 0
    again; doc_ids and doc_starts say of each segment which document it is of and where it
    begins in it. Rows of one id are documents of their own. Empty lists give no segment.
    """
    shards = max(1, -(-tokens // SHARD_TOKENS))
    placed = coded.select(
        F.pmod(F.xxhash64("id", "ids"), F.lit(shards)).cast("int").alias("shard"), "id", "ids"
    ).repartition(shards, "shard").sortWithinPartitions("shard", "id", "ids")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for group in _runs(batches, ["shard"], ["id", "ids"]):
            pieces = []
            for key, data in zip(group["id"], group["ids"]):
                n = len(data or b"") // 2
                pieces += [(key, at, data[2 * at : 2 * min(n, at + length)]) for at in range(0, n, length)]
            rows = best_fit_decreasing([len(p[2]) // 2 for p in pieces], length)
            filler = np.array([pad], "<u2").tobytes()
            out = []
            for number, members in enumerate(rows):
                segments = [pieces[i] for i in members]
                data = b"".join(s[2] for s in segments)
                ends = np.cumsum([0, *(len(s[2]) // 2 for s in segments)]).tolist()
                out.append((
                    group["key"][0], number, ends[-1], data + filler * (length - ends[-1]),
                    ends, ends[:-1], [s[0] for s in segments], [s[1] for s in segments],
                ))
            ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), ints, ints, longs, longs)
            names = [c.split()[0] for c in PACKED.split(", ")]
            for first in range(0, len(out), 500):
                columns = zip(*out[first : first + 500])
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return placed.mapInArrow(run, PACKED)


def _most_ids(docs: DataFrame, text: str) -> int:
    """Bytes of all texts, and an end for each: no text has more tokens than bytes."""
    return int(docs.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 1)).first()[0] or 0)


def pack_texts(docs: DataFrame, length: int = LENGTH, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents as packed rows of byte ids."""
    return pack(byte_ids(docs, id, text), _most_ids(docs, text), length)


def pack_tokens(
    docs: DataFrame, path: str, pattern: str, end: int, pad: int, length: int = LENGTH, id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The documents as packed rows of the token ids of a rank file, which every executor can
    open. ``end`` and ``pad`` must not be ids of the vocabulary, and no id above 16 bits."""
    used = set(bpe.read_ranks(path).values())
    if used & {end, pad} or end == pad or not all(0 <= i < 1 << 16 for i in (*used, end, pad)):
        raise ValueError("end and pad must be two 16-bit ids outside a vocabulary of 16-bit ids")
    return pack(token_ids(docs, path, pattern, end, id, text), _most_ids(docs, text), length, pad)


def segments(packed: DataFrame) -> DataFrame:
    """The pieces of documents again: (id, start, ids)."""
    each = F.explode(F.arrays_zip("doc_ids", "doc_starts", "position_resets", F.slice("cu_seqlens", 2, 1 << 30).alias("ends")))
    parts = packed.select("ids", each.alias("s"))
    piece = F.substring(
        F.col("ids"), 2 * F.col("s.position_resets") + 1, 2 * (F.col("s.ends") - F.col("s.position_resets"))
    )
    return parts.select(F.col("s.doc_ids").alias("id"), F.col("s.doc_starts").alias("start"), piece.alias("ids"))


def write_packed(packed: DataFrame, path: str) -> None:
    """Packed rows as Parquet in a shared folder, a fresh one; one file per task."""
    packed.write.parquet(path)
