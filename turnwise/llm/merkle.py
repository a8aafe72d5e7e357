"""Merkle manifest of a data set, with the witness of every leaf (incremental witnesses).

Leaves are ranked in their group, and aligned blocks of them are appended one after another
to a growing tree. A leaf in an open subtree has a partial witness, the siblings so far; when
the sibling of a subtree is complete, the witnesses on both sides are extended by each other's
root. The roots of the blocks are appended in the same way in the next round, on as many tasks
as there are blocks, until each group has one root; the roots of the groups are one more tree.
A witness is put together from its rounds by joins on the block.

A tree pairs every two consecutive nodes of a level; a node without a partner goes up as its
own hash. So position and number of leaves tell the side of each sibling, and a witness is
the siblings alone, from the leaf upwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from turnwise.session import store

# A block has 2 ** LEVELS leaves: what one task holds of a group at a time.
LEVELS = 10
DIGEST = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def joined_hash(*digests: bytes) -> bytes:
    """SHA-256 of digests as lowercase hex text, end to end."""
    return hashlib.sha256(b"".join(d.hex().encode() for d in digests)).digest()


class Block:
    """Appends to an aligned block. ``open`` holds complete subtrees of falling height that
    wait for their sibling: (height, first leaf, end, root)."""

    def __init__(self, levels: int = LEVELS):
        self.levels = levels
        self.open: list[tuple[int, int, int, bytes]] = []
        self.siblings = np.zeros((1 << levels, levels, DIGEST), np.uint8)
        self.has = np.zeros((1 << levels, levels), bool)
        self.n = 0

    def append(self, digest: bytes) -> None:
        self.open.append((0, self.n, self.n + 1, digest))
        self.n += 1
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            self._pair()

    def _pair(self) -> None:
        """The last two open subtrees are siblings: each extends the other's witnesses."""
        height, middle, end, right = self.open.pop()
        _, first, _, left = self.open.pop()
        self.siblings[first:middle, height] = np.frombuffer(right, np.uint8)
        self.siblings[middle:end, height] = np.frombuffer(left, np.uint8)
        self.has[first:end, height] = True
        self.open.append((height + 1, first, end, joined_hash(left, right)))

    def close(self, height: int) -> bytes:
        """No more leaves come: nodes without a sibling go up alone, to ``height`` at least."""
        while len(self.open) > 1 or self.open[0][0] < height:
            if len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
                self._pair()
            else:
                at, first, end, root = self.open.pop()
                self.open.append((at + 1, first, end, joined_hash(root)))
        return self.open[0][3]

    def witnesses(self) -> tuple[np.ndarray, np.ndarray]:
        """The siblings of all leaves end to end, and the number of siblings of each."""
        return self.siblings[: self.n][self.has[: self.n]], self.has[: self.n].sum(1)


def append_blocks(nodes: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Adds ``block``, the ``witness`` of every node inside its block and the block's ``root``.

    ``nodes`` has group, pos (from 0, without gaps), n (nodes of the group) and digest; other
    columns stay. All blocks of a group but the last are full, so their roots stand at one
    height and are the nodes of the next round.
    """
    kept = nodes.columns
    placed = (
        nodes.withColumn("block", F.shiftright("pos", levels))
        .repartition("group", "block")
        .sortWithinPartitions("group", "block", "pos")
    )
    schema = StructType([*placed.schema.fields]).add("witness", "binary").add("root", "binary")

    def finish(rows: list) -> Iterator:
        import pyarrow as pa

        table = pa.Table.from_batches(rows).combine_chunks()
        block = Block(levels)
        for digest in table["digest"].to_pylist():
            block.append(digest)
        root = block.close(levels if table["n"][0].as_py() > 1 << levels else 0)
        flat, number = block.witnesses()
        ends = pa.array(np.concatenate([[0], np.cumsum(number * DIGEST)]), pa.int32())
        witness = pa.BinaryArray.from_buffers(
            pa.binary(), block.n, [None, ends.buffers()[1], pa.py_buffer(flat.tobytes())]
        )
        table = table.append_column("witness", witness)
        table = table.append_column("root", pa.array([root] * block.n, pa.binary()))
        yield from table.to_batches()

    def run(batches: Iterator) -> Iterator:
        # Rows of a block follow each other, maybe over several batches.
        rows, key = [], None
        for batch in batches:
            keys = list(zip(batch.column("group").to_pylist(), batch.column("block").to_pylist()))
            starts = [i for i, k in enumerate(keys) if i == 0 or k != keys[i - 1]]
            for first, end in zip(starts, [*starts[1:], len(keys)]):
                if rows and keys[first] != key:
                    yield from finish(rows)
                    rows = []
                key = keys[first]
                rows.append(batch.slice(first, end - first))
        if rows:
            yield from finish(rows)

    return placed.mapInArrow(run, schema).select(*kept, "block", "witness", "root")


def ranked(rows: DataFrame, order: list) -> DataFrame:
    """Adds ``pos`` and ``n``: the rank in ``group`` by ``order`` from 0, and the rows of the
    group. Equal rows take the ranks that they share in any order.

    Rows are dealt by ranges, so a group of any size is spread out, also one of equal rows.
    Only the counts per range meet in a window.
    """
    numbered = rows.withColumn("_salt", F.monotonically_increasing_id())
    keys = ["group", *order, "_salt"]
    placed = numbered.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_salt")
    # The upper bits of this id are the range, the lower ones the place in it.
    held = store(placed.withColumn("_at", F.monotonically_increasing_id()), "ranges")
    held = held.withColumn("_range", F.shiftright("_at", 33))
    counts = held.groupBy(F.col("group").alias("_group"), F.col("_range").alias("_of")).agg(
        F.count("*").alias("_c"), F.min("_at").alias("_first")
    )
    before = Window.partitionBy("_group").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    counts = store(
        counts.select(
            "_group", "_of", "_first",
            F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"),
            F.sum("_c").over(Window.partitionBy("_group")).alias("n"),
        ),
        "counts",
    )
    joined = held.join(counts, (F.col("group") == F.col("_group")) & (F.col("_range") == F.col("_of")))
    pos = F.col("_at") - F.col("_first") + F.col("_before")
    return joined.select(*rows.columns, pos.alias("pos"), "n")


def _rounds(leaves: DataFrame, levels: int) -> list[DataFrame]:
    """The stored rounds of a forest: leaves first, and last the one with a block per group."""
    rounds = [store(append_blocks(leaves, levels), "witnesses")]
    most = rounds[0].agg(F.max("n")).first()[0] or 0
    while most > 1 << levels:
        most = -(-most >> levels)
        roots = rounds[-1].where(F.col("pos").bitwiseAND((1 << levels) - 1) == 0).select(
            "group", F.col("block").alias("pos"),
            F.shiftright(F.col("n") + ((1 << levels) - 1), levels).alias("n"),
            F.col("root").alias("digest"),
        )
        rounds.append(store(append_blocks(roots, levels), "witnesses"))
    return rounds


def _above(rounds: list[DataFrame]) -> DataFrame:
    """(up_group, up_block, up_witness, up_root): what extends the witnesses of each block of
    the first round, to the root of its group."""
    above = rounds[-1].where("pos = 0").select(
        F.col("group").alias("up_group"), F.col("block").alias("up_block"),
        F.unhex(F.lit("")).alias("up_witness"), F.col("root").alias("up_root"),
    )
    for nodes in reversed(rounds[1:]):
        above = _extended(nodes, above).select(
            F.col("group").alias("up_group"), F.col("pos").alias("up_block"),
            F.col("witness").alias("up_witness"), F.col("root").alias("up_root"),
        )
    return above


def _extended(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """The nodes of a round with witness and root as from the end of the last round."""
    joined = nodes.join(above, (F.col("group") == F.col("up_group")) & (F.col("block") == F.col("up_block")))
    taken = {"witness": F.concat("witness", "up_witness"), "root": F.col("up_root")}
    return joined.withColumns(taken).drop("block", "up_group", "up_block", "up_witness", "up_root")


def forest(leaves: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Witnesses of all leaves through the tree of their group to the one root.

    ``leaves`` has group (string, its bytes give the order of the groups), pos, n, digest and
    other columns, which stay. Adds witness, subroot, root, and group_pos and groups, which
    place the subroot in the tree of subroots.
    """
    rounds = _rounds(leaves, levels)
    subroots = rounds[-1].where("pos = 0").select(
        F.lit("").alias("group"), F.col("group").alias("of"), F.col("root").alias("digest")
    )
    groups = _rounds(ranked(subroots, ["of"]), levels)
    outer = _extended(groups[0], _above(groups)).select(
        "of", F.col("digest").alias("subroot"), F.col("pos").alias("group_pos"),
        F.col("n").alias("groups"), F.col("witness").alias("group_witness"), F.col("root").alias("whole"),
    )
    # Written, so that the planner knows its size: a row per block, not per leaf.
    above = store(_above(rounds).join(outer, F.col("up_group") == F.col("of")).drop("of"), "upper")
    joined = _extended(rounds[0], above)
    taken = {"witness": F.concat("witness", "group_witness"), "root": F.col("whole")}
    return joined.withColumns(taken).drop("group_witness", "whole")


def record_text(columns: dict[str, Column]) -> Column:
    """Values end to end: each as its UTF-8 byte count, a colon and itself, ``-`` if null."""
    parts = []
    for c in columns.values():
        value = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.concat(*parts)


def document_leaves(docs: DataFrame, changed: Column, by: str = "lang") -> DataFrame:
    """(group, doc_id, digest, tampered) of each document. ``tampered`` is the digest with one
    more in n_chars where ``changed`` holds, else null; a null n_chars stays null."""
    fields = {c: F.col(c) for c in FIELDS}
    more = fields | {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    digest = lambda f: F.unhex(F.sha2(record_text(f), 256))
    return docs.select(
        # A null group comes first, then groups by their bytes.
        F.coalesce(F.concat(F.lit("="), F.col(by).cast("string")), F.lit("")).alias("group"),
        F.col("doc_id"), digest(fields).alias("digest"),
        F.when(changed, digest(more)).alias("tampered"),
    )


def manifest(docs: DataFrame, changed: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """One row per document: doc_id, group, digest, tampered, pos, n, witness, subroot, root,
    group_pos, groups.

    Leaves of a language ascend by doc_id (null first; rows of one id by their digest, so only
    equal rows can change places). Null and empty texts are leaves like others, columns beyond
    those of the leaf are not looked at, and an empty table gives no row.
    """
    leaves = document_leaves(docs, F.lit(False) if changed is None else changed)
    return forest(ranked(leaves, [F.col("doc_id").asc_nulls_first(), "digest"]), levels)


def climb(digest: bytes, pos: int, n: int, siblings: list[bytes]) -> bytes:
    """The root from a node, its place among n and its siblings, which are taken from the front."""
    while n > 1:
        if pos ^ 1 >= n:
            digest = joined_hash(digest)
        else:
            other = siblings.pop(0)
            digest = joined_hash(other, digest) if pos & 1 else joined_hash(digest, other)
        pos, n = pos >> 1, (n + 1) >> 1
    return digest


def verify(manifested: DataFrame, leaf: str = "leaf_now") -> DataFrame:
    """Climbs from the digest in ``leaf`` by the witness: doc_id, leaf, subroot, root,
    proof_sha256 (of the siblings as hex text), folded_root and verified."""
    schema = (
        "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string,"
        " folded_root string, verified boolean"
    )

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            folded, proofs = [], []
            rows = (batch.column(c).to_pylist() for c in (leaf, "pos", "n", "group_pos", "groups", "witness"))
            for digest, pos, n, group_pos, groups, witness in zip(*rows):
                siblings = [witness[i : i + DIGEST] for i in range(0, len(witness), DIGEST)]
                proofs.append(hashlib.sha256(witness.hex().encode()).hexdigest())
                folded.append(climb(climb(digest, pos, n, siblings), group_pos, groups, siblings))
            roots = batch.column("root").to_pylist()
            hexes = lambda values: pa.array([v.hex() for v in values], pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), hexes(batch.column("digest").to_pylist()),
                    hexes(batch.column("subroot").to_pylist()), hexes(roots), pa.array(proofs, pa.string()),
                    hexes(folded), pa.array([a == b for a, b in zip(folded, roots)], pa.bool_()),
                ],
                [c.split()[0] for c in schema.split(", ")],
            )

    needed = ("digest", "pos", "n", "group_pos", "groups", "witness", "subroot", "root", leaf)
    rows = manifested.select(F.col("doc_id").cast("bigint").alias("doc_id"), *needed)
    return rows.mapInArrow(run, schema)
