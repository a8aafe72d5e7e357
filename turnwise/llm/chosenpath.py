"""MinHash near-dedup as a chosen-path set similarity join.

Each document is its set of word shingles. Documents with equal sets are collapsed first. The
others branch down several independent trees: a node of a tree chooses one or more of the
minwise coordinates (1 / threshold of them on average), and a document moves to the child
named by its minimum there. Two sets at the threshold stay together in about one branch per
level, unrelated ones part at once. Small nodes are compared exhaustively on their sketches;
large nodes branch on. What the comparisons connect is a cluster of candidates. Every cluster
is then checked on full shingle sets, block against block, so links are exact.

A node or cluster never gives all its pairs: tasks give a spanning forest of what they link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnwise.llm.graph import components
from turnwise.session import store

SHINGLE = 5
PERCENT = 80
COORDINATES = 64
TREES = 16
# Nodes up to this size are compared exhaustively; larger ones branch, so many levels deep.
NODE = 2_048
DEPTH = 6
# Documents of a cluster that are checked against each other at once.
BLOCK = 750
# Below this share of equal coordinates two sets are not compared. A pair at the threshold of
# 80 percent falls below with a chance of about 5e-7.
ESTIMATE = 36 / 64
SEED = 23

_PRIME = np.uint64(0x100000001B3)
_INVERSE = np.uint64(pow(0x100000001B3, -1, 1 << 64))
_MIX = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_rng = np.random.default_rng(SEED)
_A = _rng.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _MIX[0]
    h = (h ^ (h >> np.uint64(33))) * _MIX[1]
    return h ^ (h >> np.uint64(33))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_PRIME, 1 << 16), _powers(_INVERSE, 1 << 16)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles. Fewer words than ``size`` are one
    shingle; no words, none. A-Z count as a-z; words end at ASCII white space."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    n = len(data)
    blank = _BLANK[data]
    edges = np.flatnonzero(np.diff(blank, prepend=True, append=True))
    starts, ends = edges[::2], edges[1::2]
    words = len(starts)
    if words == 0:
        return np.empty(0, np.uint64)
    up, down = (_UP, _DOWN) if n <= len(_UP) else (_powers(_PRIME, n), _powers(_INVERSE, n))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((_LOWER[data] + np.uint64(1)) * up[:n], out=sums[1:])
    hashes = _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    k = min(size, words)
    out = np.full(words - k + 1, k, np.uint64)
    for i in range(k):
        # A step of mixing between the words makes their order count.
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : words - k + 1 + i])
    return np.unique(out)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The minimum of every coordinate, 32 bits."""
    out = np.empty(COORDINATES, np.uint64)
    for i in range(COORDINATES):
        out[i] = ((shingles ^ _B[i]) * _A[i]).min() >> np.uint64(32)
    return out


def chosen(node: np.ndarray) -> np.ndarray:
    """Which coordinates each node branches on: one always, the others by chance, 100 /
    PERCENT on average. It depends on the node alone."""
    each = _mix(node[:, None] ^ _mix(np.arange(1, COORDINATES + 1, dtype=np.uint64)))
    extra = (100 / PERCENT - 1) / (COORDINATES - 1)
    pick = each < np.uint64(int(extra * 2**64))
    pick[np.arange(len(node)), (node % np.uint64(COORDINATES)).astype(np.int64)] = True
    return pick


def _children(nodes: np.ndarray, minima: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and names of the nodes that rows go to next."""
    rows, at = np.nonzero(chosen(nodes))
    value = minima[rows, at].astype(np.uint64)
    return rows, _mix(nodes[rows] ^ _mix((value << np.uint64(8)) | at.astype(np.uint64)))


# Roots of the trees: each has another coordinate that it always branches on.
_ROOTS = (_rng.integers(0, 1 << 50, TREES, dtype=np.uint64) * np.uint64(COORDINATES)) + np.arange(
    TREES, dtype=np.uint64
)


def signatures(docs: DataFrame, size: int, id: str, text: str) -> DataFrame:
    """Rows (id, n_shingles, set_a, set_b, minima, nodes): the set as two hashes, 16 bits of
    each minimum, and the children of the roots."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out = []
            for key, t in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                s = shingle_set(t, size)
                if len(s) == 0:
                    out.append((key, 0, None, None, None, None))
                    continue
                minima = sketch(s)
                _, nodes = _children(_ROOTS, np.broadcast_to(minima, (TREES, COORDINATES)))
                a = _mix(s).sum(dtype=np.uint64)
                b = _mix(s ^ _MIX[1]).sum(dtype=np.uint64)
                out.append((
                    key, len(s), int(a.view(np.int64)), int(b.view(np.int64)),
                    minima.astype(np.uint16).tobytes(), nodes.view(np.int64).tolist(),
                ))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
            names = ("id", "n_shingles", "set_a", "set_b", "minima", "nodes")
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    rows = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(
        run, "id bigint, n_shingles bigint, set_a bigint, set_b bigint, minima binary, nodes array<bigint>"
    )


class _Forest:
    """Labels of what is linked so far; ``links`` is a spanning forest."""

    def __init__(self, n: int):
        self.label, self.links = np.arange(n), []

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.label[a] != self.label[b]

    def link(self, a: int, b: int) -> None:
        x, y = self.label[a], self.label[b]
        if x != y:
            self.label[self.label == max(x, y)] = min(x, y)
            self.links.append((a, b))


def _alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of equal coordinates of every row of ``a`` with every row of ``b``."""
    same = np.zeros((len(a), len(b)), np.uint8)
    for i in range(COORDINATES):
        same += a[:, i, None] == b[None, :, i]
    return same


def _runs(batches: Iterator, keys: list[str], columns: list[str]) -> Iterator[dict]:
    """The rows of each key of sorted batches, as lists."""
    held: dict | None = None
    for batch in batches:
        lists = {c: batch.column(c).to_pylist() for c in [*keys, *columns]}
        tuples = list(zip(*(lists[k] for k in keys)))
        first = 0
        for i in range(1, len(tuples) + 1):
            if i < len(tuples) and tuples[i] == tuples[first]:
                continue
            part = {c: lists[c][first:i] for c in columns}
            if held and held["key"] == tuples[first]:
                for c in columns:
                    held[c] += part[c]
            else:
                if held:
                    yield held
                held = {"key": tuples[first], **part}
            first = i
    if held:
        yield held


def _edge_batch(edges: list[tuple[int, int]]):
    import pyarrow as pa

    u, v = zip(*edges) if edges else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def _connected(alike: np.ndarray) -> list[tuple[int, int]]:
    """(first, other) for each part that a symmetric table of flags connects."""
    rest, links = np.ones(len(alike), bool), []
    for first in range(len(alike)):
        if not rest[first]:
            continue
        rest[first] = False
        front = np.array([first])
        while len(front):
            front = np.flatnonzero(alike[front].any(axis=0) & rest)
            rest[front] = False
            links += [(first, x) for x in front.tolist()]
    return links


def _compare_nodes(batches: Iterator) -> Iterator:
    """Small nodes, exhaustively on sketches: what the pairs that may be similar connect."""
    edges: list = []
    for run in _runs(batches, ["node"], ["rep", "minima"]):
        m = np.frombuffer(b"".join(run["minima"]), np.uint16).reshape(-1, COORDINATES)
        links = _connected(_alike(m, m) >= ESTIMATE * COORDINATES)
        edges += [(run["rep"][x], run["rep"][y]) for x, y in links]
        if len(edges) > 10_000:
            yield _edge_batch(edges)
            edges = []
    yield _edge_batch(edges)


def _branch(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        nodes = batch.column("node").to_numpy(zero_copy_only=False).view(np.uint64)
        if not len(nodes):
            continue
        m = np.frombuffer(b"".join(batch.column("minima").to_pylist()), np.uint16).reshape(-1, COORDINATES)
        rows, names = _children(nodes, m)
        reps = batch.column("rep").to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names.view(np.int64)), pa.array(reps[rows])], ["node", "rep"]
        )


def candidate_edges(reps: DataFrame) -> DataFrame:
    """(u, v) of a graph whose components hold every pair that may be similar. ``reps`` has
    rep, minima and nodes. At the last level what is still together in a large node agrees
    on DEPTH coordinates and is one cluster, whatever its size; the check follows anyway."""
    spark = reps.sparkSession
    sketches = reps.select("rep", "minima")
    rows = reps.select("rep", F.explode("nodes").alias("node"))
    edges = spark.createDataFrame([], "u bigint, v bigint")
    for level in range(1, DEPTH + 1):
        rows = rows.distinct() if level > 1 else rows
        sizes = rows.groupBy("node").agg(F.count("*").alias("n"), F.min("rep").alias("first"))
        shared = store(rows.join(sizes.where("n > 1"), "node"), "nodes")
        with_minima = shared.join(sketches, "rep")
        small = (
            with_minima.where(F.col("n") <= NODE).select("node", "rep", "minima")
            .repartition("node").sortWithinPartitions("node")
        )
        edges = edges.unionByName(store(small.mapInArrow(_compare_nodes, "u bigint, v bigint"), "edges"))
        large = shared.where(F.col("n") > NODE)
        if large.isEmpty():
            break
        if level == DEPTH:
            edges = edges.unionByName(large.where("rep <> first").select(F.col("rep").alias("u"), F.col("first").alias("v")))
        else:
            rows = store(
                with_minima.where(F.col("n") > NODE).select("node", "rep", "minima")
                .mapInArrow(_branch, "node bigint, rep bigint"),
                "nodes",
            )
    return edges


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    both = int(np.count_nonzero(a[at] == b))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _check_blocks(size: int, percent: int):
    """Exact links of a cluster, within a block or between two: a spanning forest."""

    def run(batches: Iterator) -> Iterator:
        for group in _runs(batches, ["cluster", "i", "j"], ["rep", "block", "text"]):
            _, i, j = group["key"]
            sets = [shingle_set(t, size) for t in group["text"]]
            minima = np.array([sketch(s) for s in sets]).astype(np.uint16)
            block, n = np.array(group["block"]), np.array([len(s) for s in sets])
            left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            same = _alike(minima[left], minima[right])
            # Sets of too different sizes cannot be similar.
            near = 100 * np.minimum.outer(n[left], n[right]) >= percent * np.maximum.outer(n[left], n[right])
            good = near & (same >= ESTIMATE * COORDINATES)
            a, b = np.nonzero(np.triu(good, 1) if i == j else good)
            # The likeliest first: once two documents are connected, they need no check.
            order = np.argsort(-same[a, b].astype(np.int64), kind="stable")
            a, b = left[a[order]], right[b[order]]
            forest, done, step = _Forest(len(n)), 0, 64
            while done < len(a):
                for x, y in zip(a[done : done + step].tolist(), b[done : done + step].tolist()):
                    if forest.label[x] != forest.label[y] and _similar(sets[x], sets[y], percent):
                        forest.link(x, y)
                a, b, done = a[done + step :], b[done + step :], 0
                keep = forest.apart(a, b)
                a, b = a[keep], b[keep]
            if forest.links:
                yield _edge_batch([(group["rep"][x], group["rep"][y]) for x, y in forest.links])

    return run


def near_duplicates(
    docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (the smallest id that links
    reach), kept (the id is that one).

    Two documents link if 100 * shared >= percent * all of their shingles. Null and empty
    texts have no shingles and link with nothing. Rows of one id count as one document with
    the links of each. A pair at the threshold is found with a chance above 0.9999; no pair
    below it is linked.
    """
    signed = store(signatures(docs, size, id, text), "signatures")
    same = signed.where("n_shingles > 0").groupBy("set_a", "set_b")
    sets = store(same.agg(F.min("id").alias("rep")), "sets")
    placed = signed.join(sets, ["set_a", "set_b"], "left").select(
        "id", "n_shingles", F.coalesce("rep", "id").alias("rep"), "minima", "nodes"
    )
    # One row per set: the first row of its smallest id.
    reps = store(
        placed.where("n_shingles > 0 and id = rep").select("rep", "minima", "nodes").dropDuplicates(["rep"]),
        "reps",
    )
    clusters = components(candidate_edges(reps))
    blocks = store(
        clusters.select(F.col("id").alias("rep"), F.col("component_id").alias("cluster"))
        .join(clusters.groupBy(F.col("component_id").alias("cluster")).agg(F.count("*").alias("n")), "cluster")
        .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
        .select("rep", "cluster", "blocks", "block"),
        "blocks",
    )
    texts = docs.select(F.col(id).cast("bigint").alias("rep"), F.col(text).alias("text"))
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    work = (
        texts.join(blocks, "rep")
        .select("rep", "cluster", "block", "text", F.explode(others).alias("other"))
        .select(
            "rep", "cluster", "block", "text", F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
        )
        .repartition("cluster", "i", "j")
        .sortWithinPartitions("cluster", "i", "j")
    )
    links = store(work.mapInArrow(_check_blocks(size, percent), "u bigint, v bigint"), "links")
    # An id and the smallest id with the same set are linked, too: ids may hold several sets.
    linked = links.unionByName(
        placed.where("id <> rep").select(F.col("id").alias("u"), F.col("rep").alias("v"))
    )
    found = components(linked)
    return (
        signed.select("id", "n_shingles")
        .join(found, "id", "left")
        .select(
            F.col("id").alias(id), "n_shingles",
            F.coalesce("component_id", "id").alias("component_id"),
            (F.col("id") == F.coalesce("component_id", "id")).alias("kept"),
        )
    )


def keep_one(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, id: str = "doc_id") -> DataFrame:
    """The documents without the near copies of another: one of each group stays. Of several
    rows with the kept id one stays, beside those without shingles. Rows without an id stay."""
    found = store(near_duplicates(docs, size, percent, id), "found")
    # The ids that go are the smaller table; the planner knows its size, as it is written.
    gone = store(found.where("not kept").select(F.col(id).alias("_tw_id")).distinct(), "gone")
    rest = docs.join(gone, F.col(id) == F.col("_tw_id"), "left_anti")
    counts = found.where("kept and n_shingles > 0").groupBy(F.col(id).alias("_tw_id")).agg(F.count("*").alias("n"))
    several = store(counts.where("n > 1").select("_tw_id"), "several")
    if several.isEmpty():
        return rest
    columns = [F.col(f"`{c}`") for c in docs.columns]
    empty = ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    place = F.row_number().over(Window.partitionBy("_tw_id", empty).orderBy("text"))
    same = rest.join(several, F.col(id) == F.col("_tw_id")).withColumn("_tw_r", place)
    once = rest.join(several, F.col(id) == F.col("_tw_id"), "left_anti")
    return once.unionByName(same.where(empty | (F.col("_tw_r") == 1)).select(*columns))
