"""Embedding near-dedup by dual traversal of cover trees.

The upper tree is made by Spark: nodes with too many vectors get some of them as centres of
children, every vector goes to the nearest centre, and each node keeps its covering radius.
Pairs of nodes are traversed level by level; a pair whose centres are farther apart than both
radii and the threshold together is pruned with all below it. Each pair of leaves that is
left is one task, where the lower tree has nested levels of halving radii and is traversed in
the same way down to single vectors. Pairs are exact; only what pruning rules out is skipped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnwise.llm.graph import components
from turnwise.session import store

COSINE = 0.98
# Vectors in a leaf of the upper tree, children of a node, levels.
LEAF, FAN, DEPTH = 2_000, 8, 8
# Radii of the nested levels inside a leaf.
RADII = (1.0, 0.5, 0.25, 0.125)
# Vectors whose distances to others of a leaf are worked out together.
BLOCK = 256
_SLACK = 1e-7


def usable(vector: Column) -> Column:
    """Not null, all components finite, at least one not zero."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _normal(batches: Iterator) -> Iterator:
    """Vectors ``raw`` as ``v`` with length 1, in double precision; they may differ in size."""
    import pyarrow as pa

    for batch in batches:
        raw = batch.column("raw")
        flat = raw.flatten().to_numpy(zero_copy_only=False).astype(float)
        sizes = raw.value_lengths().to_numpy(zero_copy_only=False)
        if len(flat):
            edges = np.cumsum(sizes) - sizes
            flat = flat / np.repeat(np.sqrt(np.add.reduceat(flat * flat, edges)), sizes)
        vectors = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(flat))
        names = ["rep", "first", "root", "n"]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], vectors], [*names, "v"])


def _distance(a: Column, b: Column) -> Column:
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.greatest(2 - 2 * dot, F.lit(0.0)))


def _matrix(column) -> np.ndarray:
    """The vectors of an Arrow column, all of one length, as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _changes(*columns) -> np.ndarray:
    """Where rows of Arrow columns differ from the row before, 0 and the end included."""
    codes = [c.dictionary_encode().indices.to_numpy() for c in columns]
    return np.r_[0, np.flatnonzero(np.any([np.diff(c) != 0 for c in codes], axis=0)) + 1, len(columns[0])]


def _nearest(batches: Iterator) -> Iterator:
    """Sends each vector to the nearest of the centres it came with, which are taken from
    Arrow once for all vectors of a node in a batch."""
    import pyarrow as pa

    for batch in batches:
        if batch.num_rows == 0:
            continue
        batch = pa.Table.from_batches([batch]).sort_by("node").combine_chunks().to_batches()[0]
        names, far = [], []
        edges = _changes(batch.column("node"))
        for first, end in zip(edges, edges[1:]):
            part = batch.slice(first, end - first)
            node, centres = part.column("node")[0].as_py(), part.column("centres")[0].as_py()
            dots = _matrix(part.column("v")) @ np.array([c["v"] for c in centres]).T
            best = dots.argmax(axis=1)
            children = np.array([f"{node}.{c['k']}" for c in centres], object)
            names.extend(children[best])
            far.append(np.sqrt(np.maximum(0, 2 - 2 * dots[np.arange(len(best)), best])))
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), batch.column("rep"), batch.column("node"), pa.array(np.concatenate(far))],
            ["node", "rep", "parent", "far"],
        )


def upper_tree(points: DataFrame, near: float) -> tuple[DataFrame, DataFrame]:
    """``points`` has rep, root and v. Gives (rep, node) for the leaves, and the unpruned
    pairs (a, b) of leaves, a = b included.

    Centres are chosen by hash, one per residue, so they come from partial minima and not
    from a sorted node. Nodes that still have too many vectors after DEPTH levels (vectors
    that cannot be told apart) are cut by hash; nothing is left out.
    """
    hash_ = F.xxhash64(F.col("rep"), F.lit(5))
    placed = store(points.select("rep", F.col("root").alias("node")), "tree")
    pairs = placed.select(F.col("node").alias("a"), F.col("node").alias("b")).distinct()
    for level in range(DEPTH):
        sizes = placed.groupBy("node").agg(F.count("*").alias("n")).where(F.col("n") > LEAF)
        if sizes.isEmpty():
            break
        fan = F.least(F.lit(FAN), F.ceil(F.col("n") / LEAF) + 1)
        big = placed.join(sizes, "node").select("node", "rep", fan.cast("int").alias("fan"))
        inside = big.join(points.select("rep", "v"), "rep")
        centres = (
            inside.groupBy("node", F.pmod(hash_, "fan").cast("int").alias("k"))
            .agg(F.min_by("v", hash_).alias("v"))
        )
        centres = store(centres, "centres")
        listed = centres.groupBy("node").agg(F.collect_list(F.struct("k", "v")).alias("centres"))
        moved = store(
            inside.join(listed, "node").select("node", "rep", "v", "centres")
            .mapInArrow(_nearest, "node string, rep bigint, parent string, far double"),
            "tree",
        )
        radii = moved.groupBy("parent", F.col("node").alias("child")).agg(F.max("far").alias("radius"))
        children = store(
            radii.join(
                centres.select(F.concat_ws(".", "node", "k").alias("child"), F.col("v").alias("centre")), "child"
            ),
            "children",
        )
        # A node that was not split is its own only child, without a bound.
        side = lambda s: children.select(
            F.col("parent").alias(s), F.col("child").alias(f"{s}_child"),
            F.col("radius").alias(f"{s}_radius"), F.col("centre").alias(f"{s}_centre"),
        )
        below = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
        apart = _distance(F.col("a_centre"), F.col("b_centre")) > (
            F.col("a_radius") + F.col("b_radius") + near + _SLACK
        )
        both = below.where(~F.coalesce(apart, F.lit(False)))
        left, right = F.coalesce("a_child", "a"), F.coalesce("b_child", "b")
        pairs = store(
            both.where((F.col("a") != F.col("b")) | (left <= right)).select(left.alias("a"), right.alias("b")),
            "pairs",
        )
        placed = store(
            placed.join(sizes.select("node"), "node", "left_anti").select("node", "rep")
            .unionByName(moved.select("node", "rep")),
            "tree",
        )
    sizes = placed.groupBy("node").agg(F.count("*").alias("n")).where(F.col("n") > 2 * LEAF)
    cut = sizes.select("node", F.ceil(F.col("n") / LEAF).cast("int").alias("cuts"))
    leaf = placed.join(cut, "node", "left").select(
        "rep", F.when(F.col("cuts").isNull(), F.col("node")).otherwise(
            F.concat_ws("#", "node", F.pmod(hash_, "cuts"))
        ).alias("node"),
    )
    spread = lambda s: cut.select(
        F.col("node").alias(s), F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias(f"{s}_cut")
    )
    named = lambda s: F.when(F.col(f"{s}_cut").isNull(), F.col(s)).otherwise(F.concat_ws("#", s, f"{s}_cut"))
    whole = pairs.join(spread("a"), "a", "left").join(spread("b"), "b", "left").select(
        "a", "b", named("a").alias("x"), named("b").alias("y")
    )
    return leaf, whole.where("a <> b or x <= y").select(F.col("x").alias("a"), F.col("y").alias("b"))


def _net(v: np.ndarray, above: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centres inside the nodes ``above`` so that each vector has one within ``radius`` and no
    two of a node are closer: (node of every vector, its distance to the centre, centres).

    Distances are taken from a block of vectors at a time, and only to those that no centre
    covers yet, so the memory is that of a block.
    """
    node, far = np.full(len(v), -1), np.zeros(len(v))
    order = np.argsort(above, kind="stable")
    starts = np.r_[0, np.flatnonzero(np.diff(above[order])) + 1, len(v)]
    # A vector alone in its node is its centre.
    alone = np.diff(starts) == 1
    centres = order[starts[:-1][alone]].tolist()
    node[centres] = np.arange(len(centres))
    for first, end in zip(starts[:-1][~alone], starts[1:][~alone]):
        members = order[first:end]
        while len(members):
            block = members[:BLOCK]
            apart = np.sqrt(np.maximum(0, 2 - 2 * (v[block] @ v[members].T)))
            near = apart <= radius
            np.fill_diagonal(near, True)
            # So is one without any other vector near it.
            lonely = np.count_nonzero(near, axis=1) == 1
            node[block[lonely]] = len(centres) + np.arange(lonely.sum())
            centres.extend(block[lonely])
            open_ = np.ones(len(members), bool)
            open_[: len(block)] = ~lonely
            for at in np.flatnonzero(~lonely):
                if not open_[at]:
                    continue
                inside = np.flatnonzero(open_ & near[at])
                node[members[inside]] = len(centres)
                far[members[inside]] = apart[at, inside]
                centres.append(block[at])
                open_[inside] = False
            members = members[open_]
    return node, far, np.array(centres)


class _Tree:
    """Nested levels over the vectors of a leaf: the node of every vector, the centre and
    the covering radius of every node."""

    def __init__(self, v: np.ndarray):
        self.v = v
        self.levels = []
        above = np.zeros(len(v), np.int64)
        for radius in RADII:
            node, far, centres = _net(v, above, radius)
            cover = np.zeros(len(centres))
            np.maximum.at(cover, node, far)
            self.levels.append((node, centres, cover))
            above = node
        # Children of the nodes of each level; those of the last level are the vectors.
        self.children = []
        for (node, _, _), below in zip(self.levels, [*self.levels[1:], None]):
            if below is None:
                parent = node
            else:
                parent = node[below[1]]
            order = np.argsort(parent, kind="stable")
            starts = np.searchsorted(parent[order], np.arange(node.max() + 2))
            self.children.append((order, starts))


def _expand(tree: _Tree, level: int, nodes: np.ndarray, other: np.ndarray):
    """Each node of a list of pairs replaced by its children."""
    order, starts = tree.children[level]
    counts = starts[nodes + 1] - starts[nodes]
    first = np.repeat(starts[nodes] - (np.cumsum(counts) - counts), counts)
    return order[first + np.arange(len(first))], np.repeat(other, counts)


def close_pairs(a: _Tree, b: _Tree, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """All (i, j) with cosine of a[i], b[j] at or above the bound, by dual traversal."""
    near = np.sqrt(2 - 2 * cosine) + _SLACK
    (_, ca, ra), (_, cb, rb) = a.levels[0], b.levels[0]
    x, y = [], []
    for at in range(0, len(ca), BLOCK):
        far = np.sqrt(np.maximum(0, 2 - 2 * (a.v[ca[at : at + BLOCK]] @ b.v[cb].T)))
        i, j = np.nonzero(far <= ra[at : at + BLOCK, None] + rb[None, :] + near)
        x.append(i + at)
        y.append(j)
    x, y = np.concatenate(x), np.concatenate(y)
    for level in range(len(RADII)):
        y, x = _expand(b, level, y, x)
        x, y = _expand(a, level, x, y)
        last = level + 1 == len(RADII)
        keep = []
        for at in range(0, len(x), 200_000):
            p, q = x[at : at + 200_000], y[at : at + 200_000]
            if last:
                keep.append(np.einsum("ij,ij->i", a.v[p], b.v[q]) >= cosine)
            else:
                (_, ca, ra), (_, cb, rb) = a.levels[level + 1], b.levels[level + 1]
                dots = np.einsum("ij,ij->i", a.v[ca[p]], b.v[cb[q]])
                keep.append(np.sqrt(np.maximum(0, 2 - 2 * dots)) <= ra[p] + rb[q] + near)
        kept = np.concatenate(keep) if keep else np.zeros(0, bool)
        x, y = x[kept], y[kept]
    return x, y


def _labels(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The smallest index that each index reaches."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, x, label[y])
        np.minimum.at(label, y, label[x])
        label = label[label]
        if (label == before).all():
            return label


def _leaf_pairs(batches: Iterator) -> Iterator[tuple]:
    """(a, b, whether a row is of a, rep, first, n, v) for each pair of leaves of sorted batches."""
    import pyarrow.compute as pc

    whole = lambda key, held: (*key, *[np.concatenate(parts) for parts in zip(*held)])
    key, held = None, []
    for batch in batches:
        edges = _changes(batch.column("a"), batch.column("b")) if batch.num_rows else [0]
        for first, end in zip(edges, edges[1:]):
            part = batch.slice(first, end - first)
            names = part.column("a")[0].as_py(), part.column("b")[0].as_py()
            if names != key:
                if held:
                    yield whole(key, held)
                key, held = names, []
            side = pc.equal(part.column("node"), names[0]).to_numpy(zero_copy_only=False)
            numbers = [part.column(c).to_numpy(zero_copy_only=False) for c in ("rep", "n")]
            held.append((side, numbers[0], np.array(part.column("first").to_pylist(), object), numbers[1], _matrix(part.column("v"))))
    if held:
        yield whole(key, held)


def _compare_leaves(cosine: float):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for name_a, name_b, side, rep, first, n, v in _leaf_pairs(batches):
            left, right = np.flatnonzero(side), np.flatnonzero(~side)
            tree = _Tree(v[left])
            if name_a == name_b:
                x, y = close_pairs(tree, tree, cosine)
                x, y = left[x[x < y]], left[y[x < y]]
            elif len(right) == 0:
                continue
            else:
                x, y = close_pairs(tree, _Tree(v[right]), cosine)
                x, y = left[x], right[y]
            links = np.zeros(len(v), np.int64)
            np.add.at(links, x, n[y])
            np.add.at(links, y, n[x])
            root = _labels(len(v), x, y)
            at = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rep[at]), pa.array(links[at]), pa.array(first[at], pa.int64()), pa.array(first[root[at]], pa.int64())],
                ["rep", "links", "u", "v"],
            )

    return run


def near_duplicates(
    vectors: DataFrame, cosine: float = COSINE, id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """One row per vector: id, n_links (other vectors linked directly), component_id (the
    smallest id that links reach) and kept.

    Vectors link within a label, at this cosine or above. Null labels, unusable vectors (null,
    zero, or with null or non-finite components) and vectors of another length than others
    of their label link with nothing of that kind. Equal vectors are compared once and
    counted as often as they stand there; no task gives all pairs of a group. A row that is
    repeated is another vector, and rows of one id with different vectors have links of their
    own; a null id takes part with its links, but no component is named after it.
    """
    near = float(np.sqrt(2 - 2 * cosine))
    good = F.col(label).isNotNull() & usable(F.col(vector))
    v = F.col(vector)
    keyed = vectors.select(
        F.col(id).alias("id"), v.alias("raw"), F.when(good, F.concat_ws(":", F.col(label).cast("string"), F.size(v))).alias("root"),
        F.xxhash64(v).alias("h"), F.xxhash64(F.lit(1), v).alias("g"),
    )
    sets = store(
        keyed.where("root is not null").groupBy("root", "h", "g")
        .agg(F.min("id").alias("first"), F.count("*").alias("n"), F.any_value("raw").alias("raw"))
        # The table is written once, so the numbers stay; one id may stand for several vectors.
        .withColumn("rep", F.monotonically_increasing_id()),
        "vectors",
    )
    schema = "rep bigint, first bigint, root string, n bigint, v array<double>"
    points = store(sets.select("rep", "first", "root", "n", "raw").mapInArrow(_normal, schema), "points")
    leaf, pairs = upper_tree(points, near)
    pairs = store(pairs, "pairs")
    ends = pairs.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("node"))
    work = (
        leaf.join(points.select("rep", "first", "n", "v"), "rep").join(ends, "node")
        .select("a", "b", "node", "rep", "first", "n", "v")
        .repartition("a", "b").sortWithinPartitions("a", "b")
    )
    found = store(work.mapInArrow(_compare_leaves(cosine), "rep bigint, links bigint, u bigint, v bigint"), "links")
    linked = components(found.select("u", "v"))
    degrees = found.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = sets.select("root", "h", "g", "rep", "first", "n").join(degrees, "rep", "left").join(
        linked.select(F.col("id").alias("first"), "component_id"), "first", "left"
    )
    component = F.coalesce("component_id", "first", "id")
    return keyed.join(classes, ["root", "h", "g"], "left").select(
        F.col("id").alias(id),
        (F.coalesce("n", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).cast("bigint").alias("n_links"),
        component.alias("component_id"), (F.col("id") == component).alias("kept"),
    )
