"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnwise.session import store


def _star(pairs: DataFrame) -> DataFrame:
    """Smallest neighbour of every node, itself included; one row per node."""
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``links`` has u and v, bigint: gives (id, component_id), the smallest id that each
    linked id reaches. Ids without a link to another one are not in the result.

    A large-star step links all larger neighbours of a node to its smallest neighbour, a
    small-star step all others; after a few rounds every edge points to the smallest id of
    its component. A node of any degree is summed up inside the tasks first, and AQE splits
    its join. Each round is written to the shared folder; the driver sees two numbers of it.
    """
    both = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = store(both.distinct(), "links")
    before = _digest(edges)
    while before[0]:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
            .join(_star(around), "u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
            .distinct()
        )
        smallest = _star(large)
        small = large.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = store(
            small.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct(), "links"
        )
        after = _digest(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
    )
