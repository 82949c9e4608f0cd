"""Connected components of a link table, as a sequence of Spark jobs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.session import persist_table


ROWS_PER_FILE = 500_000


def spanning(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union-find over id pairs: every id with the smallest id it is united with."""
    ids, flat = np.unique(pairs, return_inverse=True)
    ends = flat.reshape(-1, 2)
    root = np.arange(len(ids))
    while True:
        least = np.minimum(root[ends[:, 0]], root[ends[:, 1]])
        new = root.copy()
        np.minimum.at(new, root[ends[:, 0]], least)
        np.minimum.at(new, root[ends[:, 1]], least)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        new = new[root]
        if np.array_equal(new, root):
            break
        root = new
    other = root != np.arange(len(ids))
    return ids[root[other]], ids[other]


def _shape(edges: DataFrame) -> tuple[int, int]:
    """Number of edges ``(a, b)``, and of nodes that keep them from being stars: an
    ``a`` with several ``b`` or one that is a ``b`` itself."""
    ends = edges.select(F.col("a").alias("u"), F.lit(1).alias("low"), F.lit(0).alias("top")).union(
        edges.select(F.col("b").alias("u"), F.lit(0).alias("low"), F.lit(1).alias("top")))
    nodes = ends.groupBy("u").agg(F.sum("low").alias("low"), F.max("top").alias("top"))
    r = nodes.agg(F.sum("low").alias("n"), F.count_if(F.expr("low > 1 or (low > 0 and top > 0)")).alias("bad")).first()
    return int(r["n"] or 0), int(r["bad"] or 0)


def _nearest(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest node reachable from each node of ``edges(a, b)`` (longs).

    Union-find as alternating star contraction: every round hooks a node's
    larger neighbours, then its smaller ones, to the smallest neighbour, until
    the edge set is a set of stars. A round is two grouped minima (combined
    before the shuffle, so a hub is one row per task) and two joins that AQE
    splits on a hub. Each round is written to the shared folder, which cuts the
    lineage; only two counts reach the driver.

    Returns ``(node, component)`` for the nodes that occur in an edge between
    two different nodes; null ends and self links are ignored.
    """
    e = (edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
         .where("a is not null and b is not null and a <> b").distinct())
    e = persist_table(e, "links")
    n, bad = _shape(e)
    for _ in range(max_rounds):
        if not bad:
            break
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        m = _nearest(both)
        large = (both.join(m, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).where("u <> v"))
        small_in = large.distinct()
        m2 = _nearest(small_in)
        small = small_in.join(m2, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            m2.select(F.col("u").alias("a"), F.col("m").alias("b")))
        # a round makes no more edges than it got: write few files for few edges
        e = persist_table(small.where("a <> b").distinct().coalesce(1 + n // ROWS_PER_FILE), "links")
        n, bad = _shape(e)
    if bad:
        raise RuntimeError("components did not settle")
    return (e.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .union(e.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())
