"""Connected components of a link table by alternating star contractions.

Every task first contracts the links it holds to stars by itself.  Every round then
replaces each node's links by links to its smallest neighbour: first towards larger
nodes, then towards smaller ones, until all components are stars.  The rounds needed
grow with the logarithm of the nodes, whatever the length of chains; a hub's links
are only aggregated and joined, never gathered.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediafeat.llm import kernels as K
from mediafeat.llm.common import scratch

BATCH = 1 << 20      # links that a task contracts at a time


def _stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) of a few links."""
    node, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    root = np.arange(len(node))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    away = root != np.arange(len(node))
    return node[away], node[root[away]]


def _contract(batches):
    import pyarrow as pa
    held, n = [], 0

    def out():
        u, v = _stars(*(np.concatenate(c) for c in zip(*held)))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])
    for b in batches:
        held.append((b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)))
        n += b.num_rows
        if n >= BATCH:
            yield out()
            held, n = [], 0
    if n:
        yield out()


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node that has a link to another one; root is the
    smallest node of its component."""
    e = links.where(F.col(a) != F.col(b)).select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
    e = scratch(e.mapInArrow(K.lean(_contract), "u long, v long").distinct(), "links")     # u > v from here on
    for _ in range(max_rounds):
        # stars: a node has one link down, or only links from above
        ends = e.select(F.col("u").alias("n"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(
            e.select(F.col("v").alias("n"), F.lit(0).alias("down"), F.lit(1).alias("up")))
        bent = ends.groupBy("n").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where("down > 1 or (down = 1 and up = 1)")
        if bent.isEmpty():
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
                 .where("u != v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                              F.struct(F.col("u"), F.col("m").alias("v")))).alias("x"))
        e = scratch(small.select("x.u", "x.v").where("u != v").distinct(), "stars")
    raise RuntimeError("star contraction has not settled")
