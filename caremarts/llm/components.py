"""Connected components of edges that stay distributed.

Rounds of two steps: every partition of at most ``PART_EDGES`` edges contracts
its own edges to stars, then a large-star and a small-star step join the stars
of different partitions (aggregates and joins on the node; a hub's minimum is
combined before the shuffle, and its edges are a skewed join side, which Spark
splits). Rounds end when no edge changes; edges that fit one partition need one
contraction. Every round is cut with a checkpoint in the shared folder.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremarts.llm.common import checkpointed

PART_EDGES = 1_000_000


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``component``) for every node of ``edges`` (``a``, ``b``): the least node reachable."""
    now = checkpointed(edges.where("a != b").select(F.col("a").alias("u"), F.col("b").alias("v")))
    parts, mark = -(-now.count() // PART_EDGES), None
    while parts:
        now = now.repartition(parts).mapInArrow(_contracted, "u long, v long")
        if parts == 1:
            now = checkpointed(now)
            break
        now = checkpointed(_small_star(_large_star(now)))
        found = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(found) == mark:
            break
        mark = tuple(found)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def least_reachable(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of these edges in order, and the least node that each reaches."""
    nodes, codes = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = codes[: len(u)], codes[len(u) :]
    least = np.arange(len(nodes))
    while True:
        low = np.minimum(least[a], least[b])
        new = least.copy()
        for end in (a, b, least[a], least[b]):
            np.minimum.at(new, end, low)
        new = new[new]
        if (new == least).all():
            return nodes, nodes[least]
        least = new


def _contracted(batches):
    u, v = [], []
    for b in batches:
        u.append(b.column("u").to_numpy())
        v.append(b.column("v").to_numpy())
    if u:
        nodes, least = least_reachable(np.concatenate(u), np.concatenate(v))
        own = nodes != least
        yield pa.RecordBatch.from_pydict({"u": pa.array(nodes[own]), "v": pa.array(least[own])})


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands the least of its neighbourhood to its larger neighbours."""
    both = edges.select("u", "v").union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands the least of its smaller neighbours to those and to itself."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()
