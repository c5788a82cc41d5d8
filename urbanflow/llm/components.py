"""Connected components over links that stay distributed: alternating large and small stars.

Each round is two aggregations and two joins over the links; rounds grow with the logarithm of the
component size. The aggregated side of a join is landed first, so that both sides of the join are
dealt out for it and a node with very many links can be split. Nothing but a count and a checksum
reaches the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, landed_at


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of a link; root is the smallest node reachable.

    Nulls: a link with a null end is none. Self-links and repeated links change nothing. No links:
    an empty frame.
    """
    spark = links.sparkSession
    x, y = F.col(a), F.col(b)
    start = links.where(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct()
    e, path = landed_at(start, "links")
    seen = _signature(e)
    while True:
        nxt, new_path, used = _round(e)
        now = _signature(nxt)
        for done in (path, *used):
            discard(spark, done)
        e, path = nxt, new_path
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _signature(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _round(e: DataFrame) -> tuple[DataFrame, str, list[str]]:
    """One large star (every larger neighbour moves to the smallest neighbour), one small star: the new
    links, where they are, and the tables used on the way."""
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low, low_path = landed_at(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "stars")
    large, large_path = landed_at(
        both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "stars")
    least, least_path = landed_at(large.groupBy("u").agg(F.min("v").alias("m")), "stars")
    moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    out, path = landed_at(moved.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
    return out, path, [low_path, large_path, least_path]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of one block (arrays of node values) as (node, smallest node of its component), roots
    left out: at most one row a node, however many links there are."""
    if not len(a):
        return a[:0], b[:0]
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        for side in (x, y, label[x], label[y]):  # hook the ends and their present roots
            np.minimum.at(new, side, low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    child = label != np.arange(len(nodes))
    return nodes[child], nodes[label[child]]
