"""Connected components of an edge table by alternating large-star and
small-star steps, and the in-task contraction that keeps edge tables small.
Nodes are bigints; every node ends up linked to the smallest of its component.
No step collects edges or labels to the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Contract edges to (node, smallest node of its component) pairs."""
    nodes, idx = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = idx[:len(u)], idx[len(u):]
    lab = np.arange(len(nodes))
    while True:
        la, lb = lab[a], lab[b]
        if (la == lb).all():
            break
        low = np.minimum(la, lb)
        np.minimum.at(lab, la, low)
        np.minimum.at(lab, lb, low)
        while True:
            nxt = lab[lab]
            if (nxt == lab).all():
                break
            lab = nxt
    off = lab != np.arange(len(nodes))
    return nodes[off], nodes[lab[off]]


def _min_per(df: DataFrame) -> DataFrame:
    # written, so that the join that follows shuffles two plain tables and a
    # hub's rows can be split by the skew join
    return written(df.groupBy("u").agg(F.min("v").alias("m")), "cc-min")


def components(edges: DataFrame) -> DataFrame:
    """(a, b) edges -> (node, root) for every node that isn't its own root.

    Rounds are logarithmic in the longest path; each is written to the shared
    folder, so a lost executor costs one round at most."""
    e = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                .filter("u <> v").distinct(), "cc-edges")
    before = None
    while True:
        # large star: neighbours above u are linked to the smallest neighbour
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _min_per(both.select("u", F.least("u", "v").alias("v")))
        e1 = (both.join(low, "u").filter(F.col("v") > F.col("u"))
              .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        e1 = written(e1, "cc-large")
        # small star: neighbours below u, and u itself, to the smallest of them
        low = _min_per(e1)
        joined = e1.join(low, "u")
        e = written(joined.select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("x"))
            .select("x.u", "x.v").filter("u <> v").distinct(), "cc-small")
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
