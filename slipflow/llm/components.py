"""Connected components by alternating large-star and small-star rounds.

Every round is joins and aggregations on edges; nothing about nodes reaches the driver but the
number of edges that changed. Each half round is written to the checkpoint folder, so lineage
stays short and a lost executor costs one step. Minima are aggregated with map-side combine and
joined back from a written table, so adaptive execution can split a node with very many edges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, staged_with


def _mark():
    """What tells one set of edges from another."""
    return F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("mark")


def _contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges of a batch as stars: every node linked to the smallest node that the batch's edges
    reach from it. Shortens chains before the first round, without a shuffle."""
    for batch in batches:
        names, code = np.unique(np.concatenate([batch["u"], batch["v"]]), return_inverse=True)
        parent = np.arange(len(names))
        u, v = code[:len(batch)], code[len(batch):]
        while True:
            a, b = parent[u], parent[v]
            low = np.minimum(a, b)
            new = parent.copy()
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            while True:
                jump = new[new]
                if (jump == new).all():
                    break
                new = jump
            if (new == parent).all():
                break
            parent = new
        child = np.flatnonzero(parent != np.arange(len(names)))
        yield pd.DataFrame({"u": names[child], "v": names[parent[child]]})


def _star(edges: DataFrame, large: bool) -> tuple[DataFrame, dict]:
    """One star step over undirected edges (u, v). Large: every larger neighbour of u is linked to
    u's smallest neighbour (or u). Small: u and its smaller neighbours are linked to the smallest."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = staged(both.groupBy("u").agg(F.min("v").alias("m"))
                   .withColumn("m", F.least("u", "m")), "star")
    joined = both.join(least, "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(least.filter("m < u").select("u", F.col("m").alias("v")))
    return staged_with(out.filter("u <> v").distinct(), "star", *_mark())


def _settled(edges: DataFrame) -> bool:
    """Whether all edges are stars: no node has two, and none that has one is another's centre. One
    aggregation, where a round that changes nothing would take four steps to tell."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("centre")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("centre")))
    return ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("centre").alias("centre")) \
        .filter("out + centre > 1").isEmpty()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns u, v: two long ids or two strings);
    component is the smallest node reachable. Loops, repeated edges and nulls are ignored."""
    whole = edges.select("u", "v").filter("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    now, state = staged_with(whole.mapInPandas(_contract, whole.schema).distinct(), "edges", *_mark())
    for _ in range(rounds):
        if not state["n"] or _settled(now):
            break
        before = state
        now, state = _star(_star(now, True)[0], False)
        if state == before:  # a round that changes nothing: all are stars
            break
    else:
        raise RuntimeError("components did not settle")
    # stars now: every node but the centre has one edge, to its centre
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
