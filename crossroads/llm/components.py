"""Connected components of a graph given as an edge table, by alternating large-star and small-star steps.

Every step is a pre-aggregated minimum by node and a join back, so a node with very many
neighbours is a skewed join, which adaptive execution splits. Each round's edges are a stored
table; the loop ends when a round changes nothing. Only two numbers come to the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossroads.llm.frames import stored


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) with the same components as (u, v)."""
    nodes, inverse = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = inverse[:len(u)], inverse[len(u):]
    label = np.arange(len(nodes))
    while True:
        la, lb = label[a], label[b]
        if (la == lb).all():
            break
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while (label[label] != label).any():
            label = label[label]
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (u > v). Large: to each node's larger neighbours; small: to its smaller ones and itself."""
    if large:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        made = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        made = edges.join(least, "u").select("v", "m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return made.filter("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v) that is not the smallest of its component."""
    edges = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct(), "edges")
    before = None
    while (now := _state(edges)) != before:
        before = now
        edges = stored(_star(_star(edges, large=True), large=False), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
