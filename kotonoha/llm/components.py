"""Connected components: forests within tasks first, then rounds of stars over what is left.

Every task reduces its edges to a forest of stars with an in-memory pass. Stars are grouped by node; where a node has
several centres, the pairs of centres are what is left. Up to ``few`` such pairs go to one task. More of them are worked on
by alternating star rounds (every node's larger neighbours are tied to its smallest one, then its smaller ones), each a few
joins and aggregations over all tasks, until nothing changes or ``few`` pairs are left: no task ever sees more than that. A
hot centre is no hot key: minima are combined before they move, and adaptive execution splits the joins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle

FEW_EDGES = 200_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges and, for each, the smallest node that it reaches."""
    nodes, code = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = code[: len(a)], code[len(a) :]
    label = np.arange(len(nodes))
    while True:
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return nodes, nodes[label]
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        least = np.minimum(x, y)
        np.minimum.at(label, np.maximum(x, y), least)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held_a, held_b, held = [], [], 0
    for batch in batches:
        held_a.append(batch.column(0).to_numpy(zero_copy_only=False))
        held_b.append(batch.column(1).to_numpy(zero_copy_only=False))
        held += batch.num_rows
        if held > 2_000_000:
            nodes, roots = forest(np.concatenate(held_a), np.concatenate(held_b))
            held_a, held_b, held = [nodes], [roots], 0
    if held_a:
        nodes, roots = forest(np.concatenate(held_a), np.concatenate(held_b))
        for at in range(0, len(nodes), 100_000):
            yield pa.record_batch([pa.array(nodes[at : at + 100_000]), pa.array(roots[at : at + 100_000])], ["v", "root"])


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _star_rounds(edges: DataFrame, few: int) -> DataFrame:
    """(v, root) of the edges (a, b): alternating star rounds, the last few edges in one task."""
    now = settle(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    state = None
    while True:
        both = now.union(now.select("v", "u"))
        large = both.where("v > u").join(_least(both), "u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).where("u <> v").distinct()
        large = settle(large)
        tied = large.join(_least(large), "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        now = settle(tied.where("u <> v").distinct())
        found = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.bit_xor(F.xxhash64("v", "u")).alias("y")).first()
        if found["n"] <= few:
            return now.coalesce(1).mapInArrow(_stars, "v long, root long")
        if found == state:
            return now.select(F.col("u").alias("v"), F.col("v").alias("root"))
        state = found


def components(edges: DataFrame, few: int = FEW_EDGES) -> DataFrame:
    """Rows (id, component): for each node of the edges (a, b) the smallest node it reaches. Self-edges and repeats are allowed."""
    stars = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).mapInArrow(_stars, "v long, root long")
    # A node has at most one centre from each task.
    level = settle(stars.groupBy("v").agg(F.min("root").alias("up"), F.collect_set("root").alias("roots")))
    left = settle(level.where(F.size("roots") > 1).select(F.explode("roots").alias("a"), F.col("up").alias("b")).where("a <> b").distinct())
    flat = level.select(F.col("v").alias("id"), F.col("up").alias("component"))
    n = left.count()
    if not n:
        return flat
    above = left.coalesce(1).mapInArrow(_stars, "v long, root long") if n <= few else _star_rounds(left, few)
    above = settle(above).select(F.col("v").alias("component"), F.col("root").alias("_c"))
    return flat.join(above, "component", "left").select("id", F.coalesce("_c", "component").alias("component"))
