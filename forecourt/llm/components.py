"""Connected components of a graph too large for one machine: alternating large and small stars.

Each round hangs every node's larger neighbours, then its smaller ones, on the smallest node it knows, until every
component is a star around its smallest node; that takes about log(n) rounds. A node's neighbours are never gathered:
a round is a minimum per node (combined before the shuffle) and an equality join, whose hot keys adaptive execution
splits. Edges are kept in the shared checkpoint folder after each round.

Before the rounds each task replaces its edges, of which it takes a bounded number, by stars around the smallest nodes they
connect. Few edges are settled by that, in one step instead of some twenty per round on the driver's books; of many,
fewer are left for the rounds, on shorter paths.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .shared import fixed

#: Edges of a task before the rounds, about; no task holds more, however many there are.
EDGES = 1 << 18


def stars(a, b):
    """(nodes, smallest node each is connected to) for the edges (a, b), without the smallest nodes themselves."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = place[: len(a)], place[len(a) :]
    root = np.arange(len(nodes))
    while (apart := np.flatnonzero(root[u] != root[v])).size:
        u, v = u[apart], v[apart]
        np.minimum.at(root, np.maximum(root[u], root[v]), np.minimum(root[u], root[v]))
        while ((further := root[root]) != root).any():
            root = further
    hung = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[hung], nodes[root[hung]]


def _stars(batches):
    batches = [batch for batch in batches if batch.num_rows]
    if batches:
        rows = pa.Table.from_batches(batches)
        ends = stars(*(c.to_numpy(zero_copy_only=False) for c in rows.columns))
        yield pa.RecordBatch.from_arrays([pa.array(x, c.type) for x, c in zip(ends, rows.columns)], ["a", "b"])


def _hung(pairs, low):
    """(node, centre) for each of the pairs (u, v): v hangs on the smallest node around u."""
    return pairs.join(low, "u").where(F.col("v") != F.col("low")).select(F.col("v").alias("a"), F.col("low").alias("b"))


def _large_star(edges):
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    low = fixed(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low")))
    return _hung(both.where("v > u"), low).distinct()


def _small_star(edges):
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = fixed(down.groupBy("u").agg(F.min("v").alias("low")))
    return _hung(down, low).union(low.select("u", "low")).distinct()


def _state(edges):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def connected_components(edges, a="a", b="b"):
    """(node, root) for every node of an edge with two different ends; root is the component's smallest node.

    Edges with a null end and loops are ignored, repeated edges count once; no edges give no rows.
    """
    edges = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct()
    edges = fixed(edges)
    tasks = max(1, -(-edges.count() // EDGES))
    edges = fixed(edges.coalesce(tasks).mapInArrow(_stars, edges.schema))
    before = _state(edges) if tasks > 1 else None
    while before and before[0]:
        edges = fixed(_small_star(_large_star(edges)))
        after = _state(edges)
        if after == before:
            break
        before = after
    centres = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(centres)
