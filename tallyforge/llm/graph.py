"""Connected components by alternating large-star and small-star rounds on the cluster, until so few edges are left that one task settles them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.storage import discard, written

#: Most edges (16 bytes each) that one task settles; a round on the cluster is several shuffles, whatever the number of edges.
TASK_EDGES = 500_000


def roots(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ends of the edges, sorted, and of each the smallest end that it is connected to."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    root, i, j = np.arange(len(nodes)), at[: len(u)], at[len(u) :]
    while len(i):
        np.minimum.at(root, np.maximum(i, j), np.minimum(i, j))
        while not np.array_equal(root, up := root[root]):
            root = up
        i, j = root[i], root[j]
        between = i != j
        i, j = i[between], j[between]
    return nodes, nodes[root]


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All edges, in one task, to the nodes and their roots."""
    ends = [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches if b.num_rows]
    if ends:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in roots(*map(np.concatenate, zip(*ends, strict=True)))], names=["u", "root"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours go to its smallest. In ``edges(u, v)`` u is the larger end, so they are the u of its edges as v.

    A node without a smaller neighbour keeps its edges as they are: only the others' minima, aggregated map-side, take part in the join. They are written first, so the join has a
    shuffle on either side, which Spark can split at a hub."""
    low = edges.select("u", F.col("v").alias("m")).groupBy("u").agg(F.min("m").alias("m"))
    low = written(low.select(F.col("u").alias("v"), "m"), "minima")
    return edges.join(low, "v", "left").select("u", F.coalesce("m", "v").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node's smaller neighbours, of which few are left, and itself go to its smallest."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(low, "u")
    moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` of longs to ``(u, root)`` for every node that has an edge; root is the smallest node of its component.

    Every round writes its edges to the shared folder, so a lost executor costs one round at most. The number of rounds
    follows the square of the log of the largest component's size at worst. Edges meet in one task only if there are at most TASK_EDGES in all.
    Null ends and self loops are ignored; an empty input gives an empty result.
    """
    state = written(edges.where("u <> v").select(F.greatest("u", "v").cast("long").alias("u"), F.least("u", "v").cast("long").alias("v")).distinct(), "edges")
    mark = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = mark(state)
    while before[0] > TASK_EDGES:
        after_state = written(_small_star(_large_star(state)), "edges")
        after = mark(after_state)
        discard(state)
        state = after_state
        if after == before:
            break
        before = after
    else:
        settled = written(state.repartition(1).mapInArrow(_settled, "u long, root long"), "roots")
        discard(state)
        return settled
    return state.select("u", F.col("v").alias("root")).unionByName(state.select(F.col("v").alias("u"), F.col("v").alias("root")).distinct())
