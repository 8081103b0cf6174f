"""Connected components of links between documents or vectors, as joins.

Alternating large-star and small-star steps: each replaces a node's links by
links to the least neighbour, until every node hangs on the least node of its
component. The least neighbour is an aggregate and the links meet it in a join,
so no node's links are gathered into one row, and a node with very many links
is split by the adaptive skew join. Each round is written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import ready, saved


def _forest(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch's links as stars around the least node of each local
    component, which leaves the components as they are."""
    for frame in frames:
        a, b = (frame.column(k).to_numpy(zero_copy_only=False) for k in ("a", "b"))
        nodes, back = np.unique(np.concatenate((a, b)), return_inverse=True)
        x, y = back[: len(a)], back[len(a) :]
        root = np.arange(len(nodes))
        while True:
            rx, ry = root[x], root[y]
            if np.array_equal(rx, ry):
                break
            np.minimum.at(root, np.maximum(rx, ry), np.minimum(rx, ry))
            while not np.array_equal(root, jump := root[root]):
                root = jump
        far = np.flatnonzero(root != np.arange(len(nodes)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[far]), pa.array(nodes[root[far]])], names=["a", "b"])


def _nearest(links: DataFrame) -> DataFrame:
    """To each (u, v) the least of u's neighbours and u itself."""
    least = links.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return links.join(least, "u")


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """links: (a, b) longs in either order, doubles allowed. Returns node and
    component (the least node that it reaches) of all nodes but the least of
    each component; no links give no rows."""
    ready(links.sparkSession)
    links = links.where("a != b").select("a", "b")
    links = saved(links.mapInArrow(_forest, "a long, b long").distinct(), "links")
    before = None
    for _ in range(most_rounds):
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select(F.col("b"), F.col("a")))
        large = _nearest(both).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        near = _nearest(down)
        small = near.select(F.col("v").alias("a"), F.col("m").alias("b")).union(near.select("u", "m")).where("a != b")
        links = saved(small.mapInArrow(_forest, "a long, b long").distinct(), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.countDistinct("a")).first()
        if tuple(now) == before and now[0] == now[2]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = tuple(now)
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
