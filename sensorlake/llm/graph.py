"""Connected components of a link table, by contraction in Spark."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.sources.shared import stored

#: Links, at 16 bytes, that one task contracts to the end.
LAST = 1 << 17


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n rows the least row that the links a-b join it to."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) of all links."""
    both = [(batch.column("a").to_numpy(), batch.column("b").to_numpy()) for batch in batches]
    if both:
        a, b = (np.concatenate(ends) for ends in zip(*both, strict=True))
        nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        root = forest(nodes.size, place[: a.size], place[a.size :])
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[root])], ["node", "root"])


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); nodes of one component have one root.

    In each round every node points to the neighbour, or itself, that comes first in an order
    drawn anew by hashing, and links are moved to where their ends point. A constant share of
    the nodes is expected to go in each round, whatever the shape of the graph, long chains
    included. When ``LAST`` links are left, one task joins them to the end. Self links and repeated
    links do no harm; no links give no rows.
    """
    left = stored(links.select("a", "b").where("a <> b"))
    moves: list[DataFrame] = []
    while left.count() > LAST:

        def drawn(node: str, number: int = len(moves)) -> Column:
            return F.struct(F.xxhash64(node, F.lit(number)).alias("order"), F.col(node).alias("node"))

        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = both.groupBy("a").agg(F.min(drawn("b")).alias("first"))
        moves.append(stored(first.select(F.col("a").alias("node"), F.least(drawn("a"), "first")["node"].alias("root"))))
        ends = [moves[-1].select(F.col("node").alias(end), F.col("root").alias(f"{end}_root")) for end in ("a", "b")]
        moved = left.join(ends[0], "a").join(ends[1], "b").select(F.col("a_root").alias("a"), F.col("b_root").alias("b"))
        left = stored(moved.where("a <> b").distinct())
    last = stored(left.coalesce(1).mapInArrow(_finished, "node long, root long"))
    if not moves:
        return last
    result = moves[0]
    for more in [*moves[1:], last]:
        further = more.select(F.col("node").alias("root"), F.col("root").alias("further"))
        result = result.join(further, "root", "left").select("node", F.coalesce("further", "root").alias("root"))
    return result
