"""Connected components of a link table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postalis.llm.common import Scratch

#: Links that one local step holds.
CHUNK = 200_000


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct nodes of the links and the smallest node that each reaches over them."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    lowest = np.arange(len(nodes))
    while True:
        low = np.minimum(lowest[x], lowest[y])
        new = lowest.copy()
        np.minimum.at(new, lowest[x], low)
        np.minimum.at(new, lowest[y], low)
        while ((further := new[new]) != new).any():
            new = further
        if (new == lowest).all():
            return nodes, nodes[lowest]
        lowest = new


def components(links: DataFrame, scratch: Scratch, chunk: int = CHUNK) -> DataFrame:
    """(node, component) of the nodes in links (a long, b long); component is the smallest node reachable.

    Each task solves the links it has, `chunk` at a time, so a node has one root a chunk. Where a node has several,
    these roots are the links of the next, much smaller level; its answer is joined back. A level's largest root is
    never a root again, and as nodes are hashes, levels shrink by a factor. A level's links are dealt to no more tasks
    than make full chunks: in many small ones, a node would have as many roots, and levels would shrink slowly.
    """

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        n = 0

        def solved() -> pa.RecordBatch:
            a, b = (np.concatenate([x.column(i).to_numpy() for x in waiting]) for i in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in roots(a, b)], ["node", "root"])

        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                n += batch.num_rows
            if n >= chunk:
                yield solved()
                waiting, n = [], 0
        if waiting:
            yield solved()

    levels, edges, tables = [], links.select("a", "b"), []
    n_links = edges.count()
    while True:
        tasks = max(1, -(-n_links // chunk))
        found = (edges.repartition("a") if levels and tasks > 1 else edges).coalesce(tasks).mapInArrow(local, "node long, root long")
        if tasks == 1:  # one chunk, so one root
            placed = scratch.keep(found.withColumnRenamed("root", "component"))
            tables.append(placed)
            levels.append(placed)
            break
        placed = scratch.keep(found.groupBy("node").agg(F.min("root").alias("component"), F.collect_set("root").alias("roots")))  # a root a chunk
        tables.append(placed)
        levels.append(placed.select("node", "component"))
        edges = placed.filter("size(roots) > 1").select(F.col("component").alias("a"), F.explode("roots").alias("b")).filter("a <> b")
        if not (n_links := edges.count()):
            break
    labels = levels.pop()
    while levels:
        low = labels.select(F.col("node").alias("component"), F.col("component").alias("low"))
        labels = levels.pop().join(low, "component", "left").select("node", F.coalesce("low", "component").alias("component"))
    if len(tables) == 1:
        return labels
    labels = scratch.keep(labels)
    scratch.drop(*tables)
    return labels
