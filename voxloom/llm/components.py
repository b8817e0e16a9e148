"""Connected components of links: forests inside partitions, then alternating stars.

Links lie in partitions of about TASK_LINKS rows. A task replaces its links by stars: each
node and the smallest one it reaches there. If all links fit one task, that is the result.
Otherwise rounds of joins and small aggregates move the stars of different tasks together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import settle

MAX_ROUNDS = 64
TASK_LINKS = 1 << 20


def components(links: DataFrame, a: str = "a", b: str = "b", task_links: int = TASK_LINKS) -> DataFrame:
    """node, component (smallest node reachable) for every node that has a link.

    In each round a node hands its larger neighbours, then its smaller ones, to the smallest
    neighbour it has; rounds grow with the logarithm of the longest chain. Minima are
    combined before they are shuffled, and written, so a join with a hot node has two
    exchanges and adaptive execution can split it. Links with a null end or equal ends say
    nothing. No links: no rows.
    """
    x, y = F.col(a), F.col(b)
    edges = settle(links.filter(x != y).select(F.greatest(x, y).alias("hi"), F.least(x, y).alias("lo")))
    before = None
    for _ in range(MAX_ROUNDS):
        tasks = max(1, -(-edges.count() // task_links))
        edges = settle(edges.coalesce(tasks).mapInArrow(_stars, "hi bigint, lo bigint"))
        if tasks > 1:
            edges = _small_star(_large_star(edges))
            after = _state(edges)
            if after != before:
                before = after
                continue
        return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def forest(size: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each position the smallest one it is connected with."""
    label = np.arange(size)
    while len(i):
        before = label.copy()
        least = np.minimum(label[i], label[j])
        np.minimum.at(label, i, least)
        np.minimum.at(label, j, least)
        # What a label stood for now stands for the smaller one as well.
        np.minimum.at(label, before[i], least)
        np.minimum.at(label, before[j], least)
        label = label[label]
        if (label == before).all():
            break
    return label


def spanning(size: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The numbers of pairs i, j that connect what all of them connect, none of them in vain."""
    label, left, chosen = np.arange(size), np.arange(len(i)), [np.zeros(0, np.int64)]
    while True:
        one, two = label[i[left]], label[j[left]]
        apart = one != two
        left, high, low = left[apart], np.maximum(one, two)[apart], np.minimum(one, two)[apart]
        if not len(left):
            return np.concatenate(chosen)
        # Each part takes one pair that leads to a smaller part, so there is no circle.
        part, first = np.unique(high, return_index=True)
        chosen.append(left[first])
        up = np.arange(size)
        up[part] = low[first]
        while (up != up[up]).any():
            up = up[up]
        label = up[label]


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The partition's links as a link from each node to the smallest one it reaches."""
    held = [batch for batch in batches if batch.num_rows]
    if held:
        table = pa.Table.from_batches(held)
        hi, lo = (table.column(i).to_numpy() for i in range(2))
        nodes, place = np.unique(np.concatenate([hi, lo]), return_inverse=True)
        root = forest(len(nodes), place[: len(hi)], place[len(hi) :])
        moved = np.flatnonzero(root != np.arange(len(nodes)))
        for s in range(0, len(moved), 1 << 16):
            own = moved[s : s + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(nodes[root[own]])], ["hi", "lo"])


def _state(edges: DataFrame) -> tuple:
    """Count and checksum of the links; equal in two rounds means that nothing moved."""
    mixed = F.xxhash64("hi", "lo").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mixed)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionByName(
        edges.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
    )
    least = settle(both.groupBy("u").agg(F.min("v").alias("m")))
    joined = edges.join(least, edges["lo"] == least["u"])
    return settle(joined.select("hi", F.least("lo", "m").alias("lo")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = settle(edges.groupBy("hi").agg(F.min("lo").alias("m")))
    moved = edges.join(least.withColumnRenamed("hi", "u"), edges["hi"] == F.col("u"))
    handed = moved.filter(F.col("lo") != F.col("m")).select(
        F.col("lo").alias("hi"), F.col("m").alias("lo")
    )
    kept = least.select("hi", F.col("m").alias("lo"))
    return settle(kept.unionByName(handed).distinct())
