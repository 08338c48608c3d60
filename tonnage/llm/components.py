"""Connected components of an edge table by alternating large-star and small-star steps.

Edges are thinned first: each task takes a bounded share of them, however they lie, and leaves a
spanning forest, so a dense group costs the steps no more rows than it has nodes for each share.  Every
step is a join and an aggregate; the edges are written to the shared folder after each round, so
nothing grows on the driver and lost executors cost one round at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonnage.llm.common import staged

#: Edges of a task's share.
_SHARE = 500_000


def least_labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least node of its component for each of ``n`` nodes."""
    label = np.arange(n)
    while len(a):
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], least)
        np.minimum.at(label, label[b], least)
        while not np.array_equal(label, flat := label[label]):
            label = flat
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


def _thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of every share of edges (u, v) one (node, least node) for each node but the least of each component."""

    def forest(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        both = pa.chunked_array([x.column(k) for k in range(2) for x in parts]).combine_chunks()
        values = pc.unique(both)
        values = values.take(pc.sort_indices(values))
        at = pc.index_in(both, values).to_numpy(zero_copy_only=False).reshape(2, -1)
        label = least_labels(at[0], at[1], len(values))
        node = np.flatnonzero(label != np.arange(len(values)))
        return pa.RecordBatch.from_arrays([values.take(pa.array(node)), values.take(pa.array(label[node]))], names=["u", "v"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= _SHARE:
            yield forest(held)
            held = []
    if held:
        yield forest(held)


def _towards_least(edges: DataFrame) -> DataFrame:
    """Distinct (u, v) with u > v; loops go."""
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count("*"), F.coalesce(F.expr("bit_xor(xxhash64(u, v))"), F.lit(0))).first()
    return r[0], r[1]


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, root (the component's least node) of every node of ``edges`` (columns a, b, one orderable type)."""
    now = staged(_towards_least(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))), "edges")
    shares = -(-now.count() // _SHARE)
    if shares:
        now = staged(now.coalesce(shares).mapInArrow(_thinned, now.schema).distinct(), "edges")
    state = _state(now)
    for _ in range(most_rounds):
        if not state[0]:
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = _towards_least(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        now = staged(_towards_least(small), "edges")
        before, state = state, _state(now)
        if before == state:
            break
    else:
        raise RuntimeError(f"no fixed point after {most_rounds} rounds")
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
