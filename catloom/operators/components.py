"""Connected components of an undirected graph given as an edge table.

Alternating large-star and small-star contraction: every round replaces the edges by edges to the
smallest known neighbour, so the edge table never grows beyond twice its size and the number of rounds
is logarithmic. Neighbourhoods are only ever reduced by ``min`` (map-side combined) and joined back; the minima of
hubs (nodes with more than a thousandth of the edge ends, so a bounded number) are broadcast, so the edges of a hub are
never gathered in one task. Each round is cut by a checkpoint. Edge tables of at most ``LOCAL_EDGES`` rows, counted,
are labelled by one task instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catloom.runtime import cut

LOCAL_EDGES = 1 << 19


def _state(edges: DataFrame) -> tuple[int, int]:
    mark = F.sum(F.xxhash64("hi", "lo").bitwiseAND(0x7FFFFFFF)).alias("mark")
    row = edges.agg(F.count(F.lit(1)).alias("n"), mark).first()
    return row["n"], row["mark"] or 0


def _oriented(a: Column, b: Column) -> list[Column]:
    return [F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")]


def _star(edges: DataFrame, node: str, other: str, keep_larger: bool, size: int) -> DataFrame:
    """Connect the neighbours of each node to the smallest value in its closed neighbourhood."""
    low = cut(edges.groupBy(node).agg(F.min(other).alias("low"), F.count(F.lit(1)).alias("degree")))
    low = low.select(node, F.least(F.col(node), F.col("low")).alias("low"), "degree")
    # nodes with more than a thousandth of all edge ends: at most 2048, resolved where their edges are
    hubs = F.broadcast(low.filter(F.col("degree") > size / 1024).drop("degree"))
    rest = edges.join(hubs.select(node), node, "left_anti").join(low.drop("degree"), node)
    joined = edges.join(hubs, node).unionByName(rest)
    low = low.drop("degree")
    if keep_larger:
        moved = joined.filter(F.col(other) > F.col(node)).select(F.col(other).alias("hi"), F.col("low").alias("lo"))
        return moved.distinct()
    moved = joined.filter(F.col(other) != F.col("low")).select(F.col(other).alias("hi"), F.col("low").alias("lo"))
    return moved.unionByName(low.select(F.col(node).alias("hi"), F.col("low").alias("lo"))).distinct()


def _label_here(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Union by smaller node over all edges of one task."""
    parent: dict = {}

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for batch in batches:
        for a, b in zip(batch["hi"].tolist(), batch["lo"].tolist()):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            x, y = find(a), find(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
    nodes = list(parent)
    for at in range(0, len(nodes), 65536):
        block = nodes[at : at + 65536]
        yield pd.DataFrame({"node": block, "component": [find(x) for x in block]})


def connected_components(edges: DataFrame, left: str, right: str, max_rounds: int = 60, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """Rows ``(node, component)`` for every node on an edge; ``component`` is the smallest node reachable.

    Self loops and edges with a null end are ignored, repeated edges count once; no edges give no rows.
    """
    a, b = F.col(left), F.col(right)
    current = cut(edges.filter(a.isNotNull() & b.isNotNull() & (a != b)).select(*_oriented(a, b)).distinct())
    state = _state(current)
    if state[0] <= local_edges:
        kind = dict(current.dtypes)["hi"]
        return cut(current.coalesce(1).mapInPandas(_label_here, f"node {kind}, component {kind}"))
    for _ in range(max_rounds):
        both = current.select(F.col("hi").alias("node"), F.col("lo").alias("other")).unionByName(
            current.select(F.col("lo").alias("node"), F.col("hi").alias("other"))
        )
        large = _star(both, "node", "other", True, 2 * state[0])
        small = _star(large.select(F.col("hi").alias("node"), F.col("lo").alias("other")), "node", "other", False, state[0])
        current = cut(small.filter("hi <> lo"))
        after = _state(current)
        if after == state:
            break
        state = after
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    roots = current.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return current.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots)
