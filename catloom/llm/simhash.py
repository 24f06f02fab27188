"""SimHash near-duplicates: BK-trees over shards of fingerprints, then connected components.

Fingerprint: A-Z lower-cased, words split at ASCII white space, word shingles (repeats included) hashed with
XXH64, seed 42; a bit is 1 if set in more than half of the hashes. Two fingerprints link if at most ``radius``
bits differ.

Finding the links. Fingerprints are cut into ``m`` bit blocks; ``radius`` differing bits leave at least
``m - radius`` blocks untouched, so a linked pair shares the value of some choice of ``m - radius`` blocks. Each
choice and value is a *shard*; every distinct fingerprint goes to one shard per choice, and a shard's members
probe the shard's BK-tree: children keyed by the integer Hamming distance to their parent, a query follows only
the edges ``d - radius .. d + radius``. ``m`` grows with the number of distinct fingerprints, so that the mean shard
stays small; the scheme loses no link at any ``m``. A shard of more than ``tree_rows`` members becomes several
trees, and all its members probe each of them, in blocks: no pair rows are ever emitted, only one spanning edge
per member and tree. (Broadcasting the trees of *all* fingerprints, the other reading of the method, would
broadcast data that grows with the corpus and make every row probe every tree.)

Exact copies collapse before the search: only distinct fingerprints are sharded.

Defined results: null and empty texts have fingerprint zero, linked like any other; with fewer words than a
shingle the whole sequence is the one shingle; a null id is smaller than no other id (a component of null ids
only has a null component id); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catloom.operators.components import connected_components
from catloom.runtime import cut, spread, without_ids

RADIUS = 4
SHINGLE = 4
SEED = 42
TREE_ROWS = 16384
SHARD_TARGET = 1024
#: Rows (component, smallest id) that are broadcast at most.
BROADCAST_ROWS = 1_000_000


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned 64-bit fingerprint of a whole text."""
    from xxhash import xxh64_intdigest as xxh

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        return xxh(joined, seed)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    ends = ends[shingle - 1 :].tolist()
    ones, n = np.zeros(64, dtype=np.int64), len(ends)
    for at in range(0, n, 65536):
        block = [xxh(joined[a:b], seed) for a, b in zip(starts[at : at + 65536], ends[at : at + 65536])]
        bits = np.unpackbits(np.array(block, dtype=">u8").view(np.uint8)).reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``(doc_id, fp)``, fp as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), shingle, seed) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of rows of 64-bit words."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


class BKForest:
    """BK-trees of many shards side by side: one value a node, children keyed by their distance to the parent.

    Trees grow level by level: the first value of a shard is its root, the others go to its children by distance, of each
    child's values the first is the node, and so on. Nodes are numbered in that order, so the keys (parent, distance) are
    sorted and the children within a range of distances are one slice.
    """

    def __init__(self, trees: np.ndarray, values: np.ndarray):
        self.values, self.span, self.followed = values, 64 * values.shape[1] + 1, 0
        order = np.argsort(trees, kind="stable")
        self.names, starts, counts = np.unique(trees[order], return_index=True, return_counts=True)
        rows, keys, self.levels = [order[starts]], [], [(0, len(starts))]
        at, below = np.repeat(np.arange(len(starts)), counts), np.ones(len(order), bool)
        below[starts] = False
        rest, at = order[below], at[below]
        while len(rest):
            begin, end = self.levels[-1]
            key = at * self.span + distances(values[rest], values[rows[-1][at - begin]])
            order = np.argsort(key, kind="stable")
            rest = rest[order]
            found, starts, counts = np.unique(key[order], return_index=True, return_counts=True)
            keys.append(found)
            rows.append(rest[starts])
            self.levels.append((end, end + len(found)))
            at, below = np.repeat(end + np.arange(len(found)), counts), np.ones(len(rest), bool)
            below[starts] = False
            rest, at = rest[below], at[below]
        self.rows, self.keys = np.concatenate(rows), np.concatenate([np.zeros(0, np.int64), *keys])
        self.parents = self.keys // self.span

    def links(self, trees: np.ndarray, queries: np.ndarray, radius: int, skip=None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(query, row)`` of all values within the radius; only edges between distance - radius and distance + radius are
        followed. ``skip(queries, nodes)`` marks subtrees that need no visit."""
        node = np.minimum(np.searchsorted(self.names, trees), len(self.names) - 1)
        q = np.flatnonzero(self.names[node] == trees)
        node = node[q]
        while len(q):
            far = distances(queries[q], self.values[self.rows[node]])
            hit = far <= radius
            yield q[hit], self.rows[node[hit]]
            low = np.searchsorted(self.keys, node * self.span + np.maximum(far - radius, 0))
            high = np.searchsorted(self.keys, node * self.span + np.minimum(far + radius, self.span - 1), "right")
            n = high - low
            node = np.repeat(low - np.cumsum(n) + n, n) + np.arange(int(n.sum())) + len(self.names)
            q = np.repeat(q, n)
            if skip is not None:
                open_ = ~skip(q, node)
                q, node = q[open_], node[open_]
            self.followed += len(q)

    def uniform(self, labels: np.ndarray) -> np.ndarray:
        """Per node the label that its whole subtree bears, -1 if there are several."""
        low = labels[self.rows]
        high = low.copy()
        for begin, end in reversed(self.levels[1:]):
            up = self.parents[begin - len(self.names) : end - len(self.names)]
            np.minimum.at(low, up, low[begin:end])
            np.maximum.at(high, up, high[begin:end])
        return np.where(low == high, low, -1)


def _find(parent: list[int], x: int) -> int:
    while parent[x] != x:
        parent[x] = x = parent[parent[x]]
    return x


def spanning_links(trees: np.ndarray, values: np.ndarray, own: np.ndarray, radius: int, accept=None) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``(a, b)`` of spanning edges of the links between every row and the tree of its shard; trees hold the rows of
    ``own``. ``accept(a, b)`` may rule links out.

    Rows probe in blocks whose visits are bounded. A subtree whose values are all connected to the query already is not
    entered, so groups of many near values cost about their size, not its square.
    """
    members = np.flatnonzero(own)
    if not len(members):
        return members, members
    forest = BKForest(trees[members], values[members])
    parent = list(range(len(trees)))
    labels, uniform = np.arange(len(trees)), None
    _, codes, sizes = np.unique(trees, return_inverse=True, return_counts=True)
    cost = np.cumsum(sizes[codes])
    a_out, b_out, begin, visits = [], [], 0, 1 << 16
    while begin < len(trees):
        end = max(begin + 1, int(np.searchsorted(cost, (cost[begin - 1] if begin else 0) + visits, "right")))
        visits = min(2 * visits, 1 << 22)
        known = labels[begin:end]
        skip = None if uniform is None else lambda q, node, u=uniform, k=known: u[node] == k[q]
        found = [np.stack([labels[begin + q], labels[members[v]], begin + q, members[v]]) for q, v in forest.links(trees[begin:end], values[begin:end], radius, skip)]
        found = np.concatenate(found, axis=1) if found else np.zeros((4, 0), np.int64)
        found = found[:, found[0] != found[1]]
        if accept is not None and found.shape[1]:
            found = found[:, accept(found[2], found[3])]
        if found.shape[1]:
            _, first = np.unique(np.minimum(found[0], found[1]) * len(trees) + np.maximum(found[0], found[1]), return_index=True)
            joined = False
            for x, y, a, b in found[:, first].T.tolist():
                x, y = _find(parent, x), _find(parent, y)
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    joined = True
                    a_out.append(a)
                    b_out.append(b)
            if joined:
                labels = np.array([_find(parent, x) for x in labels.tolist()])
                uniform = forest.uniform(labels[members])
        begin = end
    return np.array(a_out, np.int64), np.array(b_out, np.int64)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int, target: int = 1 << 16) -> Iterator[np.ndarray]:
    """Rows of integers sorted by their first ``keys`` columns, in blocks of ``target`` rows or more that split no group."""
    held, waiting = [], 0
    for batch in batches:
        rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(batch.num_columns)], axis=1)
        if not len(rows):
            continue
        held.append(rows)
        waiting += len(rows)
        if waiting >= target and (held[0][0, :keys] != rows[-1, :keys]).any():
            rows = np.concatenate(held)
            done = int(np.flatnonzero((rows[:, :keys] != rows[-1, :keys]).any(axis=1))[-1]) + 1
            yield rows[:done]
            held, waiting = [rows[done:]], len(rows) - done
    if held:
        yield np.concatenate(held)


def block_choices(distinct: int, radius: int = RADIUS) -> list[int]:
    """Masks: each covers ``m - radius`` of ``m`` blocks; ``m`` is the least that keeps mean shards small."""
    m = radius + 1
    while m < 2 * radius + 1 and distinct / 2 ** (64 * (m - radius) / m) > SHARD_TARGET:
        m += 1
    edges = [round(64 * i / m) for i in range(m + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(blocks, m - radius)]


def link_edges(distinct: DataFrame, n: int, radius: int = RADIUS, tree_rows: int = TREE_ROWS) -> DataFrame:
    """Spanning edges ``(a, b)`` of the link graph over the distinct fingerprints in column ``fp``."""
    masks = block_choices(n, radius)
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    shards = distinct.select(
        "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("choice", "value")
    )
    # shards beyond one tree: usually none, and at most n * choices / tree_rows of them
    large = cut(
        shards.groupBy("choice", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > tree_rows)
        .select("choice", "value", F.ceil(F.col("n") / tree_rows).cast("int").alias("trees"))
    )
    found = large.count()
    if found:
        large = F.broadcast(large) if found <= 10_000 else large
        shards = shards.join(large, ["choice", "value"], "left")
        own = F.pmod(F.xxhash64("fp"), F.col("trees")).cast("int")
        shards = shards.select(
            "fp", "choice", "value",
            F.explode(F.sequence(F.lit(0), F.coalesce(own, F.lit(0)))).alias("tree"),
            F.coalesce(own, F.lit(0)).alias("own"),
        ).select("fp", "choice", "value", "tree", (F.col("tree") != F.col("own")).alias("probe_only"))
    else:
        shards = shards.select("fp", "choice", "value", F.lit(0).alias("tree"), F.lit(False).alias("probe_only"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, 3):
            trees = np.concatenate([[0], np.cumsum((rows[1:, :3] != rows[:-1, :3]).any(axis=1))])
            fps = np.ascontiguousarray(rows[:, 3:4]).view(np.uint64)
            a, b = spanning_links(trees, fps, rows[:, 4] == 0, radius)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(rows[x, 3]) for x in (a, b)], names=["a", "b"])

    sorted_shards = (
        shards.select("choice", "value", "tree", "fp", F.col("probe_only").cast("int").alias("probe_only"))
        .transform(spread, "choice", "value", "tree")
        .sortWithinPartitions("choice", "value", "tree")
    )
    return sorted_shards.mapInArrow(run, "a long, b long")


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, shingle: int = SHINGLE, seed: int = SEED, tree_rows: int = TREE_ROWS
) -> DataFrame:
    """``doc_id, fp, component_id`` for every row: the smallest id reachable over links, itself included."""
    table = cut(fingerprints(docs, id_col, text_col, shingle, seed))
    distinct = cut(table.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")))
    labels = connected_components(link_edges(distinct.select("fp"), distinct.count(), radius, tree_rows), "a", "b")
    linked = cut(distinct.join(labels, F.col("fp") == F.col("node")).select("fp", "first", "component"))
    smallest = cut(linked.groupBy("component").agg(F.min("first").alias("component_id")))
    smallest = F.broadcast(smallest) if smallest.count() <= BROADCAST_ROWS else smallest
    named = linked.join(smallest, "component").select(F.col("fp").alias("of"), "component_id")
    names = distinct.join(named, F.col("fp") == F.col("of"), "left").select("fp", "n", F.when(F.col("of").isNull(), F.col("first")).otherwise(F.col("component_id")).alias("component_id"))
    # fingerprints of more than a thousandth of all rows, so at most a thousand, are looked up in place
    names = cut(names)
    hot = F.broadcast(names.filter(F.col("n") > F.greatest(F.lit(table.count() // 1000), F.lit(1))).drop("n"))
    rest = table.join(hot.select("fp"), "fp", "left_anti").join(names.drop("n"), "fp")
    return table.join(hot, "fp").unionByName(rest).select("doc_id", "fp", "component_id")


def hex_fingerprint(fp="fp"):
    """16 lower-case hex digits of a signed long."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its group; all columns unchanged. Rows of null id stay."""
    groups = near_groups(docs, id_col, text_col, radius, shingle)
    return without_ids(docs, id_col, cut(groups.filter("doc_id <> component_id").select("doc_id").distinct()))
