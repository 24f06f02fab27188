"""Approximate nearest neighbours by inner product: a hash-prefix forest.

A tree is a sorted array of hash strings of 64 bits, one a vector: the sides of 64 random hyperplanes on which it lies. Vectors
that share a prefix of a string are one slice of its array; a subtree is such a slice and its parent the slice of the
prefix shorter by one bit.

*Descending*: a query's string is looked up in every tree by binary search, to the longest prefixes that together have
``FIRST`` candidates. *Ascending*: from there all trees give up one bit at a time, in step; each step scores what the parents
add, the sibling slices. A query stops at prefix length ``x`` once a vector as near as the worst of its best ones would have
been met with probability ``recall``: two vectors at angle ``a`` share ``x`` bits with probability ``(1 - a / pi)**x``, and
miss each other in all ``L`` trees with ``(1 - (1 - a / pi)**x)**L``. So close vectors are found deep down, among few
candidates, and where nothing is close the query goes up as far as it must, at last to the root, which holds every row:
nothing is capped. Queries of one subtree are scored together, as a product of matrices.

Inner products: the largest inner product becomes the smallest angle by one more component, ``sqrt(M**2 - |v|**2)`` for vectors
and 0 for queries, with ``M`` the largest norm of all.

Spark: vectors are dealt by a hash of their components to shards of about ``SHARD_ROWS``, each with its own forest; every query
visits every shard, streamed past the forest in batches, so a task holds one shard and one batch. A shard stops by its part of
the best ones (its share of ``k``). Each gives its nearest ``k + 1`` ids, and a ranking per distinct query vector joins
them. The queries are a stated set; work grows with queries times shards.

Equal vectors: of each distinct vector the ``k + 1`` smallest ids are indexed; the others cannot be among anyone's ``k``
nearest. They are chosen in two steps (by vector and part, then by vector), so no task gets all copies. Equal queries are
searched once and answered each; vectors that many queries share are answered by a broadcast of a proven size.

Defined results: vectors that are null, zero, empty or hold a null or non-finite component take no part, nor do rows of null
id; inner products are only taken between vectors of one length; equal rows count once; if an id has several
vectors its nearness is the largest of them, for queries as for candidates; ties go to the smaller id; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catloom.runtime import bounded, cut, without_ids

K = 20
TREES = 8
BITS = 64
RECALL = 0.95
#: Candidates of all trees together where ascending begins, in multiples of ``k``.
FIRST = 16
SHARD_ROWS = 1 << 17
#: Shards are at least this large, however many tasks there are.
LEAST_ROWS = 1 << 11
#: Parts over which the copies of one vector are dealt.
PARTS = 32
#: Queries of one batch, per component.
BATCH = 1 << 20
SEED = 11


def hyperplanes(dim: int, trees: int, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dim + 1, trees * BITS))


def hash_strings(points: np.ndarray, extra: np.ndarray, planes: np.ndarray, trees: int) -> np.ndarray:
    """``(trees, rows)`` of 64-bit strings, the first bit in the highest place."""
    side = points @ planes[:-1] + extra[:, None] * planes[-1] > 0
    packed = np.packbits(side.reshape(len(points), trees, BITS), axis=2).view(">u8")[:, :, 0]
    return np.ascontiguousarray(packed.T.astype(np.uint64))


class Forest:
    """The trees over the vectors of one shard."""

    def __init__(self, points: np.ndarray, largest: float, trees: int = TREES, seed: int = SEED):
        self.points, self.largest, self.trees = points, largest, trees
        self.planes = hyperplanes(points.shape[1], trees, seed)
        extra = np.sqrt(np.maximum(largest**2 - (points**2).sum(axis=1), 0))
        strings = hash_strings(points, extra, self.planes, trees)
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.strings = np.take_along_axis(strings, self.order, axis=1)

    def slices(self, strings: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end, per tree and query, of the subtree of the query's first ``length`` bits."""
        free = np.where(length > 0, (np.uint64(1) << np.minimum(BITS - length, 63).astype(np.uint64)) - np.uint64(1), ~np.uint64(0))
        low = np.stack([np.searchsorted(s, q & ~free) for s, q in zip(self.strings, strings)])
        high = np.stack([np.searchsorted(s, q | free, "right") for s, q in zip(self.strings, strings)])
        return low, high

    def descend(self, strings: np.ndarray, first: int) -> np.ndarray:
        """Per query the longest prefix whose subtrees hold ``first`` vectors together; 0 if none does."""
        low, high = np.zeros(strings.shape[1], np.int64), np.full(strings.shape[1], BITS)
        while (low < high).any():
            middle = (low + high + 1) // 2
            begin, end = self.slices(strings, middle)
            enough = (end - begin).sum(axis=0) >= first
            low, high = np.where(enough, middle, low), np.where(enough, high, middle - 1)
        return low

    def search(self, queries: np.ndarray, keep: int, share: int, first: int, recall: float) -> tuple[np.ndarray, np.ndarray]:
        """Scores and rows ``(queries, keep)``, nearest first (row -1: no more); stops by the ``share``-th best."""
        n = len(queries)
        norms = np.linalg.norm(queries, axis=1)
        strings = hash_strings(queries, np.zeros(n), self.planes, self.trees)
        start = self.descend(strings, first)
        best, rows = np.full((n, keep), -np.inf), np.full((n, keep), -1)
        going = np.ones(n, bool)
        begin, end = np.zeros((self.trees, n), np.int64), np.zeros((self.trees, n), np.int64)
        for length in range(int(start.max(initial=0)), -1, -1):
            at = np.flatnonzero(going & (start >= length))
            if not len(at):
                continue
            low, high = self.slices(strings[:, at], np.full(len(at), length))
            was_low, was_high = begin[:, at], end[:, at]
            new = start[at] == length
            was_low[:, new] = was_high[:, new] = low[:, new]
            found_s, found_r = [best[at]], [rows[at]]
            for tree in range(self.trees):
                # the parent adds the sibling slice, on one side of what was scored before
                right = low[tree] == was_low[tree]
                a, b = np.where(right, was_high[tree], low[tree]), np.where(right, high[tree], was_low[tree])
                s, r = self._score(queries[at], a, b, self.order[tree], keep)
                found_s.append(s)
                found_r.append(r)
            begin[:, at], end[:, at] = low, high
            best[at], rows[at] = _merge(np.concatenate(found_s, axis=1), np.concatenate(found_r, axis=1), keep)
            worst = best[at, min(share, keep) - 1]
            cosine = np.clip(worst / (norms[at] * self.largest), -1, 1)
            meet = (1 - np.arccos(cosine) / np.pi) ** length
            going[at] = ~(np.isfinite(worst) & (1 - (1 - meet) ** self.trees >= recall)) if length else False
        # one way of summing for all, whatever was scored together
        exact = np.where(rows >= 0, (queries[:, None, :] * self.points[rows]).sum(axis=2), -np.inf)
        order = np.argsort(-exact, axis=1, kind="stable")
        return np.take_along_axis(exact, order, axis=1), np.take_along_axis(rows, order, axis=1)

    def _score(self, queries: np.ndarray, a: np.ndarray, b: np.ndarray, order: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``keep`` nearest of every query among ``order[a:b]``; queries of one slice are scored together."""
        scores, found = np.full((len(queries), keep), -np.inf), np.full((len(queries), keep), -1)
        some = np.flatnonzero(b > a)
        some = some[np.lexsort((b[some], a[some]))]
        if not len(some):
            return scores, found
        edges = np.flatnonzero(np.concatenate([[True], (np.diff(a[some]) != 0) | (np.diff(b[some]) != 0), [True]]))
        for i, j in zip(edges[:-1], edges[1:]):
            who = some[i:j]
            members = order[a[who[0]] : b[who[0]]]
            for part in np.array_split(who, -(-len(who) * len(members) // (1 << 24))):
                block = queries[part] @ self.points[members].T
                if len(members) > keep:
                    top = np.argpartition(-block, keep - 1, axis=1)[:, :keep]
                    scores[part], found[part] = np.take_along_axis(block, top, axis=1), members[top]
                else:
                    scores[part, : len(members)], found[part, : len(members)] = block, members
        return scores, found


def _merge(scores: np.ndarray, rows: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``keep`` best of each line, every row once, best first."""
    order = np.argsort(rows, axis=1, kind="stable")
    rows, scores = np.take_along_axis(rows, order, axis=1), np.take_along_axis(scores, order, axis=1)
    again = np.zeros(rows.shape, bool)
    again[:, 1:] = rows[:, 1:] == rows[:, :-1]
    scores = np.where(again | (rows < 0), -np.inf, scores)
    top = np.argsort(-scores, axis=1, kind="stable")[:, :keep]
    scores = np.take_along_axis(scores, top, axis=1)
    return scores, np.where(np.isfinite(scores), np.take_along_axis(rows, top, axis=1), -1)


def points(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, vector, dim, norm2, key``: what takes part; equal vectors have equal keys."""
    vector = F.col(vector_col).cast("array<double>")
    limit = F.lit(float("inf"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector")).filter(
        "vec_id is not null and vector is not null"
    ).filter(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit)))
    norm2 = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    # 0.0 and -0.0 are one value
    plain = F.transform("vector", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    return rows.select("vec_id", plain.alias("vector"), F.size("vector").alias("dim"), norm2.alias("norm2")).filter("norm2 > 0").withColumn(
        "key", F.md5(F.to_json(F.struct("vector")).cast("binary"))
    )


def _smallest(rows: DataFrame, k: int, *columns: str) -> DataFrame:
    """The rows of the ``k`` smallest ids per value of the columns; most rows go before anything is dealt."""
    return rows.withColumn("at", F.row_number().over(Window.partitionBy(*columns).orderBy("vec_id"))).filter(F.col("at") <= k).drop("at")


def _searcher(k: int, trees: int, recall: float, seed: int):
    """A map over rows sorted by shard, vectors before queries: one shard's forest is held at a time."""

    def answer(forest: Forest, ids: np.ndarray, starts: np.ndarray, keys: list[str], queries: np.ndarray, shards: int) -> pa.RecordBatch:
        keep = k + 4  # k + 1, and room for sums that differ in their last bits
        scores, rows = forest.search(queries, keep, -(-k // shards) + 1, FIRST * k, recall)
        query, at = np.nonzero(rows >= 0)
        row, score = rows[query, at], scores[query, at]
        size = np.diff(starts)[row]
        query, score = np.repeat(query, size), np.repeat(score, size)
        vec = ids[np.arange(len(query)) + np.repeat(starts[row] - (np.cumsum(size) - size), size)]
        order = np.lexsort((-score, vec, query))  # an id once, at its best
        order = order[np.concatenate([[True], (np.diff(vec[order]) != 0) | (np.diff(query[order]) != 0)])] if len(order) else order
        order = order[np.lexsort((vec[order], -score[order], query[order]))]
        place = np.arange(len(order)) - np.searchsorted(query[order], query[order])
        order = order[place <= k]
        return pa.RecordBatch.from_arrays([pa.array(keys).take(pa.array(query[order])), pa.array(vec[order]), pa.array(score[order])], names=["key", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, forest, held, waiting = None, None, [], []

        def ask() -> Iterator[pa.RecordBatch]:
            if waiting and forest is not None:
                keys = [key for _, more, _ in waiting for key in more]
                yield answer(forest, *ids, keys, np.concatenate([v for v, _, _ in waiting]), waiting[0][2])
            waiting.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            place = np.stack([batch.column(c).to_numpy() for c in ("dim", "shard", "asks")], axis=1)
            edges = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]).any(axis=1), [True]]))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                part, (dim, shard, asks) = batch.slice(a, b - a), place[a].tolist()
                if (dim, shard) != group:
                    yield from ask()
                    group, forest, held = (dim, shard), None, []
                values = part.column("vector")
                vectors = values.flatten().to_numpy().reshape(-1, dim)
                keys = part.column("key").to_pylist()
                if not asks:
                    held.append((vectors, keys, part.column("vec_id").to_numpy(), part.column("largest")[0].as_py()))
                    continue
                if forest is None and held:
                    every = np.array([key for _, more, _, _ in held for key in more])
                    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
                    ids = (np.concatenate([x for _, _, x, _ in held]), np.append(first, len(every)))
                    forest = Forest(np.concatenate([v for v, _, _, _ in held])[first], held[0][3], trees, seed)
                    held = []
                waiting.append((vectors, keys, part.column("shards")[0].as_py()))
                if sum(len(v) for v, _, _ in waiting) * dim >= BATCH:
                    yield from ask()
        yield from ask()

    return run


def nearest(
    vectors: DataFrame,
    is_query: Callable[[Column], Column],
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    trees: int = TREES,
    recall: float = RECALL,
    shard_rows: int = SHARD_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every row whose id satisfies ``is_query``."""
    spark = vectors.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = points(vectors, id_col, vector_col)
    wanted = rows.filter(is_query(F.col("vec_id")))
    keys = cut(rows.select("vec_id", "key", "dim", "norm2"))
    # per length: rows, largest norm, shards
    least = F.greatest(F.ceil(F.col("n") / shard_rows), F.least(F.lit(width), F.ceil(F.col("n") / LEAST_ROWS)))
    lengths = cut(keys.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.max("norm2")).alias("largest")).withColumn("shards", least.cast("int")))
    # ids beyond the k + 1 smallest of a vector that occurs often
    often = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > k + 1).select("key")
    copies = cut(keys.join(bounded(cut(often)), "key").select("key", "vec_id").distinct())
    if not copies.isEmpty():
        first = _smallest(copies.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(PARTS))), k + 1, "key", "part")
        first = _smallest(first, k + 1, "key").select("key", "vec_id")
        left_out = copies.join(first, ["key", "vec_id"], "left_anti").select(F.concat("key", F.lit(":"), F.col("vec_id").cast("string")).alias("gone"))
        rows = rows.withColumn("pair", F.concat("key", F.lit(":"), F.col("vec_id").cast("string"))).join(bounded(cut(left_out)), F.col("pair") == F.col("gone"), "left_anti").drop("pair")
    shard = F.pmod(F.xxhash64("key"), F.col("shards")).cast("int")
    index = rows.join(bounded(lengths), "dim").select("dim", shard.alias("shard"), F.lit(0).alias("asks"), "key", "vec_id", "vector", "largest", "shards")
    asked = wanted.dropDuplicates(["key"]).join(bounded(lengths), "dim").select(
        "dim", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), F.lit(1).alias("asks"), "key", F.lit(0).cast("long").alias("vec_id"), "vector", "largest", "shards"
    )
    total = int(lengths.agg(F.coalesce(F.sum("shards"), F.lit(1))).first()[0])
    dealt = index.unionByName(asked).repartitionByRange(total, "dim", "shard").sortWithinPartitions("dim", "shard", "asks", "key", "vec_id")
    found = dealt.mapInArrow(_searcher(k, trees, recall, seed), "key string, vec_id long, score double")
    # each distinct query vector: its k + 1 nearest ids
    best = found.groupBy("key", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    answers = cut(best.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= k + 1).groupBy("key").agg(F.collect_list(F.struct("vec_id", "score")).alias("answers")))
    asking = keys.filter(is_query(F.col("vec_id"))).select(F.col("vec_id").alias("query_id"), "key").distinct()
    # vectors of more than a thousandth of all queries, so at most a thousand, are answered by a broadcast
    often = cut(asking.groupBy("key").agg(F.count(F.lit(1)).alias("n")))
    floor = max((often.agg(F.sum("n")).first()[0] or 0) // 1000, 1)
    hot = F.broadcast(answers.join(often.filter(F.col("n") > floor).select("key"), "key", "left_semi"))
    rest = asking.join(hot.select("key"), "key", "left_anti").join(answers, "key")
    each = asking.join(hot, "key").unionByName(rest).select("query_id", F.explode("answers").alias("x")).select("query_id", "x.vec_id", "x.score").filter("vec_id <> query_id")
    each = each.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).cast("int")
    return each.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
