"""Near copies by word-shingle similarity: fingerprints propose, the exact Jaccard similarity of the shingle sets decides.

Two documents link if their sets of word shingles have Jaccard similarity ``SIMILARITY`` (4/5) or more. A-Z is
lower-cased, words split at ASCII white space, shingles are XXH64 digests as in :mod:`catloom.llm.simhash`.

1. *Shards.* In any fixed order of all shingles, sets of similarity 4/5 share one of their first ``n - ceil(4n/5) + 1``
   shingles (n their size). Every document goes to the shards of these; no pair is lost. The order puts shingles that
   are common in a sample of documents last, so passages that many documents quote seldom make a shard. (Bit blocks
   that are untouched within the radius below, as in :mod:`catloom.llm.simhash`, would leave a fixed number of shards.)
2. *Candidates.* In a shard, documents whose sizes allow similarity 4/5 and whose 128-bit fingerprints (of the set,
   without repeats) differ in at most ``RADIUS`` bits are joined by spanning edges; no pair rows. At similarity 4/5
   about 19 of 128 bits differ, with a deviation of 4, between unrelated texts 64. Each shard is searched by its
   BK-tree, as in :mod:`catloom.llm.simhash`.
3. *Decision.* The texts of each connected group of candidates meet in one task, which finds the connected components
   of the exact relation.

Defined results: texts without words are equal to each other; fewer words than a shingle are one shingle; rows of null
id stay and link nothing; of repeated ids each row counts, and an id goes if one of its rows does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catloom.llm.simhash import SEED, spanning_links, whole_groups
from catloom.operators.components import connected_components
from catloom.runtime import cut, spread, without_ids

SHINGLE = 5
RADIUS = 36
SAMPLE_DOCS = 8192
COMMON = 4
COMMON_ROWS = 1 << 16


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The sorted distinct digests of a text's word shingles."""
    from xxhash import xxh64_intdigest as xxh

    words = (text or "").encode().lower().split()
    joined = b" ".join(words)
    if len(words) < shingle:
        return np.array([xxh(joined, SEED)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    return np.unique(np.array([xxh(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())], np.uint64))


def similar(common: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether sets of sizes a and b with so many common elements have Jaccard similarity 4/5 or more, in integers."""
    return 5 * common >= 4 * (a + b - common)


def _majority(hashes: np.ndarray) -> int:
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        ones += np.unpackbits(hashes[at : at + 65536].astype(">u8").view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def wide_fingerprint(hashes: np.ndarray) -> tuple[int, int]:
    """128 majority bits: 64 of the digests and 64 of the digests mixed again."""
    x = hashes ^ (hashes >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return _majority(hashes), _majority(x ^ (x >> np.uint64(31)))


def prefix(hashes: np.ndarray, common: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first shingles by (sample count, digest), as many as similarity 4/5 needs. ``common`` is sorted."""
    size = len(hashes) - -(-4 * len(hashes) // 5) + 1
    if not len(common):
        return hashes[:size]
    at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
    known = common[at] == hashes
    rare = hashes[~known]
    if len(rare) >= size:
        return rare[:size]
    rest = hashes[known]
    return np.concatenate([rare, rest[np.lexsort((rest, counts[at[known]]))]])[:size]


def joined(near, n: int) -> Iterator[tuple[int, int]]:
    """Spanning edges of a graph on 0..n-1; ``near(i, others)`` tells which of the others i links to."""
    open_ = np.arange(n)
    while len(open_) > 1:
        root, open_ = int(open_[0]), open_[1:]
        frontier = [root]
        while frontier and len(open_):
            i = frontier.pop()
            hit = near(i, open_)
            if hit.any():
                found = open_[hit].tolist()
                open_ = open_[~hit]
                frontier += found
                yield from ((root, j) for j in found)


def not_first(ids: list[int], texts: list[str | None], shingle: int = SHINGLE) -> set[int]:
    """The ids that are not the smallest of their component of the exact relation."""
    sets = [shingles(t, shingle) for t in texts]
    sizes = np.array([len(s) for s in sets])
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1].reshape(-1)
    ends = np.cumsum(sizes)
    parts = [codes[e - n : e] for e, n in zip(ends.tolist(), sizes.tolist())]
    marked = np.zeros(int(codes.max()) + 1, bool)
    held: dict = {"of": None}

    def near(i: int, others: np.ndarray) -> np.ndarray:
        # codes of what is open lie together; they are gathered anew when half of them has gone
        if held["of"] is None or 2 * len(others) < len(held["of"]):
            held["of"] = others
            held["codes"] = np.concatenate([parts[j] for j in others.tolist()])
            held["starts"] = np.concatenate([[0], np.cumsum(sizes[others])[:-1]])
        marked[parts[i]] = True
        shared = np.add.reduceat(marked[held["codes"]].astype(np.int64), held["starts"])
        marked[parts[i]] = False
        shared = shared[np.searchsorted(held["of"], others)]
        return similar(shared, sizes[others], sizes[i])

    members: dict[int, list[int]] = {}
    for root, j in joined(near, len(ids)):
        members.setdefault(root, [root]).append(j)
    gone: set[int] = set()
    for group in members.values():
        least = min(ids[j] for j in group)
        gone |= {ids[j] for j in group} - {least}
    return gone


def _common(docs: DataFrame, rows: int, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Digests of shingles that several documents of a sample hold, sorted, and in how many: at most ``COMMON_ROWS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(1):
                yield pa.RecordBatch.from_arrays([pa.array(shingles(text.as_py(), shingle).view(np.int64))], names=["h"])

    every = max(1, rows // SAMPLE_DOCS)
    sample = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0)
    counted = sample.mapInArrow(run, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= COMMON)
    found = counted.orderBy(F.col("n").desc(), "h").limit(COMMON_ROWS).collect()
    digests = np.array([r["h"] for r in found], np.int64).view(np.uint64)
    order = np.argsort(digests)
    return digests[order], np.array([r["n"] for r in found], np.int64)[order]


def candidate_edges(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Spanning edges ``(a, b)`` of ids; ``docs`` has doc_id (no nulls) and text."""
    common = docs.sparkSession.sparkContext.broadcast(_common(docs, docs.count(), shingle))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests, counts = common.value
        for batch in batches:
            keys, heads = [], []
            for text in batch.column(1):
                found = shingles(text.as_py(), shingle)
                keys.append(prefix(found, digests, counts))
                heads.append((*wide_fingerprint(found), len(found)))
            times = np.array([len(k) for k in keys], np.int64)
            if not len(times):
                continue
            ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), times)
            fps = np.array([h[:2] for h in heads], np.uint64).view(np.int64)
            columns = [np.concatenate(keys).view(np.int64), ids, np.repeat(fps[:, 0], times), np.repeat(fps[:, 1], times), np.repeat([h[2] for h in heads], times)]
            whole = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["h", "doc_id", "fp", "fq", "size"])
            for at in range(0, whole.num_rows, 65536):
                yield whole.slice(at, 65536)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, 1):
            trees = np.concatenate([[0], np.cumsum(rows[1:, 0] != rows[:-1, 0])])
            sizes = rows[:, 4]
            allowed = lambda a, b, n=sizes: 5 * np.minimum(n[a], n[b]) >= 4 * np.maximum(n[a], n[b])
            a, b = spanning_links(trees, np.ascontiguousarray(rows[:, 2:4]).view(np.uint64), np.ones(len(rows), bool), RADIUS, allowed)
            if len(a):
                out = np.unique(np.sort(np.stack([rows[a, 1], rows[b, 1]], axis=1), axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], names=["a", "b"])

    dealt = docs.mapInArrow(deal, "h long, doc_id long, fp long, fq long, size long")
    return spread(dealt, "h").sortWithinPartitions("h").mapInArrow(search, "a long, b long")


def later_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id`` of the documents that are not the first, by id, of their component of near copies."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).filter("doc_id IS NOT NULL")
    groups = connected_components(candidate_edges(narrow, shingle), "a", "b").withColumnRenamed("node", "doc_id")

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, texts = None, [], []

        def out() -> Iterator[pa.RecordBatch]:
            gone = not_first(ids, texts, shingle) if len(ids) > 1 else ()
            if gone:
                yield pa.RecordBatch.from_arrays([pa.array(sorted(gone), pa.int64())], names=["doc_id"])

        for batch in batches:
            for component, i, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if component != key:
                    yield from out()
                    key, ids, texts = component, [], []
                ids.append(i)
                texts.append(text)
        yield from out()

    met = narrow.join(groups, "doc_id").select("component", "doc_id", "text").repartition("component").sortWithinPartitions("component", "doc_id")
    return met.mapInArrow(decide, "doc_id long").distinct()


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` that are no later near copies; all columns unchanged. Rows of null id stay."""
    return without_ids(docs, id_col, cut(later_copies(docs, id_col, text_col, shingle)))
