"""Spelling variants: words one edit apart, found by rolling hashes of their deletions.

Two words are near if one code point is inserted, deleted or replaced. Every word gives the hash of itself and of
each deletion of one code point. Replaced: both words give the same deletion at the same place. Deleted: a deletion of
the longer word is the shorter one. So near words always share a key, and no pair of words is compared otherwise.

1. Tasks count words in a bounded table and hand on partial counts; counts are summed by word.
2. Keys: with ``x_j`` a mixed code point and odd base ``B`` modulo 2**64, the prefix hashes ``sum x_j B**j`` of all words of a
   batch are one NumPy cumulative sum; the deletion at ``i`` is the prefix before ``i`` plus the suffix after it,
   moved down by the inverse of ``B``. The length goes into the key.
3. Keys are dealt by hash to partitions and sorted. Groups in which nothing can be near are left out there, so that nearly all
   rows end as integers and never meet their strings.
4. What is left gets its word. Groups are made again on the deletions *as strings*: a collision of hashes parts there.
   Words that share a deletion at one place differ in that letter only, so a group is bounded by the alphabet; members take
   its size and its two best words, and no pairs within it are made. A shorter word meets at most the alphabet times its length.

A word's ``form`` is its near word of largest count (ties: the smallest in code-point order) if that is at least ``ratio``
times the word's own; ``root`` follows forms to the last. Counts grow along forms, so this ends; it is done by doubling.

Defined results: a null or empty text has no words; equal rows count as often as they occur; a null id is the empty
string in the deletion rule; words of any length are treated alike; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catloom.llm.simhash import whole_groups
from catloom.runtime import bounded, cut, spread

MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
#: Entries of a task's table of counts before it is handed on.
TABLE = 200_000
#: Code points hashed at once.
BLOCK = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
WHOLE = -1


def drop_one(run: str, crc: int) -> str:
    """The registered rule: a run whose checksum 199 divides loses one code point."""
    if crc % 199:
        return run
    at = crc % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, edited: bool = True) -> DataFrame:
    """``word, n``: runs of letters, A-Z lower-cased, after :func:`drop_one` (if ``edited``)."""
    runs = re.compile(r"[a-zÀ-ÿ]{%d,}" % min_length)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                # bytes are lowered in ASCII only
                found = runs.findall((text.as_py() or "").encode().lower().decode())
                if not edited:
                    for run in found:
                        held[run] = held.get(run, 0) + 1
                else:
                    crc = zlib.crc32(b"%d:" % doc if doc is not None else b":")
                    made: dict[str, str] = {}
                    for run in found:
                        word = made.get(run)
                        if word is None:
                            word = made[run] = drop_one(run, zlib.crc32(run.encode(), crc))
                        held[word] = held.get(word, 0) + 1
                if len(held) >= TABLE:
                    yield _counts(held, min_length)
                    held = {}
        if held:
            yield _counts(held, min_length)

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _counts(held: dict[str, int], min_length: int) -> pa.RecordBatch:
    long_enough = [w for w in held if len(w) >= min_length]
    return pa.RecordBatch.from_arrays([pa.array(long_enough, pa.string()), pa.array([held[w] for w in long_enough], pa.int64())], names=["word", "n"])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def deletion_keys(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(key, place, word, first)`` of the words (place ``WHOLE``) and of all their deletions; ``first``: no earlier deletion
    of the word gives the same string."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64)
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(points)) - starts[owner]
    powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(int(sizes.max(initial=0)), BASE)]))
    terms = _mix(points + BASE) * powers[place]
    summed = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])
    total = summed[starts + sizes] - summed[starts]
    before = summed[:-1] - summed[starts][owner]
    after = (total[owner] - before - terms) * INVERSE
    first = np.ones(len(points), bool)
    first[1:] = (points[1:] != points[:-1]) | (place[1:] == 0)
    length = sizes.astype(np.uint64)
    keys = np.concatenate([_mix(total + length), _mix(before + after + length[owner] - np.uint64(1))])
    return (
        keys.view(np.int64),
        np.concatenate([np.full(len(words), WHOLE), place]),
        np.concatenate([np.arange(len(words)), owner]),
        np.concatenate([np.ones(len(words), bool), first]),
    )


def _blocks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    begin = held = 0
    for at, size in enumerate(sizes):
        if held and held + size > BLOCK:
            yield begin, at
            begin, held = at, 0
        held += size
    if held:
        yield begin, len(sizes)


def candidates(words: DataFrame) -> DataFrame:
    """``wid, place, first`` of the keys that may make words near; ``words`` holds ``wid`` and ``word``."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for a, b in _blocks([len(w) for w in texts]):
                key, place, word, first = deletion_keys(texts[a:b])
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(place), pa.array(ids[a:b][word]), pa.array(first.astype(np.int64))], names=["key", "place", "wid", "first"])

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, 1):
            new = np.concatenate([[True], (rows[1:, 0] != rows[:-1, 0])])
            group = np.cumsum(new) - 1
            spot = np.concatenate([[True], new[1:] | (rows[1:, 1] != rows[:-1, 1])])  # rows are sorted by key and place
            together = np.bincount(np.cumsum(spot) - 1)[np.cumsum(spot) - 1] > 1
            whole, deleted = rows[:, 1] == WHOLE, (rows[:, 1] != WHOLE) & (rows[:, 3] == 1)
            both = (np.bincount(group, whole) > 0) & (np.bincount(group, deleted) > 0)
            keep = (both[group] & (whole | deleted)) | (together & ~whole)
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(rows[keep, c]) for c in (2, 1, 3)], names=["wid", "place", "first"])

    rows = words.select("wid", "word").mapInArrow(keys, "key long, place long, wid long, first long")
    dealt = spread(rows, "key").sortWithinPartitions("key", "place")
    return dealt.mapInArrow(pick, "wid long, place long, first long")


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, best (neg_n, word)`` of every word that has a near one; ``words``: distinct ``word`` with ``n``.

    The best near word is the one of largest count, then the smallest.
    """
    words = cut(words.select("word", "n").withColumn("wid", F.monotonically_increasing_id()))
    named = candidates(words).join(words, "wid")
    place = F.col("place").cast("int")
    text = F.when(place == WHOLE, F.col("word")).otherwise(F.concat(F.substring("word", F.lit(1), place), F.substring("word", place + 2, F.length("word"))))
    entry = F.struct((-F.col("n")).alias("neg_n"), "word")
    named = cut(named.select(text.alias("rest"), "place", "first", "word", entry.alias("entry")))
    # at most the letters of the alphabet: the words of a group differ in the one letter that is left out
    spots = named.filter(F.col("place") != WHOLE).groupBy("rest", "place").agg(F.array_sort(F.collect_list("entry")).alias("all")).filter(F.size("all") > 1)
    replaced = spots.select(F.explode("all").alias("entry"), "all").select(
        "entry.word", (F.size("all") - 1).alias("n_near"), F.when(F.get("all", F.lit(0))["word"] == F.col("entry.word"), F.get("all", F.lit(1))).otherwise(F.get("all", F.lit(0))).alias("best")
    )
    whole = named.filter(F.col("place") == WHOLE).select("rest", F.col("entry").alias("whole"))
    split = named.filter((F.col("place") != WHOLE) & (F.col("first") == 1)).select("rest", "word", "entry").join(whole, "rest")
    shorter = split.groupBy(F.col("whole.word").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), F.min("entry").alias("best"))
    longer = split.select("word", F.lit(1).alias("n_near"), F.col("whole").alias("best"))
    return replaced.unionByName(shorter).unionByName(longer).groupBy("word").agg(F.sum("n_near").cast("long").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for every row ``word, form``: forms are followed to the last, twice as far each round."""
    links = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        met = links.join(bounded(ahead.join(links.select("root").distinct(), "root", "left_semi")), "root", "left")
        links = cut(met.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if links.filter("moved").isEmpty():
            return links.select("word", "root")
        links = links.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO, edited: bool = True) -> DataFrame:
    """``word, n, n_near, form, form_n, root``, a row per word."""
    words = cut(word_counts(docs, id_col, text_col, min_length, min_count, edited))
    near = words.join(near_words(words), "word", "left")
    better = -F.col("best.neg_n") >= ratio * F.col("n")
    found = cut(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(better, F.col("best.word")).alias("form"), F.when(better, -F.col("best.neg_n")).alias("form_n")))
    last = roots(found.filter("form is not null"))
    return found.join(last, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
