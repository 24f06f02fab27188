"""Cross-tokenizer alignment through a dictionary of groups.

A text is tokenised by a byte-level tokenizer (A) and a word-piece model (B). Byte offsets where tokens of both end cut them into
groups; all A-B pairs of token occurrences of a group are linked. An id pair counts once for every document that holds
it linked.

The same small groups make up nearly all of a corpus, so groups are interned:

1. Each task tokenises its documents and keeps a dictionary of the groups it meets; a document becomes a list of group keys
   with frequencies, the dictionary a row per group with the number of documents. Both are written once.
2. Dictionary rows of all tasks are summed by key. The key of a group of one token each is its two ids; of others it is a hash, and
   a hash that stands for two groups raises an error, as another seed would have to be taken.
3. Links are expanded once per distinct group, not per document. A pair's count is the documents of its groups summed, less what
   documents with several of its groups counted twice; tasks state that excess, document by document.
4. Each group sums, over its links, the counts and the links whose count is the highest of their A id. These sums go back by
   group key: groups that make up more than a ``HOT``-th of all entries (so at most ``HOT``) by a broadcast, the others by a
   shuffle, and a document adds them up, multiplied by frequency.

Defined results: texts that are null or empty, or whose tokens' bytes are not those of a space and the text, have no tokens:
zeros and an empty digest; strings of special tokens are plain text; equal rows are documents of their own, also if their
ids are equal or null; texts of any length are taken whole; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catloom.llm.packing import BYTE_LETTERS, Encoder
from catloom.runtime import cut, stored

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
#: Groups of a task's dictionary, and of the cache of expanded groups, before they are handed on or dropped.
TABLE = 100_000
HOT = 1 << 16
#: Pairs of a group that is expanded anew each time it is met.
LONG = 4096
SEED = 12
SPACE = "▁"

FIELDS = "kind string, rid long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, keys array<long>, freqs array<int>, key long, a_ids array<int>, b_ids array<int>, docs long"
SCHEMA = pa.schema([
    ("kind", pa.string()), ("rid", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("keys", pa.list_(pa.int64())), ("freqs", pa.list_(pa.int32())),
    ("key", pa.int64()), ("a_ids", pa.list_(pa.int32())), ("b_ids", pa.list_(pa.int32())), ("docs", pa.int64()),
])


class Aligner:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, a: str = TOKENIZER_A, b: str = TOKENIZER_B):
        import public_tokenizers
        from sentencepiece import SentencePieceProcessor

        self.a = Encoder(public_tokenizers.path(a), special=False)
        letters = {chr(letter): byte for byte, letter in BYTE_LETTERS.items()} | {chr(b): b for b in range(256) if b not in BYTE_LETTERS}
        size = self.a.tokenizer.get_vocab_size()
        self.a_bytes = [bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t in (self.a.tokenizer.id_to_token(i) or "" for i in range(size))]
        self.b = SentencePieceProcessor(model_file=public_tokenizers.path(b))
        pieces = [(i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in pieces]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in all_], np.int64) for all_ in (self.a_bytes, self.b_bytes))

    def groups(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """A ids, B ids and, of each, the ends of the groups; None if the text has no tokens."""
        if not text:
            return None
        raw = b" " + text.encode()
        a, b = np.frombuffer(self.a.ids(" " + text), "<u4"), self.b.encode(text, num_threads=1)
        # byte-level tokens without a normaliser spell their text by construction
        if b"".join([self.b_bytes[i] for i in b]) != raw or not self.a.cached and b"".join([self.a_bytes[i] for i in a.tolist()]) != raw:
            return None
        b = np.array(b, "<u4")
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        a_cut = np.searchsorted(b_ends, a_ends)
        same = b_ends[a_cut] == a_ends
        return a, b, np.flatnonzero(same) + 1, a_cut[same] + 1


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a: str, b: str) -> Aligner:
    if (a, b) not in _aligners:
        _aligners[a, b] = Aligner(a, b)
    return _aligners[a, b]


class _Spelled(dict):
    """Key of a group to its spelling; a group of one token each has the key ``A id << 32 | B id``, others a negative hash."""

    def __missing__(self, key: int) -> bytes:
        if len(self) >= TABLE:
            self.clear()
        spelled = self[key] = b"%d|%d" % (key >> 32, key & 0xFFFFFFFF)
        return spelled


def _ids(spelled: bytes) -> list[list[int]]:
    return [list(map(int, side.split(b","))) for side in spelled.split(b"|")]


class _Task:
    """What a task has gathered since it last handed on: documents, and its dictionary."""

    def __init__(self, seed: int):
        self.seed, self.spelled = seed, _Spelled()
        self.pairs: dict[int, list[int]] = {}
        self.clear_docs()
        self.clear_dictionary()

    def clear_docs(self) -> None:
        self.docs: list[tuple] = []
        self.keys: list[np.ndarray] = []
        self.freqs: list[np.ndarray] = []
        self.held = 0

    def clear_dictionary(self) -> None:
        self.seen: list[np.ndarray] = []
        self.excess: Counter[int] = Counter()
        # of groups of several tokens: ids to key, key to spelling
        self.made: dict[tuple[bytes, bytes], int] = {}
        self.longer: dict[int, bytes] = {}
        self.entries = 0

    def _pairs(self, key: int) -> list[int]:
        pairs = self.pairs.get(key)
        if pairs is None:
            left, right = _ids(self.longer[key])
            pairs = [p << 32 | q for p in set(left) for q in set(right)]
            if len(self.pairs) >= TABLE:
                self.pairs.clear()
            if len(pairs) <= LONG:
                self.pairs[key] = pairs
        return pairs

    def add(self, rid: int, doc: int | None, found: tuple | None) -> None:
        if found is None:
            self.docs.append((rid, doc, 0, 0, 0, 0, ""))
            self.keys.append(np.zeros(0, np.int64))
            self.freqs.append(np.zeros(0, np.int64))
            return
        a, b, a_cut, b_cut = found
        a_n, b_n = np.diff(a_cut, prepend=0), np.diff(b_cut, prepend=0)
        codes = a[a_cut - 1].astype(np.int64) << 32 | b[b_cut - 1]
        others, a_raw, b_raw = np.flatnonzero((a_n > 1) | (b_n > 1)), a.tobytes(), b.tobytes()
        made: list[int] = []
        for x, y, n, m in zip(*((4 * v[others]).tolist() for v in (a_cut, b_cut, a_n, b_n))):
            raw = a_raw[x - n : x], b_raw[y - m : y]
            known = self.made.get(raw)
            if known is None:
                text = "|".join(",".join(map(str, np.frombuffer(side, "<u4").tolist())) for side in raw).encode()
                known = self.made[raw] = -(xxhash.xxh64_intdigest(text, self.seed) >> 1) - 1
                self.longer[known] = text
            made.append(known)
        codes[others] = made
        distinct, times = np.unique(codes, return_counts=True)
        several = distinct[: np.searchsorted(distinct, 0)].tolist()
        if several:
            held = Counter(chain.from_iterable(map(self._pairs, several)))
            single = np.fromiter(held, np.int64, len(held))
            again = distinct[np.minimum(np.searchsorted(distinct, single), len(distinct) - 1)] == single
            for pair, n, more in zip(held, held.values(), again.tolist()):
                if n + more > 1:
                    self.excess[pair] += n + more - 1
        spelled, longer = self.spelled, self.longer
        text = b";".join([spelled[c] if c >= 0 else longer[c] for c in codes.tolist()])
        self.docs.append((rid, doc, len(a), len(b), len(codes), int((a_n * b_n).sum()), hashlib.sha256(text).hexdigest()))
        self.keys.append(distinct)
        self.freqs.append(times)
        self.seen.append(distinct)
        self.held += len(distinct) + 1
        self.entries += len(distinct)

    def documents(self) -> pa.RecordBatch:
        columns = list(zip(*self.docs))
        offsets = np.cumsum([0, *map(len, self.keys)]).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(x).astype(t))) for x, t in ((self.keys, np.int64), (self.freqs, np.int32))]
        self.clear_docs()
        return _rows("doc", len(columns[0]), dict(zip(("rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"), columns)) | dict(zip(("keys", "freqs"), lists)))

    def dictionary(self) -> Iterator[pa.RecordBatch]:
        keys, docs = np.unique(np.concatenate(self.seen), return_counts=True)
        sides = [_ids(self.longer[k]) if k < 0 else [[k >> 32], [k & 0xFFFFFFFF]] for k in keys.tolist()]
        yield _rows("group", len(keys), {"key": keys, "a_ids": [x for x, _ in sides], "b_ids": [y for _, y in sides], "docs": docs})
        if self.excess:
            yield _rows("excess", len(self.excess), {"a_ids": [[p >> 32] for p in self.excess], "b_ids": [[p & 0xFFFFFFFF] for p in self.excess], "docs": list(self.excess.values())})
        self.clear_dictionary()


def _rows(kind: str, n: int, columns: dict) -> pa.RecordBatch:
    columns = {"kind": [kind] * n} | columns
    return pa.RecordBatch.from_arrays(
        [columns[f.name] if isinstance(columns.get(f.name), pa.Array) else pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in SCHEMA], schema=SCHEMA
    )


def tokenised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a: str = TOKENIZER_A, b: str = TOKENIZER_B, seed: int = SEED) -> DataFrame:
    """Rows of three kinds: ``doc`` (group keys and frequencies of a document), ``group`` (a task's entry of the dictionary with
    its documents) and ``excess`` (a pair, and how often documents hold it in a further group)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align, task = aligner(a, b), _Task(seed)
        for batch in batches:
            for rid, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                task.add(rid, doc, align.groups(text.as_py()))
                if task.held >= TABLE:
                    yield task.documents()
                if task.entries >= 10 * TABLE or len(task.longer) + len(task.excess) >= TABLE:
                    yield from task.dictionary()
        if task.docs:
            yield task.documents()
        if task.entries:
            yield from task.dictionary()

    texts = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, FIELDS)


def dictionary(rows: DataFrame) -> DataFrame:
    """``key, a_ids, b_ids, docs``: every distinct group and the documents that hold it."""
    content = F.struct("a_ids", "b_ids")
    summed = rows.filter("kind = 'group'").groupBy("key").agg(F.min(content).alias("low"), F.max(content).alias("high"), F.sum("docs").alias("docs"))
    same = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.raise_error(F.lit("two groups have one key: take another seed")).cast(summed.schema["low"].dataType))
    return cut(summed.select("key", same.alias("group"), "docs")).select("key", "group.a_ids", "group.b_ids", "docs")


def pair_counts(groups: DataFrame, rows: DataFrame) -> DataFrame:
    """``a, b, count, best``: documents that hold the pair linked; whether no other pair of its A id has more."""
    pairs = groups.select(F.explode(F.array_distinct("a_ids")).alias("a"), F.array_distinct("b_ids").alias("b_ids"), "docs").select("a", F.explode("b_ids").alias("b"), "docs")
    twice = rows.filter("kind = 'excess'").select(F.col("a_ids")[0].alias("a"), F.col("b_ids")[0].alias("b"), (-F.col("docs")).alias("docs"))
    counts = cut(pairs.unionByName(twice).groupBy("a", "b").agg(F.sum("docs").alias("count")))
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))  # a row per A id, at most the vocabulary
    return counts.join(F.broadcast(highest), "a").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))


def group_values(groups: DataFrame, pairs: DataFrame) -> DataFrame:
    """``key, n_best, count_sum`` of one occurrence of each distinct group."""
    times = lambda ids, x: F.size(F.filter(ids, lambda y: y == x))
    links = (
        groups.select("key", "a_ids", "b_ids", F.explode(F.array_distinct("a_ids")).alias("a"))
        .select("key", times("a_ids", F.col("a")).alias("n_a"), "a", "b_ids", F.explode(F.array_distinct("b_ids")).alias("b"))
        .select("key", "a", "b", (F.col("n_a") * times("b_ids", F.col("b"))).cast("long").alias("times"))
    )
    best = F.sum(F.when(F.col("best"), F.col("times")).otherwise(0))
    return links.join(pairs, ["a", "b"]).groupBy("key").agg(best.alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a: str = TOKENIZER_A, b: str = TOKENIZER_B, seed: int = SEED) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    rows = stored(tokenised(docs, id_col, text_col, a, b, seed), "alignment")
    groups = dictionary(rows)
    values = cut(group_values(groups, pair_counts(groups, rows)).join(groups.select("key", "docs"), "key"))
    entries = groups.agg(F.sum("docs")).first()[0] or 0
    hot = F.broadcast(values.filter(F.col("docs") > entries / HOT).drop("docs"))
    texts = rows.filter("kind = 'doc'")
    listed = texts.select("rid", F.explode(F.arrays_zip("keys", "freqs")).alias("x")).select("rid", F.col("x.keys").alias("key"), F.col("x.freqs").alias("freq"))
    rest = listed.join(hot.select("key"), "key", "left_anti").join(values.drop("docs"), "key")
    sums = [F.sum(F.col("freq") * F.col(c)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    added = listed.join(hot, "key").unionByName(rest).groupBy("rid").agg(*sums)
    kept = texts.select("rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return kept.join(added, "rid", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
