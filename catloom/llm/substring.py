"""Removal of repeated passages by fixed-block anchors.

A window is ``WINDOW`` = 13 consecutive words; a word goes if a window covers it whose word sequence also starts
in a document with a smaller id. Any 13 words contain one whole block of ``BLOCK`` = 7 words that starts at a
multiple of 7, so repeats are found in two exact steps:

1. *Anchors.* The non-overlapping 7-word blocks of every document are the reference index; every rolling 7-word
   window probes it. A window that meets a block of another document is an anchor hit. If a 13-word window occurs
   in two documents, each of the two has an anchor hit inside it (a block of the other).
2. *Extension.* Hits are extended to all 13-word windows around them; these are compared by a 128-bit hash over
   the whole corpus, the smallest document id of each is found, and windows with a larger id are marked. Runs of
   marked windows are the maximal exact repeats; their words go.

Data layout. Documents are first packed into chunks (about ``CHUNK_BYTES`` of text, compressed), the unit of all
later work, and stored. Hashes are computed in numpy from the chunk's bytes; a chunk sends, per hash bucket, one
sorted array of its *distinct* hashes and gets back positions in it, so a passage that a chunk holds a thousand
times travels once, and what two documents of a chunk share is decided in the chunk. Buckets grow in number with
the text, keep their size, and stream: their memory is the distinct block hashes of one bucket. Pairs of documents
are never formed.

Hashes: 64-bit word hashes, mixed, combined per window and mixed again. Anchor hits are only candidates, so their
32-bit tails (below the bucket's share of the hash) cost nothing but work; the decision uses two independent
64-bit hashes together.

Defined results: null and empty texts have no words, lose none and keep the empty text; windows that start in
documents of equal id do not remove each other; a null id counts as larger than every other; repeated rows get
equal results; an empty table gives an empty result; only id and text are read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catloom.runtime import short_shuffles, stored

WINDOW = 13
BLOCK = 7
CHUNK_BYTES = 2_000_000
BUCKET_BYTES = 6_000_000
SLICE = 4_000_000
NULL_ID = np.iinfo(np.int64).max
_P1, _P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)  # odd multipliers
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)  # the finaliser of splitmix64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    if n:
        out[0] = 1
        out[1:] = base
        np.multiply.accumulate(out, out=out)
    return out


class Chunk:
    """Some whole documents: ids (a null as ``NULL_ID``), null marks, raw texts; a document never spans chunks."""

    def __init__(self, ids: np.ndarray, nulls: np.ndarray, texts: list[bytes]):
        self.ids, self.nulls, self.texts = ids, nulls, texts

    def pack(self) -> bytes:
        lengths = np.array([len(t) for t in self.texts], dtype="<i8")
        raw = b"".join([struct.pack("<q", len(self.texts)), self.ids.astype("<i8").tobytes(), self.nulls.astype(np.uint8).tobytes(), lengths.tobytes(), *self.texts])
        return zstandard.ZstdCompressor(level=1).compress(raw)

    @classmethod
    def unpack(cls, packed: bytes) -> Chunk:
        raw = zstandard.ZstdDecompressor().decompress(packed)
        (n,) = struct.unpack_from("<q", raw)
        ids = np.frombuffer(raw, "<i8", n, 8)
        nulls = np.frombuffer(raw, np.uint8, n, 8 + 8 * n).astype(bool)
        ends = 8 + 17 * n + np.concatenate([[0], np.cumsum(np.frombuffer(raw, "<i8", n, 8 + 9 * n))])
        return cls(ids, nulls, [raw[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())])

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Two hashes of every word and the document each word belongs to."""
        data = np.frombuffer(b"\n".join(self.texts) + b"\n", dtype=np.uint8)
        found, begin = [], 0
        while begin < len(data):  # slices that end at white space bound the memory of long chunks
            end = min(len(data), begin + SLICE)
            while not _SPACE[data[end - 1]]:
                end += 1
            found.append(_word_hashes(data[begin:end], begin))
            begin = end
        first, second, starts = map(np.concatenate, zip(*found))
        bounds = np.cumsum([len(t) + 1 for t in self.texts])
        return first, second, np.searchsorted(bounds, starts, side="right")


def _word_hashes(data: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes and the start of every word of ``data``, which ends with white space."""
    blank = _SPACE[data]
    edge = np.diff(blank.view(np.int8), prepend=np.int8(1))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero((edge == 1)[1:]) + 1
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), starts
    ends = ends[-len(starts) :]
    spans = np.diff(np.append(starts, len(data)))
    inside = np.arange(starts[0], len(data)) - np.repeat(starts, spans)
    live = ~blank[starts[0] :]
    kept = (data[starts[0] :].astype(np.uint64) + np.uint64(1)) * live
    inside *= live
    lengths = ends - starts
    hashes = []
    for base in (_P1, _P2):
        total = np.add.reduceat(kept * _powers(base, int(lengths.max()))[inside], starts - starts[0])
        hashes.append(_mix(total + lengths.astype(np.uint64) * base))
    return hashes[0], hashes[1], starts + begin


def _rolling(words: np.ndarray, owner: np.ndarray, size: int, base: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Mixed hashes of the windows of ``size`` words, and which starts have a whole window inside one document."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    total = words[:n].copy()
    for k in range(1, size):
        total *= base
        total += words[k : k + n]
    return _mix(total), owner[:n] == owner[size - 1 :]


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """A bucket from the high half of each hash; sorted hashes have sorted buckets."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _slices(hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """``(bucket, start, end)`` over sorted hashes."""
    if len(hashes):
        b = _bucket(hashes, buckets)
        cuts = [0, *(np.flatnonzero(np.diff(b)) + 1).tolist(), len(b)]
        for s, e in zip(cuts, cuts[1:]):
            yield int(b[s]), s, e


class Anchors:
    """Step 1 of a chunk: its distinct rolling windows, its blocks, and the hits found without other chunks."""

    def __init__(self, first: np.ndarray, owner: np.ndarray):
        rolling, whole = _rolling(first, owner, BLOCK, _P1)
        at = np.flatnonzero(whole)
        self.distinct, self.code = np.unique(rolling[at], return_inverse=True)
        self.at = at
        begin = np.searchsorted(owner, owner[at], side="left")
        is_block = (at - begin) % BLOCK == 0
        code, doc = self.code[is_block], owner[at][is_block]
        low = np.full(len(self.distinct), np.iinfo(np.int64).max)
        high = np.full(len(self.distinct), -1, dtype=np.int64)
        np.minimum.at(low, code, doc)
        np.maximum.at(high, code, doc)
        self.is_block = high >= 0
        docs = owner[at]
        own_block = self.is_block[self.code]
        self.local = np.zeros(len(self.distinct), dtype=bool)
        other = own_block & ((low[self.code] != docs) | (high[self.code] != docs))
        self.local[self.code[other]] = True


def extended(hit_codes: np.ndarray, anchors: Anchors, second: np.ndarray, first: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and the two hashes of all whole 13-word windows that contain an anchor hit."""
    n = len(first) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    h1, whole = _rolling(first, owner, WINDOW, _P1)
    h2, _ = _rolling(second, owner, WINDOW, _P2)
    hits = np.zeros(len(first) + 1, dtype=np.int64)
    hits[anchors.at[hit_codes[anchors.code]] + 1] = 1
    seen = np.cumsum(hits)
    # a window at i holds the anchors that start at i .. i + 6
    inside = seen[np.minimum(np.arange(n) + WINDOW - BLOCK + 1, len(first))] - seen[np.arange(n)]
    starts = np.flatnonzero(whole & (inside > 0))
    return starts, h1[starts], h2[starts]


class Windows:
    """Step 2 of a chunk: distinct candidate windows with the smallest id that holds each in the chunk."""

    def __init__(self, chunk: Chunk, hit_codes: np.ndarray, anchors: Anchors, first: np.ndarray, second: np.ndarray, owner: np.ndarray):
        self.starts, h1, h2 = extended(hit_codes, anchors, second, first, owner)
        order = np.lexsort((h2, h1))
        h1, h2 = h1[order], h2[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        self.code = np.empty(len(order), dtype=np.int64)
        self.code[order] = np.cumsum(new) - 1
        self.h1, self.h2 = h1[new], h2[new]
        self.doc = chunk.ids[owner[self.starts]] if len(order) else np.zeros(0, np.int64)
        self.low = np.full(len(self.h1), NULL_ID)
        np.minimum.at(self.low, self.code, self.doc)


def make_chunks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        ids: list = []
        texts: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal ids, texts, size, made
            numbers = np.array([NULL_ID if i is None else i for i in ids], dtype=np.int64)
            packed = Chunk(numbers, np.array([i is None for i in ids]), texts).pack()
            out = pa.RecordBatch.from_arrays([pa.array([(part << 32) + made]), pa.array([packed], pa.binary())], names=["chunk", "packed"])
            ids, texts, size, made = [], [], 0, made + 1
            return out

        for batch in batches:
            for i, t in zip(batch.column(0), batch.column(1)):
                raw = t.as_buffer()
                raw = raw.to_pybytes() if raw is not None else b""
                if ids and size + len(raw) > CHUNK_BYTES:
                    yield flush()
                ids.append(i.as_py())
                texts.append(raw)
                size += len(raw)
        if ids:
            yield flush()

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return stored(narrow.mapInArrow(run, "chunk long, packed binary"), "substring-chunks")


def _emit(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    types = [pa.int32(), pa.int32(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["bucket", "kind", "chunk", "payload"])


def _replies(batches: Iterator[pa.RecordBatch], table, answer) -> Iterator[pa.RecordBatch]:
    """Per bucket: fold rows of kind 0 into a table, then answer rows of kind 1 against it, one by one."""
    bucket, state = None, None
    for batch in batches:
        rows = zip(*(batch.column(k).to_pylist() for k in range(4)))
        out = []
        for b, kind, chunk, payload in rows:
            if b != bucket:
                bucket, state = b, table(None, None, None)
            if kind == 0:
                state = table(state, chunk, payload)
            else:
                state = table(state, None, None)
                found = answer(state, chunk, payload)
                if len(found):
                    out.append((chunk, b, found.astype("<u4").tobytes()))
        if out:
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.binary())], names=["chunk", "bucket", "found"])


def _exchange(emitted: DataFrame, table, answer, purpose: str) -> DataFrame:
    dealt = emitted.repartition("bucket").sortWithinPartitions("bucket", "kind")
    with short_shuffles(emitted.sparkSession):  # what one step sent must not lie beside what the next one sends
        return stored(dealt.mapInArrow(lambda batches: _replies(batches, table, answer), "chunk long, bucket int, found binary"), purpose)


def _grouped(replies: DataFrame) -> DataFrame:
    return replies.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "found")).alias("found"))


def _codes(found: list[dict] | None, hashes: np.ndarray, buckets: int, local: np.ndarray) -> np.ndarray:
    """Positions in the chunk's sorted hashes that replies name, with those known locally."""
    marks = local.copy()
    begin = {b: s for b, s, _ in _slices(hashes, buckets)}
    for reply in found or ():
        marks[begin[reply["bucket"]] + np.frombuffer(reply["found"], "<u4")] = True
    return marks


# Step 1: the table of a bucket is (hash tails, their chunk, whether several chunks have it).
def _anchor_table(state, chunk, payload):
    if state is None:
        return [[], np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, bool)]
    waiting, tails, chunks, several = state
    if payload is not None:
        waiting.append((chunk, np.frombuffer(payload, "<u4")))
    if waiting and (payload is None or len(waiting) >= 256):
        tails = np.concatenate([tails, *(t for _, t in waiting)])
        chunks = np.concatenate([chunks, *(np.full(len(t), c) for c, t in waiting)])
        several = np.concatenate([several, np.zeros(len(tails) - len(several), bool)])
        order = np.argsort(tails, kind="stable")
        tails, chunks, several = tails[order], chunks[order], several[order]
        starts = np.flatnonzero(np.concatenate([[True], tails[1:] != tails[:-1]])) if len(tails) else np.zeros(0, np.int64)
        if len(tails):
            several = np.logical_or.reduceat(several, starts) | (np.minimum.reduceat(chunks, starts) != np.maximum.reduceat(chunks, starts))
            tails, chunks = tails[starts], chunks[starts]
        waiting = []
    return [waiting, tails, chunks, several]


def _anchor_answer(state, chunk, payload):
    _, tails, chunks, several = state
    probe = np.frombuffer(payload, "<u4")
    if not len(tails):
        return np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(tails, probe), len(tails) - 1)
    return np.flatnonzero((tails[at] == probe) & (several[at] | (chunks[at] != chunk)))


# Step 2: the table of a bucket is (first hash, second hash, smallest id).
_WINDOW = np.dtype([("h1", "<u8"), ("h2", "<u8"), ("low", "<i8")])


def _window_table(state, chunk, payload):
    if state is None:
        return [[], np.zeros(0, _WINDOW)]
    waiting, held = state
    if payload is not None:
        waiting.append(np.frombuffer(payload, _WINDOW))
    if waiting and (payload is None or len(waiting) >= 256):
        held = np.concatenate([held, *waiting])
        held = held[np.lexsort((held["low"], held["h2"], held["h1"]))]
        if len(held):
            same = (held["h1"][1:] == held["h1"][:-1]) & (held["h2"][1:] == held["h2"][:-1])
            held = held[np.concatenate([[True], ~same])]
        waiting = []
    return [waiting, held]


def _window_answer(state, chunk, payload):
    held, probe = state[1], np.frombuffer(payload, _WINDOW)
    at = np.searchsorted(held["h1"], probe["h1"])
    for _ in range(len(held)):  # equal first hashes with other second ones: as good as never
        off = held["h2"][at] != probe["h2"]
        if not off.any():
            break
        at = at + off
    return np.flatnonzero(held["low"][at] < probe["low"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text, removed`` for every row.

    ``kept_text``: the kept words joined by one space; ``removed``: the maximal runs of removed words as structs
    of first word and end (exclusive).
    """
    chunks = make_chunks(docs, id_col, text_col)
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    buckets = max(1, -(-size // bucket_bytes))

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                first, _, owner = Chunk.unpack(packed.as_py()).words()
                found = Anchors(first, owner)
                tails = found.distinct.astype("<u4")
                rows = []
                for b, s, e in _slices(found.distinct, buckets):
                    open_ = ~found.local[s:e]
                    rows.append((b, 0, key, tails[s:e][found.is_block[s:e]].tobytes()))
                    rows.append((b, 1, key, tails[s:e].tobytes()) if open_.any() else None)
                rows = [r for r in rows if r and r[3]]
                if rows:
                    yield _emit(rows)

    hits = _exchange(chunks.mapInArrow(anchors, "bucket int, kind int, chunk long, payload binary"), _anchor_table, _anchor_answer, "substring-hits")

    def state(batch: pa.RecordBatch, i: int) -> tuple[Chunk, Windows, np.ndarray]:
        chunk = Chunk.unpack(batch.column(1)[i].as_py())
        first, second, owner = chunk.words()
        found = Anchors(first, owner)
        marks = _codes(batch.column(2)[i].as_py(), found.distinct, buckets, found.local)
        return chunk, Windows(chunk, marks, found, first, second, owner), owner

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, key in enumerate(batch.column(0).to_pylist()):
                _, found, _ = state(batch, i)
                entries = np.empty(len(found.h1), _WINDOW)
                entries["h1"], entries["h2"], entries["low"] = found.h1, found.h2, found.low
                rows = [(b, kind, key, entries[s:e].tobytes()) for b, s, e in _slices(found.h1, buckets) for kind in (0, 1)]
                if rows:
                    yield _emit(rows)

    with_hits = chunks.join(_grouped(hits), "chunk", "left")
    small = _exchange(with_hits.mapInArrow(windows, "bucket int, kind int, chunk long, payload binary"), _window_table, _window_answer, "substring-windows")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            for i in range(batch.num_rows):
                chunk, found, owner = state(batch, i)
                marks = _codes(batch.column(3)[i].as_py(), found.h1, buckets, np.zeros(len(found.h1), bool))
                gone = (found.doc > found.low[found.code]) | marks[found.code]
                cover = np.zeros(len(owner) + WINDOW + 1, dtype=np.int64)
                np.add.at(cover, found.starts[gone], 1)
                np.add.at(cover, found.starts[gone] + WINDOW, -1)
                kept = np.cumsum(cover)[: len(owner)] == 0
                ends = np.searchsorted(owner, np.arange(len(chunk.texts)), side="right")
                begin, rows, volume = 0, [], 0
                for k, (end, raw) in enumerate(zip(ends.tolist(), chunk.texts)):
                    words, mine = raw.split(), kept[begin:end]
                    begin = end
                    edges = np.flatnonzero(np.diff(np.concatenate([[True], mine, [True]]).view(np.int8)))
                    runs = [{"first": a, "end": b} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]
                    text = b" ".join(compress(words, mine.tolist()) if runs else words)
                    rows.append((None if chunk.nulls[k] else int(chunk.ids[k]), len(words), len(words) - int(mine.sum()), text.decode(), runs))
                columns = list(zip(*rows))
                types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), span]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "n_words", "n_removed", "kept_text", "removed"])

    schema = "doc_id long, n_words long, n_removed long, kept_text string, removed array<struct<first:int,end:int>>"
    smaller = _grouped(small).withColumnRenamed("found", "smaller")
    return chunks.join(_grouped(hits), "chunk", "left").join(smaller, "chunk", "left").select("chunk", "packed", "found", "smaller").mapInArrow(finish, schema)
