"""Sum-of-squares packing of tokenised documents into fixed-length sequences.

A document becomes its token ids followed by ``END_ID``; only documents longer than the capacity are cut, into
full pieces, and the remainder comes first so that every cut ends in a full sequence. Tokens are produced once
per document in an Arrow map; the packing itself sees only ``(doc_id, piece, length)``.

Placement follows the sum-of-squares rule: with ``N(g)`` open sequences of residual gap ``g``, an item of size
``s`` goes where the sum of ``N(g)**2`` afterwards is smallest. Moving from gap ``g`` to ``g - s`` changes that
sum by ``2 * (N(g - s) - N(g) + 1)``, filling a gap exactly by ``1 - 2 * N(s)``. Items come in order of
decreasing size, and a new sequence is opened only if no open one has room: of the placements the rule allows,
that keeps the number of sequences lowest (measured in the tests against the volume bound). Ties take the
smallest gap.

Scale: unless an order is to be kept (:func:`pack_in_order`), items are dealt to shards of about ``SHARD_ITEMS`` by a hash of id and piece, so no shard depends on a
source, a key or a single long document; every shard is packed on its own and wastes at most its last few
sequences. Sequences never cross shards.

Defined results: a null text counts as empty and gives one piece holding ``END_ID`` alone; equal rows are packed
as often as they occur; a null id is kept; an empty table gives an empty result; columns other than id and text
are not read.
"""

from __future__ import annotations

import array
import json
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catloom.runtime import cut

CAPACITY = 1024
END_ID = 2
SHARD_ITEMS = 8192
SHARD_DOCS = 4096
TOKENIZER = "byte_bpe_50k.json"
CACHE_ENTRIES = 300_000

# The byte-level pre-tokeniser's pattern restricted to Latin-1, on Latin-1 bytes. Letters, numbers
# and white space of that range.
_L, _N, _S = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0"
_PIECES = re.compile(rf" ?[{_L}]+|'(?:s|t|re|ve|m|ll|d)| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+".encode())


# Byte-level vocabularies spell bytes as letters: printable Latin-1 characters stand for themselves, the other bytes, in
# order, for the letters from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = {byte: 256 + k for k, byte in enumerate(b for b in range(256) if b not in _PRINTABLE)}


class Encoder(dict):
    """Text to little-endian ids of a ``tokenizers`` file at its default setting: the strings of its added tokens give their
    ids, unless ``special`` is off: then they are plain text. Word pieces of Latin-1 texts are cached, other texts are encoded
    whole.

    One per Python worker, kept between tasks; the cache is emptied when it holds ``CACHE_ENTRIES``.
    """

    def __init__(self, path: str, special: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as handle:
            file = json.load(handle)
        added = file["added_tokens"]
        # the cached path knows this pre-tokeniser and plain added tokens; anything else is left to the library
        plain = file["normalizer"] is None and file["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        plain &= not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added)
        self.added = {t["content"]: array.array("I", [t["id"]]).tobytes() for t in added if special}
        split = "|".join(re.escape(c) for c in sorted(self.added, key=len, reverse=True))
        self.split = re.compile(f"({split})").split if self.added else lambda text: [text]
        self.cached = plain

    def __missing__(self, piece: bytes) -> bytes:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        spelled = piece.decode("latin-1").encode().decode("latin-1").translate(BYTE_LETTERS)
        ids = self[piece] = array.array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()
        return ids

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def ids(self, text: str) -> bytes:
        if not self.cached:
            return self._whole(text)
        try:
            raw = text.encode("latin-1")
        except UnicodeEncodeError:
            return self._whole(text)
        if not any(c in text for c in self.added):
            return b"".join(map(self.__getitem__, _PIECES.findall(raw)))
        return b"".join(self.added[part] if part in self.added else self.ids(part) for part in self.split(text) if part)


_encoders: dict[str, Encoder] = {}


def encoder(tokenizer: str = TOKENIZER) -> Encoder:
    if tokenizer not in _encoders:
        import public_tokenizers

        _encoders[tokenizer] = Encoder(public_tokenizers.path(tokenizer))
    return _encoders[tokenizer]


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, end)`` of the pieces of ``n`` tokens: full ones, but for the first."""
    first = (n - 1) % capacity + 1
    return [(0, first), *((s, s + capacity) for s in range(first, n, capacity))]


def tokenize(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    tokenizer: str = TOKENIZER,
    with_ids: bool = True,
    shard: Column | None = None,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``shard`` and ``token_ids``, a row per piece."""
    end = np.array([end_id], dtype="<u4").tobytes()
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, shard long" + ", token_ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).ids
        for batch in batches:
            rows: list[list] = [[] for _ in range(6 + with_ids)]
            size = 0
            for doc, text, place in zip(batch.column(0), batch.column(1), batch.column(2)):
                ids = encode(text.as_py() or "") + end
                for k, (a, b) in enumerate(piece_bounds(len(ids) // 4, capacity)):
                    part = ids[4 * a : 4 * b]
                    row = [doc.as_py(), k, a, b - a, zlib.crc32(part), place.as_py()]
                    for column, value in zip(rows, row + [np.frombuffer(part, "<i4")] * with_ids):
                        column.append(value)
                size += len(ids)
                if size > 8_000_000:
                    yield _batch(rows, with_ids)
                    rows, size = [[] for _ in range(6 + with_ids)], 0
            if rows[0]:
                yield _batch(rows, with_ids)

    place = (F.lit(None) if shard is None else shard).cast("long").alias("shard")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), place).mapInArrow(run, schema)


def _batch(rows: list[list], with_ids: bool) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int32())] * with_ids
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "shard"] + ["token_ids"] * with_ids
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names=names)


def sum_of_squares(sizes: Iterable[int], capacity: int, any_fit: bool = True) -> tuple[list[int], list[int], int]:
    """Bin and offset of every item in the order given, and the number of bins."""
    counts = np.zeros(capacity + 1, dtype=np.int64)  # N(g); N(0) stays 0, closed bins do not count
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, made = [], [], 0
    for size in sizes:
        best, cost = 0, None
        gaps = counts[size:]
        usable = np.flatnonzero(gaps)
        if len(usable):
            change = 2 * (counts[usable] - gaps[usable] + 1)
            if usable[0] == 0:
                change[0] = 1 - 2 * gaps[0]
            at = int(np.argmin(change))
            best, cost = size + int(usable[at]), int(change[at])
        if cost is None or (not any_fit and size < capacity and 2 * counts[capacity - size] + 1 < cost):
            home, gap, made = made, capacity, made + 1
        else:
            home, gap = open_bins[best].pop(), best
            counts[best] -= 1
        bins.append(home)
        offsets.append(capacity - gap)
        if gap > size:
            counts[gap - size] += 1
            open_bins[gap - size].append(home)
    return bins, offsets, made


def place(pieces: DataFrame, capacity: int = CAPACITY, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """``pieces`` (materialised; columns doc_id, piece, length, shard and others) with ``sequence_id`` and ``offset``.

    A null shard is dealt by hash. Ids stay Arrow integers throughout.
    """
    shards = max(1, round(pieces.count() / shard_items))
    names = [c for c in pieces.columns if c != "shard"]

    def pack(key: tuple, items: pa.Table) -> pa.Table:
        items = items.take(pc.sort_indices(items, [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")]))
        bins, offsets, _ = sum_of_squares(items["length"].to_pylist(), capacity)
        ids = np.array(bins, dtype=np.int64) + (key[0].as_py() << 32)
        return items.select(names).append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offsets, pa.int64()))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema if f.name != "shard") + ", sequence_id long, offset long"
    dealt = pieces.withColumn("shard", F.coalesce("shard", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shards))))
    return dealt.groupBy("shard").applyInArrow(pack, schema)


def pack_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str = TOKENIZER, shard: Column | None = None
) -> DataFrame:
    """Placement of every piece, without its tokens: what a writer of sequences needs to know."""
    return place(cut(tokenize(docs, id_col, text_col, capacity, end_id, tokenizer, with_ids=False, shard=shard)), capacity)


def pack_in_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_docs: int = SHARD_DOCS, **options) -> DataFrame:
    """As :func:`pack_documents`, along the order of a table's files: sequences hold documents of ``shard_docs`` consecutive
    rows, and sequence ids follow the order. Tables that are not read from files are dealt by hash."""
    try:
        rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    except AnalysisException:
        return pack_documents(docs, id_col, text_col, **options)
    sizes = cut(rows.groupBy("file").agg((F.max("row") + 1).alias("n")))
    # a row per file; names of one write sort in the order of its tasks
    before = F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("file", before.alias("before"))
    starts = F.broadcast(starts) if sizes.count() <= 1_000_000 else starts
    numbered = rows.join(starts, "file")
    return pack_documents(numbered, shard=F.floor((F.col("before") + F.col("row")) / shard_docs), **options)


def sequences(docs: DataFrame, **options) -> DataFrame:
    """The packed sequences themselves: ``sequence_id, token_ids, doc_ids``; a sequence is at most one capacity long."""
    capacity = options.get("capacity", CAPACITY)
    placed = place(cut(tokenize(docs, with_ids=True, **options)), capacity)
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "token_ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.flatten("parts.token_ids").alias("token_ids"), F.col("parts.doc_id").alias("doc_ids")
    )
