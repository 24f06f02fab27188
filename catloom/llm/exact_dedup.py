"""Exact deduplication with a heavy-hitter split.

1. One narrow table of SHA-256 digests is made and checkpointed; texts are not shuffled.
2. Every task runs a Misra-Gries summary of ``counters`` entries over its digests. Summaries are summed per
   digest; the ``2 * counters`` with the largest sums are candidates. A digest missed there only takes the ordinary way.
3. Candidates are verified by an exact count (map-side combined). Those above the floor - at most
   ``2 * counters`` rows, the bound of what is broadcast - are resolved map-side against the broadcast winners.
4. All other digests have small groups by construction and take the ordinary shuffle: sizes and winners are an aggregate, joined back.

Defined results: a null text counts as the empty text; a null id sorts below every other id; of rows with
equal text *and* equal id one is kept; an empty table gives an empty result; only the id and the text column
are read, so other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catloom.runtime import cut

COUNTERS = 1024
#: Keys of 40 bytes that are broadcast at most.
BROADCAST_KEYS = 500_000


def misra_gries(batches: Iterator[pa.RecordBatch], counters: int) -> dict[bytes, int]:
    """Summary of a digest stream: every value with more than ``n / counters`` occurrences survives."""
    held: dict[bytes, int] = {}
    for batch in batches:
        for entry in pc.value_counts(batch.column(0)).to_pylist():
            if entry["values"] is not None:
                held[entry["values"]] = held.get(entry["values"], 0) + entry["counts"]
        if len(held) > counters:
            floor = sorted(held.values(), reverse=True)[counters]
            held = {k: n - floor for k, n in held.items() if n > floor}
    return held


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, digest, rid)``: the narrow table that all later steps read."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return cut(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
            F.monotonically_increasing_id().alias("rid"),
        )
    )


def heavy_winners(table: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Verified frequent digests with their winner and size; at most ``2 * counters`` rows."""

    def summarise(batches):
        held = misra_gries(batches, counters)
        if held:
            yield pa.RecordBatch.from_pydict({"digest": pa.array(list(held), pa.binary()), "seen": pa.array(list(held.values()), pa.int64())})

    seen = table.select("digest").mapInArrow(summarise, "digest binary, seen long")
    candidates = (
        seen.groupBy("digest").agg(F.sum("seen").alias("seen")).filter("seen > 1").orderBy(F.desc("seen"), "digest").limit(2 * counters)
    )
    verified = (
        table.join(F.broadcast(candidates.select("digest")), "digest", "left_semi")
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "rid")).alias("winner"))
    )
    return cut(verified)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256, rid``; the largest id stays."""
    table = digests(docs, id_col, text_col)
    heavy = heavy_winners(table, counters)
    hot = table.join(F.broadcast(heavy), "digest").select("doc_id", "rid", "digest", "group_size", "winner")
    # counted with map-side combine and joined back: a digest just under the frequent ones is no group in one task
    rest = table.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    sizes = rest.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "rid")).alias("winner"))
    cold = rest.join(sizes, "digest").select("doc_id", "rid", "digest", "group_size", "winner")
    return hot.unionByName(cold).select(
        "doc_id",
        F.col("winner.doc_id").alias("keep_id"),
        "group_size",
        (F.col("rid") == F.col("winner.rid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "rid",
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs``, unchanged in columns, without those whose text a row with a larger id repeats.

    Only the keys of dropped rows travel; texts are shuffled if those keys are too many to broadcast.
    """
    decided = cut(exact_groups(docs, id_col, text_col, counters).select("doc_id", "kept", F.unhex("text_sha256").alias("digest")))
    per = decided.groupBy("doc_id", "digest").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    marked = cut(per.filter(~F.col("kept") | (F.col("n") > 1)))
    gone = marked.filter(~F.col("kept")).select("doc_id", "digest")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_KEYS else gone.hint("shuffle_hash")
    # columns go by position, so that no name clashes
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at = [f"c{docs.columns.index(c)}" for c in (id_col, text_col)]
    keys = [F.col(at[0]).cast("long").alias("id"), F.unhex(F.sha2(F.coalesce(F.col(at[1]).cast("string"), F.lit("")), 256)).alias("key")]
    left = plain.select("*", *keys)
    left = left.join(gone, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("digest")), "left_anti")
    if not marked.filter("kept").isEmpty():  # the same row several times
        left = left.dropDuplicates(["id", "key"])
    return left.drop("id", "key").toDF(*docs.columns)
