"""Pfair mixing of sources to target weights; DataFrame functions only.

Each source's documents, in a hashed order, are cut into blocks of ``BLOCK_DOCS``. The target weights are read as
fractions (the simple one a float stands for) and brought to their common denominator: integer shares ``q`` of a period
of ``Q`` slots, so that ``q / Q`` is the weight itself. Block ``i`` (from 0) of a source of weight ``w`` is released at slot ``floor(i / w)`` and due at slot ``ceil((i + 1) / w)``; every slot goes
to the released block with the earliest deadline. After any number of slots each source then has less than one
block more or less than its share. Windows repeat with period ``Q``, so one period is scheduled - a fold of ``Q``
steps whose size depends on the weights, not on the data - and block ``i`` takes slot
``(i // q) * Q + pattern[i % q]``. A period longer than ``FOLDED`` slots is scheduled on the driver with heaps, and only as
far as the blocks go; beyond ``LONGEST`` slots :func:`mix` stops with an error instead of rounding weights. When a source has run out its slots stay empty; the others go on in proportion.

Numbering blocks needs ranks within sources that may hold a third of all rows. Ranks are found in two levels:
within cells of about ``CELL_DOCS`` rows (source and leading hash digits), and between cells by a running sum over
their counts. No window sees a whole source.

Defined results: a null source is a source of its own; sources without a given weight get the mean of the given
ones, sources with weight but no rows are ignored, without weights all sources count alike; weights must be
positive; null or repeated ids and equal rows are ordered by the hash, then the id (equal rows interchangeably);
an empty table gives an empty result; texts are not read, and other columns may have any names.
"""

from __future__ import annotations

from fractions import Fraction
from heapq import heappop, heappush
from math import gcd, lcm

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catloom.runtime import cut

FOLDED = 4096
LONGEST = 1 << 24
BLOCK_DOCS = 16
CELL_DOCS = 4096


def fraction(weight: float) -> Fraction:
    """The fraction of small denominator that equals a float but for its rounding."""
    exact = Fraction(weight)
    for digits in range(1, 16):
        near = exact.limit_denominator(10**digits)
        if abs(near - exact) * (1 << 51) <= exact:
            return near
    return exact


def integer_shares(sources: list[str | None], weights: dict[str | None, float] | None, period: int = 1) -> list[tuple[str | None, int]]:
    """``(source, q)`` in the exact ratio of the weights, null first; the q sum to the least common period or a multiple of ``period`` slots or more."""
    if weights and min(weights.values()) <= 0:
        raise ValueError("weights must be positive")
    given = {name: fraction(value) for name, value in (weights or {}).items()}
    mean = sum(given.values()) / len(given) if given else Fraction(1)
    listed = [(name, given.get(name, mean)) for name in sorted(sources, key=lambda x: (x is not None, x or ""))]
    if not listed:
        return []
    scale = lcm(*(w.denominator for _, w in listed))
    whole = [int(w * scale) for _, w in listed]
    total = sum(whole) // gcd(*whole)
    times = -(-period // total)
    return [(name, q // gcd(*whole) * times) for (name, _), q in zip(listed, whole)]


def shares(counts: DataFrame, weights: dict[str | None, float] | None, period: int = 1) -> DataFrame:
    """One row, ``shares``: the :func:`integer_shares` of the sources in ``counts``, whose number bounds it."""
    found = integer_shares([r["source"] for r in counts.select("source").distinct().collect()], weights, period)
    return counts.sparkSession.createDataFrame([(found,)], "shares array<struct<source:string,q:bigint>>")


def long_pattern(shared: list[tuple[str | None, int]], slots: int) -> list[tuple[str | None, int, int, int, int, int]]:
    """``(source, q, j, slot, release, deadline)`` for the first slots of a period: :func:`pattern` in steps of the logarithm of the sources."""
    period = sum(q for _, q in shared)
    waiting = [(0, k, 0) for k in range(len(shared))]  # release, source, block
    ready: list[tuple[int, int, int]] = []  # deadline, source, block
    out = []
    for t in range(slots):
        while waiting and waiting[0][0] <= t:
            _, k, j = heappop(waiting)
            heappush(ready, (-(-(j + 1) * period // shared[k][1]), k, j))
        due, k, j = heappop(ready)
        name, q = shared[k]
        out.append((name, min(q, 1 << 62), j, t, j * period // q, due))
        if j + 1 < q:
            heappush(waiting, ((j + 1) * period // q, k, j + 1))
    return out


def pattern(shared: DataFrame, period: int) -> DataFrame:
    """``(source, q, j, slot)``: the slots of one period by earliest deadline first. ``shared`` has one row."""
    n = F.size("shares")

    def step(acc: Column, t: Column) -> Column:
        # candidates are released and not used up; the earliest deadline wins, then the first source
        due = F.zip_with(
            F.col("q"), acc["done"],
            lambda q, k: F.when((k < q) & (F.floor(k * period / q) <= t), F.ceil((k + 1) * period / q)).otherwise(F.lit(1 << 40)),
        )
        chosen = F.array_position(due, F.array_min(due)).cast("int")
        done = F.transform(acc["done"], lambda k, i: F.when(i + 1 == chosen, k + 1).otherwise(k))
        return F.struct(done.alias("done"), F.concat(acc["picks"], F.array(chosen)).alias("picks"))

    start = F.struct(F.array_repeat(F.lit(0), n).alias("done"), F.array().cast("array<int>").alias("picks"))
    base = shared.withColumn("q", F.transform("shares", lambda x: x["q"]))
    picks = F.aggregate(F.sequence(F.lit(0), F.lit(period - 1)), start, step, lambda acc: acc["picks"])
    slots = base.filter(n > 0).select("shares", F.posexplode(picks).alias("slot", "pick"))
    named = slots.select(F.element_at("shares", F.col("pick")).alias("x"), "slot").select("x.source", "x.q", "slot")
    return named.withColumn("j", F.row_number().over(Window.partitionBy("source").orderBy("slot")) - 1)


def order_in_source(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", cell_docs: int = CELL_DOCS) -> DataFrame:
    """``doc_id, source, rank``: the place of every row in its source's hashed order, from 0."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"))
    # rows of null id are spread by their place in the input, which the cut makes lasting
    base = cut(base.withColumn("h", F.md5(F.coalesce(F.col("doc_id"), F.monotonically_increasing_id()).cast("string").cast("binary"))))
    rows = base.count()
    digits = 1
    while 16**digits * cell_docs < rows:
        digits += 1
    base = base.withColumn("cell", F.substring("h", 1, digits))
    ranked = base.withColumn("inside", F.row_number().over(Window.partitionBy("source", "cell").orderBy("h", F.col("doc_id").asc_nulls_first())) - 1)
    counts = base.groupBy("source", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(F.col("source").alias("of"), F.col("cell").alias("at"), F.coalesce(before, F.lit(0)).alias("before"))
    joined = ranked.join(offsets, F.col("source").eqNullSafe(F.col("of")) & (F.col("cell") == F.col("at")))
    return joined.select("doc_id", "source", (F.col("before") + F.col("inside")).alias("rank"))


def mix(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    block_docs: int = BLOCK_DOCS,
    period: int = 1,
    cell_docs: int = CELL_DOCS,
) -> DataFrame:
    """Every row's place: ``doc_id, source, block, release, deadline, slot, place``; slot, then place, is the order.

    ``period`` is the least number of slots that are scheduled at once.
    """
    ranked = cut(order_in_source(docs, id_col, source_col, cell_docs))
    counts = cut(ranked.groupBy("source").agg(F.count(F.lit(1)).alias("n")))
    sizes = {r["source"]: r["n"] for r in counts.collect()}  # one row per source
    shared = integer_shares(list(sizes), weights, period)
    period = sum(q for _, q in shared)
    if period <= FOLDED:
        table = pattern(shares(counts, weights, period), period)
        at = [F.floor(F.col("j") * period / F.col("q")).alias("release"), F.ceil((F.col("j") + 1) * period / F.col("q")).alias("deadline")]
        table, slots = cut(table.select("*", *at)), period
    else:
        slots = min(period, max(-(-(-(-sizes[s] // block_docs)) * period // q) for s, q in shared))
        if slots > LONGEST:
            raise ValueError(f"the weights have no common period under {LONGEST} slots; give rounder ones")
        table = cut(ranked.sparkSession.createDataFrame(long_pattern(shared, slots), "source string, q bigint, j bigint, slot bigint, release bigint, deadline bigint"))
    table = table.select(F.col("source").alias("of"), "q", "j", F.col("slot").alias("in_period"), "release", "deadline")
    side = F.broadcast(table) if slots <= 1 << 20 else table  # one row per scheduled slot
    shared = F.broadcast(table.select("of", "q").distinct())  # one row per source
    blocks = ranked.withColumn("block", F.floor(F.col("rank") / block_docs))
    with_q = blocks.join(shared, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    with_q = with_q.withColumn("jj", F.col("block") % F.col("q"))
    placed = with_q.join(side.drop("q"), F.col("source").eqNullSafe(F.col("of")) & (F.col("jj") == F.col("j")))
    before = F.expr("block div q") * F.lit(min(period, 1 << 62))
    return placed.select(
        "doc_id", "source", F.col("block").cast("long").alias("block"),
        *[(before + F.col(c)).cast("long").alias(c) for c in ("release", "deadline")],
        (before + F.col("in_period")).cast("long").alias("slot"),
        (F.col("rank") % block_docs).cast("int").alias("place"),
    )


def interleave(docs: DataFrame, weights: dict[str | None, float] | None = None, id_col: str = "doc_id", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs``, unchanged and all of them, in mixed order (a range partitioned sort)."""
    # columns go by position, so that no name clashes; a row of null id goes by its contents
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    identity, source = (F.col(f"c{docs.columns.index(c)}") for c in (id_col, source_col))
    key = F.coalesce(identity.cast("long"), F.xxhash64(*plain.columns))
    order = mix(plain.select(key.alias("doc_id"), source.cast("string").alias("source")), weights, **options)
    # rows that share a key share its places; which of them takes which does not matter, so take the first
    order = order.groupBy("doc_id", "source").agg(F.min(F.struct("slot", "place")).alias("at"))
    matched = plain.join(order.hint("shuffle_hash"), (key == F.col("doc_id")) & source.cast("string").eqNullSafe(F.col("source")), "left")
    return matched.orderBy("at.slot", "at.place").drop("doc_id", "source", "at").toDF(*docs.columns)
