"""Quoted multi-line CSV, read in parallel.

A line break inside quotes makes it impossible to tell, from the middle of a file, where a record starts. Two passes over byte
ranges find out. Spark's text source deals every file in ranges of whole lines; a line maps the state before it (inside or
outside quotes) to the state after it, and so does a range.

1. Every range gives, for both states it may begin in, the state it ends in and the records that start in it.
2. A prefix over the ranges of each file, a row a range, tells the true state and the number of records before each.
3. Every range is parsed from its first true record start. What belongs to a record of the range before, and a last record that
   goes on in the range after, are handed on as fragments; only fragments are shuffled, to be joined and parsed.

The rules are those of the standard library's ``csv``: a quote opens a quoted cell only at its start, doubled quotes are one, blank
lines are no records; line ends inside cells become a plain line feed; a quote that never closes takes the rest of its file, up to the
last line's end. The first record of a file is its header.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catloom.runtime import bounded, cut

MOST_RANGES = 2_000_000
_CELL = re.compile(r'[^,]*(?:,|$)')  # the rest of an unquoted cell
_QUOTED = re.compile(r'[^"]*(?:""[^"]*)*')  # inside quotes, up to a quote that closes or the end


def inside_after(line: str, inside: bool) -> bool:
    """Whether the end of a line (without its break) is inside quotes."""
    if '"' not in line:
        return inside
    at, size = 0, len(line)
    while True:
        if not inside:
            if at >= size:
                return False
            if line[at] != '"':
                at = _CELL.match(line, at).end()
                if at == size and line[-1] != ",":
                    return False
                continue
            at, inside = at + 1, True
        at = _QUOTED.match(line, at).end()
        if at >= size:
            return True
        at, inside = _CELL.match(line, at + 1).end(), False
        if at >= size:
            return False


def _ranges(batches: Iterable[pa.RecordBatch], columns: int) -> Iterator[tuple[tuple, list[str]]]:
    """``(first columns, lines)`` of the batches' runs of equal leading columns; a range may come in several runs."""
    for batch in batches:
        keys, lines = list(zip(*(batch.column(i).to_pylist() for i in range(columns)))), batch.column(columns).to_pylist()
        begin = 0
        for at in range(1, len(keys) + 1):
            if at == len(keys) or keys[at] != keys[begin]:
                yield keys[begin], lines[begin:at]
                begin = at


def _text(spark: SparkSession, path: str, pattern: str | None) -> DataFrame:
    reader = spark.read.option("lineSep", "\n")
    lines = (reader.option("pathGlobFilter", pattern) if pattern else reader).text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.regexp_replace("value", "\r$", "").alias("line"))


def range_states(lines: DataFrame) -> DataFrame:
    """``file, at, inside, before, records``: of every range the state it begins in, and its file's records before and in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # two hypotheses: the range begins outside, inside
        held: dict[tuple, list] = {}
        for key, part in _ranges(batches, 2):
            now = held.setdefault(key, [False, True, 0, 0])
            for line in part:
                for k in (0, 1):
                    now[2 + k] += not now[k] and line != ""
                    now[k] = inside_after(line, now[k])
        rows = [(*key, *now) for key, now in held.items()]
        types = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["file", "at", "if_out", "if_in", "n_out", "n_in"])

    ranges = cut(lines.mapInArrow(run, "file string, at long, if_out boolean, if_in boolean, n_out long, n_in long"))
    # a range turns the state, keeps it, or ends in one state whatever it began in: the last that does not merely turn decides, with the
    # turns since
    fixed = F.when(F.col("if_out") == F.col("if_in"), F.col("if_out"))
    turns = F.when(fixed.isNull() & F.col("if_out"), 1).otherwise(0)
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    marked = ranges.withColumn("turn", turns).withColumn("so_far", F.coalesce(F.sum("turn").over(before), F.lit(0)))
    marked = marked.withColumn("known", F.last(F.when(fixed.isNotNull(), F.struct(fixed.alias("state"), (F.col("so_far") + F.col("turn")).alias("so_far"))), ignorenulls=True).over(before))
    since = F.col("so_far") - F.coalesce("known.so_far", F.lit(0))
    inside = F.coalesce("known.state", F.lit(False)) != (since % 2 == 1)
    counted = marked.withColumn("inside", inside).withColumn("records", F.when(F.col("inside"), F.col("n_in")).otherwise(F.col("n_out")))
    return counted.select("file", "at", "inside", F.coalesce(F.sum("records").over(before), F.lit(0)).alias("before"), "records")


def _cells(lines: list[str], columns: int, end: str = "\n") -> Iterator[list[str]]:
    csv.field_size_limit(2**31 - 1)
    last = len(lines) - 1
    for cells in csv.reader(line + ("\n" if i < last else end) for i, line in enumerate(lines)):
        if cells:
            yield (cells + [""] * (columns - len(cells)))[:columns]


def read_split_csv(spark: SparkSession, path: str, columns: list[str], pattern: str | None = None, order: str = "_ord") -> DataFrame:
    """The records of all files as strings, empty cells as empty strings, with a dense ordinal by file and position, and ``file``."""
    lines = _text(spark, path, pattern)
    states = cut(range_states(lines))
    width = len(columns)
    names = [f"c{i}" for i in range(width)]
    schema = "file string, at long, record long, fragment string, " + ", ".join(f"{c} string" for c in names)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.string(), pa.int64(), pa.int64(), pa.string()] + [pa.string()] * width
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["file", "at", "record", "fragment", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, record, open_ = None, False, 0, []  # open_: lines of a record that has not ended

        def fragment() -> Iterator[pa.RecordBatch]:
            if open_:
                yield batch([(key[0], key[1], record - 1, "\n".join(open_), *[None] * width)])

        for here, part in _ranges(batches, 4):
            if here != key:
                yield from fragment()
                key, (state, record), open_ = here, here[2:], []
                handed_on = state  # lines of a record of the range before
            rows, whole, first = [], [], record
            for line in part:
                if not state and line == "":
                    continue
                if not state:
                    record += 1
                    handed_on = False
                after = inside_after(line, state)
                open_.append(line)
                if not after and handed_on:
                    rows.append((here[0], here[1], record - 1, "\n".join(open_), *[None] * width))
                    open_, handed_on = [], False
                elif not after:
                    whole += open_
                    open_ = []
                state = after
            done = record - bool(open_ and not handed_on)
            # records that end here, in order; those whose number came before were open already
            cells = list(_cells(whole, width))
            rows += [(here[0], here[1], n, None, *c) for n, c in zip(range(done - len(cells), done), cells)]
            if rows:
                yield batch(rows)
        yield from fragment()

    # a row per range, 100 TB have under a million; another join would not keep the order of lines
    if states.count() > MOST_RANGES:
        raise ValueError(f"more than {MOST_RANGES} ranges: set spark.sql.files.maxPartitionBytes higher")
    known = lines.join(F.broadcast(states.select("file", "at", "inside", "before")), ["file", "at"]).select("file", "at", "inside", "before", "line")
    parsed = cut(known.mapInArrow(run, schema))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            rows = [(f, 0, n, None, *next(_cells(text.split("\n"), width, ""))) for f, n, text in zip(*(part.column(i).to_pylist() for i in range(3)))]
            if rows:
                yield batch(rows)

    pieces = parsed.filter("fragment is not null").groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("at", "fragment"))).alias("parts"))
    joined = pieces.select("file", "record", F.array_join("parts.fragment", "\n").alias("text")).mapInArrow(join, schema)
    every = parsed.filter("fragment is null").unionByName(joined).filter("record > 0")  # record 0 is the header
    sizes = states.groupBy("file").agg((F.greatest(F.sum("records") - 1, F.lit(0))).alias("n"))
    name = F.element_at(F.split("file", "/"), -1)
    starts = sizes.select(F.col("file").alias("of"), F.coalesce(F.sum("n").over(Window.orderBy(name, "file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    placed = every.join(bounded(starts), F.col("file") == F.col("of"))
    return placed.select(*[F.col(c).alias(n) for c, n in zip(names, columns)], (F.col("start") + F.col("record") - 1).alias(order), "file")

