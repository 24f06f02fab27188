"""Reconciliation of the fact table with the nested search log.

Log entries are indexed by their full and by their legacy (five-part) signature; of entries with one signature the
one with the longest history wins, on ties the earlier. A row takes the entry of its full, else of its legacy
signature.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catloom import schema
from catloom.functions import ids, values
from catloom.functions.text import lower_strip
from catloom.runtime import Sliced

EVENT = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("date", "round", "method", "result")]
    + [T.StructField("score", T.DoubleType()), T.StructField("previous_url", T.StringType()), T.StructField("reason_codes", T.ArrayType(T.StringType()))]
)
ENTRY = T.StructType(
    [T.StructField("row_hash", T.StringType()), T.StructField("row_number", T.LongType())]
    + [T.StructField(n, T.StringType()) for n in ("artist", "album_name", "song_name", *schema.SIGNATURE[3:])]
    + [T.StructField(n, T.StringType()) for n in ("spotify_status", "youtube_status", "last_search_date")]
    + [T.StructField("search_attempts", T.LongType()), T.StructField("confidence_level", T.StringType()), T.StructField("search_history", T.ArrayType(EVENT))]
)
LOG = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("version", "created", "last_updated")] + [T.StructField("entries", T.ArrayType(ENTRY))]
)
CARRIED = ["spotify_status", "youtube_status", "last_search_date", "search_attempts", "confidence_level", "search_history"]


def history(value: Column) -> Column:
    """Only the entries that are objects; no history is an empty one."""
    return F.filter(F.coalesce(value, F.array().cast(T.ArrayType(EVENT))), lambda x: x.isNotNull())


def appended(value: Column, event: Column) -> Column:
    return F.array_append(history(value), event)


def indexed(entries: DataFrame, order_col: str) -> DataFrame:
    """``(sig, prev)``: the best entry under every full and legacy signature."""
    prev = F.struct(*[F.col(c) for c in CARRIED])
    keyed = entries.select(F.explode(F.array_distinct(F.array(ids.signature(), ids.legacy_signature()))).alias("sig"), prev.alias("prev"), F.col(order_col).alias("o"))
    longest = F.struct((-F.size(history(F.col("prev.search_history")))).alias("n"), "o")
    return keyed.groupBy("sig").agg(F.min_by("prev", longest).alias("prev"))


def reconcile(rows: DataFrame, entries: DataFrame, row_number: Column, order_col: str = "_ord") -> DataFrame:
    """The new log entry of every row, with ``matched``.

    Both signatures of a row begin alike, so rows and entries are dealt by that beginning and meet part by part.
    """
    place = F.split_part(lower_strip("artist"), F.lit("|"), F.lit(1))
    named = ["artist", "album_name", "song_name", *schema.SIGNATURE[3:]]
    read = rows.select(row_number.alias("row_number"), *named, "spotify_url", "youtube_url")
    log = Sliced.of(entries.select(order_col, *named, *CARRIED), place)
    if log.read().isEmpty():  # nothing to meet, so the rows stay where they are
        log.remove()
        prev = F.lit(None).cast(entries.select(F.struct(*CARRIED).alias("prev")).schema["prev"].dataType)
        return _entries(read.withColumns({"__sig": ids.signature(), "prev": prev}))
    dealt = Sliced.of(read, place)
    return dealt.each(lambda part, known: _reconciled(part, known, order_col), log)


def _hashes(sig: Column) -> tuple[dict[str, Column], dict[str, Column]]:
    """The legacy signature of a full one, and that, as hashes."""
    return ids.key_hashes("__legacy", F.substring_index(sig, "|", 5)), ids.key_hashes("__full", sig)


def _by_legacy(entries: DataFrame, order_col: str) -> DataFrame:
    """By the hashes of the legacy signature: ``__short``, its best entry, and ``__fulls``, the best of each full signature.

    A full signature holds its legacy one and is never one itself, so the entries move once, and a row meets both at one place. Of
    one legacy signature there are as many full ones as row types, categories and editions.
    """
    short, full = _hashes(F.col("__sig"))
    prev, longest = F.struct(*CARRIED), F.struct((-F.size(history(F.col("search_history")))).alias("n"), F.col(order_col).alias("o"))
    keyed = entries.withColumn("__sig", ids.signature()).select(*[c.alias(k) for k, c in (short | full).items()], prev.alias("prev"), longest.alias("rank"))
    best = keyed.repartition(*short).groupBy(*short, *full).agg(F.min_by(F.struct("prev", "rank"), "rank").alias("x"))
    fulls = F.collect_list(F.struct(*full, F.col("x.prev").alias("prev")))
    return best.groupBy(*short).agg(F.min_by("x.prev", "x.rank").alias("__short"), fulls.alias("__fulls"))


def _reconciled(rows: DataFrame, entries: DataFrame, order_col: str) -> DataFrame:
    keyed = rows.withColumn("__sig", ids.signature())
    short, full = _hashes(F.col("__sig"))
    joined = keyed.withColumns(short | full).join(_by_legacy(entries, order_col), list(short), "left")
    same = F.filter("__fulls", lambda x: (x["__full_1"] == F.col("__full_1")) & (x["__full_2"] == F.col("__full_2")))
    return _entries(joined.withColumn("prev", F.coalesce(F.get(same, F.lit(0))["prev"], "__short")))


def _entries(joined: DataFrame) -> DataFrame:
    """The new entries of rows with ``__sig`` and ``prev``, the entry before (null: none)."""
    spotify = values.link_status("spotify_url", F.col("prev.spotify_status"))
    return joined.select(
        ids.row_hash(F.col("__sig")).alias("row_hash"), "row_number", "artist", "album_name", "song_name", *schema.SIGNATURE[3:],
        spotify.alias("spotify_status"),
        values.link_status("youtube_url", F.col("prev.youtube_status")).alias("youtube_status"),
        F.col("prev.last_search_date").alias("last_search_date"),
        F.coalesce(F.col("prev.search_attempts"), F.lit(0)).cast("long").alias("search_attempts"),
        values.link_confidence(spotify, F.col("prev.confidence_level")).alias("confidence_level"),
        history(F.col("prev.search_history")).alias("search_history"),
        F.col("prev").isNotNull().alias("matched"),
    )


def statistics(entries: DataFrame) -> DataFrame:
    """Totals by status (one row)."""
    return entries.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("spotify_status") == "found").alias("has_spotify_url"),
        F.count_if(F.col("youtube_status") == "found").alias("has_youtube_url"),
        F.count_if(F.col("spotify_status") == "needs_research").alias("needs_research"),
        F.count_if(F.col("spotify_status") == "not_searched").alias("not_searched"),
    )


def orphans(rows: DataFrame, entries: DataFrame) -> DataFrame:
    """Log entries that no row leads to, by full or legacy signature."""
    full = rows.select(ids.signature().alias("s")).distinct()
    legacy = rows.select(ids.legacy_signature().alias("s")).distinct()
    keyed = entries.withColumn("__s", ids.signature()).withColumn("__l", ids.legacy_signature())
    left = keyed.join(full, F.col("__s") == full["s"], "left_anti")
    return left.join(legacy, F.col("__l") == legacy["s"], "left_anti").drop("__s", "__l")
