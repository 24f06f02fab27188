"""The star schema of the fact table: artists, releases, works and tracks with content-hash keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catloom.functions import ids, text
from catloom.functions.text import clean_title, lower_strip, strip
from catloom.operators.dedupe import ORDER, keep_first
from catloom.operators.lineage import READ, identified, with_sources
from catloom.runtime import Sliced


def artists(rows: DataFrame, order_col: str = ORDER) -> DataFrame:
    base = rows.select(order_col, ids.artist_id().alias("artist_id"), strip("artist").alias("artist_name"), lower_strip("artist").alias("artist_name_normalized"))
    return keep_first(base, ["artist_id"], order_col)


def releases(rows: DataFrame, order_col: str = ORDER) -> DataFrame:
    """Keyed by the release id itself, so the primary key is unique whatever the case of its parts."""
    base = rows.select(
        order_col, ids.release_id().alias("release_id"), ids.artist_id().alias("artist_id"), strip("artist").alias("artist_name"),
        strip("album_name").alias("album_name"), *[strip(c).alias(c) for c in ("release_date", "release_category", "edition_type", "era", "genre")],
    )
    return keep_first(base, ["release_id"], order_col)


def works(rows: DataFrame, order_col: str = ORDER) -> DataFrame:
    """A row per artist and base title; its id is the first row's."""
    base = rows.select(
        order_col, ids.work_id().alias("work_id"), ids.artist_id().alias("artist_id"), strip("artist").alias("artist_name"), text.base_title("song_name").alias("work_name")
    )
    return keep_first(base, ["artist_id", F.lower("work_name")], order_col)


def tracks(rows: DataFrame, order_col: str = ORDER) -> DataFrame:
    """One row per fact row."""
    read = [*READ, "track_position", "spotify_url", "youtube_url"]  # no other column is dealt
    sourced = with_sources(identified(rows.select(order_col, *read, F.col("duration_seconds").alias("__duration"))), order_col)
    return sourced.select(
        ids.track_id().alias("track_id"), ids.release_id().alias("release_id"), "work_id", "version_id", ids.artist_id().alias("artist_id"),
        strip("artist").alias("artist_name"), clean_title("song_name").alias("song_name"), strip("album_name").alias("album_name"),
        *[strip(c).alias(c) for c in ("track_position", "row_type", "release_date", "release_category", "edition_type")], "version_type",
        strip("source_release_id").alias("source_release_id"), strip("__duration").alias("duration_seconds"), strip("spotify_url").alias("spotify_url"), strip("youtube_url").alias("youtube_url"),
    )


def keys(rows: DataFrame, order_col: str = ORDER) -> dict[str, DataFrame]:
    """The four tables by their keys alone, which is what the gates read: no sources, and no columns of first rows.

    Works are dealt by artist and title and gone through part by part.
    """
    named = ids.key_hashes("__name", ids.artist_id(), F.lower(text.base_title("song_name")))
    told = rows.select(order_col, ids.work_id().alias("work_id"), *[c.alias(k) for k, c in named.items()])
    first = Sliced.of(told, F.col("__name_1")).each(lambda part: part.groupBy(*named).agg(F.min_by("work_id", order_col).alias("work_id")).select("work_id"))
    return {
        "artists": rows.select(ids.artist_id().alias("artist_id")).distinct(), "releases": rows.select(ids.release_id().alias("release_id")).distinct(), "works": first,
        "tracks": rows.select(ids.artist_id().alias("artist_id"), ids.release_id().alias("release_id"), ids.work_id().alias("work_id")),
    }


def build(rows: DataFrame, order_col: str = ORDER) -> dict[str, DataFrame]:
    """All four tables, dimensions in output order (a range-partitioned sort each; ties in row order)."""
    return {
        "artists": artists(rows, order_col).orderBy("artist_name_normalized", order_col).drop(order_col),
        "releases": releases(rows, order_col).orderBy(F.lower("artist_name"), F.lower("album_name"), order_col).drop(order_col),
        "works": works(rows, order_col).orderBy(F.lower("artist_name"), F.lower("work_name"), order_col).drop(order_col),
        "tracks": tracks(rows, order_col),
    }


def in_order(dimension: DataFrame, *names: str, order_col: str = "_ord") -> DataFrame:
    """A dimension as files list it: by its names without regard to case, then by first row (a range partitioned sort)."""
    return dimension.orderBy(*[F.lower(n) for n in names], order_col)
