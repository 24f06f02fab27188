"""Discovery rows from service payloads, and the work lists that drive lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catloom import schema
from catloom.functions import similarity, text, values
from catloom.functions.text import lower_strip, strip
from catloom.operators.dedupe import ORDER, keep_first

_RELEASES = "releases array<struct<id: bigint, title: string, year: bigint, type: string, role: string, format: string, label: string, resource_url: string>>"
_GROUPS = "`release-groups` array<struct<id: string, title: string, `primary-type`: string, `first-release-date`: string, `secondary-types`: array<string>>>"
_RECORDINGS = "recordings array<struct<id: string, title: string, length: bigint, isrcs: array<string>>>"
_ALBUMS = "items array<struct<id: string, name: string, release_date: string, album_type: string, total_tracks: bigint, external_urls: struct<spotify: string>>>"


def _rows(df: DataFrame, **given: Column) -> DataFrame:
    """The ten discovery columns; what is not given is empty."""
    return df.select(*[F.coalesce(given.get(c, F.lit("")), F.lit("")).alias(c) for c in schema.SOURCE])


def _label(value: Column) -> Column:
    """A label given as a list of objects, a list of names, or a name."""
    named = F.get_json_object(value, "$[0].name")
    first = F.get_json_object(value, "$[0]")
    return F.when(value.startswith("["), F.coalesce(named, first, F.lit(""))).otherwise(F.coalesce(value, F.lit("")))


def release_rows(pages: DataFrame) -> DataFrame:
    """Release pages (``artist, payload``) as album rows."""
    items = pages.select("artist", F.explode(F.from_json("payload", _RELEASES)["releases"]).alias("r"))
    year = F.when(F.coalesce("r.year", F.lit(0)) != 0, F.col("r.year").cast("string"))
    extra = F.to_json(F.struct(F.col("r.id").alias("discogs_id"), "r.format", "r.type", "r.role"))
    return _rows(items, artist=F.col("artist"), album_name=F.col("r.title"), release_date=year, label=_label(F.col("r.label")), row_type=F.lit("album"),
                 discovery_source=F.lit("discogs"), source_url=F.col("r.resource_url"), source_confidence=F.lit("high"), raw_extra=extra)


def group_rows(pages: DataFrame) -> DataFrame:
    """Release group pages as album or single rows; blank titles go."""
    items = pages.select("artist", F.explode(F.from_json("payload", _GROUPS)["release-groups"]).alias("g")).filter(strip("g.title") != "")
    kind = F.coalesce(F.col("g.primary-type"), F.lit("Album"))
    mbid = F.coalesce("g.id", F.lit(""))
    extra = F.to_json(F.struct(mbid.alias("mbid"), kind.alias("primary_type"), F.coalesce(F.col("g.secondary-types"), F.array().cast("array<string>")).alias("secondary_types")))
    return _rows(items, artist=F.col("artist"), album_name=strip("g.title"), release_date=F.col("g.first-release-date"), row_type=values.release_group_kind(kind),
                 discovery_source=F.lit("musicbrainz"), source_url=F.concat(F.lit("https://musicbrainz.org/release-group/"), mbid), source_confidence=F.lit("high"), raw_extra=extra)


def recording_rows(pages: DataFrame) -> DataFrame:
    """Recording pages as track rows; blank titles go."""
    items = pages.select("artist", F.explode(F.from_json("payload", _RECORDINGS)["recordings"]).alias("r")).filter(strip("r.title") != "")
    seconds = F.when(F.coalesce("r.length", F.lit(0)) != 0, values.seconds_of_ms(F.col("r.length")).cast("string")).otherwise("")
    mbid = F.coalesce("r.id", F.lit(""))
    extra = F.to_json(F.struct(mbid.alias("mbid"), seconds.alias("duration_seconds"), F.coalesce("r.isrcs", F.array().cast("array<string>")).alias("isrcs")))
    return _rows(items, artist=F.col("artist"), song_name=strip("r.title"), row_type=F.lit("track"), discovery_source=F.lit("musicbrainz"),
                 source_url=F.concat(F.lit("https://musicbrainz.org/recording/"), mbid), source_confidence=F.lit("high"), raw_extra=extra)


def album_rows(pages: DataFrame) -> DataFrame:
    """Album pages of matched artists (``artist, name, confidence, payload``); of equal names the first by artist stays."""
    items = pages.select("artist", "name", "confidence", F.posexplode(F.from_json("payload", _ALBUMS)["items"]).alias("pos", "a")).filter(F.coalesce("a.name", F.lit("")) != "")
    items = items.withColumn("at", F.struct("artist", "pos"))
    first = keep_first(items, [text.norm_discovery("name"), text.norm_discovery("a.name")], "at")
    extra = F.to_json(F.struct(F.col("a.id").alias("spotify_id"), F.coalesce("a.album_type", F.lit("album")).alias("album_type"), "a.total_tracks"))
    return _rows(first, artist=F.col("name"), album_name=F.col("a.name"), release_date=F.col("a.release_date"), row_type=values.album_kind(F.coalesce("a.album_type", F.lit("album"))),
                 discovery_source=F.lit("spotify"), source_url=F.col("a.external_urls.spotify"), source_confidence=F.col("confidence"), raw_extra=extra)


def catalog_artists(artists: DataFrame | None, rows: DataFrame) -> DataFrame:
    """Distinct artist names to look up: of the dimension, or of the fact table where there is none."""
    names = artists.select(strip("artist_name_normalized").alias("artist")) if artists is not None else rows.select(lower_strip("artist").alias("artist"))
    return names.filter("artist <> ''").distinct()


def unique_releases(releases: DataFrame | None, rows: DataFrame, order_col: str = ORDER) -> DataFrame:
    """Releases to look up: of the dimension, or the first row of every album of the fact table."""
    if releases is not None:
        return releases.select("release_id", "artist_name", "album_name", "release_date")
    albums = rows.filter("row_type = 'album'").withColumn("release_id", F.concat_ws("|", "artist", "album_name", "release_date"))
    return keep_first(albums, ["release_id"], order_col).select("release_id", F.col("artist").alias("artist_name"), "album_name", "release_date")


def forced(names: DataFrame, column: str, wanted: str | None) -> DataFrame:
    """Only the wanted name if one is given, also if the table lacks it."""
    if wanted is None:
        return names
    match = names.filter(lower_strip(column) == wanted.strip().lower())
    if not match.isEmpty():
        return match
    return names.sparkSession.range(1).select(*[(F.lit(wanted) if f.name == column else F.lit(None).cast(f.dataType)).alias(f.name) for f in names.schema])


def live_recordings(rows: DataFrame) -> DataFrame:
    return rows.filter((strip("version_type") == "live_recording") | F.lower("album_name").contains("live"))


def missing_links(rows: DataFrame, column: str = "spotify_url") -> DataFrame:
    return rows.filter(strip(column) == "")


def row_range(rows: DataFrame, start: int = 0, limit: int | None = None, order_col: str = ORDER) -> DataFrame:
    """Rows by ordinal, from ``start`` on."""
    kept = rows.filter(F.col(order_col) >= start)
    return kept if limit is None else kept.filter(F.col(order_col) < start + limit)


def needs_research(rows: DataFrame, entries: DataFrame) -> DataFrame:
    """Rows without a link whose log entry asks for research; joined by row number as the log counts it."""
    wanted = entries.filter("spotify_status = 'needs_research'").select("row_number").distinct()
    return missing_links(rows).join(wanted, "row_number", "left_semi")


def coverage_report(songs: DataFrame, rows: DataFrame) -> DataFrame:
    """Per artist how many of the live recordings' songs occur in setlists (``artist, song``)."""
    played = songs.groupBy(lower_strip("artist").alias("k")).agg(F.collect_set(text.norm_matching("song")).alias("played"))
    known = live_recordings(rows).groupBy(lower_strip("artist").alias("k")).agg(F.collect_set(text.norm_matching("song_name")).alias("known"))
    both = played.join(known, "k", "full").select(F.col("k").alias("artist"), *[F.coalesce(c, F.array().cast("array<string>")).alias(c) for c in ("played", "known")])
    return both.select("artist", F.size("played").cast("long").alias("setlist_count"), F.size("known").cast("long").alias("known_count"), similarity.coverage(F.col("played"), F.col("known")).alias("c")).select(
        "artist", "setlist_count", "known_count", "c.*"
    )


def seeds(rows: DataFrame) -> DataFrame:
    """Discovery seeds: artists with a catalogue id, the core ones first; an empty database id is null."""
    rank = F.when(F.col("priority") == "core", 0).when(F.col("priority") == "associated", 1).otherwise(2)
    filled = F.when(F.trim("musicbrainz_artist_id") != "", F.trim("musicbrainz_artist_id"))
    kept = rows.filter(F.trim(F.coalesce("discogs_artist_id", F.lit(""))) != "")
    return kept.withColumn("musicbrainz_artist_id", filled).withColumn("rank", rank)
