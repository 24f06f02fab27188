"""Content-hash identifiers and row keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catloom import schema
from catloom.functions.text import Text, _c, base_title, clean_title, lower_strip, strip


def slug_hash(prefix: str, *parts: Text) -> Column:
    """``<prefix>_`` and 12 hex digits of the SHA-1 of the stripped, lower-cased parts joined by ``|``."""
    return _slug(prefix, *map(lower_strip, parts))


def _slug(prefix: str, *parts: Column) -> Column:
    """:func:`slug_hash` of parts that are stripped and in lower case already."""
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha1(F.concat_ws("|", *parts).cast("binary")), 1, 12))


def artist_id(artist: Text = "artist") -> Column:
    return slug_hash("art", artist)


def release_id() -> Column:
    return _slug("rel", artist_id(), *map(lower_strip, ("album_name", "release_date", "release_category", "edition_type")))


def work_id() -> Column:
    """The given id, else a hash of artist and base title."""
    given = strip("work_id")
    return F.when(given != "", given).otherwise(_slug("wrk", artist_id(), F.lower(base_title("song_name"))))


def version_id(work: Text = "work_id") -> Column:
    """The given id, else a hash of work, title and the duration as it stands."""
    given = strip("version_id")
    return F.when(given != "", given).otherwise(_slug("ver", lower_strip(work), F.lower(clean_title("song_name")), lower_strip("duration_seconds")))


def track_id() -> Column:
    return _slug("trk", artist_id(), *map(lower_strip, ("song_name", "album_name", "track_position", "release_date", "release_category", "edition_type")))


def dedupe_key() -> Column:
    return F.struct(*[lower_strip(c).alias(c) for c in schema.KEY])


def key_hashes(name: str, *parts: Column) -> dict[str, Column]:
    """Two long columns that stand for texts as a key of joins and groups: 128 bits, so that different texts share none in practice.

    Longs are sorted by their own bits, and are all that travels; sorting the texts would compare, and compute, them each time.
    """
    return {f"{name}_1": F.xxhash64(*parts), f"{name}_2": F.xxhash64(F.lit(1), *parts)}


def dedupe_hashes(name: str = "__key") -> dict[str, Column]:
    """:func:`dedupe_key` as two longs."""
    return key_hashes(name, *map(lower_strip, schema.KEY))


def signature() -> Column:
    """Eight parts; artist, album, song in this order, unlike in the dedupe key."""
    parts = ["artist", "album_name", "song_name", *schema.SIGNATURE[3:]]
    return F.concat_ws("|", *map(lower_strip, parts))


def legacy_signature() -> Column:
    """The first five parts of :func:`signature`."""
    return F.substring_index(signature(), "|", 5)


def row_hash(sig: Column) -> Column:
    return F.substring(F.sha2(sig.cast("binary"), 256), 1, 16)


def cluster_id(row_numbers: Column) -> Column:
    """From the row numbers of the members in ascending order."""
    text = F.array_join(F.transform(F.array_sort(row_numbers), lambda x: x.cast("string")), "|")
    return F.concat(F.lit("dup_"), F.substring(F.sha1(text.cast("binary")), 1, 12))


def raw_key(*parts: Text) -> Column:
    return F.concat_ws("|", *map(_c, parts))
