"""Record layouts and vocabularies of the catalogue, and the raw layer's rules.

Every column of the raw layer is a string; null and the empty string are the same value, so readers fill nulls
before any operator runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column order is part of the file contract.
FACT = (
    "artist song_name album_name track_position row_type release_category edition_type version_type release_date label era genre"
    " chart_position awards spotify_url youtube_url duration_seconds alternative_names source_release_id work_id version_id notes"
).split()
SOURCE = "artist album_name song_name release_date label row_type discovery_source source_url source_confidence raw_extra".split()
CANDIDATE = "artist album_name song_name release_date label row_type overall_confidence sources source_count status raw_extra".split()
CORRECTION = "row_key field current_value proposed_value source confidence".split()
PERSONNEL = "release_id track_position person_name person_name_variant role discogs_artist_id discogs_release_id source".split()
PATCH = "row_index field_name value".split()
LINEAGE = "work_id version_id version_type source_release_id duration_seconds".split()
KEY = "artist song_name album_name track_position release_date row_type release_category edition_type".split()
SIGNATURE = "artist album_name song_name track_position release_date row_type release_category edition_type".split()
COMPARED = "artist album_name song_name release_date label row_type".split()

# Vocabularies of the catalogue.
ROW_TYPES = ["album", "track", "single"]
CATEGORIES = ["original", "reissue", "compilation", "live", "remix_album", "soundtrack"]
EDITIONS = ["standard", "expanded", "deluxe", "remaster", "remix", "demo", "bonus_track", "alternate_mix"]
VERSIONS = ["same_master", "remix_or_edit", "live_recording", "re_recording", "unknown"]
ERAS = [
    "Pre-P-Funk (1955–1969)", "Classic P-Funk (1970–1981)", "Transition Era (1982–1992)",
    "Comeback Era (1993–2004)", "Late Career (2005–2015)", "Legacy Era (2016–present)",
]
GENRES = (
    "Funk,Soul,R&B,Psychedelic Rock,Hip-Hop,Electronic/Dance,Jazz-Funk,P-Funk,Proto-Funk,Neo-Funk,Space Funk,Boogie,G-Funk,Experimental"
).split(",")
GENRE_SUFFIXES = ["(Compilation)", "(Live)"]
LINK_PREFIX = {"spotify_url": ["https://open.spotify.com/"], "youtube_url": ["https://www.youtube.com/", "https://youtu.be/"]}
CONFIDENCES = ["low", "medium", "high"]
SOURCE_WEIGHTS = {
    "musicbrainz": 0.9, "discogs": 0.9, "spotify": 0.7, "wikidata": 0.6, "wikipedia": 0.4, "georgeclinton": 0.3, "motherpage": 0.3, "forums": 0.2,
}
STRUCTURED_SOURCES = ["discogs", "spotify", "musicbrainz"]
ERA_WEIGHTS = dict(zip(ERAS, [2, 4, 3, 3, 2, 2]))


class SchemaMismatch(ValueError):
    """A file's header is not the expected one, or it has too few rows."""

    def __init__(self, label: str, missing: list[str], extra: list[str], detail: str = ""):
        self.missing, self.extra = missing, extra
        super().__init__(f"{label}: missing {missing}, extra {extra}{'; ' + detail if detail else ''}")


def strings(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def check_header(label: str, found: list[str], expected: list[str]) -> None:
    """Compare headers in order; the difference is reported as sets."""
    if found != expected:
        missing = [c for c in expected if c not in found]
        extra = [c for c in found if c not in expected]
        raise SchemaMismatch(label, missing, extra, "" if missing or extra else "same columns in another order")


def filled(df: DataFrame) -> DataFrame:
    """Nulls of string columns as empty strings."""
    return df.select(*[F.coalesce(F.col(f.name), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in df.schema])


def evolved(df: DataFrame, expected: list[str] = FACT) -> DataFrame:
    """Append missing expected columns, empty, at the end."""
    return df.select("*", *[F.lit("").alias(c) for c in expected if c not in df.columns])
