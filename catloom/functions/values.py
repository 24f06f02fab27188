"""Partial dates, positions, durations, scores and priorities as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catloom import schema
from catloom.functions.text import Text, _c, lower_strip, strip

MONTHS = "january february march april may june july august september october november december".split()
PARTIAL_DATE = r"^\d{4}(-\d{2})?(-\d{2})?$"
# Fixed value: names of the core acts.
CORE_ACTS = ["parliament", "funkadelic", "george clinton", "bootsy", "parliaments"]


def mapped(value: Column, table: dict, default) -> Column:
    """A table lookup as a chain of conditions (no map is built per row)."""
    out = F
    for key, result in table.items():
        out = out.when(value == key, F.lit(result))
    return out.otherwise(F.lit(default))


def date_order(value: Text) -> Column:
    """Lexicographic order of partial dates, missing ones last: ``1975`` before ``1975-03``."""
    date = _c(value)
    return F.when(date == "", "9999").otherwise(date)


def date_tuple(value: Text) -> Column:
    """Numeric order of partial dates, missing parts last: ``1975-03`` before ``1975``."""
    date = strip(value)
    known = date.rlike(r"^\d{4}(-\d{2}(-\d{2})?)?$")
    part = lambda start, n, miss: F.when(known & (F.length(date) >= start + n - 1), F.substring(date, start, n).try_cast("int")).otherwise(miss)
    return F.struct(part(1, 4, 9999).alias("year"), part(6, 2, 99).alias("month"), part(9, 2, 99).alias("day"))


def is_partial_date(value: Text) -> Column:
    return strip(value).rlike(PARTIAL_DATE)


def heading_date(value: Text) -> Column:
    """Year, or month and day, that a heading names; both null if neither."""
    text = strip(value)
    names = "|".join(MONTHS)
    month = F.lower(F.regexp_extract(text, rf"(?i)^({names})(?:\s+(\d{{1,2}}))?$", 1))
    day = F.regexp_extract(text, rf"(?i)^({names})(?:\s+(\d{{1,2}}))?$", 2)
    number = mapped(month, {m: f"{i:02d}" for i, m in enumerate(MONTHS, 1)}, None)
    month_day = F.concat(number, F.lit("-"), F.when(day == "", "01").otherwise(F.lpad(day, 2, "0")))
    return F.struct(F.when(text.rlike(r"^\d{4}$"), text).alias("year"), month_day.alias("month_day"))


def pivot_year(two_digits: Column) -> Column:
    """A two-digit year as four: from 70 on in the 1900s."""
    year = two_digits.try_cast("int")
    return F.when(year >= 70, 1900 + year).otherwise(2000 + year).cast("string")


def date_of_timestamp(value: Text) -> Column:
    return F.substring(_c(value), 1, 10)


def whole_seconds(value: Text) -> Column:
    """All-digit durations in canonical form; anything else is blank."""
    text = strip(value)
    return F.when(text.rlike(r"^\d+$"), F.regexp_replace(text, r"^0+(?=\d)", "")).otherwise("")


def seconds_of_ms(ms: Column) -> Column:
    """Half goes to the even second."""
    return F.bround(ms / 1000).cast("long")


def track_position(row_type: Text, position: Text, total: Column) -> Column:
    """``N`` as ``N/total`` where the album's total reaches N; blank for anything but tracks."""
    raw = strip(position)
    n = F.when(raw.rlike(r"^\d+$"), raw.try_cast("int"))
    whole = F.concat_ws("/", n.cast("string"), total.cast("string"))
    return F.when(_c(row_type) != "track", "").when(n.isNotNull() & (total > 0) & (total >= n), whole).otherwise(raw)


def at_least(confidence: Text, threshold: str) -> Column:
    """Ordinal comparison low < medium < high; unknown values are below everything."""
    levels = F.array(*map(F.lit, schema.CONFIDENCES))
    wanted = schema.CONFIDENCES.index(threshold.lower()) + 1 if threshold.lower() in schema.CONFIDENCES else 99
    return F.coalesce(F.array_position(levels, F.lower(_c(confidence))) >= wanted, F.lit(False))


def source_score(sources: Column, filled: list[Text], years_agree: Column) -> Column:
    """Best source weight, a tenth per filled field, a fifth for agreeing years; at most 1. Sums run in this order."""
    weights = F.transform(sources, lambda s: mapped(F.lower(s), schema.SOURCE_WEIGHTS, 0.1))
    bonus: Column = F.lit(0.0)
    for field in filled:
        bonus = bonus + F.when(strip(field) != "", 0.1).otherwise(0.0)
    total = F.array_max(weights) + bonus + F.when(years_agree, 0.2).otherwise(0.0)
    return F.when(F.size(sources) == 0, 0.0).otherwise(F.least(total, F.lit(1.0)))


def confidence_of(score: Column) -> Column:
    return F.when(score >= 0.7, "high").when(score >= 0.4, "medium").otherwise("low")


def severity(mismatch: Column, title: Column, artist: Column) -> Column:
    return F.when(mismatch | (title < 0.35) | (artist < 0.25), "high").when((title < 0.55) | (artist < 0.4), "medium").otherwise("low")


def quarantine(mismatch: Column, title: Column, artist: Column) -> Column:
    return mismatch | (title < 0.35) | (artist < 0.25) | ((title < 0.5) & (artist < 0.35))


def suspicious(mismatch: Column, title: Column, artist: Column) -> Column:
    return mismatch | (title < 0.55) | (artist < 0.4)


def reason_codes(mismatch: Column, title: Column, artist: Column) -> Column:
    found = F.array(F.when(mismatch, "url_type_mismatch"), F.when(title < 0.55, "low_title_similarity"), F.when(artist < 0.4, "low_artist_similarity"))
    return F.filter(found, lambda x: x.isNotNull())


def core_act(artist: Text) -> Column:
    return lower_strip(artist).rlike("|".join(CORE_ACTS))


def impact_score(era: Text, row_type: Text, artist: Text) -> Column:
    types = mapped(strip(row_type), {"album": 4, "single": 3, "track": 2}, 1)
    return (mapped(_c(era), schema.ERA_WEIGHTS, 1) + types + F.when(core_act(artist), 2).otherwise(0)).cast("double")


def mismatch_score(title: Column, artist: Column, mismatch: Column, reasons: Column) -> Column:
    kind = F.when(mismatch, 2.5).otherwise(0.0)
    low = F.when(F.array_contains(reasons, "low_artist_similarity"), 1.5).otherwise(0.0)
    return F.round((1 - title) * 3 + (1 - artist) * 2 + kind + low, 4)


def review_action(reasons: Column, artist: Column) -> Column:
    return (
        F.when(F.array_contains(reasons, "low_artist_similarity"), "verify_artist_match_first")
        .when(F.array_contains(reasons, "low_title_similarity") & (artist >= 0.85), "check_alt_title_or_version")
        .otherwise("manual_track_search")
    )


def gap_priority(era: Text, row_type: Text, link: Text) -> Column:
    types = mapped(_c(row_type), {"album": 4, "single": 3, "track": 1}, 1)
    return mapped(_c(era), schema.ERA_WEIGHTS, 1) + types + F.when(strip(link) != "", 1.5).otherwise(0.0)


def video_score(title: Column, contains: Column, channel: Column, channel_name: Column, video_title: Column) -> Column:
    official = F.when(F.lower(channel_name).rlike("official|vevo|topic"), 0.1).when(F.lower(video_title).contains("official"), 0.05).otherwise(0.0)
    return F.least(title * 0.55 + F.when(contains, 0.15).otherwise(0.0) + channel * 0.2 + official, F.lit(1.0))


def album_score(title: Column, artist: Column) -> Column:
    return 0.55 * title + 0.45 * artist


def track_score(title: Column, artist: Column, album: Column) -> Column:
    return 0.45 * title + 0.45 * artist + 0.10 * album


def accepted(row_type: Text, score: Column, title: Column, artist: Column, album: Column) -> Column:
    albums = (score >= 0.90) & (title >= 0.90) & (artist >= 0.82)
    tracks = (score >= 0.88) & (title >= 0.86) & (artist >= 0.80) & (album >= 0.65)
    return F.when(_c(row_type) == "album", albums).otherwise(tracks)


def link_status(url: Text, previous: Column) -> Column:
    return F.when(strip(url) != "", "found").when(previous.isin("not_found", "needs_research", "not_searched"), previous).otherwise("not_searched")


def link_confidence(status: Column, previous: Column) -> Column:
    kept = F.when(previous.isin("none", "low", "medium", "high"), previous)
    return F.coalesce(kept, mapped(status, {"found": "low", "needs_research": "medium"}, "none"))


def album_kind(value: Text) -> Column:
    """Row type of a streaming catalogue's album type."""
    return mapped(F.lower(_c(value)), {"album": "album", "single": "single", "compilation": "compilation"}, "album")


def release_group_kind(value: Text) -> Column:
    """Row type of a release group's primary type, as it is spelled there."""
    return mapped(_c(value), {"Single": "single"}, "album")


def percent(part: Column, whole: Column, empty: float = 0.0) -> Column:
    return F.coalesce(F.try_divide(part * 100.0, whole), F.lit(empty))
