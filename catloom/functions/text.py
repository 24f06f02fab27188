"""Text canonicalisation as column expressions. The normalisers differ on purpose; none stands in for another."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Text = Column | str

# Vocabularies of the title rules.
VERSION_WORDS = "remix|mix|edit|extended|instrumental|dub|version|live"
HINTS = "remix mix edit extended instrumental dub version live remaster radio mono stereo session recording rehearsal bonus".split()
STOP_WORDS = "a an and feat featuring ft for in of on part pt the to version".split()
LOW_SIGNAL = "fire funk jam music song time".split()
VARIANT_WORDS = (
    r"\b(?:mono|stereo|version|mix|remix|remaster(?:ed)?|live|instrumental|instr|edit|extended|long|short|radio|dub|rework(?:ed)?"
    r"|flip|demo|alternate|alt|single|album|unedited|bonus|track|pt|part)\b"
)
FEATURED = r"(?i)\((feat\.|ft\.|featuring)\s+[^)]*\)"
#: All characters of Unicode's White_Space.
WHITE = "\t\n\x0b\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
META_TAGS = "book 7-inch 12-inch magazine comics bootleg stream".split()


def _c(value: Text) -> Column:
    return F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit(""))


def strip(value: Text) -> Column:
    """Without leading and trailing white space of any kind."""
    return F.btrim(_c(value), F.lit(WHITE))


def lower_strip(value: Text) -> Column:
    return F.lower(strip(value))


def squeeze(value: Column) -> Column:
    """Runs of white space as one space, ends stripped."""
    return strip(F.regexp_replace(value, r"(?U)\s+", " "))


def _alnum(value: Column) -> Column:
    return strip(F.regexp_replace(value, "[^a-z0-9]+", " "))


def clean_title(value: Text) -> Column:
    return strip(value)


def matching_title(value: Text) -> Column:
    """Without a leading ``[tag] `` and featured artists in parentheses."""
    text = strip(value)
    untagged = F.when(text.startswith("[") & (F.instr(text, "] ") > 0), strip(F.regexp_replace(text, r"(?s)^.*?\] ", "")))
    return squeeze(F.regexp_replace(untagged.otherwise(text), FEATURED, ""))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body reads it."""
    return F.transform(F.array(value), body)[0]


def _or(value: Column, other: Column) -> Column:
    return F.when(value == "", other).otherwise(value)


def _dash_head(title: Column, versioned) -> Column:
    """What stands before the first `` - `` if what follows names a version."""
    tail = F.regexp_replace(title, r"(?s)^.*? - ", "")
    head = F.substring_index(title, " - ", 1)
    return F.when((F.instr(title, " - ") > 0) & versioned(tail), head).otherwise(title)


def base_title(value: Text) -> Column:
    """The work's title: version suffixes after a dash or in closing parentheses go, unless nothing would be left."""

    def of(title: Column) -> Column:
        head = _dash_head(title, lambda tail: tail.rlike(rf"(?i)\b({VERSION_WORDS})\b"))
        plain = (F.instr(title, " - ") == 0) & ~title.endswith(")")  # neither rule can apply
        return F.when(plain, title).otherwise(_or(strip(F.regexp_replace(head, rf"(?i)\(([^)]*({VERSION_WORDS})[^)]*)\)$", "")), title))

    return let(clean_title(value), of)


def detector_base_title(value: Text) -> Column:
    """As :func:`base_title` on matching titles; hints count as parts of words."""
    closing = rf"(?i)\(([^)]*({VERSION_WORDS}|remaster|radio|mono|stereo)[^)]*)\)$"

    def of(title: Column) -> Column:
        head = strip(_dash_head(title, lambda tail: F.lower(tail).rlike("|".join(HINTS))))
        return _or(strip(F.regexp_replace(head, closing, "")), title)

    return let(matching_title(value), of)


def norm_matching(value: Text) -> Column:
    """Lower case, letters of any script, digits and underscores only."""
    return squeeze(F.regexp_replace(lower_strip(value), r"(?U)[^\w\s]", ""))


def norm_compare(value: Text) -> Column:
    text = F.replace(F.lower(detector_base_title(value)), F.lit("&"), F.lit(" and "))
    return _alnum(F.regexp_replace(text, r"\b(pt|part)\s*\.?\s*\d+\b", " "))


def norm_audit(value: Text) -> Column:
    text = F.regexp_replace(lower_strip(value), r"^\[[^\]]+\]\s*", "")
    text = F.regexp_replace(text, FEATURED, "")
    text = F.regexp_replace(text, r"\b(feat\.?|ft\.?|featuring)\b.*$", "")
    text = F.replace(text, F.lit("&"), F.lit(" and "))
    text = F.regexp_replace(F.regexp_replace(text, r"\b4\b", "for"), r"\b2\b", "to")
    return _alnum(text)


def norm_strict(value: Text) -> Column:
    text = F.regexp_replace(lower_strip(value), FEATURED, "")
    return _alnum(F.replace(text, F.lit("&"), F.lit(" and ")))


def norm_plain(value: Text) -> Column:
    """As :func:`norm_strict`, keeping featured artists."""
    return _alnum(F.replace(lower_strip(value), F.lit("&"), F.lit(" and ")))


def norm_cache(value: Text) -> Column:
    text = F.regexp_replace(F.lower(_c(value)), r"\(feat\.[^)]+\)|\(ft\.[^)]+\)", "")
    text = F.replace(F.regexp_replace(text, r"^\[[^\]]+\]\s*", ""), F.lit("&"), F.lit("and"))
    return squeeze(strip(F.regexp_replace(_alnum(text), r"\bthe\b", "")))


def norm_discovery(value: Text) -> Column:
    text = F.regexp_replace(F.lower(_c(value)), r"\(feat\.[^)]+\)|\(ft\.[^)]+\)", "")
    return _alnum(F.replace(text, F.lit("&"), F.lit(" and ")))


def query_text(value: Text) -> Column:
    return strip(F.regexp_replace(_c(value), r"(?i)\(feat\.[^)]+\)|\(ft\.[^)]+\)", ""))


def bounded_query_text(value: Text, limit: int = 110) -> Column:
    """Query text cut after the last whole word within ``limit`` characters (a longer first word is cut itself)."""
    text = squeeze(F.regexp_replace(F.regexp_replace(_c(value), FEATURED, ""), r"\[[^]]+\]", ""))
    start = F.struct(F.lit("").alias("kept"), F.lit(0).alias("used"), F.lit(True).alias("open"))

    def step(acc: Column, word: Column) -> Column:
        first = acc["kept"] == ""
        fits = acc["open"] & (acc["used"] + F.length(word) + F.when(first, 0).otherwise(1) <= limit)
        kept = F.when(fits, F.when(first, word).otherwise(F.concat(acc["kept"], F.lit(" "), word))).otherwise(acc["kept"])
        # every kept word is charged its separator, the first one too
        used = F.when(fits, acc["used"] + F.length(word) + 1).otherwise(acc["used"])
        return F.struct(kept.alias("kept"), used.cast("int").alias("used"), fits.alias("open"))

    cut = F.aggregate(F.split(text, " "), start, step, lambda acc: acc["kept"])
    return F.when(F.length(text) <= limit, text).otherwise(_or(cut, strip(F.substring(text, 1, limit))))


def without_variants(value: Column) -> Column:
    return squeeze(F.regexp_replace(value, "(?i)" + VARIANT_WORDS, " "))


def title_forms(value: Text) -> Column:
    """Sorted distinct forms of a title: whole, without parentheses, its parts and aliases, each with and without variant words."""
    raw = strip(value)
    alias = F.regexp_extract(raw, r"(?i)\ba\.?k\.?a\.?\b(.+)$", 1)
    tail = F.regexp_replace(alias, r"^[ \-:;]+|[ \-:;]+$", "")
    shapes = F.concat(
        F.array(raw, F.regexp_replace(raw, r"\([^)]*\)", "")),
        F.split(raw, r"(?U)\s*/\s*|\s*;\s*"),
        F.when(alias != "", F.concat(F.array(tail), F.split(tail, r"(?U)\s+-\s+"))).otherwise(F.array().cast("array<string>")),
    )
    normed = F.transform(shapes, norm_audit)
    both = F.concat(normed, F.transform(normed, without_variants))
    return F.array_sort(F.array_distinct(F.filter(both, lambda x: x != "")))


def artist_parts(value: Text) -> Column:
    """The full credit, then its parts."""
    raw = strip(value)
    parts = F.split(raw, r"(?i)\s*(?:,|/|&| and | with | feat\.?|ft\.?|featuring)\s*")
    return F.filter(F.transform(F.concat(F.array(raw), parts), strip), lambda x: x != "")


def artist_credits(value: Text) -> Column:
    """The full credit, then its parts; of parts with equal normal form the first stays."""
    listed = artist_parts(value)
    keyed = F.filter(F.transform(listed, lambda x: F.struct(norm_audit(x).alias("k"), x.alias("v"))), lambda x: x["k"] != "")
    empty = F.array().cast("array<struct<k:string,v:string>>")
    first = F.aggregate(keyed, empty, lambda acc, x: F.when(F.exists(acc, lambda y: y["k"] == x["k"]), acc).otherwise(F.array_append(acc, x)))
    return F.transform(first, lambda x: x["v"])


def tokens(normalised: Column) -> Column:
    """Sorted distinct tokens without stop words and single characters."""
    words = F.filter(F.split(normalised, " "), lambda w: F.length(w) > 1)
    return F.array_sort(F.array_except(F.array_distinct(words), F.array(*[F.lit(w) for w in STOP_WORDS])))


def title_components(value: Text) -> Column:
    """Compared forms of the whole title and of its parts between slashes, distinct, first ones first."""
    title = matching_title(value)
    parts = F.when(F.instr(title, "/") > 0, F.split(title, r"\s*/\s*")).otherwise(F.array().cast("array<string>"))
    return F.filter(F.array_distinct(F.transform(F.concat(F.array(title), parts), norm_compare)), lambda x: x != "")


def comma_list(value: Text) -> Column:
    return F.filter(F.transform(F.split(_c(value), ","), strip), lambda x: x != "")


def joined_list(values: Column) -> Column:
    return F.array_join(F.array_distinct(F.filter(values, lambda x: x != "")), ", ")


def match_key(artist: Text, album: Text, song: Text) -> Column:
    return F.concat_ws("|", norm_matching(artist), norm_matching(album), norm_matching(song))


def fuzzy_signature(artist: Text, album: Text, song: Text) -> Column:
    """Normal forms run together, without a separator."""
    return F.concat(norm_matching(artist), norm_matching(album), norm_matching(song))


def version_type(song: Text, notes: Text, current: Text) -> Column:
    """A valid current value stays; else inferred from title and notes."""
    given = strip(current)
    text = F.lower(F.concat(_c(song), F.lit(" "), _c(notes)))
    return (
        F.when(given.isin("same_master", "remix_or_edit", "live_recording", "re_recording", "unknown"), given)
        .when(text.rlike(r"\b(remix|mix|edit|extended|instrumental|dub|version)\b"), "remix_or_edit")
        .when(text.rlike(r"\blive\b"), "live_recording")
        .when(text.rlike(r"\b(re-record|rerecord|new recording|alternate take)\b"), "re_recording")
        .otherwise("same_master")
    )


def subtype_tags(song: Text, edition: Text, version: Text, compilation_copy: Column) -> Column:
    """Tags in their fixed order; ``live`` counts inside words."""
    title, ed, ver = F.lower(matching_title(song)), F.lower(_c(edition)), F.lower(_c(version))
    found = [
        F.when(title.contains("radio") | ed.contains("radio"), "radio_edit"),
        F.when((ver == "remix_or_edit") | title.rlike(r"\b(remix|mix|edit|dub|extended|instrumental)\b"), "remix"),
        F.when((ed == "remaster") | title.contains("remaster"), "remastered"),
        F.when(title.contains("live"), "live"),
        F.when(ver == "re_recording", "re_recording"),
        F.when(compilation_copy, "compilation_copy"),
    ]
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def link_parts(url: Text) -> Column:
    """Entity type and id of a streaming link, null if it is none."""
    pattern = r"open\.spotify\.com/(track|album)/([A-Za-z0-9]+)"
    kind = F.regexp_extract(_c(url), pattern, 1)
    return F.when(kind != "", F.struct(kind.alias("kind"), F.regexp_extract(_c(url), pattern, 2).alias("id")))


def expected_link_type(row_type: Text) -> Column:
    return F.when(_c(row_type) == "album", "album").otherwise("track")


def title_case(value: Column) -> Column:
    """Every letter after a non-letter in upper case, the others in lower case (also after apostrophes)."""
    chars = F.split(F.lower(value), "")
    start = F.struct(F.lit("").alias("text"), F.lit(False).alias("inside"))
    step = lambda acc, ch: F.struct(
        F.concat(acc["text"], F.when(acc["inside"], ch).otherwise(F.upper(ch))).alias("text"), ch.rlike(r"\p{L}").alias("inside")
    )
    return F.aggregate(chars, start, step, lambda acc: acc["text"])


def tags_to_artist(tags: Column, meta: list[str] = META_TAGS) -> Column:
    """Topic tags as an artist credit: meta tags go, dashes become spaces."""
    kept = F.filter(tags, lambda t: (t != "") & ~F.lower(t).isin(*meta))
    return F.array_join(F.transform(kept, lambda t: title_case(F.replace(t, F.lit("-"), F.lit(" ")))), ", ")


def artist_and_title(value: Text, default: str) -> Column:
    """``Artist – Title`` or ``Artist - Title`` in two; a suffix that only names a format goes, with the artist."""
    text = _c(value)
    separator = F.when(F.instr(text, " – ") > 0, " – ").when(F.instr(text, " - ") > 0, " - ").otherwise("")
    at = F.when(separator == "", 0).otherwise(F.call_function("instr", text, separator))
    before, after = strip(F.substring(text, F.lit(1), at - 1)), strip(F.substring(text, at + 3, F.length(text)))
    formats = F.lower(after).isin("single", "live", "ep")
    artist = F.when((separator != "") & ~formats & (before != ""), before).otherwise(default)
    title = F.when(separator == "", text).when(formats, before).otherwise(after)
    return F.struct(artist.alias("artist"), _or(title, text).alias("title"))


def host(url: Text) -> Column:
    """The authority part of an address (host, and port if given); empty if there is none."""
    return F.coalesce(F.try_parse_url(_c(url), F.lit("AUTHORITY")), F.lit(""))


def url_key(url: Text) -> Column:
    return F.md5(_c(url).cast("binary"))


def cache_key(namespace: str, query: Text) -> Column:
    return F.md5(F.concat(F.lit(namespace + ":"), lower_strip(query)).cast("binary"))


def search_queries(artist: Text, song: Text, album: Text, row_type: Text) -> Column:
    """Search texts from the most to the least specific one."""
    a, s, b = bounded_query_text(artist, 80), bounded_query_text(song, 100), bounded_query_text(album, 100)
    quoted = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    albums = F.array(quoted('album:"', b, '" artist:"', a, '"'), quoted('"', b, '" "', a, '"'))
    tracks = F.array(
        quoted('track:"', s, '" artist:"', a, '" album:"', b, '"'), quoted('track:"', s, '" artist:"', a, '"'), quoted('"', s, '" "', a, '"')
    )
    return F.when(_c(row_type) == "album", albums).otherwise(tracks)


def video_url(kind: Column, video: Column, playlist: Column) -> Column:
    """Watch or playlist address of a video search item, else empty."""
    video, playlist = F.coalesce(video, F.lit("")), F.coalesce(playlist, F.lit(""))
    return (
        F.when(kind.contains("video") & (video != ""), F.concat(F.lit("https://www.youtube.com/watch?v="), video))
        .when(kind.contains("playlist") & (playlist != ""), F.concat(F.lit("https://www.youtube.com/playlist?list="), playlist))
        .otherwise("")
    )


def year_text(date: Text) -> Column:
    return F.substring(strip(date), 1, 4)
