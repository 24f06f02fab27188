"""Queries of the text, id and value functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catloom.functions import ids, text, values
from catloom.plans.disc import DISC, disc
from catloom.plans.registry import query
from catloom.runtime import table

#: A title per document: its first line; punctuation and letters of several languages occur.
_FIRST = "first AS (SELECT doc_id AS id, split_part(text, chr(10), 1) AS t FROM documents UNION ALL SELECT p_partkey + 1000000 AS id, p_name || CASE WHEN p_partkey % 5 = 0 THEN ' (feat. X & Y)' WHEN p_partkey % 5 = 1 THEN ' - Live / Pt. 2' WHEN p_partkey % 5 = 2 THEN ' 4 the [mix]' ELSE '' END AS t FROM part)"
_STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_ALNUM = "trim(regexp_replace({}, '[^a-z0-9]+', ' ', 'g'))"


def titles(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.split_part("text", F.lit("\n"), F.lit(1)).alias("t"))
    part, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    suffix = F.when(key % 5 == 0, " (feat. X & Y)").when(key % 5 == 1, " - Live / Pt. 2").when(key % 5 == 2, " 4 the [mix]").otherwise("")
    return docs.unionByName(part.select((key + 1000000).alias("id"), F.concat("p_name", suffix).alias("t")))


def _one(function):
    return lambda spark, sf_dir: titles(spark, sf_dir).select("id", function("t").alias("v"))


def _add(name, function, expression):
    run = _one(function)
    run.__name__ = name
    query(f"WITH {_FIRST} SELECT id, {expression} AS v FROM first")(run)


_LOW = "lower(regexp_replace(t, '^\\s+|\\s+$', '', 'g'))"
_FEAT = r"'\((feat\.|ft\.|featuring)\s+[^)]*\)'"
_add("norm_matching", text.norm_matching, rf"trim(regexp_replace(regexp_replace({_LOW}, '[^\p{{L}}\p{{N}}\p{{M}}_\s]', '', 'g'), '\s+', ' ', 'g'))")
_add("norm_strict", text.norm_strict, _ALNUM.format(f"replace(regexp_replace({_LOW}, {_FEAT}, '', 'g'), '&', ' and ')"))
_add("norm_discovery", text.norm_discovery, _ALNUM.format(r"replace(regexp_replace(lower(t), '\(feat\.[^)]+\)|\(ft\.[^)]+\)', '', 'g'), '&', ' and ')"))
_add(
    "norm_cache", text.norm_cache,
    r"trim(regexp_replace(trim(regexp_replace(trim(regexp_replace(replace(regexp_replace(regexp_replace(lower(t), '\(feat\.[^)]+\)|\(ft\.[^)]+\)', '', 'g'), '^\[[^\]]+\]\s*', ''), '&', 'and'), '[^a-z0-9]+', ' ', 'g')), '\bthe\b', '', 'g')), '\s+', ' ', 'g'))",
)


def _audit(x):
    """The audit normaliser of ``x``."""
    low = rf"regexp_replace(regexp_replace(lower({_STRIP.format(x)}), '^\[[^\]]+\]\s*', ''), {_FEAT}, '', 'g')"
    return _ALNUM.format(rf"regexp_replace(regexp_replace(replace(regexp_replace({low}, '\b(feat\.?|ft\.?|featuring)\b.*$', '', 'g'), '&', ' and '), '\b4\b', 'for', 'g'), '\b2\b', 'to', 'g')")


_add("norm_audit", text.norm_audit, _audit("t"))
_WORDS = "(remix|mix|edit|extended|instrumental|dub|version|live)"
_BASE = rf"""CASE WHEN contains({_STRIP.format('t')}, ' - ') AND regexp_matches(substr({_STRIP.format('t')}, instr({_STRIP.format('t')}, ' - ') + 3), '\b{_WORDS}\b', 'i')
 THEN split_part({_STRIP.format('t')}, ' - ', 1) ELSE {_STRIP.format('t')} END"""
_CUT = _STRIP.format(rf"regexp_replace({_BASE}, '\(([^)]*{_WORDS}[^)]*)\)$', '', 'i')")
_add("base_title", text.base_title, f"CASE WHEN {_CUT} = '' THEN {_STRIP.format('t')} ELSE {_CUT} END")



def _clean(rows, p):
    """The detector's chain over ``rows`` (id, t) in steps, as every step reads the one before twice; the last one is ``{p}cmp``."""
    return rf"""{p}1 AS (SELECT id, {_STRIP.format('t')} AS t FROM {rows}),
{p}2 AS (SELECT id, CASE WHEN starts_with(t, '[') AND contains(t, '] ') THEN {_STRIP.format("substr(t, instr(t, '] ') + 2)")} ELSE t END AS t FROM {p}1),
{p}3 AS (SELECT id, {_STRIP.format(rf"regexp_replace(regexp_replace(t, {_FEAT}, '', 'gi'), '\s+', ' ', 'g')")} AS t FROM {p}2),
{p}4 AS (SELECT id, t AS c, {_STRIP.format(r"CASE WHEN contains(t, ' - ') AND regexp_matches(lower(substr(t, instr(t, ' - ') + 3)), 'remix|mix|edit|extended|instrumental|dub|version|live|remaster|radio|mono|stereo|session|recording|rehearsal|bonus') THEN split_part(t, ' - ', 1) ELSE t END")} AS t FROM {p}3),
{p}5 AS (SELECT id, c, {_STRIP.format(r"regexp_replace(t, '\(([^)]*(remix|mix|edit|extended|instrumental|dub|version|live|remaster|radio|mono|stereo)[^)]*)\)$', '', 'i')")} AS t FROM {p}4),
{p}base AS (SELECT id, c AS cleaned, CASE WHEN t = '' THEN c ELSE t END AS b FROM {p}5),
{p}cmp AS (SELECT id, cleaned, b, trim(regexp_replace(regexp_replace(replace(lower(b), '&', ' and '), '\b(pt|part)\s*\.?\s*\d+\b', ' ', 'g'), '[^a-z0-9]+', ' ', 'g')) AS n FROM {p}base)"""


_STOP = "['a','an','and','feat','featuring','ft','for','in','of','on','part','pt','the','to','version']"


@query(f"WITH {_FIRST}, {_clean("first", "c")} SELECT id, cleaned, b AS base, n AS compared, list_sort(list_distinct(list_filter(string_split(n, ' '), lambda w: length(w) > 1 AND NOT list_contains({_STOP}, w)))) AS tokens FROM ccmp")
def detector_titles(spark, sf_dir):
    """Cleaned, base and compared titles with their tokens."""
    base = titles(spark, sf_dir).withColumn("compared", text.norm_compare("t"))
    return base.select("id", text.matching_title("t").alias("cleaned"), text.detector_base_title("t").alias("base"), "compared", text.tokens(F.col("compared")).alias("tokens"))


_VARIANTS = text.VARIANT_WORDS.replace("'", "''")


@query(rf"""WITH {_FIRST}, raw AS (SELECT id, {_STRIP.format('t')} AS r, regexp_extract({_STRIP.format('t')}, '\ba\.?k\.?a\.?\b(.+)$', 1, 'i') AS a FROM first),
tail AS (SELECT *, regexp_replace(a, '^[ \-:;]+|[ \-:;]+$', '', 'g') AS e FROM raw),
shape AS (SELECT id, [r, regexp_replace(r, '\([^)]*\)', '', 'g')] || string_split_regex(r, '\s*/\s*|\s*;\s*') || CASE WHEN a <> '' THEN [e] || string_split_regex(e, '\s+-\s+') ELSE [] END AS s FROM tail),
norm AS (SELECT id, list_transform(s, lambda x: {_audit('x')}) AS s FROM shape),
form AS (SELECT id, list_sort(list_distinct(list_filter(s || list_transform(s, lambda x: trim(regexp_replace(regexp_replace(x, '{_VARIANTS}', ' ', 'gi'), '\s+', ' ', 'g'))), lambda x: x <> ''))) AS forms FROM norm),
{_clean("first", "w")}, part AS (SELECT {{'id': id, 'pos': 0}} AS id, cleaned AS t FROM wcmp UNION ALL
 SELECT {{'id': id, 'pos': unnest(range(1, len(string_split_regex(cleaned, '\s*/\s*')) + 1))}}, unnest(string_split_regex(cleaned, '\s*/\s*')) FROM wcmp WHERE contains(cleaned, '/')),
{_clean("part", "p")}, listed AS (SELECT id.id AS id, list(n ORDER BY id.pos) AS l FROM pcmp WHERE n <> '' GROUP BY 1)
SELECT form.id, forms, CASE WHEN l IS NULL THEN [] ELSE list_filter(l, lambda x, i: list_position(l, x) = i) END AS components FROM form LEFT JOIN listed ON form.id = listed.id""")
def title_forms(spark, sf_dir):
    """Forms and components of all titles."""
    return titles(spark, sf_dir).select("id", text.title_forms("t").alias("forms"), text.title_components("t").alias("components"))


@query(rf"""WITH {_FIRST}, raw AS (SELECT id, {_STRIP.format('t')} AS r FROM first),
part AS (SELECT id, list_filter(list_transform([r] || string_split_regex(r, '(?i)\s*(?:,|/|&| and | with | feat\.?|ft\.?|featuring)\s*'), lambda x: {_STRIP.format('x')}), lambda x: x <> '') AS v FROM raw),
keyed AS (SELECT id, v, list_transform(v, lambda x: {_audit('x')}) AS k FROM part)
SELECT id, list_filter(v, lambda x, i: k[i] <> '' AND list_position(k, k[i]) = i) AS credits FROM keyed""")
def artist_credits(spark, sf_dir):
    """Every title read as a credit: the whole, then its parts."""
    return titles(spark, sf_dir).select("id", text.artist_credits("t").alias("credits"))


@query("""SELECT c_custkey, 'art_' || substr(sha1(lower(trim(c_name))), 1, 12) AS artist_id,
 'rel_' || substr(sha1('art_' || substr(sha1(lower(trim(c_name))), 1, 12) || '|' || lower(c_mktsegment) || '|' || c_nationkey), 1, 12) AS nested_id FROM customer""")
def slug_ids(spark, sf_dir):
    """Content-hash ids, plain and nested."""
    nested = ids.slug_hash("rel", ids.artist_id("c_name"), "c_mktsegment", F.col("c_nationkey").cast("string"))
    return table(spark, sf_dir, "customer").select("c_custkey", ids.artist_id("c_name").alias("artist_id"), nested.alias("nested_id"))


_SIG = "lower(concat_ws('|', artist, album_name, song_name, track_position, release_date, row_type, release_category, edition_type))"


@query(f"WITH {DISC} SELECT _ord, {_SIG} AS sig, array_to_string(string_split({_SIG}, '|')[1:5], '|') AS legacy, substr(sha256({_SIG}), 1, 16) AS row_hash FROM disc")
def row_signature(spark, sf_dir):
    return disc(spark, sf_dir).select("_ord", ids.signature().alias("sig"), ids.legacy_signature().alias("legacy"), ids.row_hash(ids.signature()).alias("row_hash"))


@query(rf"""WITH {DISC} SELECT _ord, CASE WHEN regexp_matches(lower(song_name || ' ' || notes), '\b(remix|mix|edit|extended|instrumental|dub|version)\b') THEN 'remix_or_edit'
 WHEN regexp_matches(lower(song_name || ' ' || notes), '\blive\b') THEN 'live_recording' ELSE 'same_master' END AS version_type,
 list_filter([CASE WHEN regexp_matches(lower(song_name), '\b(remix|mix|edit|dub|extended|instrumental)\b') THEN 'remix' END, CASE WHEN edition_type = 'remaster' THEN 'remastered' END,
 CASE WHEN contains(lower(song_name), 'live') THEN 'live' END], lambda x: x IS NOT NULL) AS tags FROM disc""")
def version_types(spark, sf_dir):
    """Inferred version types and subtype tags."""
    tags = text.subtype_tags("song_name", "edition_type", "version_type", F.lit(False))
    return disc(spark, sf_dir).select("_ord", text.version_type("song_name", "notes", "version_type").alias("version_type"), tags.alias("tags"))


@query(f"""WITH {DISC} SELECT _ord, release_date, CAST(substr(release_date, 1, 4) AS INT) AS year, CASE WHEN length(release_date) >= 7 THEN CAST(substr(release_date, 6, 2) AS INT) ELSE 99 END AS month,
 CASE WHEN length(release_date) = 10 THEN CAST(substr(release_date, 9, 2) AS INT) ELSE 99 END AS day, regexp_matches(release_date, '^\\d{{4}}(-\\d{{2}})?(-\\d{{2}})?$') AS valid,
 CASE WHEN regexp_matches(duration_seconds, '^\\d+$') THEN duration_seconds ELSE '' END AS seconds FROM disc""")
def partial_dates(spark, sf_dir):
    """Partial dates as sortable parts, their format check, and whole seconds."""
    at = values.date_tuple("release_date")
    return disc(spark, sf_dir).select(
        "_ord", "release_date", at["year"].alias("year"), at["month"].alias("month"), at["day"].alias("day"),
        values.is_partial_date("release_date").alias("valid"), values.whole_seconds("duration_seconds").alias("seconds"),
    )


@query(r"""SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, md5(url) AS url_key, md5('page:' || lower(url)) AS cache_key,
 trim(regexp_extract(html, '<title[^>]*>(.*?)</title>', 1, 's')) AS title, len(regexp_extract_all(html, '<a\s[^>]*href="([^"]*)"', 1)) AS n_links FROM pages""")
def page_keys(spark, sf_dir):
    """Hosts, cache keys, titles and anchors of pages."""
    from catloom.operators import extract

    return table(spark, sf_dir, "pages").select(
        "page_id", text.host("url").alias("host"), text.url_key("url").alias("url_key"), text.cache_key("page", "url").alias("cache_key"),
        extract.page_title("html").alias("title"), F.size(extract.hrefs("html")).cast("long").alias("n_links"),
    )


@query("""SELECT event_id, CAST(round_even(CAST(value AS DOUBLE) * 1000 / 1000, 0) AS BIGINT) AS seconds, CASE WHEN CAST(substr(CAST(ts AS VARCHAR), 3, 2) AS INT) >= 70 THEN '19' ELSE '20' END || substr(CAST(ts AS VARCHAR), 3, 2) AS year,
 substr(CAST(ts AS VARCHAR), 1, 10) AS day FROM events""")
def scalar_dates(spark, sf_dir):
    """Milliseconds to seconds (half to even), two-digit years, days of timestamps."""
    at = F.col("ts").cast("string")
    return table(spark, sf_dir, "events").select(
        "event_id", values.seconds_of_ms(F.col("value") * 1000).alias("seconds"), values.pivot_year(at.substr(3, 2)).alias("year"), values.date_of_timestamp(at).alias("day")
    )
