"""Queries of deduplication, lineage, star schema, reconciliation, enrichment and audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from catloom import schema
from catloom.functions import text, values
from catloom.functions import text as text_functions
from catloom.operators import audit, blocking, catalog, consolidate, dedupe, duplicate_classes, duplicates, enrich, extract, graph, lineage, quality, reconcile
from catloom.operators.components import connected_components
from catloom.plans.disc import DISC, disc
from catloom.plans.registry import query
from catloom.runtime import bounded, cut, table
from catloom.sources import integrity

_KEY = ", ".join(f"lower(trim({c}))" for c in schema.KEY)
_ART = "'art_' || substr(sha1(lower(trim(artist))), 1, 12)"
_REL = f"'rel_' || substr(sha1(lower({_ART} || '|' || album_name || '|' || release_date || '|' || release_category || '|' || edition_type)), 1, 12)"
_BASETITLE = r"CASE WHEN ends_with(song_name, ' - Remix') THEN left(song_name, length(song_name) - 8) WHEN ends_with(song_name, ' (Live)') THEN left(song_name, length(song_name) - 7) ELSE song_name END"
_WORK = f"'wrk_' || substr(sha1({_ART} || '|' || lower({_BASETITLE})), 1, 12)"
_IDS = f"{DISC}, ids AS (SELECT *, {_ART} AS a_id, {_REL} AS r_id, {_BASETITLE} AS base, {_WORK} AS w_id FROM disc)"


@query(f"WITH {DISC} SELECT artist AS of_artist, album_name AS of_album, max(CAST(track_position AS INT)) AS total FROM disc WHERE row_type = 'track' GROUP BY ALL")
def track_totals(spark, sf_dir):
    return lineage.track_totals(disc(spark, sf_dir))


@query(f"""WITH {DISC}, t AS (SELECT artist a, album_name b, max(CAST(track_position AS INT)) AS total FROM disc WHERE row_type = 'track' GROUP BY ALL)
SELECT _ord, CASE WHEN row_type = 'track' THEN track_position || '/' || total ELSE '' END AS track_position FROM disc LEFT JOIN t ON artist = a AND album_name = b""")
def track_positions(spark, sf_dir):
    return lineage.normalised(disc(spark, sf_dir)).select("_ord", "track_position")


def _small(df):
    """Keys that collide: songs per artist, so that merging has work to do."""
    return df.withColumn("album_name", F.lit("")).withColumn("track_position", F.lit("")).withColumn("release_date", F.substring("release_date", 1, 4))


_MERGED = f"""WITH {DISC}, s AS (SELECT * REPLACE ('' AS album_name, '' AS track_position, substr(release_date, 1, 4) AS release_date) FROM disc)
SELECT min(_ord) AS _ord, count(*) AS _copies, coalesce(arg_min(spotify_url, _ord) FILTER (spotify_url <> ''), '') AS spotify_url, coalesce(arg_min(youtube_url, _ord) FILTER (youtube_url <> ''), '') AS youtube_url,
 coalesce(arg_min(chart_position, _ord) FILTER (chart_position <> ''), '') AS chart_position, arg_min(duration_seconds, _ord) AS duration_seconds, arg_min(label, _ord) AS label, arg_min(genre, _ord) AS genre
FROM s GROUP BY {_KEY}"""


@query(_MERGED)
def dedupe_merge(spark, sf_dir):
    """Keep-first merge with first-filled columns."""
    names = ["spotify_url", "youtube_url", "chart_position", "duration_seconds", "label", "genre"]
    return dedupe.merge_duplicates(_small(disc(spark, sf_dir)), columns=names).select("_ord", "_copies", *names)


@query(f"""WITH {DISC}, s AS (SELECT * REPLACE ('' AS album_name, '' AS track_position, substr(release_date, 1, 4) AS release_date) FROM disc),
g AS (SELECT min(_ord) AS _ord, count(*) AS n, arg_min(alternative_names, _ord) AS one, list_filter(flatten(list(string_split(alternative_names, ', ') ORDER BY _ord)), lambda x: x <> '') AS parts, list(notes ORDER BY _ord) AS notes FROM s GROUP BY {_KEY})
SELECT _ord, CASE WHEN n = 1 THEN one ELSE coalesce(array_to_string(list_filter(parts, lambda x, i: list_position(parts, x) = i), ', '), '') END AS alternative_names,
 list_reduce(notes, lambda a, x: CASE WHEN a = x OR x = '' THEN a WHEN a = '' THEN x ELSE a || ' | ' || x END) AS notes FROM g""")
def dedupe_folds(spark, sf_dir):
    """Order-dependent merges: comma lists and notes."""
    names = ["alternative_names", "notes"]
    return dedupe.merge_duplicates(_small(disc(spark, sf_dir)), columns=names).select("_ord", *names)


@query(f"WITH {_IDS} SELECT a_id AS artist_id, arg_min(artist, _ord) AS artist_name, lower(arg_min(artist, _ord)) AS artist_name_normalized FROM ids GROUP BY a_id")
def dim_artists(spark, sf_dir):
    return catalog.artists(disc(spark, sf_dir)).drop("_ord")


@query(f"""WITH {_IDS} SELECT r_id AS release_id, arg_min(a_id, _ord) AS artist_id, arg_min(artist, _ord) AS artist_name, arg_min(album_name, _ord) AS album_name, arg_min(release_date, _ord) AS release_date,
 arg_min(release_category, _ord) AS release_category, arg_min(edition_type, _ord) AS edition_type, arg_min(era, _ord) AS era, arg_min(genre, _ord) AS genre FROM ids GROUP BY r_id""")
def dim_releases(spark, sf_dir):
    return catalog.releases(disc(spark, sf_dir)).drop("_ord")


@query(f"WITH {_IDS} SELECT arg_min(w_id, _ord) AS work_id, a_id AS artist_id, arg_min(artist, _ord) AS artist_name, arg_min(base, _ord) AS work_name FROM ids GROUP BY a_id, lower(base)")
def dim_works(spark, sf_dir):
    return catalog.works(disc(spark, sf_dir)).drop("_ord")


_VERSION = "CASE WHEN ends_with(song_name, ' - Remix') OR regexp_matches(lower(song_name), '\\b(remix|mix|edit|extended|instrumental|dub|version)\\b') THEN 'remix_or_edit' WHEN regexp_matches(lower(song_name), '\\blive\\b') THEN 'live_recording' ELSE 'same_master' END"
_VER = "'ver_' || substr(sha1(w_id || '|' || lower(song_name) || '|' || duration_seconds), 1, 12)"
_TRK = "'trk_' || substr(sha1(lower(a_id || '|' || song_name || '|' || album_name || '|' || track_position || '|' || release_date || '|' || release_category || '|' || edition_type)), 1, 12)"
_SOURCES = """w AS (SELECT w_id, arg_min(r_id, row(release_date, _ord)) AS by_work FROM ids WHERE release_category <> 'compilation' GROUP BY w_id),
a AS (SELECT lower(artist) AS la, arg_min(r_id, row(release_date, _ord)) AS by_artist FROM ids WHERE release_category <> 'compilation' GROUP BY lower(artist)),
src AS (SELECT ids.*, CASE WHEN row_type = 'track' AND release_category = 'compilation' THEN coalesce(by_work, by_artist, '') ELSE '' END AS source FROM ids LEFT JOIN w USING (w_id) LEFT JOIN a ON lower(artist) = la)"""


@query(f"WITH {_IDS}, {_SOURCES} SELECT {_TRK} AS track_id, r_id AS release_id, w_id AS work_id, {_VER} AS version_id, a_id AS artist_id, song_name, {_VERSION} AS version_type, source AS source_release_id, duration_seconds FROM src")
def dim_tracks(spark, sf_dir):
    names = ["track_id", "release_id", "work_id", "version_id", "artist_id", "song_name", "version_type", "source_release_id", "duration_seconds"]
    return catalog.tracks(disc(spark, sf_dir)).select(*names)


@query(f"WITH {_IDS} SELECT w_id AS key, arg_min(r_id, row(release_date, _ord)) AS source FROM ids WHERE release_category <> 'compilation' GROUP BY w_id")
def earliest_source(spark, sf_dir):
    return lineage.earliest(lineage.identified(disc(spark, sf_dir)), F.col("work_id"))


@query(f"WITH {_IDS}, {_SOURCES} SELECT _ord, w_id AS work_id, {_VER} AS version_id, {_VERSION} AS version_type, source AS source_release_id, CASE WHEN contains(duration_seconds, '.') THEN '' ELSE duration_seconds END AS duration_seconds FROM src")
def lineage_fill(spark, sf_dir):
    """Flagship: every row with its work, version and the earliest release it comes from."""
    return lineage.lineage_filled(disc(spark, sf_dir).select("_ord", *lineage.READ)).select("_ord", *schema.LINEAGE)


_FIRSTS = ["artist", "song_name", "album_name", "track_position", "row_type", "release_category", "edition_type", "release_date", "label", "era", "genre", "duration_seconds"]
_FILLED = ["chart_position", "awards", "spotify_url", "youtube_url"]


_CANONICAL = f"""WITH {DISC}, s AS (SELECT * REPLACE ('' AS album_name, '' AS track_position, substr(release_date, 1, 4) AS release_date) FROM disc),
g AS (SELECT min(_ord) AS _ord, {', '.join(f'arg_min({c}, _ord) AS {c}' for c in _FIRSTS)}, {', '.join(f"coalesce(arg_min({c}, _ord) FILTER ({c} <> ''), '') AS {c}" for c in _FILLED)}, count(*) AS copies,
 arg_min(alternative_names, _ord) AS one, list_filter(flatten(list(string_split(alternative_names, ', ') ORDER BY _ord)), lambda x: x <> '') AS parts, list(notes ORDER BY _ord) AS every FROM s GROUP BY {_KEY}),
m AS (SELECT *, CASE WHEN copies = 1 THEN one ELSE coalesce(array_to_string(list_filter(parts, lambda x, i: list_position(parts, x) = i), ', '), '') END AS alternative_names,
 list_reduce(every, lambda a, x: CASE WHEN a = x OR x = '' THEN a WHEN a = '' THEN x ELSE a || ' | ' || x END) AS notes FROM g),
ids AS (SELECT *, {_ART} AS a_id, {_REL} AS r_id, {_BASETITLE} AS base, {_WORK} AS w_id FROM m), {_SOURCES}
SELECT _ord, {', '.join(_FIRSTS[:-1] + _FILLED)}, CASE WHEN contains(duration_seconds, '.') THEN '' ELSE duration_seconds END AS duration_seconds, alternative_names, notes,
 w_id AS work_id, {_VER} AS version_id, {_VERSION} AS version_type, source AS source_release_id FROM src"""


@query(_CANONICAL)
def canonicalise(spark, sf_dir):
    """The whole normalisation: positions, merge, lineage."""
    return lineage.canonicalise(_small(disc(spark, sf_dir)))[0]


def _tree_sql(source, columns, depth):
    """A hash tree in SQL: row hashes, leaves, then level by level."""
    spell = " || ".join(f"coalesce(length({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in columns)
    levels = [f"hashed AS (SELECT sha256({spell}) AS hash, count(*) AS n FROM {source} GROUP BY 1)"]
    levels.append(f"l{depth} AS (SELECT {depth} AS level, substr(hash, 1, {depth}) AS bucket, sum(n)::BIGINT AS rows, sha256(string_agg(hash || ':' || n, ',' ORDER BY hash)) AS digest FROM hashed GROUP BY 2)")
    for up in range(depth - 1, -1, -1):
        levels.append(f"l{up} AS (SELECT {up} AS level, substr(bucket, 1, {up}) AS bucket, sum(rows)::BIGINT AS rows, sha256(string_agg(bucket || '=' || digest, ',' ORDER BY bucket)) AS digest FROM l{up + 1} GROUP BY 2)")
    return ", ".join(levels)


@query(f"WITH {_tree_sql('documents', ['doc_id', 'text', 'lang', 'source', 'n_chars'], 2)} SELECT * FROM l2 UNION ALL SELECT * FROM l1 UNION ALL SELECT * FROM l0")
def table_tree(spark, sf_dir):
    """The hash tree of all documents."""
    return integrity.hash_tree(table(spark, sf_dir, "documents"), ["doc_id", "text", "lang", "source", "n_chars"], 2)


@query(f"WITH canonical AS ({_CANONICAL}), {_tree_sql('canonical', schema.FACT, 1)} SELECT rows, digest AS once, digest AS twice FROM l0")
def rerun_proof(spark, sf_dir):
    """Normalisation applied once and again: both tables have one root, which is that of the table as SQL makes it."""
    once = lineage.canonicalise(_small(disc(spark, sf_dir)))[0]
    twice = lineage.canonicalise(once)[0]
    first, second = (integrity.hash_tree(t, schema.FACT, 1).filter("level = 0") for t in (once, twice))
    return first.select("rows", F.col("digest").alias("once")).join(second.select(F.col("digest").alias("twice")))


@query("""WITH c AS (SELECT CASE WHEN doc_id % 7 = 0 THEN '' ELSE coalesce(source, '') END AS artist, CASE WHEN doc_id % 7 = 4 THEN 'session' ELSE 'album' END AS row_type,
 CASE WHEN doc_id % 11 = 0 THEN 'merged' ELSE 'pending' END AS status, source, doc_id FROM documents)
SELECT count(*) AS total_raw_rows, count(DISTINCT source) AS source_files, count(*) AS unique_candidates, count(DISTINCT artist) AS artists, count(*) FILTER (status = 'pending') AS pending, 0::BIGINT AS existing,
 count(*) FILTER (status = 'merged') AS merged, 0::BIGINT AS rejected, 0::BIGINT AS fuzzy_duplicate, count(*) FILTER (row_type = 'album') AS album_rows, 0::BIGINT AS track_rows, 0::BIGINT AS single_rows,
 (SELECT count(*) FROM labels) AS corrections_found FROM c""")
def run_totals(spark, sf_dir):
    """The run record over candidates made of all documents."""
    rows = candidate_rows(spark, sf_dir).withColumn("artist", F.coalesce("artist", F.lit("")))
    return consolidate.run_totals(rows.withColumn("discovery_source", F.col("sources")), rows, table(spark, sf_dir, "labels"))


def _hex(start, digits):
    """A number from digits of the order key."""
    return F.conv(F.substring("_ord", start, digits), 16, 10).cast("long")


def log_entries(spark, sf_dir):
    """Prior log entries from events: some of full, some of legacy signature only."""
    events = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    users = table(spark, sf_dir, "events").agg(F.max("user_id") + 1).first()[0] or 1
    rows = disc(spark, sf_dir).withColumn("k", _hex(1, 6) % users)
    known = rows.join(bounded(events), "k").withColumn("row_type", F.when(F.col("k") % 2 == 0, "").otherwise(F.col("row_type")))
    size = (F.col("k") % 4).cast("int")
    event = F.struct(F.lit("2024-01-01").alias("date"), F.lit("r").alias("round"), F.lit("m").alias("method"), F.lit("x").alias("result"), F.lit(None).cast("double").alias("score"),
                     F.lit(None).cast("string").alias("previous_url"), F.lit(None).cast("array<string>").alias("reason_codes"))
    return known.select(
        "_ord", *schema.KEY, F.when(F.col("k") % 3 == 0, "needs_research").otherwise("not_found").alias("spotify_status"), F.lit("odd").alias("youtube_status"),
        F.lit("2024-01-01").alias("last_search_date"), F.col("n").alias("search_attempts"), F.when(F.col("k") % 5 == 0, "high").alias("confidence_level"), F.array_repeat(event, size).alias("search_history"),
    )


_FULL = "lower(concat_ws('|', artist, album_name, song_name, track_position, release_date, {}, release_category, edition_type))"
_SHORT = "lower(concat_ws('|', artist, album_name, song_name, track_position, release_date))"


@query(f"""WITH {DISC}, k AS (SELECT *, ('0x' || substr(_ord, 1, 6))::BIGINT % (SELECT max(user_id) + 1 FROM events) AS k FROM disc), e AS (SELECT k.*, n FROM k JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY 1) u ON k = user_id),
t AS (SELECT _ord, {_FULL.format("CASE WHEN k % 2 = 0 THEN '' ELSE row_type END")} AS f, {_SHORT} AS l, CASE WHEN k % 3 = 0 THEN 'needs_research' ELSE 'not_found' END AS ss, n, CASE WHEN k % 5 = 0 THEN 'high' END AS cl, k % 4 AS h FROM e),
i AS (SELECT s, arg_min({{'ss': ss, 'n': n, 'cl': cl, 'h': h}}, row(-h, _ord)) AS p FROM (SELECT f AS s, * FROM t UNION ALL SELECT l AS s, * FROM t) GROUP BY s),
j AS (SELECT disc.*, coalesce(a.p, b.p) AS p FROM disc LEFT JOIN i a ON a.s = {_FULL.format('row_type')} LEFT JOIN i b ON b.s = {_SHORT})
SELECT substr(sha256({_FULL.format('row_type')}), 1, 16) AS row_hash, ('0x' || substr(_ord, 1, 14))::BIGINT AS row_number, CASE WHEN spotify_url <> '' THEN 'found' ELSE coalesce(p.ss, 'not_searched') END AS spotify_status,
 CASE WHEN youtube_url <> '' THEN 'found' ELSE 'not_searched' END AS youtube_status, coalesce(p.n, 0) AS search_attempts,
 coalesce(p.cl, CASE WHEN spotify_url <> '' THEN 'low' WHEN p.ss = 'needs_research' THEN 'medium' ELSE 'none' END) AS confidence_level, coalesce(p.h, 0) AS n_history, p IS NOT NULL AS matched FROM j""")
def reconcile_log(spark, sf_dir):
    """New log entries with what earlier ones carry over."""
    out = reconcile.reconcile(disc(spark, sf_dir).withColumn("number", _hex(1, 14)), log_entries(spark, sf_dir), F.col("number"))
    return out.select("row_hash", "row_number", "spotify_status", "youtube_status", "search_attempts", "confidence_level", F.size("search_history").cast("long").alias("n_history"), "matched")


@query(f"""WITH {DISC} SELECT CASE WHEN spotify_url <> '' THEN 'found' ELSE 'not_searched' END AS spotify_status, CASE WHEN youtube_url <> '' THEN 'found' ELSE 'not_searched' END AS youtube_status,
 CASE WHEN spotify_url <> '' THEN 'low' ELSE 'none' END AS confidence_level, count(*) AS n FROM disc GROUP BY ALL""")
def reconcile_new(spark, sf_dir):
    """Statuses of rows without earlier entries."""
    none = log_entries(spark, sf_dir).limit(0)
    out = reconcile.reconcile(disc(spark, sf_dir), none, F.lit(0))
    return out.groupBy("spotify_status", "youtube_status", "confidence_level").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT d.source, count(*) AS orphans FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY d.source""")
def fk_orphans(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id", "left_anti").groupBy("source").agg(F.count(F.lit(1)).alias("orphans"))


@query("SELECT count(*) AS orphans FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def fk_orphan_count(spark, sf_dir):
    return quality.orphan_count(table(spark, sf_dir, "documents"), "doc_id", table(spark, sf_dir, "labels"))


@query(f"WITH {DISC} SELECT CAST(sum(n - 1) AS BIGINT) AS excess FROM (SELECT count(*) AS n FROM disc GROUP BY {_KEY})")
def duplicate_excess(spark, sf_dir):
    return quality.duplicate_excess(disc(spark, sf_dir))


#: Cells that break rules, by the first digit of a row's ordinal.
_PLANTED = {
    "row_type": "CASE substr(_ord, 1, 1) WHEN 'a' THEN 'odd' ELSE row_type END", "release_category": "CASE substr(_ord, 1, 1) WHEN 'b' THEN 'odd' ELSE release_category END",
    "edition_type": "CASE substr(_ord, 1, 1) WHEN 'c' THEN 'odd' ELSE edition_type END", "track_position": "CASE substr(_ord, 1, 1) WHEN 'd' THEN 'x/1' WHEN '1' THEN '' ELSE track_position END",
    "era": "CASE substr(_ord, 1, 1) WHEN 'e' THEN 'Odd era' WHEN '0' THEN '' ELSE era END", "artist": "CASE substr(_ord, 1, 1) WHEN 'f' THEN '' ELSE artist END",
    "spotify_url": "CASE substr(_ord, 1, 1) WHEN '2' THEN 'http://x' ELSE spotify_url END", "youtube_url": "CASE substr(_ord, 1, 1) WHEN '3' THEN 'https://www.youtube.com/watch' WHEN '4' THEN 'x' ELSE youtube_url END",
    "genre": "CASE substr(_ord, 1, 1) WHEN '5' THEN 'Funk, Soul' WHEN '6' THEN 'Any (Live)' WHEN '7' THEN 'Funk, Odd' WHEN '8' THEN '' ELSE genre END",
}


def _one_of(values):
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


_RULES = {
    "row_type_unknown": f"row_type <> '' AND row_type NOT IN {_one_of(schema.ROW_TYPES)}", "release_category_unknown": f"release_category <> '' AND release_category NOT IN {_one_of(schema.CATEGORIES)}",
    "edition_type_unknown": f"edition_type <> '' AND edition_type NOT IN {_one_of(schema.EDITIONS)}",
    "release_date_format": r"release_date <> '' AND NOT regexp_matches(release_date, '^\d{4}(-\d{2})?(-\d{2})?$')", "track_position_format": r"track_position <> '' AND NOT regexp_matches(track_position, '^\d+(/\d+)?$')",
    "track_position_missing": "row_type = 'track' AND track_position = ''", "track_position_bare": r"row_type = 'track' AND regexp_matches(track_position, '^\d+$')",
    "track_position_invalid": r"row_type = 'track' AND track_position <> '' AND NOT regexp_matches(track_position, '^\d+(/\d+)?$')", "position_without_track": "row_type <> 'track' AND track_position <> ''",
    "album_with_position": "row_type = 'album' AND track_position <> ''", "artist_missing": "artist = ''", "era_missing": "era = ''", "era_unknown": f"era <> '' AND era NOT IN {_one_of(schema.ERAS)}",
    "genre_missing": "genre = ''", "genre_unknown": f"genre <> '' AND len(list_filter(string_split(genre, ','), lambda g: trim(g) NOT IN {_one_of(schema.GENRES)} AND NOT ends_with(trim(g), '(Live)') AND NOT ends_with(trim(g), '(Compilation)'))) > 0",
    "spotify_url_prefix": "spotify_url <> '' AND NOT starts_with(spotify_url, 'https://open.spotify.com/')",
    "youtube_url_prefix": "youtube_url <> '' AND NOT starts_with(youtube_url, 'https://youtu.be/') AND NOT starts_with(youtube_url, 'https://www.youtube.com/')",
}


@query(f"WITH {DISC}, planted AS (SELECT {', '.join(f'{v} AS {k}' for k, v in _PLANTED.items())}, release_date FROM disc) " + " UNION ALL ".join(f"SELECT '{k}' AS rule, count(*) FILTER ({v}) AS broken FROM planted" for k, v in _RULES.items()))
def rule_violations(spark, sf_dir):
    """Every rule over the fact table with cells that break it."""
    rows = disc(spark, sf_dir)
    return quality.violations(rows.withColumns({c: F.expr(e) for c, e in _PLANTED.items()}))


_FIELDS = ["artist", "song_name", "album_name", "release_date", "era", "genre"]


@query(f"WITH {DISC} " + " UNION ALL ".join(f"SELECT '{c}' AS field, count(*) FILTER ({c} = '') AS missing, round((count(*) - count(*) FILTER ({c} = '')) * 100.0 / count(*), 4) AS pct FROM disc{w}" for c, w in [*((f, "") for f in _FIELDS), ("track_position", " WHERE row_type = 'track'")]))
def completeness(spark, sf_dir):
    return quality.completeness(disc(spark, sf_dir))


@query(f"WITH {DISC} SELECT era, count(*) AS n, count(*) FILTER (spotify_url <> '') AS with_spotify, count(*) FILTER (youtube_url <> '') AS with_youtube, count(*) FILTER (spotify_url <> '' OR youtube_url <> '') AS with_any FROM disc GROUP BY era")
def coverage_by_era(spark, sf_dir):
    return quality.link_coverage(disc(spark, sf_dir))


@query(f"""WITH {DISC} SELECT count(*) AS albums, count(*) FILTER (chart_position <> '') AS with_chart, count(*) FILTER (awards <> '') AS with_awards FROM disc
WHERE row_type = 'album' AND release_category = 'original' AND CAST(substr(release_date, 1, 4) AS INT) BETWEEN 1995 AND 1998""")
def chart_subset(spark, sf_dir):
    return quality.chart_coverage(disc(spark, sf_dir), 1995, 1998)


@query(f"""WITH {DISC} SELECT artist, song_name, version_type, count(*) AS n, list_sort(list(_ord)) AS lines FROM disc WHERE release_category = 'original' GROUP BY ALL HAVING count(*) > 1""")
def multi_original(spark, sf_dir):
    return quality.several_originals(disc(spark, sf_dir), "_ord")


_TERM = "CASE substr(_ord, 1, 1) WHEN '0' THEN 'Funk, ' || genre WHEN '1' THEN genre || ' (Live)' WHEN '2' THEN 'Odd ' || genre ELSE genre END"


@query(f"""WITH {DISC}, t AS (SELECT trim(unnest(string_split({_TERM}, ','))) AS genre FROM disc)
SELECT genre, count(*) AS n, genre IN ({", ".join(repr(g) for g in schema.GENRES)}) OR {" OR ".join(f"ends_with(genre, {s!r})" for s in schema.GENRE_SUFFIXES)} AS allowed FROM t WHERE genre <> '' GROUP BY genre""")
def genre_terms(spark, sf_dir):
    """Genres of the fact table with planted terms: allowed ones, allowed by their ending, and unknown ones."""
    return quality.genre_terms(disc(spark, sf_dir).withColumn("genre", F.expr(_TERM)))


@query(rf"""WITH {DISC}, n AS (SELECT count(*) AS rows, (SELECT coalesce(CAST(sum(k - 1) AS BIGINT), 0) FROM (SELECT count(*) AS k FROM disc GROUP BY {_KEY})) AS excess,
 count(*) FILTER (row_type = 'track' AND NOT regexp_matches(track_position, '^\d+(/\d+)?$')) AS positions, count(*) FILTER (release_date <> '' AND NOT regexp_matches(release_date, '^\d{{4}}(-\d{{2}})?(-\d{{2}})?$')) AS dates,
 count(*) FILTER (row_type <> 'track' AND track_position <> '') AS stray, count(*) FILTER (row_type = 'track' AND regexp_matches(track_position, '^\d+$')) AS bare FROM disc),
planted AS (SELECT count(*) FILTER (first % 2 = 0) AS no_original, count(*) FILTER (same > 0 AND other > 0) AS mixed, (SELECT count(*) FROM documents WHERE doc_id % 97 = 5) AS covers FROM (
 SELECT min(doc_id) AS first, max(doc_id) AS last, count(*) FILTER (doc_id % 5 IN (1, 2)) AS same, count(*) FILTER (doc_id % 5 = 3) AS other FROM documents GROUP BY source, doc_id // 50) WHERE last % 3 > 0),
l AS (SELECT rows, excess, list_filter([CASE WHEN excess > 0 THEN 'Duplicate rows detected: ' || excess END, CASE WHEN positions > 0 THEN 'Invalid track_position rows: ' || positions END,
 CASE WHEN dates > 0 THEN 'Invalid release_date rows: ' || dates END], lambda x: x IS NOT NULL) AS issues,
 list_sort(list_filter([CASE WHEN stray > 0 THEN 'Non-track row has track_position' END, CASE WHEN bare > 0 THEN 'Track rows with bare digit track_position (no total): ' || bare END,
 CASE WHEN no_original > 0 THEN 'Duplicate high-confidence clusters missing original candidate: ' || no_original END,
 CASE WHEN mixed > 0 THEN 'Duplicate high-confidence clusters contain mixed same_master and variant version_type values: ' || mixed END,
 CASE WHEN covers > 0 THEN 'Duplicate detector cross-artist probable cover/interpolation pairs: ' || covers END,
 'Tracking file of the search log not found -- skipping tracking checks'], lambda x: x IS NOT NULL)) AS warnings FROM n, planted)
SELECT CASE WHEN len(issues) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, issues, warnings, rows, excess FROM l""")
def quality_status(spark, sf_dir):
    """All gates over the fact table, its star schema and duplicate clusters planted in the documents."""
    rows, docs = disc(spark, sf_dir), table(spark, sf_dir, "documents")
    tables = catalog.keys(rows)
    clusters = docs.groupBy("source", F.expr("doc_id div 50").alias("part")).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.collect_list("doc_id").alias("members"))
    clusters = clusters.select(
        F.concat_ws(":", F.coalesce("source", F.lit("none")), "part").alias("cluster_id"), F.when(F.col("last") % 3 > 0, "high").otherwise("low").alias("cluster_confidence"),
        F.when(F.col("first") % 2 == 1, F.col("first")).alias("original"), "members",
    )
    kind = F.col("doc_id") % 5
    items = docs.select(F.col("doc_id").alias("n"), F.when(kind == 1, "same_master").when(kind == 2, " Same_Master").when(kind == 3, "live").otherwise("").alias("version_type"))
    pairs = docs.select(F.lit("high").alias("confidence_band"), F.when(F.col("doc_id") % 97 == 5, "probable_cover_or_interpolation").otherwise("uncertain").alias("relation_class"))
    report = quality.report_of(clusters, items, pairs)
    return quality.gates(rows, tables, full=report, high=report).select("status", "issues", "warnings", "rows", "excess")


@query("""WITH p AS (SELECT page_id, url, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host, regexp_extract(url, '^[a-z]+://[^/?#]*([^#]*)', 1) AS path FROM pages)
SELECT page_id, url FROM p WHERE NOT (coalesce(ends_with(host, '.com') OR ends_with(host, '.net'), false) AND (starts_with(path, '/en/1') OR (starts_with(path, '/de/') AND NOT starts_with(path, '/de/2')) OR starts_with(path, '/fr/3')))""")
def robots_gate(spark, sf_dir):
    """Pages that the stored rules of their hosts permit: the first rule decides, so nothing opens a part of /en/1 again."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    hosts = pages.select(F.regexp_extract("url", r"^[a-z]+://([^/?#]*)", 1).alias("host")).distinct().filter(r"host rlike '\\.(com|net)$'")
    body = "User-agent: other\nDisallow: /\n\nUser-agent: *\nDisallow: /en/1 # no\nAllow: /en/12\nAllow: /de/2\nDisallow: /de/\nDisallow: /fr/3\n"
    return graph.permitted(pages, graph.robots_rules(hosts.withColumn("body", F.lit(body))), agent="catbot/1.0")


@query("""WITH l AS (SELECT DISTINCT CASE WHEN doc_id % 3 = 0 THEN 'album' ELSE 'track' END AS kind, md5(coalesce(text, '')) AS id FROM documents),
m AS (SELECT CASE WHEN d.doc_id % 3 = 0 THEN 'album' ELSE 'track' END AS kind, md5(coalesce(text, '')) AS id FROM documents d JOIN labels USING (doc_id))
SELECT kind, id, (row_number() OVER (PARTITION BY kind ORDER BY id) - 1) // CASE WHEN kind = 'album' THEN 20 ELSE 50 END AS batch FROM l ANTI JOIN m USING (kind, id)""")
def fetch_batches(spark, sf_dir):
    """Calls to make for what the cache lacks: 50 tracks or 20 albums each."""
    docs = table(spark, sf_dir, "documents")
    links = docs.select("doc_id", F.when(F.col("doc_id") % 3 == 0, "album").otherwise("track").alias("kind"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("id"))
    return audit.missing_metadata(links, links.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi"))


def sentence(text="text"):
    """The title of a document: its first sentence, whole."""
    return text_functions.strip(F.regexp_extract(F.coalesce(F.col(text), F.lit("")), r"^\s*([^.!?\n]*)", 1))


def candidate_rows(spark, sf_dir):
    """Candidates of mixed quality from documents."""
    docs, k = table(spark, sf_dir, "documents"), F.col("doc_id") % 7
    line = sentence()
    return docs.select(
        "doc_id", F.when(k == 0, "").otherwise(F.col("source")).alias("artist"), F.when(k == 1, "").otherwise(F.col("lang")).alias("album_name"), F.when(k == 1, "").otherwise(line).alias("song_name"),
        F.when(k == 2, "1975-3").otherwise("1975-03").alias("release_date"), F.when(k == 3, F.repeat(F.lit("x"), 501)).otherwise("").alias("label"), F.when(k == 4, "session").otherwise("album").alias("row_type"),
        F.when(F.col("doc_id") % 2 == 0, "high").otherwise("low").alias("overall_confidence"), F.col("source").alias("sources"), F.lit(1).alias("source_count"),
        F.when(F.col("doc_id") % 11 == 0, "merged").otherwise("pending").alias("status"), F.lit("").alias("raw_extra"),
    )


@query(r"""SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'empty artist' WHEN doc_id % 7 = 1 THEN 'both song_name and album_name are empty' WHEN doc_id % 7 = 4 THEN 'invalid row_type ''session'''
 WHEN doc_id % 7 = 2 THEN 'invalid release_date format ''1975-3''' WHEN length(regexp_replace(regexp_extract(coalesce(text, ''), '^\s*([^.!?\n]*)', 1), '^\s+|\s+$', '', 'g')) > 500 THEN 'song_name exceeds 500 chars'
 WHEN doc_id % 7 = 3 THEN 'label exceeds 500 chars' END AS reason FROM documents""")
def candidate_validate(spark, sf_dir):
    return candidate_rows(spark, sf_dir).select("doc_id", consolidate.rejection().alias("reason"))


@query()
def merge_router(spark, sf_dir):
    """Candidates against a fact table of all benchmark items and altered copies of the labelled documents' titles."""
    rows = candidate_rows(spark, sf_dir)
    bench = table(spark, sf_dir, "benchmark").select(F.lit("").alias("artist"), sentence().alias("song_name"), F.lit("").alias("album_name"))
    labelled = rows.join(table(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id", "left_semi")
    fact = bench.unionByName(labelled.select("artist", F.concat("song_name", F.lit(" x")).alias("song_name"), "album_name"))
    return consolidate.routed(rows, fact).groupBy("route", "reason").agg(F.count(F.lit(1)).alias("n"))


def feed_rows(spark, sf_dir):
    """Discovery rows from documents: texts that occur several times come from several sources."""
    docs = table(spark, sf_dir, "documents")
    names = ["musicbrainz", "discogs", "spotify", "forums", "other"]
    source = F.element_at(F.array(*map(F.lit, names)), (F.col("doc_id") % 5 + 1).cast("int"))
    return docs.select(
        F.col("doc_id").alias("_ord"), F.lit("").alias("artist"), F.lit("").alias("album_name"), sentence().alias("song_name"),
        F.when(F.col("doc_id") % 3 == 0, "1975").otherwise("1976-01").alias("release_date"), F.when(F.col("doc_id") % 2 == 0, "L").otherwise("").alias("label"), F.lit("track").alias("row_type"),
        source.alias("discovery_source"), F.lit("").alias("source_url"), F.lit("low").alias("source_confidence"), F.lit("").alias("raw_extra"),
    )


@query()
def fuzzy_groups(spark, sf_dir):
    """Greedy groups of similar titles, consolidated and scored."""
    return consolidate.consolidated(feed_rows(spark, sf_dir)).select("_ord", "song_name", "release_date", "score", "overall_confidence", "sources", "source_count")


@query("""WITH w AS (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 0.9 WHEN 1 THEN 0.9 WHEN 2 THEN 0.7 WHEN 3 THEN 0.2 ELSE 0.1 END + (0.1 + CASE WHEN doc_id % 2 = 0 THEN 0.1 ELSE 0.0 END + 0.1) AS s FROM documents)
SELECT doc_id, least(round(CAST(s AS DOUBLE), 6), 1.0) AS score, CASE WHEN s >= 0.7 THEN 'high' WHEN s >= 0.4 THEN 'medium' ELSE 'low' END AS confidence FROM w""")
def confidence_score(spark, sf_dir):
    rows = feed_rows(spark, sf_dir)
    score = values.source_score(F.array("discovery_source"), ["release_date", "label", "row_type"], F.lit(False))
    return rows.select(F.col("_ord").alias("doc_id"), F.round(score, 6).alias("score"), values.confidence_of(score).alias("confidence"))


@query("""WITH a AS (SELECT l.doc_id, d.source AS artist, d.lang AS album_name, CAST(l.quality AS VARCHAR) AS label, CAST(l.toxic AS VARCHAR) AS row_type FROM labels l JOIN documents d USING (doc_id))
SELECT doc_id, 'label' AS field, label AS current_value, '1' AS proposed_value FROM a WHERE label <> '1' UNION ALL SELECT doc_id, 'row_type', row_type, '1' FROM a WHERE row_type <> '1'""")
def corrections_unpivot(spark, sf_dir):
    """Field differences between matched rows, long."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fact = labels.join(docs, "doc_id").select("doc_id", F.struct(F.col("source").alias("artist"), F.col("lang").alias("album_name"), F.lit("s").alias("song_name"), F.lit("").alias("release_date"),
                                              F.col("quality").cast("string").alias("label"), F.col("toxic").cast("string").alias("row_type")).alias("fact"))
    rows = fact.select("doc_id", "fact", F.col("fact.artist").alias("artist"), F.col("fact.album_name").alias("album_name"), F.lit("s").alias("song_name"), F.lit("").alias("release_date"), F.lit("1").alias("label"), F.lit("1").alias("row_type"),
                       F.array(F.col("doc_id").cast("string")).alias("sources"), F.lit("low").alias("overall_confidence"))
    return consolidate.corrections(rows).select(F.col("source").cast("long").alias("doc_id"), "field", "current_value", "proposed_value")


@query("""WITH RECURSIVE e AS (SELECT a.doc_id AS x, b.doc_id AS y FROM documents a JOIN documents b ON a.text = b.text AND a.doc_id <> b.doc_id),
r(node, seen) AS (SELECT x, x FROM e UNION SELECT r.node, e.y FROM r JOIN e ON r.seen = e.x)
SELECT node, min(seen) AS component FROM r GROUP BY node""")
def components(spark, sf_dir):
    """Connected components of documents with equal texts (edges to the first of each)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("t"))
    first = docs.groupBy("t").agg(F.min("doc_id").alias("first"))
    return connected_components(docs.join(first, "t"), "doc_id", "first")


@query(f"""WITH {DISC} SELECT _ord, CASE WHEN spotify_url = '' THEN 'track' END AS kind, CASE WHEN spotify_url = '' THEN song_name END AS title FROM disc WHERE spotify_url = '' AND row_type <> 'album'""")
def missing_links(spark, sf_dir):
    rows = disc(spark, sf_dir).filter((F.col("spotify_url") == "") & (F.col("row_type") != "album"))
    return rows.select("_ord", F.lit("track").alias("kind"), F.col("song_name").alias("title"))


@query(f"""WITH {DISC}, m AS (SELECT lower(p_name) AS t, max(p_partkey) AS k FROM part GROUP BY 1)
SELECT _ord, 'spotify_url' AS field_name, 'u' || k AS value FROM disc JOIN m ON t = trim(regexp_replace(lower(song_name), '[^a-z0-9]+', ' ', 'g')) WHERE spotify_url = '' AND row_type <> 'album'""")
def backfill_lookup(spark, sf_dir):
    """Links from a cache of search items, the last one per artist and title."""
    part = table(spark, sf_dir, "part")
    rows = disc(spark, sf_dir)
    item = F.struct(
        F.col("p_name").alias("name"), F.lit(1).cast("long").alias("duration_ms"), F.struct(F.concat(F.lit("u"), F.col("p_partkey").cast("string")).alias("spotify")).alias("external_urls"),
    )
    items = part.select(F.lpad(F.col("p_partkey").cast("string"), 12, "0").alias("file"), F.lit(0).alias("pos"), F.lit("track").alias("kind"), item.alias("i"))
    # all items name one artist: the keys differ by title
    links = enrich.link_map(items.select("file", "pos", "kind", F.struct("i.name", "i.duration_ms", "i.external_urls", F.array(F.struct(F.lit("any").alias("name"))).alias("artists")).alias("item")))
    return enrich.backfill_links(rows.withColumn("artist", F.lit("any")), links)


@query(f"""WITH {DISC}, p AS (SELECT _ord, min(substr(_ord, 1, 4)) AS v FROM disc WHERE substr(_ord, 1, 1) < '8' GROUP BY _ord)
SELECT disc._ord, CASE WHEN spotify_url <> '' THEN spotify_url WHEN v IS NOT NULL THEN 'p' || v ELSE '' END AS spotify_url, CASE WHEN awards <> '' THEN awards WHEN v IS NOT NULL THEN 'first' ELSE '' END AS awards
FROM disc LEFT JOIN p ON disc._ord = p._ord""")
def sidecar_apply(spark, sf_dir):
    """Long patches: the first writer of an empty cell wins, unknown columns and filled cells are left alone."""
    rows = disc(spark, sf_dir)
    keys = rows.filter(F.substring("_ord", 1, 1) < "8").select(F.col("_ord").alias("row_index")).distinct()
    each = lambda f, v, file, line: keys.select("row_index", F.lit(f).alias("field_name"), v.alias("value"), F.lit(file).alias("file"), F.lit(line).alias("line"))
    link = F.concat(F.lit("p"), F.substring("row_index", 1, 4))
    patches = each("spotify_url", link, "b", 0).unionByName(each("awards", F.lit("second"), "b", 1)).unionByName(each("awards", F.lit("first"), "a", 9))
    patches = patches.unionByName(each("nothing", F.lit("x"), "a", 1)).unionByName(each("notes", F.lit(" "), "a", 2))
    return enrich.apply_patches(rows, patches).select("_ord", "spotify_url", "awards")


@query(f"""WITH {DISC} SELECT _ord, CASE WHEN spotify_url <> '' THEN 'track' END AS kind, CASE WHEN spotify_url <> '' THEN split_part(spotify_url, '/', 5) END AS id,
 CASE WHEN row_type = 'album' THEN 'album' ELSE 'track' END AS expected FROM disc""")
def link_parse(spark, sf_dir):
    link = text.link_parts("spotify_url")
    return disc(spark, sf_dir).select("_ord", link["kind"].alias("kind"), link["id"].alias("id"), text.expected_link_type("row_type").alias("expected"))


@query("""WITH s AS (SELECT event_id, (event_id * 37 % 100) / 100.0 AS t, (event_id * 53 % 100) / 100.0 AS a, event_id % 10 = 0 AS m FROM events)
SELECT event_id, CASE WHEN m OR t < 0.35 OR a < 0.25 THEN 'high' WHEN t < 0.55 OR a < 0.4 THEN 'medium' ELSE 'low' END AS severity, m OR t < 0.35 OR a < 0.25 OR (t < 0.5 AND a < 0.35) AS quarantine,
 list_filter([CASE WHEN m THEN 'url_type_mismatch' END, CASE WHEN t < 0.55 THEN 'low_title_similarity' END, CASE WHEN a < 0.4 THEN 'low_artist_similarity' END], lambda x: x IS NOT NULL) AS reasons FROM s""")
def severity(spark, sf_dir):
    """Severity, recommendation and reasons of scored links."""
    k = F.col("event_id")
    t, a, m = (k * 37 % 100) / 100.0, (k * 53 % 100) / 100.0, k % 10 == 0
    return table(spark, sf_dir, "events").select(
        "event_id", values.severity(m, t, a).alias("severity"), values.quarantine(m, t, a).alias("quarantine"), values.reason_codes(m, t, a).alias("reasons")
    )


def _scores(spark, sf_dir):
    rows = disc(spark, sf_dir).filter("spotify_url <> ''").withColumn("row_number", _hex(1, 14))
    k = _hex(15, 6)
    scored = rows.withColumn("title_score", (k % 100) / 100.0).withColumn("artist_score", (F.floor(k / 100) % 100) / 100.0)
    return scored.withColumn("type_mismatch", F.col("row_type") == "album").dropDuplicates(["row_number"])


_SCORED = f"""{DISC}, s AS (SELECT DISTINCT ON (row_number) *, ('0x' || substr(_ord, 1, 14))::BIGINT AS row_number, (('0x' || substr(_ord, 15, 6))::BIGINT % 100) / 100.0 AS t,
 ((('0x' || substr(_ord, 15, 6))::BIGINT // 100) % 100) / 100.0 AS a, row_type = 'album' AS m FROM disc WHERE spotify_url <> '')"""
_ERAS = "CASE era " + " ".join(f"WHEN '{e}' THEN {w}" for e, w in schema.ERA_WEIGHTS.items()) + " ELSE 1 END"


@query(f"""WITH {_SCORED}, q AS (SELECT row_number, t, a, CAST({_ERAS} + CASE row_type WHEN 'album' THEN 4 WHEN 'single' THEN 3 ELSE 2 END AS DOUBLE) AS impact_score,
 round(CAST((1 - t) * 3 + (1 - a) * 2 + CASE WHEN a < 0.4 THEN 1.5 ELSE 0 END AS DOUBLE), 4) AS mismatch_score FROM s WHERE NOT (m OR t < 0.35 OR a < 0.25) AND (t < 0.55 OR a < 0.4)),
p AS (SELECT *, round(impact_score * 0.65 + mismatch_score * 0.35, 4) AS priority_score FROM q)
SELECT row_number, priority_score, impact_score, mismatch_score, CASE WHEN a < 0.4 THEN 'verify_artist_match_first' WHEN t < 0.55 AND a >= 0.85 THEN 'check_alt_title_or_version' ELSE 'manual_track_search' END AS review_action,
 CAST(row_number() OVER (ORDER BY priority_score DESC, p.row_number) AS INT) AS priority_rank FROM p""")
def mismatch_queue(spark, sf_dir):
    """Review queue of medium findings with ranks."""
    found = audit.findings(_scores(spark, sf_dir))
    queue = audit.medium_queue(found, found)
    return queue.select("row_number", "priority_score", "impact_score", "mismatch_score", "review_action", "priority_rank")


_BAD = "(m OR t < 0.35 OR a < 0.25 OR (t < 0.5 AND a < 0.35))"


@query(f"""WITH {_SCORED} SELECT row_number, CASE WHEN {_BAD} THEN '' ELSE spotify_url END AS spotify_url, CASE WHEN {_BAD} THEN 'needs_research' ELSE 'found' END AS spotify_status,
 CASE WHEN {_BAD} THEN 'low' ELSE 'high' END AS confidence_level, CASE WHEN {_BAD} THEN 1 ELSE 0 END AS n_history FROM s""")
def link_quarantine(spark, sf_dir):
    """Recommended links cleared, log entries downgraded."""
    rows = _scores(spark, sf_dir)
    entries = rows.select("row_number", F.lit("found").alias("spotify_status"), F.lit("high").alias("confidence_level"), F.lit("").alias("last_search_date"), F.array().cast("array<" + reconcile.EVENT.simpleString() + ">").alias("search_history"))
    cleared, log = audit.quarantined(rows, audit.findings(rows), entries, F.lit("2024-02-01"))
    both = cleared.select("row_number", "spotify_url").join(log, "row_number")
    return both.select("row_number", "spotify_url", "spotify_status", "confidence_level", F.size("search_history").alias("n_history"))


_GAP = "CASE era " + " ".join(f"WHEN '{e}' THEN {w}" for e, w in schema.ERA_WEIGHTS.items()) + " ELSE 1 END + CASE row_type WHEN 'album' THEN 4 WHEN 'single' THEN 3 ELSE 1 END + CASE WHEN spotify_url <> '' THEN 1.5 ELSE 0.0 END"


@query(f"WITH {DISC} SELECT _ord, CAST({_GAP} AS DOUBLE) AS priority_score FROM disc WHERE youtube_url = '' ORDER BY priority_score DESC, _ord LIMIT 95")
def gap_queue(spark, sf_dir):
    """The day's quota of rows without a video link, by priority."""
    return audit.gap_queue(disc(spark, sf_dir), 95).select("_ord", "priority_score")


@query("""WITH c AS (SELECT DISTINCT l_suppkey AS s_suppkey, l_partkey AS p_partkey, (l_suppkey * l_partkey) % 101 AS score FROM lineitem)
SELECT s_suppkey, max(score) / 100.0 AS score, arg_max(p_partkey, row(score, -p_partkey)) AS p_partkey FROM c WHERE score > 0 GROUP BY s_suppkey""")
def best_candidate(spark, sf_dir):
    """Best of the parts a supplier delivers, the first on ties."""
    pairs = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("s_suppkey"), F.col("l_partkey").alias("p_partkey")).distinct()
    rows = pairs.select("s_suppkey", "p_partkey", ((F.col("s_suppkey") * F.col("p_partkey")) % 101 / 100.0).alias("score"), F.lit(0).alias("query_pos"), F.col("p_partkey").alias("pos"))
    return enrich.best_candidate(rows, "s_suppkey").select("s_suppkey", "score", "p_partkey")


@query("""SELECT conv_id, arg_min(text, turn) AS url FROM conversations WHERE text <> '' GROUP BY conv_id""")
def first_hit(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.lit(0).alias("query_pos"), F.col("turn").alias("pos"), F.col("text").alias("url"))
    return enrich.first_hit(rows, "conv_id")


@query(r"""WITH d AS (SELECT lang, list_sort(list_distinct(flatten(list(string_split(lower(split_part(text, chr(10), 1)), ' '))))) AS w FROM documents GROUP BY lang), b AS (SELECT list_sort(list_distinct(flatten(list(string_split(lower(text), ' '))))) AS w FROM benchmark)
SELECT lang, CAST(len(list_intersect(d.w, b.w)) AS BIGINT) AS matched, round(100.0 * len(list_intersect(d.w, b.w)) / len(d.w), 2) AS rate FROM d, b""")
def set_coverage(spark, sf_dir):
    """How many of a language's first-line words occur in the benchmark."""
    words = lambda df, c, keys: df.select(*keys, F.explode(F.split(F.lower(c), " ")).alias("w")).distinct()
    docs = words(table(spark, sf_dir, "documents"), F.split_part("text", F.lit("\n"), F.lit(1)), ["lang"])
    bench = words(table(spark, sf_dir, "benchmark"), F.col("text"), []).withColumn("hit", F.lit(1))
    return docs.join(bench, "w", "left").groupBy("lang").agg(F.count("hit").alias("matched"), F.round(100.0 * F.count("hit") / F.count(F.lit(1)), 2).alias("rate"))


@query("""WITH t AS (SELECT DISTINCT lower(p_name) AS name, list_sort(list_distinct(string_split(lower(p_name), ' '))) AS w FROM part)
SELECT a.name AS left_name, b.name AS right_name, len(list_intersect(a.w, b.w)) / CAST(len(list_distinct(list_concat(a.w, b.w))) AS DOUBLE) AS overlap
FROM t a JOIN t b ON a.name < b.name WHERE len(list_intersect(a.w, b.w)) > 0""")
def jaccard_pairs(spark, sf_dir):
    """Token overlap of distinct part names that share a token; a part belongs to its name in lower case."""
    names = table(spark, sf_dir, "part").select(F.lower("p_name").alias("name")).distinct()
    return blocking.overlap_pairs(names, "name")


@query(f"""WITH {_SCORED} SELECT CASE WHEN m OR t < 0.35 OR a < 0.25 THEN 'high' WHEN t < 0.55 OR a < 0.4 THEN 'medium' ELSE 'low' END AS severity, count(*) AS n, count(*) FILTER ({_BAD}) AS quarantined
FROM s GROUP BY 1""")
def severity_counts(spark, sf_dir):
    """Scored links by severity, and how many of each are to be cleared."""
    return audit.severity_counts(_scores(spark, sf_dir))


def title_rows(spark, sf_dir):
    """Titles from the first sentences of documents, with altered copies of some."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", sentence().alias("t")).filter("t <> ''")
    copies = docs.filter("doc_id % 5 = 0").select(F.col("doc_id") + 10_000_000, "source", F.concat("t", F.lit("x (Live)")))
    lists = docs.filter("doc_id % 7 = 0").select(F.col("doc_id") + 20_000_000, F.lit("other"), F.concat("t", F.lit(" / Second Long Piece")))
    every = docs.unionByName(copies.toDF("doc_id", "source", "t")).unionByName(lists.toDF("doc_id", "source", "t"))
    given = {"artist": F.col("source"), "song_name": F.col("t"), "row_type": F.lit("track"), "version_type": F.lit("same_master"), "release_date": F.lit("1975")}
    return every.select(F.col("doc_id").alias("row_number"), *[given.get(c, F.lit("")).alias(c) for c in schema.FACT])


@query()
def duplicate_counts(spark, sf_dir):
    """Classified title pairs by type, relation and confidence."""
    return duplicate_classes.counts(duplicates.entries(title_rows(spark, sf_dir)))


@query()
def duplicate_clusters(spark, sf_dir):
    """Clusters of certain pairs with their originals."""
    items = duplicates.entries(title_rows(spark, sf_dir))
    found = duplicate_classes.clusters(items)
    return found.select("cluster_id", "cluster_confidence", "pair_count", "subtype_tags", F.col("original.n").alias("original"), "members")


@query(r"""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(json_extract(props, '$.k') AS BIGINT) IS NOT NULL AS has_k FROM events""")
def nested_json(spark, sf_dir):
    """A typed view of JSON cells."""
    parsed = F.from_json("props", "k bigint")
    return table(spark, sf_dir, "events").select("event_id", parsed["k"].alias("k"), parsed["k"].isNotNull().alias("has_k"))


@query("""SELECT conv_id, len(list(role)) AS n, list(role ORDER BY turn) AS roles FROM conversations GROUP BY conv_id""")
def history_append(spark, sf_dir):
    """Events in order, gathered per conversation."""
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("x"))
    return rows.select("conv_id", F.size("x").cast("long").alias("n"), F.col("x.role").alias("roles"))


@query(r"""SELECT page_id, unnest(regexp_extract_all(html, '<a\s[^>]*href="([^"]*)"', 1)) AS href FROM pages""")
def page_links(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.explode(extract.hrefs("html")).alias("href"))


@query()
def page_rows(spark, sf_dir):
    """Pages through the extractor for titled pages."""
    pages = table(spark, sf_dir, "pages").select("url", F.col("html").alias("body"))
    return extract.page_rows(pages, F.lit("titled"), source="pages", kinds=("titled",))


@query("""WITH l AS (SELECT doc_id, unnest(range(0, len(string_split(text, chr(10))))) AS pos, unnest(string_split(text, chr(10))) AS line FROM documents),
h AS (SELECT *, CASE WHEN length(line) < 40 THEN 1 ELSE 0 END AS head FROM l)
SELECT doc_id, pos, sum(head) OVER (PARTITION BY doc_id ORDER BY pos) AS section FROM h""")
def line_sections(spark, sf_dir):
    """Lines of documents with a running section number, as headings are carried down."""
    from pyspark.sql.window import Window

    rows = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    order = Window.partitionBy("doc_id").orderBy("pos")
    return rows.select("doc_id", F.col("pos").cast("long").alias("pos"), F.sum(F.when(F.length("line") < 40, 1).otherwise(0)).over(order).alias("section"))


@query("""WITH RECURSIVE e(src, dst) AS (SELECT 'r' || n_regionkey, 'n' || n_nationkey FROM nation UNION ALL SELECT 'n' || s_nationkey, 's' || s_suppkey FROM supplier UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer),
w(node, depth) AS (SELECT 'r' || r_regionkey, 0 FROM region WHERE r_regionkey < 2 UNION SELECT e.dst, w.depth + 1 FROM w JOIN e ON e.src = w.node WHERE w.depth < 2)
SELECT node, CAST(min(depth) AS INT) AS depth FROM w GROUP BY node""")
def bfs_reach(spark, sf_dir):
    """Everything within two steps of two regions."""
    key = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    nation, supplier, customer, region = (table(spark, sf_dir, n) for n in ("nation", "supplier", "customer", "region"))
    edges = nation.select(key("r", "n_regionkey").alias("src"), key("n", "n_nationkey").alias("dst"))
    edges = edges.unionByName(supplier.select(key("n", "s_nationkey").alias("src"), key("s", "s_suppkey").alias("dst")))
    edges = edges.unionByName(customer.select(key("n", "c_nationkey").alias("src"), key("c", "c_custkey").alias("dst")))
    return graph.reachable(edges, region.filter("r_regionkey < 2").select(key("r", "r_regionkey").alias("node")), 2)


@query("SELECT event_type, user_id, min(event_id) AS event_id FROM events GROUP BY event_type, user_id")
def incremental_dedupe(spark, sf_dir):
    """Keep-first over an incremental intake, in one available-now run."""
    from catloom.streaming import intake

    return intake.run_once(spark, f"{sf_dir}/events.parquet", ["event_type", "user_id"], "event_id")


@query("""SELECT source, lang, count(*) AS n FROM documents GROUP BY GROUPING SETS ((source), (lang))""")
def grouped_counts(spark, sf_dir):
    """Counts by several keys in one pass."""
    docs = table(spark, sf_dir, "documents")
    return docs.groupingSets([["source"], ["lang"]], "source", "lang").agg(F.count(F.lit(1)).alias("n"))


@query()
def fuzzy_exists(spark, sf_dir):
    """First sentences of documents that a benchmark item's sentence, whole or without its first word, resembles."""
    docs = table(spark, sf_dir, "documents").select(F.lower(sentence()).alias("t"))
    items = table(spark, sf_dir, "benchmark").select(F.explode(F.split(F.lower("text"), r"[.!?\n]")).alias("s")).select(text_functions.strip("s").alias("s"))
    known = items.unionByName(items.select(F.regexp_replace("s", r"^\S+\s+", "").alias("s"))).select(F.col("s").alias("known")).distinct()
    return blocking.similar_pairs(docs.distinct(), known, "t", "known", 0.85).select("t").distinct()
