"""Enrichment from caches: lookups, best candidates and additive patches. Nothing here overwrites a value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catloom import schema
from catloom.functions import text, values
from catloom.functions.similarity import sequence_ratio
from catloom.functions.text import norm_cache, norm_strict, strip

_NAMED = T.StructType([T.StructField("name", T.StringType())])
_LINKS = T.StructType([T.StructField("spotify", T.StringType())])
ITEM = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("duration_ms", T.LongType()), T.StructField("external_urls", _LINKS),
     T.StructField("artists", T.ArrayType(_NAMED)), T.StructField("album", _NAMED)]
)
_PAGE = T.StructType([T.StructField("items", T.ArrayType(ITEM))])
PAYLOAD = T.StructType([T.StructField("tracks", _PAGE), T.StructField("albums", _PAGE)])
_CREDIT = T.StructType([T.StructField(n, T.StringType()) for n in ("name", "anv", "role", "id")])
RELEASE = T.StructType(
    [T.StructField("extraartists", T.ArrayType(_CREDIT)),
     T.StructField("tracklist", T.ArrayType(T.StructType([T.StructField("position", T.StringType()), T.StructField("extraartists", T.ArrayType(_CREDIT)), T.StructField("artists", T.ArrayType(_CREDIT))])))]
)


def cached_items(payloads: DataFrame, json_col: str = "payload", file_col: str = "file") -> DataFrame:
    """``file, pos, kind, item`` of all search payloads; wrong types and broken JSON give nothing."""
    parsed = payloads.select(F.col(file_col).alias("file"), F.from_json(json_col, PAYLOAD).alias("p"))
    of = lambda field, kind: parsed.select("file", F.lit(kind).alias("kind"), F.posexplode(f"p.{field}.items").alias("pos", "item"))
    return of("tracks", "track").unionByName(of("albums", "album")).filter("item is not null")


def link_map(items: DataFrame) -> DataFrame:
    """``kind, artist, title, url``; of several urls the last in file order wins."""
    url = F.col("item.external_urls.spotify")
    listed = items.filter(url != "").select("kind", "file", "pos", url.alias("url"), norm_cache("item.name").alias("title"), F.posexplode("item.artists").alias("apos", "a"))
    keyed = listed.withColumn("artist", norm_cache("a.name")).filter("artist <> '' and title <> ''")
    return keyed.groupBy("kind", "artist", "title").agg(F.max_by("url", F.struct("file", "pos", "apos")).alias("url"))


def duration_map(items: DataFrame) -> DataFrame:
    """``url, seconds`` of tracks with a positive duration; the last in file order wins."""
    url, ms = F.col("item.external_urls.spotify"), F.col("item.duration_ms")
    good = items.filter((F.col("kind") == "track") & (url != "") & (ms > 0))
    return good.select(url.alias("url"), values.seconds_of_ms(ms).alias("s"), "file", "pos").groupBy("url").agg(F.max_by("s", F.struct("file", "pos")).alias("seconds"))


def backfill_links(rows: DataFrame, links: DataFrame, order_col: str = "_ord") -> DataFrame:
    """Patches ``order, field_name, value`` for rows without a streaming link."""
    open_rows = rows.filter(strip("spotify_url") == "")
    album = F.col("row_type") == "album"
    keyed = open_rows.select(
        order_col, F.when(album, "album").otherwise("track").alias("kind"), norm_cache("artist").alias("artist"),
        F.when(album, norm_cache("album_name")).otherwise(norm_cache("song_name")).alias("title"),
    )
    return keyed.join(links, ["kind", "artist", "title"]).select(order_col, F.lit("spotify_url").alias("field_name"), F.col("url").alias("value"))


def backfill_durations(rows: DataFrame, durations: DataFrame, order_col: str = "_ord") -> DataFrame:
    """Patches for rows with a link and without a duration."""
    open_rows = rows.filter((strip("spotify_url") != "") & (strip("duration_seconds") == "")).select(order_col, strip("spotify_url").alias("url"))
    return open_rows.join(durations, "url").select(order_col, F.lit("duration_seconds").alias("field_name"), F.col("seconds").cast("string").alias("value"))


def apply_patches(rows: DataFrame, patches: DataFrame, order_col: str = "_ord", columns: list[str] | None = None) -> DataFrame:
    """Fill empty cells from long patches ``row_index, field_name, value`` (with ``file`` and ``line``).

    Of several patches of a cell the first by file and line wins. Patches of unknown columns, rows that do not
    exist, empty values and cells that hold something are ignored.
    """
    columns = columns or schema.FACT
    field = strip("field_name")
    good = patches.filter(field.isin(*columns) & (strip("value") != ""))
    good = good.select(F.col("row_index").try_cast(dict(rows.dtypes)[order_col]).alias("__row"), field.alias("f"), strip("value").alias("v"), "file", "line")
    wide = good.filter("__row is not null").groupBy("__row").agg(
        *[F.min_by(F.when(F.col("f") == c, F.col("v")), F.when(F.col("f") == c, F.struct("file", "line"))).alias(f"__{c}") for c in columns]
    )
    joined = rows.join(wide, F.col(order_col) == F.col("__row"), "left")
    filled = [F.when(strip(c) != "", F.col(c)).otherwise(F.coalesce(F.col(f"__{c}"), F.col(c))).alias(c) if c in columns else F.col(c) for c in rows.columns]
    return joined.select(*filled)


def lookup_keys(rows: DataFrame, namespace: str = "search", order_col: str = "_ord") -> DataFrame:
    """``order, query_pos, query, key``: the cache keys of a row's queries, most specific first."""
    queries = text.search_queries("artist", "song_name", "album_name", "row_type")
    listed = rows.select(order_col, F.posexplode(queries).alias("query_pos", "query"))
    return listed.withColumn("key", text.cache_key(namespace, "query"))


def first_hit(candidates: DataFrame, order_col: str = "_ord") -> DataFrame:
    """The first url by query, then position."""
    hits = candidates.filter("url <> ''")
    return hits.groupBy(order_col).agg(F.min_by("url", F.struct("query_pos", "pos")).alias("url"))


def best_candidate(candidates: DataFrame, order_col: str = "_ord") -> DataFrame:
    """The candidate of the highest score above 0; the first one on ties."""
    live = candidates.filter("score > 0")
    rank = F.struct(F.col("score"), -F.col("query_pos"), -F.col("pos"))
    return live.groupBy(order_col).agg(F.max_by(F.struct(*[c for c in candidates.columns if c != order_col]), rank).alias("best")).select(order_col, "best.*")


def score_candidates(rows: DataFrame, items: DataFrame, order_col: str = "_ord") -> DataFrame:
    """Scores of rows joined with their candidate items (``order, query_pos, pos, item``)."""
    joined = rows.select(order_col, "artist", "song_name", "album_name", "row_type").join(items, order_col)
    alike = lambda a, b: sequence_ratio(norm_strict(a), norm_strict(b))
    album = F.col("row_type") == "album"
    expected = F.when(album, F.col("album_name")).otherwise(F.col("song_name"))
    artist = F.coalesce(F.array_join(F.transform("item.artists", lambda x: F.coalesce(x["name"], F.lit(""))), "\x1f"), F.lit(""))
    out = joined.withColumn("title_score", alike(expected, F.col("item.name"))).withColumn("__names", artist)
    # one row per listed artist, the best one counts
    each = out.select("*", F.explode_outer(F.split("__names", "\x1f")).alias("__name")).withColumn("__s", F.when(F.col("__names") == "", 0.0).otherwise(alike(F.col("artist"), F.col("__name"))))
    best = each.groupBy(order_col, "query_pos", "pos").agg(
        F.first("row_type").alias("row_type"), F.first("title_score").alias("title_score"), F.max("__s").alias("artist_score"),
        F.first("album_name").alias("album_name"), F.first("item").alias("item"),
    )
    on_album = F.when(F.col("album_name") == "", 1.0).otherwise(alike(F.col("album_name"), F.col("item.album.name")))
    best = best.withColumn("album_score", F.when(F.col("row_type") == "album", 1.0).otherwise(on_album))
    total = F.when(F.col("row_type") == "album", values.album_score(F.col("title_score"), F.col("artist_score"))).otherwise(
        values.track_score(F.col("title_score"), F.col("artist_score"), F.col("album_score"))
    )
    return best.withColumn("score", total).withColumn("url", F.coalesce("item.external_urls.spotify", F.lit(""))).drop("album_name")


def accepted(best: DataFrame) -> DataFrame:
    """Best candidates good enough to be written."""
    good = values.accepted("row_type", F.col("score"), F.col("title_score"), F.col("artist_score"), F.col("album_score"))
    return best.filter(good & (F.col("url") != "")).withColumn("confidence_level", F.when(F.col("score") >= 0.93, "high").otherwise("medium"))


def personnel(details: DataFrame, json_col: str = "payload") -> DataFrame:
    """Credits of releases (columns ``release_id, discogs_release_id`` and the payload): three branches, one layout."""
    base = details.select("release_id", F.col("discogs_release_id").cast("string").alias("discogs_release_id"), F.from_json(json_col, RELEASE).alias("r"))
    whole = base.select("release_id", "discogs_release_id", F.lit("").alias("position"), F.explode("r.extraartists").alias("c"), F.lit(None).cast("string").alias("fixed"))
    tracks = base.select("release_id", "discogs_release_id", F.explode("r.tracklist").alias("t"))
    extra = tracks.select("release_id", "discogs_release_id", F.col("t.position").alias("position"), F.explode("t.extraartists").alias("c"), F.lit(None).cast("string").alias("fixed"))
    main = tracks.select("release_id", "discogs_release_id", F.col("t.position").alias("position"), F.explode("t.artists").alias("c"), F.lit("Performer").alias("fixed"))
    listed = whole.unionByName(extra).unionByName(main)
    out = listed.select(
        "release_id", strip("position").alias("track_position"), strip("c.name").alias("person_name"), strip("c.anv").alias("person_name_variant"),
        F.coalesce("fixed", strip("c.role")).alias("role"), F.coalesce("c.id", F.lit("")).alias("discogs_artist_id"), "discogs_release_id", F.lit("discogs").alias("source"),
    )
    return out.filter("person_name <> '' and role <> ''")


def fresh(cache: DataFrame, now: Column, days: int = 7, at: str = "fetched_at") -> DataFrame:
    """Cache rows younger than their time to live."""
    return cache.filter(F.col(at) > now - F.expr(f"interval {days} days"))


def not_cached(wanted: DataFrame, cache: DataFrame, key: str = "key") -> DataFrame:
    """What must be asked for: keys the cache has no answer to (empty answers count as answers)."""
    return wanted.join(cache.select(key).distinct(), key, "left_anti")


def remaining(rows: DataFrame, done: DataFrame, order_col: str = "_ord") -> DataFrame:
    """Rows that no earlier run has finished."""
    return rows.join(done.select(order_col).distinct(), order_col, "left_anti")


def first_page_match(artists: DataFrame, hits: DataFrame) -> DataFrame:
    """Per artist the first search hit; an equal discovery form makes it certain."""
    best = hits.groupBy("artist").agg(F.min_by(F.struct("id", "name"), "pos").alias("h"))
    same = text.norm_discovery("artist") == text.norm_discovery("h.name")
    return artists.join(best, "artist").select("artist", "h.id", "h.name", F.when(same, "high").otherwise("medium").alias("confidence"))


def _cached_candidates(rows: DataFrame, cache: DataFrame, namespace: str, order_col: str) -> DataFrame:
    """Items of all cached answers to a row's queries: ``order, query_pos, pos, item``."""
    asked = lookup_keys(rows, namespace, order_col).join(cache.select("key", "payload"), "key")
    parsed = asked.select(order_col, "query_pos", F.from_json("payload", PAYLOAD).alias("p"))
    items = F.concat(F.coalesce("p.tracks.items", F.array().cast(T.ArrayType(ITEM))), F.coalesce("p.albums.items", F.array().cast(T.ArrayType(ITEM))))
    return parsed.select(order_col, "query_pos", F.posexplode(items).alias("pos", "item")).filter("item is not null")


def first_hits(rows: DataFrame, cache: DataFrame, namespace: str = "search", order_col: str = "_ord", done: DataFrame | None = None) -> DataFrame:
    """First cached link of every row without one that no earlier run has finished: ``order, url``."""
    open_rows = rows.filter(strip("spotify_url") == "")
    if done is not None:
        open_rows = remaining(open_rows, done, order_col)
    found = _cached_candidates(open_rows, cache, namespace, order_col)
    return first_hit(found.select(order_col, "query_pos", "pos", F.coalesce("item.external_urls.spotify", F.lit("")).alias("url")), order_col)


def repopulate(rows: DataFrame, cache: DataFrame, entries: DataFrame, today: Column, namespace: str = "search", order_col: str = "row_number") -> tuple[DataFrame, DataFrame]:
    """Links certain enough fill empty cells; their log entries are raised and get an event."""
    from catloom.operators.reconcile import EVENT, appended

    open_rows = rows.filter(strip("spotify_url") == "")
    scored = score_candidates(open_rows, _cached_candidates(open_rows, cache, namespace, order_col), order_col)
    good = accepted(best_candidate(scored, order_col)).select(F.col(order_col).alias("__row"), F.col("url").alias("__url"), F.col("score").alias("__score"), F.col("confidence_level").alias("__level"))
    filled = rows.join(good, F.col(order_col) == F.col("__row"), "left")
    filled = filled.withColumn("spotify_url", F.coalesce("__url", "spotify_url")).select(*rows.columns)
    log = entries.join(good, F.col(order_col) == F.col("__row"), "left")
    hit = F.col("__row").isNotNull()
    event = F.struct(
        today.alias("date"), F.lit("Strict Repopulation").alias("round"), F.lit("strict_high_confidence_search").alias("method"), F.lit("found").alias("result"),
        F.round("__score", 4).alias("score"), F.lit(None).cast("string").alias("previous_url"), F.lit(None).cast("array<string>").alias("reason_codes"),
    ).cast(EVENT)
    log = (
        log.withColumn("spotify_status", F.when(hit, "found").otherwise(F.col("spotify_status")))
        .withColumn("confidence_level", F.coalesce("__level", "confidence_level"))
        .withColumn("last_search_date", F.when(hit, today).otherwise(F.col("last_search_date")))
        .withColumn("search_attempts", F.coalesce("search_attempts", F.lit(0)) + F.when(hit, 1).otherwise(0))
        .withColumn("search_history", F.when(hit, appended(F.col("search_history"), event)).otherwise(F.col("search_history")))
    )
    return filled, log.select(*entries.columns)


def video_links(rows: DataFrame, items: DataFrame, quota: int, order_col: str = "_ord") -> DataFrame:
    """Best video of the first ``quota`` rows of the gap queue, if it is good enough.

    ``items``: ``order, query_pos, pos, kind, video, playlist, title, channel``.
    """
    from catloom.operators.audit import gap_queue

    queue = gap_queue(rows, quota, order_col).select(order_col, "artist", "row_type", F.when(F.col("row_type") == "album", F.col("album_name")).otherwise(F.col("song_name")).alias("expected"))
    joined = queue.join(items, order_col).withColumn("url", text.video_url(F.coalesce("kind", F.lit("")), F.col("video"), F.col("playlist"))).filter("url <> ''")
    alike = lambda a, b: sequence_ratio(norm_strict(a), norm_strict(b))
    scored = joined.withColumn("title_sim", alike("expected", "title")).withColumn("channel_sim", alike("artist", "channel"))
    inside = F.contains(norm_strict("title"), norm_strict("artist"))
    scored = scored.withColumn("score", values.video_score(F.col("title_sim"), inside, F.col("channel_sim"), F.coalesce("channel", F.lit("")), F.coalesce("title", F.lit(""))))
    best = best_candidate(scored, order_col)
    return best.filter(F.col("score") >= F.when(F.col("row_type") == "album", 0.50).otherwise(0.55)).select(order_col, "url", "score")
