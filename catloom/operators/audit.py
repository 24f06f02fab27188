"""Link audit: scoring against cached metadata, quarantine and review queues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catloom.functions import text, values
from catloom.functions.similarity import artist_similarity, title_similarity
from catloom.functions.text import strip
from catloom.operators.reconcile import EVENT, appended
from catloom.runtime import cut

META = T.MapType(T.StringType(), T.StructType([T.StructField("name", T.StringType()), T.StructField("artists", T.ArrayType(T.StringType())), T.StructField("album_name", T.StringType())]))


def metadata(documents: DataFrame, json_col: str, kind: str) -> DataFrame:
    """``kind, id, name, artists`` from documents that map ids to metadata; what is not JSON counts as empty."""
    listed = documents.select(F.explode(F.from_json(json_col, META)).alias("id", "m")).filter("m is not null")
    return listed.select(F.lit(kind).alias("kind"), "id", "m.name", "m.artists")


def linked(rows: DataFrame) -> DataFrame:
    """Rows with a parseable streaming link: ``kind`` and ``id`` beside the row."""
    return rows.withColumn("link", text.link_parts(strip("spotify_url"))).filter("link is not null").select("*", "link.kind", "link.id").drop("link")


#: Entities that the service takes in one call.
BATCHES = {"track": 50, "album": 20}


def missing_metadata(links: DataFrame, meta: DataFrame, batches: dict[str, int] | None = None) -> DataFrame:
    """Entities to fetch: ``kind, id, batch``; batches of a kind are numbered from 0 and full but for the last, and hold one kind."""
    sizes = F.create_map(*[F.lit(x) for item in (batches or BATCHES).items() for x in item])
    wanted = links.select("kind", "id").filter("id is not null").distinct().join(meta.select("kind", "id"), ["kind", "id"], "left_anti")
    numbered = ranked(wanted, [F.asc("kind"), F.asc("id")], "rank")
    starts = numbered.groupBy("kind").agg(F.min("rank").alias("start"))  # a row per kind
    place = F.col("rank") - F.col("start")
    return numbered.join(F.broadcast(starts), "kind").select("kind", "id", F.floor(place / F.coalesce(F.try_element_at(sizes, F.col("kind")), F.lit(50))).cast("long").alias("batch"))


def scored(links: DataFrame, meta: DataFrame) -> DataFrame:
    """Links with metadata and their similarity scores; links without metadata go."""
    known = links.join(meta, ["kind", "id"]).withColumn("type_mismatch", F.col("kind") != text.expected_link_type("row_type"))
    expected = F.when(F.col("row_type") == "album", strip("album_name")).otherwise(strip("song_name"))
    out = known.withColumn("expected_title", expected)
    out = out.withColumn("title_score", title_similarity(F.col("expected_title"), F.col("name")))
    return out.withColumn("artist_score", artist_similarity(F.col("artist"), F.col("artists")))


def findings(scores: DataFrame) -> DataFrame:
    """Suspicious links with severity, reasons and recommendation."""
    mismatch, title, artist = F.col("type_mismatch"), F.col("title_score"), F.col("artist_score")
    return (
        scores.filter(values.suspicious(mismatch, title, artist))
        .withColumn("severity", values.severity(mismatch, title, artist))
        .withColumn("reason_codes", values.reason_codes(mismatch, title, artist))
        .withColumn("quarantine_recommended", values.quarantine(mismatch, title, artist))
        .withColumn("title_score", F.round("title_score", 4))
        .withColumn("artist_score", F.round("artist_score", 4))
    )


def report_order(found: DataFrame) -> DataFrame:
    return found.orderBy("severity", "title_score", "artist_score", "row_number")


def quarantined(rows: DataFrame, found: DataFrame, entries: DataFrame, today: Column) -> tuple[DataFrame, DataFrame]:
    """Rows with recommended links cleared, and log entries downgraded with an event appended."""
    bad = found.filter("quarantine_recommended").select("row_number", F.col("reason_codes").alias("__codes"))
    joined = rows.join(bad, "row_number", "left")
    hit = F.col("__codes").isNotNull() & (strip("spotify_url") != "")
    cleared = joined.withColumn("spotify_url", F.when(hit, "").otherwise(F.col("spotify_url"))).drop("__codes")
    events = joined.filter(hit).select("row_number", strip("spotify_url").alias("__previous"), "__codes")
    log = entries.join(events, "row_number", "left")
    changed = F.col("__previous").isNotNull()
    event = F.struct(
        today.alias("date"), F.lit("Spotify Quarantine").alias("round"), F.lit("mismatch_audit").alias("method"), F.lit("quarantined").alias("result"),
        F.lit(None).cast("double").alias("score"), F.col("__previous").alias("previous_url"), F.col("__codes").alias("reason_codes"),
    ).cast(EVENT)
    log = (
        log.withColumn("spotify_status", F.when(changed, "needs_research").otherwise(F.col("spotify_status")))
        .withColumn("confidence_level", F.when(changed, "low").otherwise(F.col("confidence_level")))
        .withColumn("last_search_date", F.when(changed, today).otherwise(F.col("last_search_date")))
        .withColumn("search_history", F.when(changed, appended(F.col("search_history"), event)).otherwise(F.col("search_history")))
    )
    return cleared, log.drop("__previous", "__codes")


def medium_queue(found: DataFrame, rows: DataFrame) -> DataFrame:
    """Findings of medium severity by blended priority, ties by row number, ranked from 1."""
    base = rows.select("row_number", F.col("era").alias("__era"), F.col("artist").alias("__artist"))
    queue = found.filter((F.col("severity") == "medium") & (F.col("row_number") > 1)).join(base, "row_number", "left")
    impact = values.impact_score("__era", "row_type", "__artist")
    mismatch = values.mismatch_score(F.col("title_score"), F.col("artist_score"), F.col("type_mismatch"), F.col("reason_codes"))
    queue = queue.withColumn("impact_score", impact).withColumn("mismatch_score", mismatch)
    queue = queue.withColumn("priority_score", F.round(F.col("impact_score") * 0.65 + F.col("mismatch_score") * 0.35, 4))
    queue = queue.withColumn("review_action", values.review_action(F.col("reason_codes"), F.col("artist_score")))
    return ranked(queue.drop("__era", "__artist"), [F.desc("priority_score"), F.asc("row_number")], "priority_rank")


def ranked(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Rows numbered from 1 in a total order: sorted ranges, each numbered from where the ones before it end."""
    from pyspark.sql.window import Window

    # cut, so that the ranges that are counted are the ranges that are numbered
    marked = cut(rows.orderBy(*order).withColumn("__id", F.monotonically_increasing_id()))
    part = F.shiftright("__id", 33)
    sizes = marked.groupBy(part.alias("__p")).agg(F.count(F.lit(1)).alias("n"), F.min("__id").alias("__first"))
    # one row per range: the only thing that is ordered as a whole
    before = F.coalesce(F.sum("n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("__p", "__first", before.alias("__before"))
    joined = marked.join(F.broadcast(starts), part == F.col("__p"))
    return joined.withColumn(name, F.col("__before") + F.col("__id") - F.col("__first") + 1).drop("__id", "__p", "__first", "__before")


def gap_queue(rows: DataFrame, limit: int | None = None, order_col: str = "_ord") -> DataFrame:
    """Rows without a video link by priority, in row order on ties; ``limit`` is the day's quota."""
    open_rows = rows.filter(strip("youtube_url") == "").withColumn("priority_score", values.gap_priority("era", "row_type", "spotify_url"))
    ordered = open_rows.orderBy(F.desc("priority_score"), order_col)
    return ordered.limit(limit) if limit is not None else ordered


def severity_counts(scored: DataFrame) -> DataFrame:
    """``severity, n, quarantined`` over scored links."""
    m, t, a = F.col("type_mismatch"), F.col("title_score"), F.col("artist_score")
    return scored.groupBy(values.severity(m, t, a).alias("severity")).agg(F.count(F.lit(1)).alias("n"), F.count_if(values.quarantine(m, t, a)).alias("quarantined"))
