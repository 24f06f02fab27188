"""Quality gates: every rule is one predicate, every table is read in one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catloom import schema
from catloom.functions import ids, values
from catloom.functions.text import comma_list, strip, year_text
from catloom.runtime import cut, short_shuffles

POSITION = r"^\d+/\d+$"


def _said(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) != ""


def bad_genres(value: str = "genre") -> Column:
    """Genre terms outside the vocabulary and without an allowed suffix."""
    ends = lambda g: F.array(*[g.endswith(s) for s in schema.GENRE_SUFFIXES])
    terms = F.transform(F.split(F.col(value), ","), strip)
    return F.filter(terms, lambda g: ~g.isin(*schema.GENRES) & ~F.exists(ends(g), lambda x: x))


def rules() -> dict[str, Column]:
    """Name to predicate: true where a row breaks the rule."""
    track, position = F.col("row_type") == "track", strip("track_position")
    return {
        "row_type_unknown": _said("row_type") & ~F.col("row_type").isin(*schema.ROW_TYPES),
        "release_category_unknown": _said("release_category") & ~F.col("release_category").isin(*schema.CATEGORIES),
        "edition_type_unknown": _said("edition_type") & ~F.col("edition_type").isin(*schema.EDITIONS),
        "release_date_format": _said("release_date") & ~F.col("release_date").rlike(values.PARTIAL_DATE),
        "track_position_format": _said("track_position") & ~F.col("track_position").rlike(r"^\d+(/\d+)?$"),
        "track_position_missing": track & (position == ""),
        "track_position_bare": track & position.rlike(r"^\d+$"),
        "track_position_invalid": track & (position != "") & ~position.rlike(r"^\d+(/\d+)?$"),
        "position_without_track": ~track & (position != ""),
        "album_with_position": (F.col("row_type") == "album") & _said("track_position"),
        "artist_missing": ~_said("artist"),
        "era_missing": ~_said("era"),
        "era_unknown": _said("era") & ~F.col("era").isin(*schema.ERAS),
        "genre_missing": ~_said("genre"),
        "genre_unknown": _said("genre") & (F.size(bad_genres()) > 0),
        **{
            f"{c}_prefix": _said(c) & ~F.exists(F.array(*[F.col(c).startswith(p) for p in ps]), lambda x: x)
            for c, ps in schema.LINK_PREFIX.items()
        },
    }


def violations(rows: DataFrame) -> DataFrame:
    """``rule, broken`` for every rule, in one pass over the rows."""
    named = rules()
    one = rows.agg(*[F.count_if(p).alias(n) for n, p in named.items()])
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("broken")) for n in named])))


def samples(rows: DataFrame, row_number: str, limit: int = 10) -> DataFrame:
    """The first rows that break a rule, at most ``limit`` of each."""
    named = rules()
    broken = F.filter(F.array(*[F.when(p, n) for n, p in named.items()]), lambda x: x.isNotNull())
    from pyspark.sql.window import Window

    listed = rows.select(F.explode(broken).alias("rule"), F.col(row_number).alias("row_number"))
    rank = F.row_number().over(Window.partitionBy("rule").orderBy("row_number"))
    return listed.withColumn("k", rank).filter(F.col("k") <= limit).drop("k")


def duplicate_excess(rows: DataFrame) -> DataFrame:
    """Rows beyond the first of each dedupe key (one row)."""
    keys = ids.dedupe_hashes()
    return rows.select(*[c.alias(k) for k, c in keys.items()]).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("excess"))


def completeness(rows: DataFrame) -> DataFrame:
    """``field, missing, pct``; track positions count over tracks only."""
    fields = ["artist", "song_name", "album_name", "release_date", "era", "genre"]
    track = F.col("row_type") == "track"
    one = rows.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(track).alias("tracks"),
        *[F.count_if(~_said(c)).alias(c) for c in fields], F.count_if(track & ~_said("track_position")).alias("track_position"),
    )
    pct = lambda c, whole: values.percent(F.col(whole) - F.col(c), F.col(whole), 100.0)
    items = [(c, "n") for c in fields] + [("track_position", "tracks")]
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("missing"), F.round(pct(c, w), 4).alias("pct")) for c, w in items])))


def link_coverage(rows: DataFrame) -> DataFrame:
    """Linked rows per era."""
    a, b = _said("spotify_url"), _said("youtube_url")
    return rows.groupBy("era").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(a).alias("with_spotify"), F.count_if(b).alias("with_youtube"), F.count_if(a | b).alias("with_any")
    )


def chart_coverage(rows: DataFrame, first: int = 1970, last: int = 1985) -> DataFrame:
    """Chart and award entries among original albums of the given years (one row)."""
    year = year_text("release_date")
    major = rows.filter((F.col("row_type") == "album") & (F.col("release_category") == "original") & year.rlike(r"^\d+$") & year.try_cast("int").between(first, last))
    return major.agg(
        F.count(F.lit(1)).alias("albums"), F.count_if(_said("chart_position")).alias("with_chart"), F.count_if(_said("awards")).alias("with_awards")
    )


def several_originals(rows: DataFrame, row_number: str) -> DataFrame:
    """Recordings marked original more than once, with their lines."""
    found = rows.filter("release_category = 'original'").groupBy("artist", "song_name", "version_type")
    return found.agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(row_number)).alias("lines")).filter("n > 1")


def orphan_count(child: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key no parent has; a null key has none (one row)."""
    keys = parent.select(F.col(parent_key or key).alias("__k")).distinct()
    counted = child.groupBy(F.col(key).alias("__c")).agg(F.count(F.lit(1)).alias("n"))
    return counted.join(keys, F.col("__c") == F.col("__k"), "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("orphans"))


def _alone(counts: DataFrame) -> DataFrame:
    """Counts made at once, whose shuffle files go before the next ones are made."""
    with short_shuffles(counts.sparkSession):
        return cut(counts)


def log_alignment(rows: DataFrame, entries: DataFrame) -> DataFrame:
    """Whether log and rows agree in number, row numbers and hashes (one row)."""
    log = entries.agg(
        F.count(F.lit(1)).alias("entries"), F.count_distinct("row_number").alias("numbers"), (F.count("row_hash") - F.count_distinct("row_hash")).alias("collisions")
    )
    both = rows.agg(F.count(F.lit(1)).alias("rows")).join(log)
    return both.withColumn("aligned", (F.col("rows") == F.col("entries")) & (F.col("numbers") == F.col("rows")) & (F.col("collisions") == 0))


def duration_drift(tracks: DataFrame, limit: int = 3) -> DataFrame:
    """Tracks whose duration is more than ``limit`` seconds off their source release's same work, without a variant type."""
    seconds = F.col("duration_seconds").try_cast("int")
    base = tracks.select("track_id", "work_id", "release_id", "source_release_id", "version_type", seconds.alias("seconds"))
    source = base.groupBy(F.col("release_id").alias("r"), F.col("work_id").alias("w")).agg(F.min("seconds").alias("expected"))
    joined = base.join(source, (F.col("source_release_id") == F.col("r")) & (F.col("work_id") == F.col("w")))
    return joined.filter((F.abs(F.col("seconds") - F.col("expected")) > limit) & F.col("version_type").isin("", "same_master", "unknown")).select("track_id", "seconds", "expected")


def _message(text: str, n: Column) -> Column:
    return F.when(n > 0, F.concat(F.lit(text + ": "), n.cast("string")))


REPORT = (
    "clusters array<struct<original_candidate:string,members:array<struct<version_type:string>>>>, pairs array<string>,"
    " metrics struct<match_type_counts:struct<relation_class:struct<probable_cover_or_interpolation:int>>>"
)


def _mixed(versions: Column) -> Column:
    """Whether version types hold ``same_master`` beside another one; empty ones say nothing."""
    said = F.filter(F.transform(versions, lambda v: F.lower(strip(v))), lambda v: v != "")
    return F.array_contains(said, "same_master") & F.exists(said, lambda v: v != "same_master")


def stored_report(documents: DataFrame, payload: str = "payload") -> DataFrame:
    """Counts of a stored duplicate report, a JSON document (one row): ``valid, clusters, pairs, no_original, mixed, covers``.

    ``valid`` is null if there is no document, false if it is not JSON.
    """
    parsed = documents.select(F.from_json(payload, REPORT).alias("r"), F.expr(f"try_parse_json({payload})").isNotNull().alias("valid"))
    clusters = F.coalesce("r.clusters", F.from_json(F.lit("[]"), "array<struct<original_candidate:string,members:array<struct<version_type:string>>>>"))
    missing = F.filter(clusters, lambda c: F.coalesce(c["original_candidate"], F.lit("")).isin("", "{}", "[]", "0", "false", "null"))
    mixed = F.filter(clusters, lambda c: F.coalesce(_mixed(c["members"]["version_type"]), F.lit(False)))
    covers = F.coalesce("r.metrics.match_type_counts.relation_class.probable_cover_or_interpolation", F.lit(0))
    return parsed.agg(
        F.first("valid").alias("valid"), *[F.coalesce(F.sum(x), F.lit(0)).alias(n) for n, x in (
            ("clusters", F.size(clusters)), ("pairs", F.greatest(F.size(F.coalesce("r.pairs", F.array())), F.lit(0))), ("no_original", F.size(missing)), ("mixed", F.size(mixed)), ("covers", covers))],
    )


def report_of(clusters: DataFrame, items: DataFrame, pairs: DataFrame) -> DataFrame:
    """As :func:`stored_report`, of the tables themselves: high-confidence ``clusters`` (cluster_id, cluster_confidence, original,
    members), ``items`` (n, version_type) and ``pairs`` (confidence_band, relation_class)."""
    high = clusters.filter("cluster_confidence = 'high'")
    members = high.select("cluster_id", F.explode("members").alias("n")).join(items.select("n", F.lower(strip("version_type")).alias("v")), "n")
    kinds = members.filter("v <> ''").groupBy("cluster_id").agg(F.max(F.col("v") == "same_master").alias("same"), F.max(F.col("v") != "same_master").alias("other"))
    one = high.agg(F.count(F.lit(1)).alias("clusters"), F.count_if(F.col("original").isNull()).alias("no_original"))
    return (
        one.join(kinds.agg(F.count_if(F.col("same") & F.col("other")).alias("mixed")))
        .join(pairs.agg(F.count_if(F.col("confidence_band") == "high").alias("pairs"), F.count_if(F.col("relation_class") == "probable_cover_or_interpolation").alias("covers")))
        .select(F.lit(True).alias("valid"), "clusters", "pairs", "no_original", "mixed", "covers")
    )


def gates(
    rows: DataFrame,
    catalog: dict[str, DataFrame] | None = None,
    entries: DataFrame | None = None,
    personnel: DataFrame | None = None,
    full: DataFrame | None = None,
    high: DataFrame | None = None,
    header: list[str] | None = None,
    table_name: str = "the fact table",
    log_name: str = "of the search log",
) -> DataFrame:
    """``status, issues, warnings`` and the counts behind them (one row). Missing inputs become warnings.

    ``full`` and ``high``: counts of the whole and of the high-confidence duplicate report (:func:`stored_report`,
    :func:`report_of`); ``header``: the columns that the table's file had.
    """
    named = rules()
    missing, invalid = named["track_position_missing"], named["track_position_invalid"]
    one = _alone(rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(missing | invalid).alias("bad_position"), F.count_if(named["track_position_bare"]).alias("bare_position"),
        F.count_if(named["position_without_track"]).alias("stray_position"), F.count_if(named["release_date_format"]).alias("bad_date"),
    )).join(_alone(duplicate_excess(rows)))
    issues = [_message("Duplicate rows detected", F.col("excess")), _message("Invalid track_position rows", F.col("bad_position")), _message("Invalid release_date rows", F.col("bad_date"))]
    if header is not None and header != schema.FACT:
        issues.insert(0, F.lit(f"Schema header mismatch in {table_name}"))
    warnings = [F.when(F.col("stray_position") > 0, "Non-track row has track_position"), _message("Track rows with bare digit track_position (no total)", F.col("bare_position"))]
    if entries is None:
        warnings.append(F.lit(f"Tracking file {log_name} not found -- skipping tracking checks"))
    else:
        one = one.join(log_alignment(rows, entries).select("entries", "numbers", "collisions"))
        differ = F.concat(F.lit("Tracking entry mismatch: rows="), F.col("rows").cast("string"), F.lit(", entries="), F.col("entries").cast("string"))
        issues += [F.when(F.col("entries") != F.col("rows"), differ), F.when(F.col("numbers") != F.col("rows"), "Tracking row_number uniqueness mismatch")]
    if catalog is None:
        warnings.append(F.lit("Catalog files not found -- skipping FK checks"))
    else:
        for name, key in (("artists", "artist_id"), ("releases", "release_id"), ("works", "work_id")):
            one = one.join(_alone(orphan_count(catalog["tracks"], key, catalog[name])).withColumnRenamed("orphans", f"no_{key}"))
            issues.append(_message(f"Catalog track rows missing {key[:-3]} FK", F.col(f"no_{key}")))
        if personnel is not None:
            one = one.join(orphan_count(personnel, "release_id", catalog["releases"]).withColumnRenamed("orphans", "no_personnel_release"))
            warnings.append(_message("Personnel rows with no matching release", F.col("no_personnel_release")))
    for report, kind, counts in (
        (high, "Duplicate high-confidence report", {
            "no_original": "Duplicate high-confidence clusters missing original candidate",
            "mixed": "Duplicate high-confidence clusters contain mixed same_master and variant version_type values",
        }),
        (full, "Duplicate report", {"covers": "Duplicate detector cross-artist probable cover/interpolation pairs"}),
    ):
        absent = F.lit(f"{kind} not found")
        if report is None:
            warnings.append(absent)
            continue
        valid = f"valid_{len(one.columns)}"
        one = one.join(report.select(F.col("valid").alias(valid), *counts, *(["clusters", "pairs"] if report is high else [])))
        warnings += [F.when(F.col(valid).isNull(), absent).when(~F.col(valid), F.lit(f"{kind} is not valid JSON")), *[_message(text, F.col(c)) for c, text in counts.items()]]
    some = lambda xs: F.filter(F.array(*xs), lambda x: x.isNotNull())
    out = one.withColumn("issues", some(issues)).withColumn("warnings", F.array_sort(F.array_distinct(some(warnings))))
    return out.withColumn("status", F.when(F.size("issues") == 0, "PASS").otherwise("FAIL"))


def verdict(critical: Column, total: Column) -> Column:
    return (
        F.when(critical > 0, "VALIDATION FAILED").when(total > 20, "VALIDATION PARTIAL").when(total > 0, "VALIDATION MOSTLY PASS").otherwise("VALIDATION PASSED")
    )


def validated(rows: DataFrame, entries: DataFrame | None = None) -> DataFrame:
    """The rule counts folded into one verdict: critical issues are rows without an artist (one row). A log that holds entries adds an
    issue if their number differs from the rows' and one if hashes repeat."""
    broken = violations(rows)
    listed = ["row_type_unknown", "release_category_unknown", "artist_missing"]
    capped = [f"{c}_prefix" for c in schema.LINK_PREFIX]
    # of link issues the report lists five each
    weight = F.when(F.col("rule").isin(*listed), F.col("broken")).when(F.col("rule").isin(*capped), F.least(F.col("broken"), F.lit(5))).otherwise(0)
    one = broken.agg(F.sum(F.when(F.col("rule") == "artist_missing", F.col("broken")).otherwise(0)).alias("critical"), F.sum(weight).alias("total"))
    if entries is not None:
        log = log_alignment(rows, entries)
        found = F.when(F.col("entries") > 0, (F.col("entries") != F.col("rows")).cast("int") + (F.col("collisions") > 0).cast("int")).otherwise(0)
        one = one.join(log.select(found.alias("log"))).select("critical", (F.col("total") + F.col("log")).alias("total"))
    return one.withColumn("verdict", verdict(F.col("critical"), F.col("total")))


def genre_terms(rows: DataFrame) -> DataFrame:
    """How often every genre term occurs, and whether it is allowed."""
    terms = rows.select(F.explode(comma_list("genre")).alias("genre"))
    return terms.groupBy("genre").agg(F.count(F.lit(1)).alias("n")).withColumn("allowed", F.size(bad_genres("genre")) == 0)


def clusters_without_original(listed: DataFrame) -> DataFrame:
    """High-confidence clusters whose original is missing."""
    return listed.filter((F.col("cluster_confidence") == "high") & F.col("original").isNull()).select("cluster_id")
