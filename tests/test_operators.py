"""Table operators against plain versions; results must not depend on partitioning."""

import json
import random
from collections import Counter
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from catloom import schema
from catloom.operators import audit, blocking, catalog, consolidate, dedupe, duplicates, enrich, extract, graph, lineage, quality, reconcile
from catloom.operators.components import connected_components
from catloom.plans import pipeline


def fact(spark, rows):
    """Fact rows from dicts, in order."""
    full = [(i, *[r.get(c, "") for c in schema.FACT]) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, "_ord long, " + ", ".join(f"{c} string" for c in schema.FACT))


BASE = {"artist": "A", "song_name": "S", "album_name": "L", "row_type": "track", "release_category": "original", "edition_type": "standard", "release_date": "1975"}


def test_merge_policies(spark):
    rows = [
        BASE | {"notes": "a", "alternative_names": "x, y", "awards": ""}, BASE | {"artist": " a ", "notes": "b", "alternative_names": "y, z", "awards": "won"},
        BASE | {"notes": "a", "awards": "later", "spotify_url": "u"}, BASE | {"song_name": "T", "alternative_names": " q ,q"},
    ]
    for parts in (1, 5):
        out = {r["song_name"]: r for r in dedupe.merge_duplicates(fact(spark, rows).repartition(parts)).collect()}
        assert out["S"]["notes"] == "a | b | a" and out["S"]["alternative_names"] == "x, y, z" and out["S"]["awards"] == "won"
        assert out["S"]["spotify_url"] == "u" and out["S"]["artist"] == "A" and out["S"]["_ord"] == 0 and out["S"]["_copies"] == 3
        assert out["T"]["alternative_names"] == " q ,q"


def test_lineage_and_idempotency(spark):
    rows = [
        BASE | {"release_date": ""}, BASE | {"album_name": "M", "release_date": "1975-03"}, BASE | {"album_name": "N", "release_date": "1975"},
        BASE | {"album_name": "C", "release_category": "compilation", "song_name": "S - Live"}, BASE | {"album_name": "C", "release_category": "compilation", "song_name": "Other"},
        BASE | {"artist": "Z", "release_category": "compilation"}, BASE | {"album_name": "P", "track_position": "2"}, BASE | {"album_name": "P", "song_name": "Q", "track_position": "7/9", "duration_seconds": "1.5"},
    ]
    once, metrics = lineage.canonicalise(fact(spark, rows))
    first = {r["_ord"]: r.asDict() for r in once.collect()}
    release = {r["album_name"]: r["release_id"] for r in catalog.releases(fact(spark, rows)).collect() if r["release_category"] != "compilation"}
    assert first[3]["source_release_id"] == first[4]["source_release_id"] == release["N"] and first[5]["source_release_id"] == ""
    assert first[6]["track_position"] == "2/9" and first[7]["duration_seconds"] == "" and first[3]["version_type"] == "live_recording"
    assert metrics.first()["track_position_normalized_count"] == 1
    again, _ = lineage.canonicalise(once)
    assert {r["_ord"]: r.asDict() for r in again.collect()} == first


def test_star_schema(spark):
    rows = [BASE, BASE | {"artist": "a", "song_name": "S (Live)"}, BASE | {"work_id": "wrk_given", "song_name": "New"}, BASE | {"work_id": "wrk_two", "song_name": "new"}]
    out = catalog.build(fact(spark, rows))
    assert [r["artist_name"] for r in out["artists"].collect()] == ["A"]
    assert out["tracks"].count() == 4 and [r["work_name"] for r in out["works"].collect()] == ["New", "S"]
    gates = quality.gates(fact(spark, rows), {k: v for k, v in out.items()}).first()
    assert gates["no_work_id"] == 1 and gates["status"] == "FAIL" and "Catalog track rows missing work FK: 1" in gates["issues"]


def test_golden_ids(spark):
    from catloom.functions import ids

    df = spark.createDataFrame([("Parliament",), (" parliament ",)], "artist string").select(ids.artist_id()).distinct()
    assert df.count() == 1


def test_reconcile_prefers_full_signatures_and_long_histories(spark):
    rows = fact(spark, [BASE | {"spotify_url": "u"}, BASE | {"song_name": "T"}, BASE | {"song_name": "N"}])
    event = ("d", "r", "m", "x", None, None, None)
    make = lambda o, r, st, n: (o, *[r.get(c, "") for c in schema.KEY], st, None, "2020", n, "medium", [event] * n + [None])
    log = [make(0, BASE, "found", 1), make(1, BASE, "not_found", 2), make(2, BASE, "late", 2), make(3, {k: v for k, v in (BASE | {"song_name": "T"}).items() if k not in ("row_type", "release_category", "edition_type")}, "needs_research", 0),
           make(4, BASE | {"artist": "gone"}, "found", 0)]
    ddl = "_ord long, " + ", ".join(f"{c} string" for c in schema.KEY) + ", spotify_status string, youtube_status string, last_search_date string, search_attempts long, confidence_level string, search_history array<" + reconcile.EVENT.simpleString() + ">"
    entries = spark.createDataFrame(log, ddl)
    out = {r["song_name"]: r for r in reconcile.reconcile(rows, entries, F.col("_ord") + 2).collect()}
    assert (out["S"]["spotify_status"], out["S"]["search_attempts"], len(out["S"]["search_history"]), out["S"]["confidence_level"]) == ("found", 2, 2, "medium")
    assert (out["T"]["spotify_status"], out["T"]["matched"], out["N"]["matched"], out["N"]["spotify_status"]) == ("needs_research", True, False, "not_searched")
    assert reconcile.orphans(rows, entries).count() == 1
    stats = reconcile.statistics(reconcile.reconcile(rows, entries, F.col("_ord") + 2)).first()
    assert (stats["total"], stats["has_spotify_url"], stats["needs_research"]) == (3, 1, 1)


def words(rng, n):
    return " ".join("".join(rng.choices("abcdegilmnorst", k=rng.randint(2, 6))) for _ in range(n))


def similar_texts(seed=1, n=60):
    rng = random.Random(seed)
    out = [words(rng, rng.randint(1, 4)) for _ in range(n)]
    for t in list(out):
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(t) + 1)
            out.append(t[:at] + rng.choice("xyz ") + t[at + rng.randint(0, 1) :])
    return [*out, "", "", "a"]


def test_similar_pairs_lose_none(spark):
    texts = list(dict.fromkeys(similar_texts()))
    df = spark.createDataFrame([(t,) for t in texts], "a string")
    found = {(r["a"], r["b"]) for r in blocking.similar_pairs(df, df.toDF("b"), "a", "b", 0.85).collect()}
    assert found == {(a, b) for a in texts for b in texts if SequenceMatcher(None, a, b).ratio() >= 0.85}


def greedy(texts, threshold=0.85):
    leaders, out = [], {}
    for i, t in enumerate(texts):
        hit = next((k for k in leaders if SequenceMatcher(None, t, texts[k]).ratio() >= threshold), None)
        if hit is None:
            leaders.append(i)
        out[i] = i if hit is None else hit
    return out


def test_greedy_groups_are_the_sequential_ones(spark):
    texts = similar_texts(2)
    df = spark.createDataFrame(list(enumerate(texts)), "_ord long, sig string")
    for parts in (1, 6):
        groups = {r["sig"]: r["leader"] for r in consolidate.greedy_groups(df.repartition(parts), "sig").collect()}
        assert {i: groups[t] for i, t in enumerate(texts)} == greedy(texts)


def test_consolidation(spark):
    feed = lambda o, song, src, date="", label="": (o, "Artist", "", song, date, label, "track", src, "", "", "")
    rows = [feed(0, "some song title", "discogs", "1975-01"), feed(1, "some song titles", "spotify", "1975", "L"), feed(2, "another", "other"), feed(3, "some song title", "discogs")]
    df = spark.createDataFrame(rows, "_ord long, " + ", ".join(f"{c} string" for c in schema.SOURCE))
    out = {r["song_name"]: r for r in consolidate.consolidated(df).collect()}
    assert out["some song title"]["sources"] == ["discogs", "spotify"] and out["some song title"]["label"] == "L" and out["some song title"]["score"] == 1.0
    assert out["another"]["overall_confidence"] == "low"
    known = fact(spark, [{"artist": "artist", "song_name": "Some song title", "label": "K"}])
    matched = consolidate.with_status(consolidate.consolidated(df), known)
    fixes = {r["field"]: (r["current_value"], r["proposed_value"]) for r in consolidate.corrections(matched).collect()}
    assert fixes["label"] == ("K", "L") and fixes["artist"] == ("artist", "Artist")
    routes = consolidate.routed(consolidate.output_rows(matched), known, "low")
    assert Counter(r["route"] for r in routes.collect()) == {"not_pending": 1, "merge": 1}
    assert consolidate.merged_fact(routes, known).count() == 2 and consolidate.review_queue(routes).count() == 0
    assert Counter(r["status"] for r in consolidate.updated_status(routes).collect()) == {"existing": 1, "merged": 1}


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 140)] + [(5, 5), (None, 3)] + [(200, k) for k in range(201, 260)]
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    assert found == {x: find(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def entry_rows(spark, rows):
    return fact(spark, rows).withColumn("row_number", F.col("_ord") + 2)


def test_duplicate_pairs_and_clusters(spark):
    t = lambda name, artist="A", **k: BASE | {"song_name": name, "artist": artist, "version_type": "same_master"} | k
    rows = [t("Flashing light bulb"), t("Flashing lights bulb", release_date="1974"), t("Flashing light bulb", "B"), t("Long First Piece / Second Longer Piece"), t("Second Longer Piece", "C"),
            t("Jam time"), t("Jam tune"), t("Flashing light bulb - Live"), t("The of"), BASE | {"row_type": "album"}]
    items = duplicates.entries(entry_rows(spark, rows))
    found = {(r["left_row"], r["right_row"]): r for r in duplicates.pairs(items).collect()}
    assert found[2, 3]["relation_class"] == "same_work_variant" and found[2, 3]["match_type"] == "fuzzy_title"
    assert found[5, 6]["match_type"] == "component_overlap" and found[5, 6]["relation_class"] == "uncertain"
    assert (2, 4) not in found and (7, 8) not in found and (2, 9) not in found and (3, 4) in found
    exact = {(r["left_row"], r["right_row"]): r["match_type"] for r in duplicates.pairs(items, include_exact=True).collect()}
    assert exact[2, 4] == exact[2, 9] == "exact_normalized"
    made = duplicates.clusters(items, duplicates.pairs(items, include_exact=True)).collect()
    assert [r["members"] for r in made] == [[2, 3, 4, 9]] and made[0]["original"]["n"] == 3 and made[0]["cluster_confidence"] == "high"
    kinds = {(r["kind"], r["value"]): r["pairs"] for r in duplicates.counts(duplicates.pairs(items, include_exact=True)).collect()}
    assert kinds["match_type", "exact_normalized"] == 3
    labels = spark.createDataFrame([(2, 2), (3, 2)], "node long, component long")
    mixed = items.withColumn("version_type", F.when(F.col("n") == 3, "unknown").otherwise("same_master"))
    assert duplicates.mixed_versions(mixed, labels).count() == 1


def test_rules(spark):
    rows = [BASE | {"track_position": "1/2", "genre": "Funk, Odd", "era": schema.ERAS[0]}, BASE | {"track_position": "x", "artist": "", "release_date": "75", "spotify_url": "http://x"},
            BASE | {"row_type": "album", "track_position": "1", "genre": "Any (Live)"}, BASE | {"row_type": "odd", "release_category": "odd", "edition_type": "odd", "youtube_url": "https://youtu.be/x"}]
    broken = {r["rule"]: r["broken"] for r in quality.violations(fact(spark, rows)).collect()}
    assert broken["genre_unknown"] == broken["artist_missing"] == broken["release_date_format"] == broken["spotify_url_prefix"] == broken["row_type_unknown"] == broken["edition_type_unknown"] == 1
    assert broken["track_position_invalid"] == 1 and broken["album_with_position"] == 1 and broken["position_without_track"] == 1 and broken["youtube_url_prefix"] == 0
    assert quality.validated(fact(spark, rows)).first()["verdict"] == "VALIDATION FAILED"
    assert {r["rule"]: r["row_number"] for r in quality.samples(fact(spark, rows), "_ord").collect()}["artist_missing"] == 1
    assert quality.gates(fact(spark, [])).first()["status"] == "PASS"
    log = spark.createDataFrame([(2, "h"), (2, "h")], "row_number long, row_hash string")
    assert not quality.log_alignment(fact(spark, rows[:2]), log).first()["aligned"]


def test_duration_drift(spark):
    rows = "track_id string, work_id string, release_id string, source_release_id string, version_type string, duration_seconds string"
    df = spark.createDataFrame([("a", "w", "r1", "", "", "100"), ("b", "w", "r2", "r1", "same_master", "104"), ("c", "w", "r2", "r1", "remix_or_edit", "200"), ("d", "w", "r2", "r1", "", "103")], rows)
    assert [r["track_id"] for r in quality.duration_drift(df).collect()] == ["b"]


def test_audit_and_quarantine(spark):
    rows = entry_rows(spark, [BASE | {"spotify_url": "https://open.spotify.com/track/t1"}, BASE | {"row_type": "album", "spotify_url": "https://open.spotify.com/track/t1"}, BASE | {"spotify_url": "https://open.spotify.com/track/t2"}])
    meta = audit.metadata(spark.createDataFrame([(json.dumps({"t1": {"name": "S (Live)", "artists": ["A"]}}),), ("broken",)], "j string"), "j", "track")
    links = audit.linked(rows)
    assert audit.missing_metadata(links, meta).count() == 1
    found = audit.findings(audit.scored(links, meta))
    out = {r["row_number"]: r for r in audit.report_order(found).collect()}
    assert set(out) == {3} and out[3]["severity"] == "high" and out[3]["reason_codes"][0] == "url_type_mismatch"
    log = rows.select("row_number", F.lit("found").alias("spotify_status"), F.lit("high").alias("confidence_level"), F.lit("").alias("last_search_date"), F.lit(None).cast("array<" + reconcile.EVENT.simpleString() + ">").alias("search_history"))
    cleared, after = audit.quarantined(rows, found, log, F.lit("2024-01-02"))
    assert {r["row_number"]: bool(r["spotify_url"]) for r in cleared.collect()} == {2: True, 3: False, 4: True}
    entry = after.filter("row_number = 3").first()
    assert entry["spotify_status"] == "needs_research" and entry["search_history"][0]["previous_url"].endswith("t1")


def test_enrichment(spark):
    item = lambda name, url, artists, ms=None: {"name": name, "external_urls": {"spotify": url}, "artists": [{"name": a} for a in artists], "duration_ms": ms, "album": {"name": "L"}}
    payloads = [("a.json", json.dumps({"tracks": {"items": [item("S", "u1", ["A"], 1500), item("S", "u2", ["A", "B"], 2500)]}})), ("b.json", json.dumps({"albums": {"items": [item("L", "u3", ["A"])]}})), ("c.json", "{broken"), ("d.json", json.dumps({"tracks": []}))]
    items = enrich.cached_items(spark.createDataFrame(payloads, "file string, payload string"))
    links = {(r["kind"], r["artist"], r["title"]): r["url"] for r in enrich.link_map(items).collect()}
    assert links == {("track", "a", "s"): "u2", ("track", "b", "s"): "u2", ("album", "a", "l"): "u3"}
    assert {r["url"]: r["seconds"] for r in enrich.duration_map(items).collect()} == {"u1": 2, "u2": 2}
    rows = fact(spark, [BASE, BASE | {"row_type": "album"}, BASE | {"spotify_url": "u1"}])
    assert {r["_ord"]: r["value"] for r in enrich.backfill_links(rows, enrich.link_map(items)).collect()} == {0: "u2", 1: "u3"}
    assert {r["_ord"]: r["value"] for r in enrich.backfill_durations(rows, enrich.duration_map(items)).collect()} == {2: "2"}
    candidates = items.filter("kind = 'track'").select(F.lit(0).cast("long").alias("_ord"), F.lit(0).alias("query_pos"), "pos", "item")
    best = enrich.best_candidate(enrich.score_candidates(rows, candidates)).first()
    assert best["url"] == "u1" and best["score"] == pytest.approx(1.0)
    assert enrich.accepted(enrich.best_candidate(enrich.score_candidates(rows, candidates))).first()["confidence_level"] == "high"
    keys = enrich.lookup_keys(rows).filter("_ord = 0").orderBy("query_pos").collect()
    assert [k["query"] for k in keys] == ['track:"S" artist:"A" album:"L"', 'track:"S" artist:"A"', '"S" "A"']
    patches = spark.createDataFrame([("0", "label", " x ", "b", 0), ("0", "label", "y", "a", 5), ("x", "label", "z", "a", 1), ("99", "label", "z", "a", 1), ("0", "odd", "z", "a", 1), ("0", "artist", "z", "a", 1)], "row_index string, field_name string, value string, file string, line int")
    filled = {r["_ord"]: (r["label"], r["artist"]) for r in enrich.apply_patches(rows, patches).collect()}
    assert filled == {0: ("y", "A"), 1: ("", "A"), 2: ("", "A")}
    once = enrich.apply_patches(rows, patches)
    assert sorted(map(tuple, enrich.apply_patches(once, patches).collect())) == sorted(map(tuple, once.collect()))
    credits = json.dumps({"extraartists": [{"name": "P", "role": "Bass", "anv": "p", "id": 7}, {"name": "Q", "role": ""}], "tracklist": [{"position": "A1", "extraartists": [{"name": "R", "role": "Keys"}], "artists": [{"name": "S"}]}]})
    people = enrich.personnel(spark.createDataFrame([("rel", 5, credits)], "release_id string, discogs_release_id int, payload string"))
    assert {(r["person_name"], r["role"], r["track_position"]) for r in people.collect()} == {("P", "Bass", ""), ("R", "Keys", "A1"), ("S", "Performer", "A1")} and people.columns == schema.PERSONNEL


def test_reachability(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("b", "x")], "src string, dst string")
    seeds = spark.createDataFrame([("a",)], "node string")
    walk = lambda **k: {r["node"]: r["depth"] for r in graph.reachable(edges, seeds, **k).collect()}
    assert walk(max_depth=2) == {"a": 0, "b": 1, "c": 2, "x": 2}
    assert walk(denied=F.col("node") == "x") == {"a": 0, "b": 1, "c": 2, "d": 3}
    assert walk(max_nodes=2) == {"a": 0, "b": 1}


def test_extractors(spark):
    chrono = """<div class="mw-parser-output"><h2>x</h2><h3>1971</h3><li>Nobody</li><h4>March 5</h4><li>Band - "Tune"/"Flip" (7") (Westbound Records)</li><li>Band - "Tune"/"Flip" (7") (other)</li>
      <h3>1972</h3><li>Jan 4 Other Band - [Album](link) (LP)[1]</li><h2>y</h2><li>Band - "Later song" (CD)</li></div>"""
    detail = "<h1>Band – Album</h1><p>1. \"One\" 2. Two</p>"
    listed = "<h1>Some – Album</h1><ol><li>Alpha</li><li>Beta</li></ol>"
    box = '<h1>Name</h1><table class="infobox x"><tr><th>Released</th><td>1975</td></tr><tr><th>Label</th><td>L</td></tr><tr><th>Genre</th><td>G</td></tr></table>'
    index = '<div><h3>Band - Live</h3><a href="/audio/x/">Read more</a><a href="/audio/x/">again</a></div>'
    pages = spark.createDataFrame([("http://h/c", chrono), ("http://h/d", detail), ("http://h/l", listed), ("http://h/b", box), ("http://h/i", index)], "url string, body string")
    rows = {(r["artist"], r["album_name"], r["song_name"]): r for r in extract.chronological(pages.filter("url like '%/c'"), "list").collect()}
    assert rows["Band", "", "Tune"]["release_date"] == "1971-03-05" and rows["Band", "", "Tune"]["label"] == "Westbound Records"
    assert rows["Other Band", "Album", ""]["release_date"] == "1972" and rows["Band", "Later song", ""]["release_date"] == ""
    at = lambda kind, url: [tuple(r)[:7] for r in extract.page_rows(pages.filter(F.col("url").endswith(url)), F.lit(kind), "D", "src").collect()]
    assert at("detail", "/d") == [("Band", "Album", n, "", "", "track", "src") for n in ("One", "Two")]
    assert at("titled", "/l") == [("Some", "Album", n, "", "", "track", "src") for n in ("Alpha", "Beta")]
    assert at("infobox", "/b") == [("", "Name", "", "1975", "L", "album", "src")]
    assert at("index", "/i")[0][:2] == ("Band", "Live") and len(at("index", "/i")) == 1 and at("unknown", "/i") == []
    assert at("headings", "/d") == [("Band", "Album", "", "", "", "album", "src")]
    tracks = spark.createDataFrame([('01. "One" 2. Two',)], "t string").select(extract.track_lines("t")).first()[0]
    assert [(x["number"], x["name"]) for x in tracks] == [(1, "One"), (2, "Two")]
    hrefs = spark.createDataFrame([("http://h/a/", '<a href="b?q#f">x</a><a href="http://o/c">y</a><a href="x.GIF">z</a><a href="#t">t</a>')], "url string, body string")
    assert [r["target"] for r in extract.page_links(hrefs).collect()] == ["http://h/a/b"]


def test_fixed_width_lists(spark):
    body = "intro\n-----\nTHE BAND\n-----\nFirst Album  71  Westbound  W-2001 (LP)\n  \"  Other  X-9 (CD 99)\nsee **** note\nNo match\n=====\nSECOND\n\nTitle two  05^ One 77"
    owned = extract.sections(extract.lines(spark.createDataFrame([("u", body)], "url string, body string"), "url"), "url")
    out = [tuple(r)[2:] for r in extract.album_lines(owned, "url").orderBy("pos").collect()]
    assert out == [("THE BAND", "First Album", "1971", "Westbound", "W-2001", "LP"), ("THE BAND", "First Album", "1999", "Other", "X-9", "CD 99"), ("SECOND", "Title two", "2005", "One", "77", "")]


def test_json_sources(spark):
    topics = json.dumps({"topic_list": {"topics": [{"id": 1, "slug": "s", "title": "T", "tags": ["a-b", "book"], "views": 3}, {"id": 1, "slug": "s", "title": "again"}, {"id": None, "title": "no"}]}})
    rows = extract.topic_rows(spark.createDataFrame([("u", topics)], "url string, body string"), "http://f", "forum").collect()
    assert {(r["artist"], r["album_name"], r["source_url"]) for r in rows} == {("A B", "T", "http://f/t/s/1"), ("", "no", "")}
    bindings = json.dumps([{"item": {"value": "q"}, "itemLabel": {"value": "N"}, "date": {"value": "1975-01-02T00:00"}, "mbid": {"value": "m"}, "other": {"value": ""}}])
    row = extract.binding_rows(spark.createDataFrame([("u", bindings)], "url string, body string"), "A", "graph").first()
    assert (row["album_name"], row["release_date"], json.loads(row["raw_extra"])) == ("N", "1975-01-02", {"mbid": "m"})
    sets = json.dumps({"setlist": [{"sets": {"set": [{"song": [{"name": "x"}, {"name": ""}]}, {"song": [{"name": "y"}]}]}}, {"sets": {}}]})
    assert [r["song"] for r in extract.setlist_songs(spark.createDataFrame([("u", sets)], "url string, body string")).collect()] == ["x", "y"]


def test_pipeline_runs_on_after_a_failure(spark):
    rows = fact(spark, [BASE, BASE | {"song_name": "T"}])
    steps = [*pipeline.curation_steps(), pipeline.Step("bad", "x", lambda r: r.select("nowhere"), ("raw",)), pipeline.Step("after", "x", lambda b: b, ("bad",)), pipeline.Step("net", "x", lambda r: r, ("raw",), needs_service=True)]
    out = pipeline.run(spark, steps, {"raw": rows}, services=False, at_once=2)
    status = {r.name: r.status for r in out.results}
    assert status["gates"] == "done" and status["bad"] == "failed" and status["after"] == "skipped" and status["candidates"] == "skipped" and status["net"] == "skipped by choice"
    assert out.tables["tracks"].count() == 2 and not out.ok
    with pytest.raises(ValueError):
        pipeline.waves([pipeline.Step("a", "x", None, ("b",)), pipeline.Step("b", "x", None, ("a",))], set())


def test_setlist_coverage(spark):
    from catloom.functions.similarity import coverage

    df = spark.createDataFrame([(["a", "b", "c"], ["b", "d"])], "a array<string>, b array<string>")
    r = df.select(coverage(F.col("a"), F.col("b")).alias("c")).first()["c"]
    assert (r["matched"], r["rate"], r["only_left"], r["only_right"]) == (1, 0.5, ["a", "c"], ["d"])


def test_discovery_payloads(spark):
    from catloom.operators import discover

    frame = lambda payload: spark.createDataFrame([("A", json.dumps(payload))], "artist string, payload string")
    page = {"releases": [{"id": 1, "title": "T", "year": 1975, "type": "master", "label": "L", "resource_url": "u"}, {"id": 2, "title": "U", "year": 0, "label": [{"name": "M"}]}, {"title": "V", "label": ["N"]}]}
    assert [(r["album_name"], r["release_date"], r["label"]) for r in discover.release_rows(frame(page)).collect()] == [("T", "1975", "L"), ("U", "", "M"), ("V", "", "N")]
    groups = {"release-groups": [{"id": "g", "title": " G ", "primary-type": "Single", "first-release-date": "1975"}, {"id": "h", "title": " "}]}
    row = discover.group_rows(frame(groups)).collect()
    assert len(row) == 1 and (row[0]["album_name"], row[0]["row_type"], json.loads(row[0]["raw_extra"])["mbid"]) == ("G", "single", "g")
    recordings = {"recordings": [{"id": "r", "title": "R", "length": 2500, "isrcs": ["i"]}]}
    assert json.loads(discover.recording_rows(frame(recordings)).first()["raw_extra"])["duration_seconds"] == "2"
    albums = {"items": [{"id": "1", "name": "X", "album_type": "compilation", "external_urls": {"spotify": "u"}}, {"id": "2", "name": "x!"}]}
    found = discover.album_rows(frame(albums).withColumn("name", F.lit("The A")).withColumn("confidence", F.lit("high"))).collect()
    assert [(r["artist"], r["album_name"], r["row_type"], r["source_confidence"]) for r in found] == [("The A", "X", "compilation", "high")]


def test_worklists(spark):
    from catloom.operators import discover

    rows = fact(spark, [BASE | {"version_type": "live_recording"}, BASE | {"album_name": "Alive"}, BASE | {"artist": " B "}]).withColumn("row_number", F.col("_ord") + 2)
    assert discover.live_recordings(rows).count() == 2
    assert {r["artist"] for r in discover.catalog_artists(None, rows).collect()} == {"a", "b"}
    assert {r["release_id"] for r in discover.unique_releases(None, rows.withColumn("row_type", F.lit("album"))).collect()} == {"A|L|1975", "A|Alive|1975", " B |L|1975"}
    entries = spark.createDataFrame([(2, "needs_research"), (3, "found")], "row_number long, spotify_status string")
    assert [r["row_number"] for r in discover.needs_research(rows, entries).collect()] == [2]
    assert discover.forced(spark.createDataFrame([("x",)], "artist string"), "artist", "Z").first()["artist"] == "Z"
    songs = spark.createDataFrame([("A", "S!"), ("A", "T")], "artist string, song string")
    assert discover.coverage_report(songs, rows.filter("artist = 'A'")).first()["matched"] == 1


def test_composed_enrichment(spark):
    rows = entry_rows(spark, [BASE, BASE | {"song_name": "Zz", "youtube_url": "y"}])
    item = {"name": "S", "external_urls": {"spotify": "u1"}, "artists": [{"name": "A"}], "album": {"name": "L"}}
    keys = enrich.lookup_keys(rows, "track", "row_number").filter("row_number = 2 and query_pos = 1").select("key")
    cache = keys.withColumn("payload", F.lit(json.dumps({"tracks": {"items": [item]}})))
    assert [(r["row_number"], r["url"]) for r in enrich.first_hits(rows, cache, "track", "row_number").collect()] == [(2, "u1")]
    log = rows.select("row_number", F.lit("x").alias("spotify_status"), F.lit("low").alias("confidence_level"), F.lit("").alias("last_search_date"), F.lit(1).cast("long").alias("search_attempts"), F.lit(None).cast("array<" + reconcile.EVENT.simpleString() + ">").alias("search_history"))
    filled, entries = enrich.repopulate(rows, cache, log, F.lit("2024-01-01"), "track")
    assert {r["row_number"]: r["spotify_url"] for r in filled.collect()} == {2: "u1", 3: ""}
    entry = entries.filter("row_number = 2").first()
    assert (entry["spotify_status"], entry["confidence_level"], entry["search_attempts"], entry["search_history"][0]["result"]) == ("found", "high", 2, "found")
    videos = spark.createDataFrame([(2, 0, 0, "k#video", "v", None, "S", "A - Topic"), (2, 0, 1, "k#video", "w", None, "else", "else")], "row_number long, query_pos int, pos int, kind string, video string, playlist string, title string, channel string")
    best = enrich.video_links(rows, videos, 5, "row_number").collect()
    assert [(r["row_number"], r["url"]) for r in best] == [(2, "https://www.youtube.com/watch?v=v")]
