"""Caches, sidecars, robots rules and counts."""

from pyspark.sql import functions as F

from catloom.operators import audit, catalog, consolidate, discover, duplicates, graph, quality  # noqa: F401
from catloom.operators.components import connected_components
from catloom.sources import cache, files


def test_cache_resumes(spark, tmp_path):
    path = str(tmp_path / "cache")
    keys = spark.createDataFrame([("a",), ("b",), ("c",)], "key string")
    assert cache.misses(spark, path, keys, "n").count() == 3
    cache.put(spark.createDataFrame([("A ", '{"x": 1}'), ("b", "broken{")], "key string, body string"), path, "n")
    assert {r["key"] for r in cache.misses(spark, path, keys, "n").collect()} == {"b", "c"}


def test_sidecars_keep_file_and_line(spark, tmp_path):
    (tmp_path / "b.csv").write_text("row_index,field_name,value\n1,label,X\n")
    (tmp_path / "a.csv").write_text("row_index,field_name,value\n2,label,\"Y, Z\"\n3,notes,n\n")
    out = {(r["file"], r["line"], r["row_index"], r["value"]) for r in files.read_sidecars(spark, str(tmp_path / "*.csv")).collect()}
    assert out == {("b.csv", 0, "1", "X"), ("a.csv", 0, "2", "Y, Z"), ("a.csv", 1, "3", "n")}


ROBOTS = [
    "User-agent: x\nDisallow: /\nUser-agent: *\nDisallow: /private\nAllow: /private/open # yes\nDisallow:\n",
    "User-agent: *\nUser-agent: foo\nDisallow: /x\n",
    "User-agent: foo\n\nUser-agent: foo\nAllow: /a/b\nDisallow: /a\n\nUser-agent: *\nDisallow: /\n",
    "# only a comment\nUser-agent: foo # us\n# between\nCrawl-delay: 3\nDisallow: /a%20b\nDisallow: /ö\nDisallow: /q?x=1\n",
    "Disallow: /\nUser-agent: *\nDisallow: *\nAllow: /\n",
    "User-agent: FOO/2\nDisallow: /a\nUser-agent: foob\nDisallow: /b\n", "User-agent: *\nDisallow:\n", "", None, "User-agent: *\nDisallow: /a\n\nUser-agent: *\nDisallow: /b\n",
]


def test_robots_as_the_standard_parser_reads_them(spark):
    from urllib.robotparser import RobotFileParser

    paths = ["", "/", "/a", "/a/b", "/a/c", "/b", "/x", "/private/x", "/private/open/y", "/a b", "/a%20b", "/ö", "/%C3%B6", "/q?x=1", "/q?x=2", "/*", "/a#f"]
    urls = [(f"http://h{k}{p}", "other") for k in range(len(ROBOTS)) for p in paths] + [("http://none/a", "other"), (None, "other"), ("no url", "other")]
    rules = graph.robots_rules(spark.createDataFrame([(f"h{k}", body) for k, body in enumerate(ROBOTS)], "host string, body string"))
    df = spark.createDataFrame(urls, "url string, path string").withColumn("host", F.lit("other"))
    for agent in ("Foo/1.0", "foobar", "bar"):
        wanted = []
        for u, _ in urls:
            if u and u.startswith("http://h"):
                parser = RobotFileParser()
                parser.parse((ROBOTS[int(u[8])] or "").splitlines())
                wanted += [u] * parser.can_fetch(agent, u)
            else:
                wanted.append(u)
        out = graph.permitted(df, rules, agent=agent)
        assert out.columns == df.columns and sorted(map(str, wanted)) == sorted(str(r["url"]) for r in out.collect()), agent
    assert graph.permitted(df, rules.limit(0)).count() == len(urls) and graph.permitted(df.limit(0), rules).count() == 0


def test_batches_are_full(spark):
    links = spark.createDataFrame([("track", f"t{k:03}") for k in range(200)] * 2 + [("album", f"a{k}") for k in range(41)] + [("album", None)], "kind string, id string")
    out = audit.missing_metadata(links, spark.createDataFrame([("track", "t000")], "kind string, id string"))
    sizes = {(r["kind"], r["batch"]): r["n"] for r in out.groupBy("kind", "batch").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sizes == {("track", 0): 50, ("track", 1): 50, ("track", 2): 50, ("track", 3): 49, ("album", 0): 20, ("album", 1): 20, ("album", 2): 1}


def test_gates_read_stored_reports(spark):
    from tests.test_operators import BASE, fact

    rows = fact(spark, [BASE | {"track_position": "1/2"}])
    report = '{"clusters": [{"original_candidate": {"row": 1}, "members": [{"version_type": "same_master"}, {"version_type": " Live"}]}, {"original_candidate": {}, "members": [{"version_type": "same_master"}]}, {"members": []}], "pairs": [{"a": 1}, {"a": 2}], "metrics": {"match_type_counts": {"relation_class": {"probable_cover_or_interpolation": 4}}}}'
    read = lambda text: quality.stored_report(spark.createDataFrame([(text,)] if text is not None else [], "payload string"))
    first = quality.gates(rows, full=read(report), high=read(report)).first()
    assert (first["status"], first["issues"], first["clusters"], first["pairs"]) == ("PASS", [], 3, 2)
    assert first["warnings"] == [
        "Catalog files not found -- skipping FK checks", "Duplicate detector cross-artist probable cover/interpolation pairs: 4",
        "Duplicate high-confidence clusters contain mixed same_master and variant version_type values: 1", "Duplicate high-confidence clusters missing original candidate: 2",
        "Tracking file of the search log not found -- skipping tracking checks",
    ]
    broken = quality.gates(rows, full=read("{"), high=read("[1"), header=["artist"]).first()
    assert {"Duplicate report is not valid JSON", "Duplicate high-confidence report is not valid JSON"} <= set(broken["warnings"]) and broken["issues"] == ["Schema header mismatch in the fact table"]
    for absent in (quality.gates(rows).first(), quality.gates(rows, full=read(None), high=read(None)).first()):
        assert {"Duplicate report not found", "Duplicate high-confidence report not found"} <= set(absent["warnings"]) and absent["status"] == "PASS"
    log = spark.createDataFrame([(2, "h"), (3, "h")], "row_number long, row_hash string")
    assert quality.gates(rows, entries=log).first()["collisions"] == 1
    assert quality.validated(rows, log).first()["total"] == quality.validated(rows).first()["total"] + 2


def test_seeds_and_order(spark):
    rows = spark.createDataFrame([("1", "A", "core", ""), ("", "B", "core", "m"), ("3", "c", "peripheral", "m")], "discogs_artist_id string, artist_name string, priority string, musicbrainz_artist_id string")
    assert [(r["artist_name"], r["musicbrainz_artist_id"], r["rank"]) for r in discover.seeds(rows).orderBy("rank").collect()] == [("A", None, 0), ("c", "m", 2)]
    assert [r["n"] for r in catalog.in_order(spark.createDataFrame([("b", 1), ("A", 2)], "n string, _ord int"), "n").collect()] == ["A", "b"]
    clusters = spark.createDataFrame([("x", "high", None), ("y", "low", None), ("z", "high", 1)], "cluster_id string, cluster_confidence string, original int")
    assert [r["cluster_id"] for r in quality.clusters_without_original(clusters).collect()] == ["x"]


def test_ranks_are_those_of_the_whole_order(spark):
    rows = [(k * 7919 % 1000 // 10 / 10.0, k) for k in range(1000)]
    df = spark.createDataFrame(rows, "priority_score double, row_number int").repartition(7)
    made = {r["row_number"]: r["rank"] for r in audit.ranked(df, [F.desc("priority_score"), F.asc("row_number")], "rank").collect()}
    assert made == {k: i for i, (_, k) in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])), 1)}
    assert audit.ranked(df.limit(0), [F.asc("row_number")], "rank").count() == 0


def test_distributed_components_agree_with_the_local_ones(spark):
    edges = spark.createDataFrame([(0, k) for k in range(1, 80)] + [(100 + k, 101 + k) for k in range(30)], "a long, b long")
    here, there = (connected_components(edges, "a", "b", local_edges=n) for n in (10**6, 0))
    assert sorted(map(tuple, here.collect())) == sorted(map(tuple, there.collect()))


def _split(monkeypatch):
    """From now on a few rows make several parts; gives the numbers of parts."""
    from catloom.runtime import Sliced

    seen, before = [], Sliced.parts
    monkeypatch.setattr(Sliced, "ROWS", 1500)
    monkeypatch.setattr(Sliced, "parts", lambda self, *others: seen.append(before(self, *others)) or seen[-1])
    return seen


def _oracle(name):
    import os

    import duckdb

    from catloom.plans import catalogue

    sf, db = "/root/testdata/sf0.001", duckdb.connect()
    for f in os.listdir(sf):
        db.execute(f"create view {f[:-8]} as select * from '{sf}/{f}'")
    return catalogue.queries()[name], sf, db.execute(catalogue.oracle_sql()[name]).fetchdf()


def _same(mine, theirs):
    columns = sorted(theirs.columns)
    rows = lambda d: sorted(tuple(map(str, r)) for r in d[columns].itertuples(index=False))
    assert sorted(mine.columns) == columns and rows(mine) == rows(theirs)


def test_canonicalise_in_parts(spark, monkeypatch):
    query, sf, theirs = _oracle("canonicalise")
    seen = _split(monkeypatch)
    _same(query(spark, sf).toPandas(), theirs)
    assert [sorted(sum(x, [])) for x in seen] == [list(range(16))] * 3 and all(len(x) > 2 for x in seen)


def test_sources_are_met_in_parts(spark, monkeypatch):
    seen = _split(monkeypatch)
    for name in ("lineage_fill", "dim_tracks"):
        query, sf, theirs = _oracle(name)
        seen.clear()
        _same(query(spark, sf).toPandas(), theirs)
        assert len(seen) == 1 and len(seen[0]) > 2 and sorted(sum(seen[0], [])) == list(range(16))


def test_gates_read_keys_in_parts(spark, monkeypatch):
    from catloom.operators import catalog
    from catloom.plans.disc import disc

    query, sf, theirs = _oracle("quality_status")
    seen = _split(monkeypatch)
    mine = query(spark, sf).toPandas()
    assert [sorted(map(str, mine.iloc[0][c])) if c in ("issues", "warnings") else mine.iloc[0][c] for c in sorted(theirs.columns)] == [
        sorted(map(str, theirs.iloc[0][c])) if c in ("issues", "warnings") else theirs.iloc[0][c] for c in sorted(theirs.columns)]
    assert len(seen) == 1 and len(seen[0]) > 2
    rows = disc(spark, sf)
    ids = lambda df: sorted(map(tuple, df.select("work_id").collect()))
    assert ids(catalog.keys(rows)["works"]) == ids(catalog.works(rows))


def test_reconcile_log_in_parts(spark, monkeypatch):
    query, sf, theirs = _oracle("reconcile_log")
    seen = _split(monkeypatch)
    _same(query(spark, sf).toPandas(), theirs)
    assert len(seen) == 1 and len(seen[0]) > 2 and sorted(sum(seen[0], [])) == list(range(16))


def test_strip_takes_all_white_space(spark):
    from catloom.functions import text

    rows = [(chr(i) + "a" + chr(i) + "b" + chr(i) * 2,) for i in range(1, 0x3100)] + [("",), (" \n",), (None,)]
    data = spark.createDataFrame(rows, "s string")
    assert data.filter(text.strip("s") != F.regexp_replace(F.coalesce("s", F.lit("")), r"(?U)^\s+|\s+$", "")).count() == 0


def test_duplicate_classes_count_all_pairs(spark):
    import random

    from catloom.operators import duplicate_classes
    from tests.test_operators import BASE, entry_rows

    rng, words = random.Random(7), "amber stone river light night paper garden window".split()
    rows = []
    for k in range(90):
        title = " ".join(rng.sample(words, rng.choice([1, 1, 2, 2, 3, 4])))
        title += rng.choice(["", "", " / Second Long Piece", " / Second Long Piece", " / Other Fine Work / Second Long Piece", " / The Of", "s"])
        rows.append(BASE | {
            "song_name": title, "artist": rng.choice(["A", "a ", "B"]), "version_type": rng.choice(["same_master", "same_master", "", "unknown"]),
            "source_release_id": rng.choice(["", "", "", "r1"]), "spotify_url": rng.choice(["", "", "", "https://open.spotify.com/x"]), "release_category": rng.choice(["original", "compilation"]),
        })
    items = duplicates.entries(entry_rows(spark, rows))
    pairs = duplicates.pairs(items)
    plain = lambda df: sorted(map(str, df.collect()))
    assert plain(duplicate_classes.counts(items, hub=5)) == plain(duplicates.counts(pairs))
    assert plain(duplicate_classes.clusters(items, hub=5)) == plain(duplicates.clusters(items, pairs))


def test_titles_that_share_a_frequent_part_are_not_listed_in_pairs(spark):
    from catloom.operators import duplicate_classes
    from tests.test_operators import BASE, entry_rows

    letters = "abcdefghijklmnopqrstuvwxyz"
    name = lambda k: " ".join(letters[(k * 7 + j * j * (k + 3)) % 26] * (3 + j) for j in range(6)) + f" q{k}"
    items = duplicates.entries(entry_rows(spark, [BASE | {"song_name": f"{name(k)} / Second Long Piece", "artist": f"A{k % 3}"} for k in range(60)]))
    assert duplicate_classes.Classes(items, hub=20).listed().count() < 60 * 59 / 2 / 4
    found = {(r["kind"], r["value"]): r["pairs"] for r in duplicate_classes.counts(items, hub=20).collect()}
    assert found["match_type", "component_overlap"] == 60 * 59 / 2


def test_similar_pairs_in_slices_leave_no_windows(spark, monkeypatch):
    from difflib import SequenceMatcher
    from pathlib import Path

    from catloom import runtime
    from catloom.operators import blocking
    from tests.test_operators import similar_texts

    monkeypatch.setattr(blocking, "SLICE_CHARS", 500, raising=False)
    texts = list(dict.fromkeys(similar_texts()))
    df = spark.createDataFrame([(t,) for t in texts], "a string")
    root = Path(runtime.checkpoint_root(spark).removeprefix("file://"))
    before = set(root.glob("windows-*"))
    found = {(r["a"], r["b"]) for r in blocking.similar_pairs(df, df.toDF("b"), "a", "b", 0.85).collect()}
    assert found == {(a, b) for a in texts for b in texts if SequenceMatcher(None, a, b).ratio() >= 0.85}
    assert set(root.glob("windows-*")) == before


def test_rows_stay_where_they_are_without_a_log(spark, monkeypatch):
    """with an empty log nothing is dealt; the entries are those that no entry of the log leads to."""
    from pyspark.sql import functions as F

    from catloom.operators import reconcile
    from catloom.plans import table_queries

    rows, dealt = table_queries.disc(spark, "/root/testdata/sf0.001").limit(50), []
    known = table_queries.log_entries(spark, "/root/testdata/sf0.001").limit(1).withColumn("artist", F.lit("nobody"))
    want = sorted(map(str, reconcile.reconcile(rows, known, F.lit(0)).collect()))
    put = reconcile.Sliced.of.__func__
    monkeypatch.setattr(reconcile.Sliced, "of", classmethod(lambda cls, df, key: dealt.append(df) or put(cls, df, key)))
    found = reconcile.reconcile(rows, known.limit(0), F.lit(0))
    assert sorted(map(str, found.collect())) == want and len(want) == 50
    assert len(dealt) == 1 and "spotify_url" not in dealt[0].columns


def syllables(rng, n):
    out = ""
    while len(out) < n:
        out += rng.choice("th he an in er nd on re ha ou the tion".split()) + " " * (rng.random() < 0.3)
    return out[:n]


def test_candidates_are_what_the_common_subsequence_allows(spark):
    """texts of one language shared so many segments that most candidates came to nothing."""
    import random

    from catloom.operators import blocking

    rng = random.Random(5)
    texts = [syllables(rng, rng.randint(40, 70)) for _ in range(300)]
    df = spark.createDataFrame([(k, t) for k, t in enumerate([*texts, texts[0][:-2] + "xy"])], "id long, text string")
    assert {(r["l"], r["r"]) for r in blocking.candidate_pairs(df, None, 0.85).collect()} == {(0, 300), (300, 0)}


def test_long_texts_meet_by_blocks(spark):
    """beyond 200 characters, with frequent characters left out, one repeated word, and texts of rare characters only."""
    import random
    from difflib import SequenceMatcher

    from catloom.operators import blocking

    rng, texts = random.Random(6), []
    for k in range(24):
        n = rng.randint(195, 900)
        base = syllables(rng, n) if k % 4 else (syllables(rng, 5) + " ") * (n // 6) if k % 8 else "".join(map(chr, rng.sample(range(0x4E00, 0x9000), 300)))
        texts.append(base)
        for share in (0.02, 0.06, 0.1):
            made = list(base)
            for _ in range(int(len(made) * share)):
                made[rng.randrange(len(made))] = rng.choice("qzkvw ")
            texts.append("".join(made)[rng.randint(0, 20) :])
    texts = list(dict.fromkeys(texts))
    df = spark.createDataFrame([(t,) for t in texts], "a string")
    for threshold in (0.85, 0.92):
        want = {(a, b) for a in texts for b in texts if SequenceMatcher(None, a, b).ratio() >= threshold}
        assert len(want) > len(texts)
        assert {(r["a"], r["b"]) for r in blocking.similar_pairs(df, df.toDF("b"), "a", "b", threshold).collect()} == want
        made = blocking.numbered(df, "a")
        name = {r["id"]: r["text"] for r in made.collect()}
        met = [(name[r["l"]], name[r["r"]]) for r in blocking.candidate_pairs(made, None, threshold).collect()]
        assert len(met) == len(set(met)) and {p for p in want if p[0] != p[1]} <= set(met)


def test_neighbouring_characters_rule_pairs_out_and_lose_none(monkeypatch):
    """same-language texts of a hundred characters share most characters, so their subsequences were all computed."""
    import random

    import numpy as np

    from catloom.operators import blocking

    rng, seen = random.Random(8), []
    texts = ["".join(rng.choices("eetaoinshrd ", k=rng.randint(90, 115))) for _ in range(120)]
    for t in texts[:40]:
        made = list(t)
        for _ in range(rng.randint(1, 12)):
            made[rng.randrange(len(made))] = rng.choice(["", "q", "th", " "])
        texts.append("".join(made))
    texts += ["x", "ab" * 60, "ba" * 60, "\U0001F600" * 80, "a" * 300]
    want = {
        (x, y) for x, a in enumerate(texts) for y, b in enumerate(texts)
        if x < y and 2 * blocking._common_length(blocking._codes(a), blocking._codes(b)) >= 0.88 * (len(a) + len(b)) - 1e-6
    }
    reaching = blocking._reaching
    monkeypatch.setattr(blocking, "_reaching", lambda *args: seen.append(len(args[4])) or reaching(*args))
    found = blocking._near(texts, texts, 0.88, True)
    assert set(zip(*(v.tolist() for v in found))) == want and len(want) >= 30
    assert sum(seen) < 4 * len(want)  # characters alone leave some four hundred more
    every = [(x, y) for x in range(len(texts)) for y in range(x + 1, len(texts))]
    allowed = blocking._allowed([texts[x] for x, _ in every], [texts[y] for _, y in every], 0.88)
    assert {every[k] for k in np.flatnonzero(allowed)} == want


def test_pairs_are_decided_once(spark, monkeypatch):
    """pairs of cells went through the common subsequence again, and each of a table with itself both ways round."""
    from catloom.operators import blocking, duplicates
    from tests.test_operators import BASE, entry_rows

    rows = [BASE | {"song_name": f"{'w' * k}orld of {'q' * (9 - k)}uiet things {k}"} for k in range(8)] + [BASE | {"song_name": "quiet things of the world"}]
    items, met = duplicates.entries(entry_rows(spark, rows)), []
    made = duplicates.candidate_pairs
    monkeypatch.setattr(blocking, "_allowed", None)  # no long texts: nothing is left to decide
    monkeypatch.setattr(duplicates, "candidate_pairs", lambda *args: met.append(made(*args)) or met[-1])
    pairs = [tuple(r) for r in duplicates.candidate_titles(items).collect()]
    assert len(pairs) == len(set(pairs)) and len(pairs) >= 7 and met


def test_common_length_is_that_of_a_plain_table():
    import random

    import numpy as np

    from catloom.operators import blocking

    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last, row = row, [0]
            for k, y in enumerate(b):
                row.append(last[k] + 1 if x == y else max(row[-1], last[k + 1]))
        return row[-1]

    rng = random.Random(4)
    for k in range(300):
        a, b = ([rng.randrange(3) for _ in range(rng.randint(0, 12))] for _ in "ab")
        a, b = (a, b) if k % 3 else (a + b, a[: k % 5] + a + b)
        assert blocking._common_length(np.array(a, np.uint8), np.array(b, np.uint8)) == plain(a, b), (a, b)


def test_overlap_links_are_those_of_all_pairs(spark):
    import random

    from catloom.operators import blocking

    rng = random.Random(2)
    texts = sorted({" ".join(["the", *(rng.choice("abcdefghijkl") for _ in range(rng.randint(0, 6)))]) for _ in range(150)})
    words = {t: set(t.split(" ")) for t in texts}
    overlap = lambda a, b: len(words[a] & words[b]) / len(words[a] | words[b])
    df = spark.createDataFrame([(t,) for t in [*texts, None, texts[0]]], "t string")
    for threshold in (0.5, 0.75, 1.0):
        out = {r["t"]: (r["n_links"], r["best"], r["nearest"]) for r in blocking.overlap_links(df, "t", threshold).collect()}
        for t in texts:
            found = sorted((-overlap(t, u), u) for u in texts if u != t and overlap(t, u) >= threshold)
            assert out[t] == ((len(found), -found[0][0], found[0][1]) if found else (0, None, None))


def test_deep_pages_are_read(spark):
    from catloom.operators import extract

    deep = "<div>" * 3000 + "<h1>Artist - Album</h1>" + "</div>" * 3000 + "</p>" * 3000
    pages = spark.createDataFrame([("http://h/x", deep), ("http://h/y", None), ("http://h/y", "<h1>B</h1>"), ("http://h/[", "<a href='http://[x'>z</a>")], "url string, body string")
    assert extract.elements(pages).filter("tag = 'h1'").count() == 2
    assert extract.page_links(pages).count() == 0


def test_jaccard_pairs_lists_every_pair_with_a_common_word(spark, tmp_path):
    from catloom.plans import catalogue

    names = ["a b", "B a", "b c d e f", "f", "g", "the a", "the the", None, "A b"]
    spark.createDataFrame([(n,) for n in names], "p_name string").write.parquet(str(tmp_path / "part.parquet"))
    out = [tuple(r) for r in catalogue.queries()["jaccard_pairs"](spark, str(tmp_path)).collect()]
    texts = sorted({n.lower() for n in names if n})
    words = {t: set(t.split(" ")) for t in texts}
    wanted = [(a, b, len(words[a] & words[b]) / len(words[a] | words[b])) for a in texts for b in texts if a < b and words[a] & words[b]]
    assert sorted(out) == wanted and min(x[2] for x in out) < 0.5
    _same(*(lambda query, sf, theirs: (query(spark, sf).toPandas(), theirs))(*_oracle("jaccard_pairs")))


def test_excess_groups_by_hashes(spark):
    from tests.test_operators import BASE, fact

    rows = fact(spark, [BASE, BASE | {"artist": f" {BASE['artist'].upper()} "}, BASE | {"song_name": "other"}])
    made = quality.duplicate_excess(rows)
    assert made.first()["excess"] == 1 and "keys=[__key_1" in made._jdf.queryExecution().executedPlan().toString()


def test_merge_gives_the_named_columns_alone(spark):
    from catloom.operators import dedupe
    from tests.test_operators import BASE, fact

    rows = fact(spark, [BASE | x for x in ({"notes": "  ", "alternative_names": "b, a"}, {"notes": " n "}, {"notes": "n", "alternative_names": "a, c"}, {"notes": "m"}, {"song_name": "alone", "notes": " x "}, {"song_name": "blank", "notes": " "}, {"song_name": "blank"})])
    out = dedupe.merge_duplicates(rows, columns=["notes", "alternative_names"])
    assert out.columns == ["_ord", "alternative_names", "notes", "_copies"]
    whole = dedupe.merge_duplicates(rows).select(*out.columns)
    plain = lambda df: sorted(tuple(r)[1:] for r in df.collect())
    assert plain(out) == plain(whole) == [("", " ", 2), ("", " x ", 1), ("b, a, c", "n | m", 4)]


def _sorts(spark, make):
    """What the plan of a table sorts by where nothing is broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        plan = make()._jdf.queryExecution().sparkPlan().toString() + make()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(name, before)
    return [line for line in plan.replace("\n", " ").split("+- ") if "SortMergeJoin" in line[:14] or line.startswith("Sort ")]


def test_keys_of_the_fact_table_are_sorted_as_hashes(spark):
    from catloom.operators import lineage
    from tests.test_operators import BASE, fact

    rows = fact(spark, [BASE | {"track_position": str(k), "artist": f"A{k % 2}"} for k in range(1, 5)])
    for make, key in ((lambda: lineage.normalised(rows), "__album_1"), (lambda: lineage.lineage_filled(rows), "__of_1"), (lambda: catalog.tracks(rows), "__of_1")):
        sorts = _sorts(spark, make)
        assert sorts and all(key in x for x in sorts if "SortMergeJoin" in x)


def test_entries_move_once_and_both_signatures_find_them(spark):
    from catloom.operators import reconcile
    from tests.test_operators import BASE, fact

    event = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in reconcile.EVENT])
    rows = fact(spark, [BASE | {"row_type": t} for t in ("track", "album", "single")] + [BASE | {"song_name": "none"}])
    entries = fact(spark, [BASE | {"row_type": "track", "label": "1"}, BASE | {"row_type": "album", "label": "2"}, BASE | {"row_type": "odd", "label": "2"}, BASE | {"row_type": "track", "label": "0"}])
    entries = entries.withColumns({c: F.lit(None).cast("string") for c in ("spotify_status", "youtube_status", "confidence_level")}).withColumns({
        "last_search_date": F.concat_ws("-", "row_type", "label"), "search_attempts": F.lit(1).cast("long"), "search_history": F.array_repeat(event, F.col("label").cast("int"))})
    assert len(reconcile._by_legacy(entries, "_ord").collect()) == 1
    out = {(r["song_name"], r["row_type"]): (r["last_search_date"], len(r["search_history"])) for r in reconcile.reconcile(rows, entries, F.lit(0)).collect()}
    song = BASE["song_name"]
    assert out == {(song, "track"): ("track-1", 1), (song, "album"): ("album-2", 2), (song, "single"): ("album-2", 2), ("none", "track"): (None, 0)}
