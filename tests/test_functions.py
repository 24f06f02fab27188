"""Text, id, value and similarity functions against hand-made expectations and the standard library."""

from difflib import SequenceMatcher

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catloom.functions import ids, similarity, text, values


def column(spark, function, cases, *more):
    """Results of a one-argument function over a list, in order."""
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, t string")
    return [r["v"] for r in df.select("i", function("t").alias("v")).orderBy("i").collect()]


TABLE = [
    (text.strip, {"\t a \n": "a", None: "", " x ": "x"}),
    (text.matching_title, {"[tag] X  Y": "X Y", "[tag]X": "[tag]X", "X (feat. A) Z": "X Z", "X (Featuring B)": "X", None: ""}),
    (text.base_title, {"X - Remix": "X", "X - Remixed": "X - Remixed", "X (Live)": "X", "(Live)": "(Live)", "A - B": "A - B", "X (7 inch MIX)": "X", " ": ""}),
    (text.detector_base_title, {"X - Remixed": "X", "X (Mono)": "X", "Alive": "Alive", "[a] X - radio": "X"}),
    (text.norm_matching, {"Éte-à!  B": "éteà b", None: "", "under_score": "under_score"}),
    (text.norm_compare, {"A & B, Pt. 2": "a and b", "X - Live": "x", "Éa": "a", "!!!": ""}),
    (text.norm_audit, {"[x] Go 4 it 2 day": "go for it to day", "A feat. B": "a", "A (ft. B) C": "a c"}),
    (text.norm_strict, {"A (ft. B) & C": "a and c", "A feat. B": "a feat b"}),
    (text.norm_cache, {"The A&B (feat. C)": "aandb", "[t] Of the D": "of d"}),
    (text.norm_discovery, {"A&B (FT. c)": "a and b"}),
    (text.query_text, {" A (feat. B) ": "A"}),
    (lambda c: text.bounded_query_text(c, 10), {"abc defg hijk": "abc defg", "abcdefghijkl m": "abcdefghij", "ab [x] cd": "ab cd"}),
    (text.title_forms, {"A (Live) / B": ["a", "a b", "a live", "a live b", "b"], "": [], "X aka Y - Z": ["x aka y z", "y", "y z", "z"]}),
    (text.artist_credits, {"A & B feat. C": ["A & B feat. C", "A", "B", "C"], "A, a": ["A, a", "A"], None: []}),
    (text.title_components, {"A1 / B2 / A1": ["a1 b2 a1", "a1", "b2"], "!": []}),
    (text.comma_list, {"a, b,,a ": ["a", "b", "a"], None: []}),
    (lambda c: text.joined_list(text.comma_list(c)), {"a, b,a": "a, b", "": ""}),
    (lambda c: text.tokens(F.col(c)), {"the jam of a jam x fire": ["fire", "jam"]}),
    (lambda c: text.title_case(F.col(c)), {"bootsy's rubber-band": "Bootsy'S Rubber-Band"}),
    (lambda c: text.tags_to_artist(F.split(c, ",")), {"some-band,Book,other": "Some Band, Other", "book": ""}),
    (lambda c: text.artist_and_title(c, "D")["artist"], {"A – B": "A", "A - B – C": "A - B", "X": "D", "X - Live": "D"}),
    (lambda c: text.artist_and_title(c, "D")["title"], {"A – B": "B", "A - B – C": "C", "X": "X", "X - Live": "X"}),
    (text.host, {"https://a.b:8/c": "a.b:8", "nothing": "", None: ""}),
    (lambda c: text.link_parts(c)["id"], {"https://open.spotify.com/track/a1?x": "a1", "https://x.y/track/a": None}),
    (values.whole_seconds, {"007": "7", "0": "0", "12.5": "", " 3 ": "3"}),
    (lambda c: values.date_tuple(c)["month"], {"1975": 99, "1975-03": 3, "1975-3": 99, "x": 99}),
    (lambda c: values.date_tuple(c)["year"], {"1975": 1975, "1975-03-01": 1975, "": 9999, "75": 9999}),
    (values.is_partial_date, {"1975": True, "1975-03-01": True, "1975-3": False}),
    (lambda c: values.heading_date(c)["month_day"], {"March 5": "03-05", "may": "05-01", "1975": None, "Marching": None}),
    (lambda c: values.heading_date(c)["year"], {"1975": "1975", "May 5": None}),
    (lambda c: values.pivot_year(F.col(c)), {"69": "2069", "70": "1970", "x": None}),
    (lambda c: values.at_least(c, "medium"), {"HIGH": True, "low": False, "odd": False, None: False}),
    (lambda c: values.core_act(c), {"Bootsy Collins": True, "Other": False}),
    (values.album_kind, {"Compilation": "compilation", "odd": "album", None: "album"}),
    (values.release_group_kind, {"EP": "album", "Single": "single"}),
    (lambda c: values.track_position(F.lit("track"), c, F.lit(9)), {"3": "3/9", "12": "12", "1/2": "1/2", "A1": "A1", "": ""}),
    (lambda c: text.version_type(c, F.lit(""), F.lit("")), {"X (Dub)": "remix_or_edit", "X live": "live_recording", "Alive": "same_master", "re-record": "re_recording"}),
    (lambda c: text.subtype_tags(c, F.lit("remaster"), F.lit(""), F.lit(True)), {"Deliver": ["remastered", "live", "compilation_copy"], "Radio Mix": ["radio_edit", "remix", "remastered", "compilation_copy"]}),
]


@pytest.mark.parametrize("row", range(len(TABLE)))
def test_function(spark, row):
    function, cases = TABLE[row]
    assert column(spark, function, list(cases)) == list(cases.values())


def test_ids(spark):
    import hashlib

    made = column(spark, lambda c: ids.slug_hash("art", c, F.lit(" B ")), [" Ä a "])
    assert made == ["art_" + hashlib.sha1("ä a|b".encode()).hexdigest()[:12]]
    df = spark.createDataFrame([([10, 2],)], "n array<int>")
    assert df.select(ids.cluster_id(F.col("n"))).first()[0] == "dup_" + hashlib.sha1(b"2|10").hexdigest()[:12]


def test_confidence_uses_the_unrounded_sum(spark):
    df = spark.createDataFrame([(["wikipedia"], "1975", "l", "t")], "s array<string>, release_date string, label string, row_type string")
    score = values.source_score(F.col("s"), ["release_date", "label", "row_type"], F.lit(False))
    assert df.select(values.confidence_of(score)).first()[0] == "high"


def test_ratios_are_the_standard_ones(spark):
    cases = [("tide", "diet"), ("diet", "tide"), ("", ""), ("a", ""), ("x" * 250, "x" * 249 + "y"), ("abc def", "abd def")]
    df = spark.createDataFrame(cases, "a string, b string")
    found = [r[0] for r in df.select(similarity.sequence_ratio(F.col("a"), F.col("b"))).collect()]
    assert found == [SequenceMatcher(None, a, b).ratio() for a, b in cases]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.text("abcé 9", max_size=12), st.text("abcé 9", max_size=12)), min_size=20, max_size=20))
def test_bag_bound_is_never_below_the_ratio(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    bound = similarity.bag_bound(text.let(F.col("a"), similarity.bag), text.let(F.col("b"), similarity.bag))
    for r in df.select("a", "b", bound.alias("u")).collect():
        assert r["u"] >= SequenceMatcher(None, r["a"], r["b"]).ratio() - 1e-9


def test_title_and_artist_similarity(spark):
    df = spark.createDataFrame([("X (Live)", "x", "Various Artists", ["Someone"]), ("A", "B", "P & Q", ["Q"])], "e string, f string, a string, n array<string>")
    out = df.select(similarity.title_similarity(F.col("e"), F.col("f")).alias("t"), similarity.artist_similarity(F.col("a"), F.col("n")).alias("s")).collect()
    assert [(r["t"], r["s"]) for r in out] == [(1.0, 0.75), (0.0, 1.0)]


def test_video_scores(spark):
    df = spark.createDataFrame([("Artist - Topic", "Song (Official)")], "ch string, ti string")
    score = values.video_score(F.lit(1.0), F.lit(True), F.lit(1.0), F.col("ch"), F.col("ti"))
    assert df.select(score).first()[0] == pytest.approx(1.0)
    assert df.select(text.video_url(F.lit("k#video"), F.lit("v"), F.lit(None)), text.video_url(F.lit("k#playlist"), F.lit(None), F.lit("p"))).first()[:] == (
        "https://www.youtube.com/watch?v=v", "https://www.youtube.com/playlist?list=p")


@pytest.mark.parametrize("n", [3, 400])
def test_a_ratio_is_computed_once_for_title_and_parts(monkeypatch, n):
    """the classifier took the ratio of two titles again as that of their sorted tokens and, twice, of their parts."""
    import pandas as pd

    a, b, made = f"one quiet river {n} " * n, f"one quiet rover {n} " * n, []

    class Counted(SequenceMatcher):
        def ratio(self):
            made.append(1)
            return super().ratio()

    monkeypatch.setattr(similarity, "SequenceMatcher", Counted)
    want = SequenceMatcher(None, a, b).ratio()
    assert similarity.sequence_ratio.func(pd.Series([a]), pd.Series([b])).tolist() == [want]
    assert similarity.components_meet.func(pd.Series([[a]]), pd.Series([[b]]), pd.Series([want])).tolist() == [True]
    assert similarity.best_ratio.func(pd.Series([[a]]), pd.Series([[b]])).tolist() == [want]
    assert len(made) == 1
    assert similarity.sequence_ratio.func(pd.Series([None]), pd.Series([""])).tolist() == [1.0]
