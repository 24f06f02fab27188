"""Files, services and the incremental intake."""

import json

import pytest
from pyspark.sql import functions as F

from catloom import schema
from catloom.sources import files, rest
from catloom.streaming import intake

HEAD = ",".join(schema.SOURCE)


def test_csv_keeps_order_quotes_and_empties(spark, tmp_path):
    (tmp_path / "b.csv").write_text(HEAD + '\n"x, ""y""","two\nlines",,,,,,,,\n', encoding="utf-8")
    (tmp_path / "a.csv").write_text(HEAD + "\n" + "\n".join(f" s{i} ,,,,,,,,," for i in range(3000)) + "\n", encoding="utf-8")
    rows = files.read_feeds(spark, str(tmp_path)).orderBy("_ord").collect()
    assert [r["_ord"] for r in rows] == list(range(3001)) and rows[0]["artist"] == "s0" and rows[2999]["artist"] == "s2999"
    assert rows[3000]["artist"] == 'x, "y"' and rows[3000]["album_name"] == "two\nlines" and rows[3000]["song_name"] == "" and rows[3000]["discovery_source"] == "b"


def test_strict_reading(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b\n1,\n", encoding="utf-8")
    assert files.read_strict(spark, str(path), ["a", "b"]).first()["b"] == ""
    with pytest.raises(schema.SchemaMismatch) as error:
        files.read_strict(spark, str(path), ["b", "c"])
    assert error.value.missing == ["c"] and error.value.extra == ["a"]
    with pytest.raises(schema.SchemaMismatch):
        files.read_strict(spark, str(path), ["b", "a"])
    with pytest.raises(schema.SchemaMismatch):
        files.read_strict(spark, str(path), ["a", "b"], min_rows=2)
    with pytest.raises(FileNotFoundError):
        files.read_strict(spark, str(tmp_path / "none.csv"))
    assert files.read_optional(spark, str(tmp_path / "none.csv"), ["a"]).count() == 0


def test_guarded_writes(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.createDataFrame([(i, f"r{i}", 'q"') for i in range(20)], "_ord long, a string, b string")
    change = files.Change(rows, path, columns=["a", "b"], expected=["a", "b"])
    assert change.plan()["rows"] == 20 and not files.exists(spark, path)
    change.commit()
    back = files.read_csv(spark, path, ["a", "b"]).orderBy("_ord").collect()
    assert [r["a"] for r in back] == [f"r{i}" for i in range(20)] and back[0]["b"] == 'q"'
    with pytest.raises(ValueError):
        files.write_csv(rows.limit(5), path, ["a", "b"])
    assert files.read_csv(spark, path, ["a", "b"]).count() == 20
    files.write_csv(rows.limit(19), path, ["a", "b"])
    assert files.exists(spark, path + ".bak")
    files.append_csv(rows.limit(1).drop("_ord"), path, ["a", "b"])
    assert files.read_csv(spark, path, ["a", "b"]).count() == 20


def test_manifests(spark, tmp_path):
    rows, path = spark.createDataFrame([(1, "a"), (2, "b")], "i int, t string"), str(tmp_path / "m")
    assert files.verify_manifest(rows, path) == (True, "no manifest")
    files.save_manifest(rows, path)
    assert files.verify_manifest(rows.repartition(3), path) == (True, "unchanged")
    assert not files.verify_manifest(rows.withColumn("t", F.lit("c")), path)[0] and not files.verify_manifest(rows.limit(1), path)[0]


def test_log_and_documents(spark, tmp_path):
    (tmp_path / "log.json").write_text(json.dumps({"version": "2", "entries": [{"row_number": 2, "artist": "A", "search_history": [{"date": "d"}]}]}))
    assert files.read_json_log(spark, str(tmp_path / "log.json")).first()["search_history"][0]["date"] == "d"
    assert files.read_json_log(spark, str(tmp_path / "no.json")).count() == 0
    assert files.read_documents(spark, str(tmp_path)).first()["file"] == "log.json"
    table = files.markdown(spark.createDataFrame([("a|b", None)], "x string, y string"), ["x", "y"])
    assert table.splitlines()[2] == "| a\\|b |  |"


@pytest.mark.parametrize("mode", ["count", "items", "cursor", "until_empty"])
def test_paged_services(spark, tmp_path, mode):
    base = "http://api/{key}?page={page}&offset={offset}&token=secret"
    for page in (1, 2, 3):
        payload = {"pagination": {"pages": 3}, "total": 5, "items": [page], "next": base.format(key="k", page=page + 1, offset=page * 2) if page < 3 else None}
        (tmp_path / (rest.address_key(base.format(key="k", page=page, offset=(page - 1) * 2)) + ".json")).write_text(json.dumps(payload))
    options = {"keys": "k, missing", "address": base, "folder": str(tmp_path), "page_size": 2}
    options |= {"count": {"mode": "count", "total_path": "pagination.pages"}, "items": {"mode": "count", "total_path": "total", "counted_in": "items"}, "cursor": {"mode": "cursor"}, "until_empty": {"mode": "until_empty", "items_path": "items"}}[mode]
    rows = rest.pages(spark, **options).collect()
    assert sorted((r["key"], r["page"]) for r in rows) == [("k", 1), ("k", 2), ("k", 3)]
    assert rest.pages(spark, **options, max_pages=2).count() == 2


def test_fetch_retries_and_keys(tmp_path, monkeypatch):
    import io
    import urllib.error

    asked = []

    def opener(address):
        asked.append(address)
        if len(asked) < 3:
            raise urllib.error.HTTPError(address, 503, "busy", {}, None)
        return io.BytesIO(b'{"a": 1}')

    assert rest.fetch("http://x", pause=0, opener=opener) == {"a": 1} and len(asked) == 3

    def missing(address):
        raise urllib.error.HTTPError(address, 404, "none", {}, None)

    assert rest.fetch("http://x", opener=missing) is None
    assert rest.address_key("http://x?a=1&token=p") == rest.address_key("http://x?token=q&a=1")
    (tmp_path / ".env").write_text("CATLOOM_TEST='v'\n# c\n")
    monkeypatch.delenv("CATLOOM_TEST", raising=False)
    assert rest.load_env(str(tmp_path / ".env")) == {"CATLOOM_TEST": "v"} and rest.require_env("CATLOOM_TEST") == "v"
    with pytest.raises(RuntimeError):
        rest.require_env("CATLOOM_NOT_SET")


def test_incremental_intake_resumes(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    make = lambda rows: spark.createDataFrame(rows, "k string, o long").coalesce(1).write.mode("append").parquet(source)
    make([("a", 5), ("a", 3), ("b", 9)])
    intake.stream(spark, source, target, state, ["k"], "o")
    make([("b", 1), ("c", 2)])
    intake.stream(spark, source, target, state, ["k"], "o")
    intake.stream(spark, source, target, state, ["k"], "o")
    assert {r["k"]: r["o"] for r in intake.latest(spark, target).collect()} == {"a": 3, "b": 1, "c": 2}
