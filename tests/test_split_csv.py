"""Quoted multi-line files read in ranges, against the standard library."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from catloom.sources import files, split_csv


def plain(text, columns):
    rows = [r for r in csv.reader(io.StringIO(text.replace("\r\n", "\n"))) if r]
    return [tuple((r + [""] * columns)[:columns]) for r in rows[1:]]


def cell(rng):
    return "".join(rng.choice(['a', 'é', ',', '"', "\n", "\n\n", "'", " ", "x" * 40]) for _ in range(rng.choice([0, 1, 3, 12])))


@pytest.fixture
def ranges(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    yield lambda size: [spark.conf.set(n, v) for n, v in zip(names, (size, "1"))]
    for n, v in before.items():
        spark.conf.set(n, v)


def test_records_are_those_of_one_task(spark, tmp_path, ranges):
    rng = random.Random(13)
    wanted = []
    for k, end in enumerate(["\n", "\r\n"]):
        out = io.StringIO()
        writer = csv.writer(out, lineterminator="\n")
        writer.writerow(["a", "b, too", "c"])
        for i in range(400):
            writer.writerow([f"{k}:{i}", cell(rng), cell(rng)])
        text = out.getvalue().replace("\n", end) + ("last,no end" if k else "")
        (tmp_path / f"f{k}.csv").write_bytes(text.encode())
        wanted += plain(text, 3)
    for size in ("400", "4096", "128m"):
        ranges(size)
        out = split_csv.read_split_csv(spark, str(tmp_path), ["a", "b, too", "c"], "*.csv")
        rows = sorted((r["_ord"], r["a"], r["b, too"], r["c"]) for r in out.collect())
        assert [r[1:] for r in rows] == wanted and [r[0] for r in rows] == list(range(len(wanted)))
    ranges("4096")
    assert split_csv._text(spark, str(tmp_path), "*.csv").rdd.getNumPartitions() > 4
    assert split_csv.read_split_csv(spark, str(tmp_path), ["a", "b, too", "c"], "*.csv").filter(F.col("_ord") < 5).count() == 5


@pytest.mark.parametrize("text", [
    "", "a,b\n", "a,b", "a,b\n\n\n1,2\n\n", 'a,b\n1,x"y"z\n"q" tail,2\n"un\nended', 'a,b\n"' + "long\n" * 300 + '",1\n2,3\n', 'a,b\n"""",""""""\n"x\n""\n",2\n', "a,b\n1\n1,2,3\n ,\n",
])
def test_odd_files(spark, tmp_path, ranges, text):
    (tmp_path / "x.csv").write_bytes(text.encode())
    ranges("64")
    out = split_csv.read_split_csv(spark, str(tmp_path / "x.csv"), ["a", "b"])
    assert [(r["a"], r["b"]) for r in sorted(out.collect(), key=lambda r: r["_ord"])] == plain(text, 2)


def test_state_of_a_line_is_that_of_the_library():
    rng = random.Random(3)
    for _ in range(3000):
        line = "".join(rng.choice('a",') for _ in range(rng.randint(0, 9)))
        for inside in (False, True):
            # a record goes on if what is appended to it lands in the same record
            rows = list(csv.reader([('"' if inside else "") + line + "\n", "mark\n"]))
            assert split_csv.inside_after(line, inside) == (len(rows) == 1 and not (line == "" and not inside)), (line, inside)


def test_tables_round_trip(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [("1", 'q"uote, and\nbreak', ""), ("2", "", "ü")]
    files.write_csv(spark.createDataFrame(rows, "a string, b string, c string"), path, order=None)
    assert sorted((r["a"], r["b"], r["c"]) for r in files.read_csv(spark, path).collect()) == rows
