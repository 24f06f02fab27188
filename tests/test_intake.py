"""Keep-first merges into a bucketed table: few buckets written, replays without effect, old snapshots readable."""

import os

import pytest
from pyspark.sql import functions as F

from catloom.streaming import intake


def rows(df):
    return sorted(map(tuple, df.select("k", "o", "v").collect()), key=str)


def test_merges_write_only_what_they_change(spark, tmp_path):
    target = str(tmp_path / "t")
    make = lambda data: spark.createDataFrame(data, "k string, o long, v string")
    base = [(f"k{i}", 100, f"v{i}") for i in range(500)] + [(None, 5, "null key"), ("k1", 90, "earlier"), ("k1", 95, "between")]
    assert intake.merge_first(make(base), target, ["k"], "o", 0, buckets=32) == 32
    wanted = {k: (k, o, v) for k, o, v in sorted(base, key=lambda r: -r[1])}
    assert rows(intake.latest(spark, target)) == sorted(wanted.values(), key=str)
    # two keys: two buckets at most; an equal or a later row changes nothing
    assert 1 <= intake.merge_first(make([("k2", 1, "first"), ("new", 7, "n"), ("k3", 100, "same order"), ("k4", 101, "later")]), target, ["k"], "o", 1) <= 2
    wanted |= {"k2": ("k2", 1, "first"), "new": ("new", 7, "n")}
    assert rows(intake.latest(spark, target)) == sorted(wanted.values(), key=str)
    before = intake.snapshot(spark, target)
    assert intake.merge_first(make([("k9", 0, "replayed")]), target, ["k"], "o", 1) == 0  # the batch was there
    assert intake.snapshot(spark, target) == before
    assert intake.merge_first(make([("k5", 100, "x")]), target, ["k"], "o", 2) == 0
    assert intake.merge_first(make([]), target, ["k"], "o", 3) == 0 and rows(intake.latest(spark, target)) == sorted(wanted.values(), key=str)
    reader = intake.latest(spark, target)
    assert intake.merge_first(make([("k6", 2, "y")]), target, ["k"], "o", 4) == 1
    assert rows(reader) == sorted(wanted.values(), key=str)  # what was opened before stays as it was
    folders = len(os.listdir(f"{target}/data"))
    assert intake.vacuum(spark, target, keep=1) == folders - len(set(intake.snapshot(spark, target)["folders"].values()))
    assert len(rows(intake.latest(spark, target))) == len(wanted)


def test_a_failed_batch_leaves_the_table(spark, tmp_path):
    target = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1, "x")], "k string, o long, v string")
    intake.merge_first(df, target, ["k"], "o", 0, buckets=4)
    broken = df.withColumn("k", F.lit("b")).withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        intake.merge_first(broken, target, ["k"], "o", 1)
    assert rows(intake.latest(spark, target)) == [("a", 1, "x")]
    found = intake.snapshot(spark, target)
    with pytest.raises(Exception, match="exist"):  # a second writer of one version
        intake._publish(spark, target, found)
