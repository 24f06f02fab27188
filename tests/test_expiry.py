"""Answers expire after seven days of event time, across restarts, as a batch filter says."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from catloom.operators import enrich
from catloom.streaming import expiry

SCHEMA = "key string, payload string, fetched_at timestamp"


def test_replayed_answers_expire(spark, tmp_path):
    start = datetime(2024, 1, 1)
    day = lambda n: start + timedelta(days=n)
    batches = [
        [("a", "1", day(0)), ("b", "1", day(1)), ("b", "0", day(0.5)), (None, "x", day(0)), ("n", None, day(2)), ("t", "x", None)],
        [("a", "2", day(5)), ("c", "1", day(6)), ("c", "2", day(6))],
        [("d", "1", day(8.5))],  # b, since day 1, is gone; a was renewed
        [("b", "late again", day(9)), ("e", "1", day(9.5))],
        [("f", "1", day(12.5))],  # a, since day 5, is gone
        [("g", "1", day(12.6))],
    ]
    source, target, state = (str(tmp_path / x) for x in ("in", "out", "state"))

    def replay(rows):
        for k, part in enumerate(rows):
            spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        expiry.run(spark, source, target, state, SCHEMA, files_per_batch=1)

    for part in batches[:2], batches[2:4], batches[4:5], batches[5:]:  # a restart between them
        for rows in part:
            replay([rows])
    events = spark.read.parquet(target)
    gone = {(r["key"], r["payload"]) for r in events.filter("event = 'expired'").collect()}
    assert gone == {("b", "1"), ("n", None), ("a", "2")}
    left = {(r["key"], r["payload"]) for r in expiry.live(events).collect()}
    cache = spark.createDataFrame([r for rows in batches for r in rows if r[0] and r[2]], SCHEMA)
    newest = cache.groupBy("key").agg(F.max_by("payload", F.struct("fetched_at", "payload")).alias("payload"), F.max("fetched_at").alias("fetched_at"))
    wanted = {(r["key"], r["payload"]) for r in enrich.fresh(newest, F.lit(day(12.6))).collect()}
    assert left == wanted == {("b", "late again"), ("c", "2"), ("d", "1"), ("e", "1"), ("f", "1"), ("g", "1")}
    expiry.run(spark, source, target, state, SCHEMA)  # nothing new: nothing changes
    assert spark.read.parquet(target).count() == events.count()
