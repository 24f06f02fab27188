"""Answers that expire: a keyed stream with a timer per key.

State holds the newest answer of every key and nothing else, and a timer goes off once event time (the watermark) has passed its
time to live; then the answer leaves the state and an ``expired`` row says so. State is in RocksDB, so it may exceed memory, and
is restored from the checkpoint after a restart or a lost executor. Keys are dealt by hash; a busy key costs one state entry.

Defined results: rows of null key or time are no answers; an answer that is not newer than the one held is ignored; of answers
of one time the largest payload counts; a null payload is an answer without contents; rows behind the watermark are dropped by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

DAYS = 7
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EVENTS = "key string, event string, payload string, at timestamp"


def _time(ms: int) -> datetime:
    return datetime.fromtimestamp(ms // 1000, timezone.utc) + timedelta(milliseconds=ms % 1000)


class Expiry(StatefulProcessor):
    """``stored`` when a key gets a newer answer, ``expired`` when the newest is ``days`` old."""

    def __init__(self, days: float):
        self.life = int(days * 86_400_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.answer = handle.getValueState("answer", "payload string, ms long")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self.answer.get() if self.answer.exists() else None
        best = (held[1], held[0] or "") if held else None
        newest = None
        for row in rows:
            if best is None or (row.ms, row.payload or "") > best:
                best, newest = (row.ms, row.payload or ""), row
        if newest is None:
            return
        if held:
            self.handle.deleteTimer(held[1] + self.life)
        self.answer.update((newest.payload, newest.ms))
        self.handle.registerTimer(newest.ms + self.life)
        yield Row(key=key[0], event="stored", payload=newest.payload, at=_time(newest.ms))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self.answer.get() if self.answer.exists() else None
        if held and held[1] + self.life <= expiredTimerInfo.getExpiryTimeInMs():
            self.answer.clear()
            yield Row(key=key[0], event="expired", payload=held[0], at=_time(held[1] + self.life))

    def close(self) -> None:
        pass


def expiring(answers: DataFrame, key: str = "key", payload: str = "payload", at: str = "fetched_at", days: float = DAYS, delay: str = "0 seconds") -> DataFrame:
    """The stream of ``key, event, payload, at`` of a stream of answers."""
    named = answers.select(F.col(key).cast("string").alias("key"), F.col(payload).cast("string").alias("payload"), F.col(at).cast("timestamp").alias("at"))
    timed = named.filter("key is not null and at is not null").withWatermark("at", delay).withColumn("ms", F.unix_millis("at"))
    return timed.groupBy("key").transformWithState(Expiry(days), EVENTS, "Append", "EventTime")


def run(spark: SparkSession, source: str, target: str, checkpoint: str, schema: str, files_per_batch: int | None = None, **options) -> None:
    """Process the answers that are there into ``target``, then stop; the checkpoint remembers state, timers and files."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, PROVIDER)
    try:
        reader = spark.readStream.schema(schema)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        events = expiring(reader.parquet(source), **options)
        events.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def live(events: DataFrame) -> DataFrame:
    """``key, payload, at`` of the answers that have not expired: of every key the newest, unless it is gone."""
    newest = events.groupBy("key").agg(
        F.max(F.when(F.col("event") == "stored", F.struct("at", "payload"))).alias("kept"), F.max(F.when(F.col("event") == "expired", F.col("at"))).alias("gone"), F.count_if(F.col("event") == "expired").alias("n")
    )
    return newest.filter("gone is null or kept.at > gone").select("key", "kept.payload", "kept.at")
