"""Incremental intake: new files are read once, the first row of every key is kept.

``dropDuplicates`` on a stream does not say which row of a micro-batch stays, and its state never ends; here each
batch is reduced to its first rows and merged into a table that is bucketed by a hash of the key. A batch reads and rewrites only
the buckets in which it changes something. Which folder holds a bucket is said by a *snapshot*, one small file under a number of
its own; a merge is done once its snapshot is there, so readers see the table before or after it and never between, and a
batch that fails leaves files that nothing names. The snapshot also says which batch it came from: a batch that
comes again changes nothing. Folders that no recent snapshot names are deleted by :func:`vacuum`.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catloom.runtime import bounded, cut, shared_path
from catloom.sources.files import _fs

BUCKETS = 64
BUCKET = "__bucket"


def snapshot(spark: SparkSession, target: str) -> dict | None:
    """The newest snapshot: ``version, batch, buckets, folders`` (bucket to folder), ``schema``; None if there is no table."""
    fs, at = _fs(spark, f"{target}/snapshots")
    if not fs.exists(at):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    versions = [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]
    return _load(spark, target, max(versions)) if versions else None


def _load(spark: SparkSession, target: str, version: int) -> dict:
    return json.loads("\n".join(r["value"] for r in spark.read.text(f"{target}/snapshots/{version}.json").collect()))


def _publish(spark: SparkSession, target: str, found: dict) -> None:
    """Write the snapshot; another writer that was first makes this one fail."""
    fs, at = _fs(spark, f"{target}/snapshots/{found['version']}.json")
    out = fs.create(at, False)
    out.write(bytearray(json.dumps(found).encode()))
    out.close()


def _read(spark: SparkSession, target: str, found: dict, buckets: list[str]) -> DataFrame:
    from pyspark.sql import types as T

    schema = T.StructType.fromJson(found["schema"])
    paths = [f"{target}/data/{found['folders'][k]}/{BUCKET}={k}" for k in buckets if k in found["folders"]]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def latest(spark: SparkSession, target: str) -> DataFrame:
    found = snapshot(spark, target)
    return _read(spark, target, found, list(found["folders"]))


def first_of(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    others = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*others), order_col).alias("__r")).select(*keys, "__r.*").select(*df.columns)


def merge_first(batch: DataFrame, target: str, keys: list[str], order_col: str, batch_id: int | None = None, buckets: int = BUCKETS) -> int:
    """Keep, per key, the row of least order among the table and the batch; the number of buckets written.

    ``buckets`` counts when the table is made. Of equal orders the row that is there stays.
    """
    spark = batch.sparkSession
    found = snapshot(spark, target)
    if found is None:
        found = {"version": 0, "batch": -1, "buckets": buckets, "folders": {}, "schema": batch.schema.jsonValue()}
    if batch_id is not None and batch_id <= found["batch"]:
        return 0
    bucket = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(found["buckets"])).cast("int")
    new = cut(first_of(batch, keys, order_col).withColumn(BUCKET, bucket))
    asked = [str(r[0]) for r in new.select(BUCKET).distinct().collect()]  # at most the buckets of the table
    old = _read(spark, target, found, asked)
    known = old.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(order_col).alias("__o"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"__k{i}"))
    better = cut(new.join(known, same & (F.col("__o") <= F.col(order_col)), "left_anti"))
    touched = [str(r[0]) for r in better.select(BUCKET).distinct().collect()]
    if touched:
        kept = _read(spark, target, found, touched).withColumn(BUCKET, bucket)
        gone = bounded(better.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]))
        merged = kept.join(gone, same, "left_anti").unionByName(better.select(*kept.columns))
        folder = uuid.uuid4().hex
        merged.repartition(min(len(touched), 4096), BUCKET).write.partitionBy(BUCKET).parquet(f"{target}/data/{folder}")
        found["folders"] |= {k: folder for k in touched}
    elif batch_id is None and found["version"]:
        return 0
    _publish(spark, target, found | {"version": found["version"] + 1, "batch": found["batch"] if batch_id is None else batch_id})
    return len(touched)


def vacuum(spark: SparkSession, target: str, keep: int = 2) -> int:
    """Delete snapshots but the ``keep`` newest, and folders that none of those names; the number of folders deleted.

    Not to run beside a merge, whose folder no snapshot names yet.
    """
    found = snapshot(spark, target)
    if found is None:
        return 0
    fs, at = _fs(spark, f"{target}/snapshots")
    versions = sorted(int(s.getPath().getName()[:-5]) for s in fs.listStatus(at) if s.getPath().getName().endswith(".json"))
    named = {f for v in versions[-keep:] for f in _load(spark, target, v)["folders"].values()}
    for v in versions[:-keep]:
        fs.delete(_fs(spark, f"{target}/snapshots/{v}.json")[1], False)
    data = _fs(spark, f"{target}/data")[1]
    stale = [s.getPath() for s in fs.listStatus(data) if s.getPath().getName() not in named] if fs.exists(data) else []
    for path in stale:
        fs.delete(path, True)
    return len(stale)


def keep_first_upsert(target: str, keys: list[str], order_col: str, buckets: int = BUCKETS):
    """A batch function for a stream: :func:`merge_first` of every micro-batch."""

    def upsert(batch: DataFrame, batch_id: int) -> None:
        merge_first(batch, target, keys, order_col, batch_id, buckets)

    return upsert


def stream(spark: SparkSession, source: str, target: str, checkpoint: str, keys: list[str], order_col: str, form: str = "parquet", schema=None, files_per_batch: int | None = None, buckets: int = BUCKETS):
    """Process what is there, then stop; the checkpoint remembers what was read."""
    reader = spark.readStream.format(form).schema(schema or spark.read.format(form).load(source).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.load(source)
    query = rows.writeStream.foreachBatch(keep_first_upsert(target, keys, order_col, buckets)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def run_once(spark: SparkSession, source: str, keys: list[str], order_col: str) -> DataFrame:
    """One run into a fresh table under the shared folder: keys and order column."""
    target = shared_path(spark, "intake")
    folder, _, name = source.rpartition("/")
    schema = spark.read.parquet(source).select(*keys, order_col).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", name if name.endswith(".parquet") else "*.parquet")
    rows = reader.parquet(folder if _is_file(spark, source) else source)
    query = rows.writeStream.foreachBatch(keep_first_upsert(target, keys, order_col)).option("checkpointLocation", f"{target}-state").trigger(availableNow=True).start()
    query.awaitTermination()
    return latest(spark, target)


def _is_file(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isFile()
