"""What every operator needs from the running session: lineage cuts, shared folders, table access."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate data.

    It is ``spark.checkpoint.dir`` of the session. Only where that is unset (tests, notebooks in local
    mode) a temporary folder is made; a cluster without the setting is an error, since executors would
    not see a driver-local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    known = getattr(spark, "_catloom_checkpoint_root", None)
    if known:
        return known
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = "file://" + tempfile.mkdtemp(prefix="catloom-")
    spark._catloom_checkpoint_root = root
    return root


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, keep its rows in the shared folder and forget how they were made."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_root(spark))
    return df.checkpoint(eager=True)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` in the session's full number of shuffle partitions: for stages that compute much over few bytes, which
    adaptive execution would put in a few tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def shared_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder."""
    return f"{checkpoint_root(spark)}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of a finished action go at once; otherwise they stay until the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


class Sliced:
    """A table dealt over folders of the shared folder by the hash of a key, as compressed columns.

    Work that only needs the rows of a key together goes through it one part after another: what it shuffles at a time
    is a part of the rows, and each part goes once it is done. All rows are worked on, whatever the number of parts.
    """

    SLICES = 16
    #: Rows below which one part does not pay.
    ROWS = 1 << 24

    def __init__(self, spark: SparkSession, path: str, schema) -> None:
        self.spark, self.path, self.schema = spark, path, schema

    @classmethod
    def of(cls, df: DataFrame, key: Column) -> Sliced:
        path = shared_path(df.sparkSession, "slices")
        with short_shuffles(df.sparkSession):
            cls._put(df, key, path)
        return cls(df.sparkSession, path, df.schema)

    @classmethod
    def _put(cls, df: DataFrame, key: Column, path: str) -> None:
        sliced = df.withColumn("__slice", F.pmod(F.xxhash64(key), F.lit(cls.SLICES)).cast("int"))
        sliced.write.mode("append").option("compression", "zstd").partitionBy("__slice").parquet(path)

    def parts(self, *others: Sliced) -> list[list[int]]:
        """The slices of every part."""
        rows = sum(x.read().count() for x in (self, *others))
        n = min(self.SLICES, max(1, -(-rows // self.ROWS)))
        return [list(range(k, self.SLICES, n)) for k in range(n)]

    def read(self, slices: list[int] | None = None) -> DataFrame:
        every = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("__slice", T.IntegerType())])).parquet(self.path)
        return (every if slices is None else every.filter(F.col("__slice").isin(slices))).drop("__slice")

    def remove(self, slices: list[int] | None = None) -> None:
        jvm = self.spark.sparkContext._jvm
        for name in [self.path] if slices is None else [f"{self.path}/__slice={k}" for k in slices]:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def each(self, work: Callable[..., DataFrame], *others: Sliced, key: Column | None = None) -> DataFrame | Sliced:
        """``work`` over each part of this table and of others dealt by the same key; ``key``: dealt again by it.

        The tables go, but for a single part that nothing deals again: its work is left to who reads it.
        """
        parts = self.parts(*others)
        if len(parts) == 1 and key is None:
            return work(self.read(), *[x.read() for x in others])
        path, made = shared_path(self.spark, "slices"), None
        files = 2 * self.spark.sparkContext.defaultParallelism  # a file a task and slice
        with short_shuffles(self.spark):
            for slices in parts:
                done = work(self.read(slices), *[x.read(slices) for x in others])
                made = done.schema
                if key is None:
                    done.write.mode("append").option("compression", "zstd").parquet(path)
                else:
                    self._put(done.coalesce(files), key, path)
                for x in (self, *others):
                    x.remove(slices)
        for x in (self, *others):
            x.remove()
        return self.spark.read.schema(made).parquet(path) if key is None else Sliced(self.spark, path, made)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as Parquet (compressed, column-pruned on re-read) in the shared folder and read it back."""
    path = shared_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a table made by :func:`stored` once nothing reads it any more."""
    jvm = spark.sparkContext._jvm
    for name in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def without_ids(docs: DataFrame, id_col: str, gone: DataFrame, broadcast_rows: int = 2_000_000) -> DataFrame:
    """The rows of ``docs`` whose id is not in ``gone`` (one column of longs); null ids stay, columns may have any names.

    A short list is broadcast, so that the rows stay where they are; a longer one makes them move.
    """
    gone = gone.toDF("gone")
    gone = F.broadcast(gone) if gone.count() <= broadcast_rows else gone.hint("shuffle_hash")
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    key = F.col(f"c{docs.columns.index(id_col)}").cast("long")
    return plain.join(gone, key == F.col("gone"), "left_anti").toDF(*docs.columns)


def bounded(df: DataFrame, rows: int = 2_000_000) -> DataFrame:
    """``df`` marked for broadcast while it is short, counted first; a longer one is joined as Spark sees fit."""
    return F.broadcast(df) if df.count() <= rows else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
