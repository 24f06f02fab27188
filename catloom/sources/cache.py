"""A key-value cache as an append-only table: answers of services by md5 of namespace and key."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catloom.functions import text

DDL = "cache_key string, body string, stored_at timestamp"


def put(answers: DataFrame, path: str, namespace: str, key_col: str = "key", body_col: str = "body") -> None:
    """Append answers; nothing that is stored is rewritten."""
    keyed = answers.select(text.cache_key(namespace, key_col).alias("cache_key"), F.col(body_col).cast("string").alias("body"), F.current_timestamp().alias("stored_at"))
    keyed.write.mode("append").parquet(path)


def get(spark: SparkSession, path: str, keys: DataFrame, namespace: str, key_col: str = "key") -> DataFrame:
    """``keys`` with ``cached``: the latest stored answer that is JSON, null for a miss."""
    try:
        rows = spark.read.schema(DDL).parquet(path)
    except AnalysisException:
        rows = spark.createDataFrame([], DDL)
    latest = rows.filter(F.expr("try_parse_json(body)").isNotNull()).groupBy("cache_key").agg(F.max_by("body", "stored_at").alias("cached"))
    return keys.withColumn("cache_key", text.cache_key(namespace, key_col)).join(latest, "cache_key", "left").drop("cache_key")


def misses(spark: SparkSession, path: str, keys: DataFrame, namespace: str, key_col: str = "key") -> DataFrame:
    """The keys that are still to be asked for: a run that was stopped goes on where it ended."""
    return get(spark, path, keys, namespace, key_col).filter("cached is null").drop("cached")
