"""From raw documents to packed training sequences, stage by stage.

Every stage is a function of (spark, docs, sf_dir); ``run`` writes its rows as Parquet in the shared folder and
hands what is read again to the next. All stages but the last return the columns of documents.

Defined results: rows of null or empty text are in no learned language and go in the first stage, before any other sees them; rows of
null id are kept and packed like others; of rows equal in id and text one stays; an empty table gives an empty result; other
columns, whatever their names, are carried to the last stage and not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from catloom.llm import exact_dedup, langid, mixing, near_copies as near, packing
from catloom.runtime import shared_path, table

#: The large general source is held to a tenth; every other source counts alike.
WEIGHTS = {"src0": 0.1, **{f"src{k}": 0.9 / 19 for k in range(1, 20)}}


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labelled part of the documents; those in no learned language go."""
    return langid.drop_unidentified(docs, langid.fit(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 or more of their five-word shingles the one with the smallest id stays."""
    return near.drop_near_copies(docs, shingle=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixed schedule."""
    return mixing.interleave(docs, WEIGHTS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document goes; sequences follow the mixed order."""
    return packing.pack_in_order(docs)


STAGES = [
    ("language identification", language_id),
    ("exact deduplication", exact_copies),
    ("near-duplicate removal", near_copies),
    ("mixing to target weights", mix_sources),
    ("best-fit packing", pack),
]

#: A trained network decides the first stage, so SQL cannot express the rows of run(); tests compare the other stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
