"""The corpus pipeline on a small corpus."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

import corpus_pipeline
from catloom.llm import packing
from tests.llm.test_operators import sentence


def test_stages(spark, tmp_path):
    rng = random.Random(9)
    texts = [(i, sentence(rng, rng.randint(20, 200), lang), lang, f"src{i % 4}", 0) for i in range(120) for lang in ["xx" if i % 2 else "yy"]]
    texts += [(500 + i, texts[i][1], "xx", "src1", 0) for i in range(10)]  # exact copies
    texts += [(600 + i, texts[20 + i][1] + " x", "xx", "src2", 0) for i in range(10)]  # near ones
    texts += [(700, None, "xx", "src1", 0), (701, "", None, "src1", 0), (702, "123 456", "xx", None, 0)]
    df = spark.createDataFrame(texts, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("digest", "kept", "slot", "place", "rank", "block", "component", "fp", "key", "at", "shard", "file", "row"):
        df = df.withColumn(name, F.lit("other"))  # names that stages use inside
    df.write.parquet(str(tmp_path / "documents.parquet"))
    docs, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if stage is corpus_pipeline.mix_sources:
            mixed = docs
        seen.append({r["doc_id"] for r in docs.select("doc_id").collect()})
        if stage is not corpus_pipeline.pack:
            assert docs.columns == df.columns
    assert seen[0] == {i for i, *_ in texts} - {700, 701, 702}
    assert seen[1] == seen[0] - set(range(10))  # the larger id stays
    clean = set(range(10, 120)) - set(range(20, 30))
    # one appended word leaves a similarity of at least 0.8 in texts of 20 words or more: no copy stays, every first one does
    assert seen[2] == seen[1] - {r for r in range(600, 610) if len(texts[r - 580][1].split()) >= 20} and clean <= seen[2]
    assert seen[3] == seen[2] == seen[4]
    # packing follows the mixed order: a shard holds consecutive rows, and other weights give another result
    ranked = [r["doc_id"] for r in mixed.orderBy("_metadata.file_name", "_metadata.row_index").select("doc_id").collect()]
    packed = packing.pack_in_order(mixed, shard_docs=10).collect()
    assert all(r["sequence_id"] >> 32 == ranked.index(r["doc_id"]) // 10 for r in packed)
    other = corpus_pipeline.mixing.interleave(mixed, {"src0": 0.7, "src1": 0.1, "src2": 0.1, "src3": 0.1})
    other.write.parquet(str(tmp_path / "other"))
    again = {(r["doc_id"], r["sequence_id"]) for r in packing.pack_in_order(spark.read.parquet(str(tmp_path / "other")), shard_docs=10).collect()}
    assert again != {(r["doc_id"], r["sequence_id"]) for r in packed}
    final = corpus_pipeline.run(spark, str(tmp_path))
    used = defaultdict(int)
    for r in final.collect():
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 1024 and {r["doc_id"] for r in final.collect()} == seen[4]


def test_an_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
