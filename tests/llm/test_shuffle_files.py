"""Shuffle files of finished steps."""

from catloom.llm import substring


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for k in range(files.size()) if (name := files.apply(k).getName()).startswith("shuffle_")}


def test_repeats_leave_no_shuffle_files_between_steps(spark):
    words = " ".join(f"w{k}" for k in range(40))
    docs = spark.createDataFrame([(k, f"{words} own{k}") for k in range(50)], "doc_id long, text string").coalesce(4)
    before = _shuffle_files(spark)
    lazy = substring.remove_repeats(docs, bucket_bytes=2000)
    left = _shuffle_files(spark) - before
    assert len({name.split("_")[1] for name in left}) <= 1, left  # only of the one sum of the texts' sizes
    assert sum(r["n_removed"] for r in lazy.collect()) == 49 * 40
