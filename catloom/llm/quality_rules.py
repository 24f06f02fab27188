"""Quality rules whose cutoffs carry a guarantee; DataFrame functions only.

Every document gets four rule values. The rules tighten together along a path of ``STEPS`` steps: at each step every rule
has one cutoff of a fixed grid, from the laxest to the strictest, and a document is rejected if any of its values is above
its rule's cutoff, so each step rejects what the one before does and more. For each stratum the labelled good documents are a
binomial sample of false rejections by all rules together. A step is *certified* if the exact binomial tail says that a false-rejection
rate above ``ALPHA`` would show as few rejections with a probability of at most the stratum's share of ``DELTA``, and all steps
before it are certified (fixed-sequence testing: the steps of a stratum need no price each). Over strata the correction is
Holm's: each has an equal share, and strata that are certified to the end leave theirs to the others. So with probability
``1 - DELTA`` the rules reject no more than ``ALPHA`` of the good documents of any stratum. A stratum without a certified step
rejects nothing; with no rejected sample at all it takes ``log(DELTA / strata) / log(1 - ALPHA)`` good labels to certify one.

The stratum is the language. Cutoffs depend on labelled rows alone and are counted over all of them; the tail is
summed natively, term by term in logarithms.

Defined results: a null text is the empty text (no words); a null stratum is a stratum of its own; labels that
are repeated count once, a document labelled both good and bad is not good, labels of unknown documents do not count;
windows are compared by 64-bit hashes of word hashes; without labels no step is certified and
only the base rules reject; an empty table gives an empty result. Values are per row, so equal rows, ties and
extra columns need nothing special.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catloom.runtime import cut

ALPHA = 0.02
DELTA = 0.05
MIN_WORDS = 20
WINDOW = 8  # a power of two
SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\f\r"
# value > cutoff rejects; grids are fixed before any label is seen
GRIDS = {
    "symbol_ratio": [0.5, 1, 2, 3, 5, 8, 12, 20, 30, 50],  # symbols per 100 words
    "dup_line_ratio": [5, 10, 15, 20, 25, 30, 40, 50, 60, 80],  # repeated lines per 100 lines with a word
    "repeat_ratio": [2, 4, 6, 8, 10, 12, 15, 20, 25, 28],  # repeated words per 100 words
    "upper_ratio": [2, 4, 6, 8, 10, 15, 20, 30, 50, 80],  # capital letters A-Z per 100 code points of words
}
STEPS = 10


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _repeat_words(hashes: Column, n: Column) -> Column:
    """Words inside windows that occur at least twice, from the hash of each window in order."""
    at = F.arrays_zip(hashes.alias("h"), F.sequence(F.lit(1), F.size(hashes)).alias("i"))
    pairs = F.sort_array(at)
    follow = F.slice(pairs, F.lit(2), F.greatest(F.size(pairs), F.lit(1)))
    twice = F.flatten(
        F.zip_with(pairs, follow, lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))
    )
    found = F.sort_array(F.array_distinct(twice))
    nexts = F.slice(found, F.lit(2), F.greatest(F.size(found), F.lit(1)))
    gaps = F.zip_with(found, nexts, lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    return F.when(
        F.size(F.array_distinct(hashes)) < F.size(hashes), F.aggregate(gaps, F.lit(0), lambda s, x: s + x)
    ).otherwise(F.lit(0))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang") -> DataFrame:
    """A narrow row per document: the counts, the base verdict and the stratum."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    stratum = F.col(stratum_col).cast("string") if stratum_col else F.lit("")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), stratum.alias("stratum"), text.alias("text"))
    base = base.withColumn("words", words_of(F.col("text"))).withColumn("n", F.size("words"))
    base = base.withColumn("marks", F.transform("words", lambda w: F.xxhash64(w)))
    # three doublings of the step join the marks of eight words: 1 + 1, 2 + 2, 4 + 4
    base = base.withColumn("windows", F.col("marks"))
    for step in (1, 2, 4):
        length = F.greatest(F.size("windows") - step, F.lit(0))
        pairs = F.zip_with(F.slice("windows", F.lit(1), length), F.slice("windows", F.lit(step + 1), length), lambda a, b: F.xxhash64(a, b))
        base = base.withColumn("windows", F.when(F.size("windows") > step, pairs).otherwise(F.array().cast("array<bigint>")))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    base = base.withColumn("lines", lines)
    return base.select(
        "doc_id", "stratum",
        F.col("n").cast("long").alias("n_words"),
        F.length(F.translate("text", SPACE, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("windows"), F.col("n")).cast("long").alias("n_repeat_words"),
        (F.length("text") - F.length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long").alias("n_upper"),
    ).withColumn("base_failed", F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > 30 * n_words"))


def _ratio(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.lit(100.0) * F.col(a) / F.col(b)).otherwise(F.lit(0.0))


def rule_values() -> dict[str, Column]:
    return {
        "symbol_ratio": _ratio("n_symbols", "n_words"),
        "dup_line_ratio": _ratio("n_dup_lines", "n_lines"),
        "repeat_ratio": _ratio("n_repeat_words", "n_words"),
        "upper_ratio": _ratio("n_upper", "word_chars"),
    }


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(X <= k) for X ~ Bin(n, p), exact: terms by recurrence in logarithms."""
    odds = F.lit(p / (1 - p))
    first = n * F.log1p(F.lit(-p))
    start = F.struct(first.cast("double").alias("term"), F.exp(first).cast("double").alias("sum"))

    def step(acc: Column, j: Column) -> Column:
        term = acc["term"] + F.log((n - j + 1) / j * odds)
        return F.struct(term.cast("double").alias("term"), (acc["sum"] + F.exp(term)).cast("double").alias("sum"))

    # beyond the mean the tail exceeds any level that certifies
    total = F.aggregate(F.sequence(F.lit(1).cast("long"), k), start, step, lambda acc: acc["sum"])
    return F.when(k > n * p, F.lit(1.0)).when(k == 0, F.exp(first)).otherwise(F.least(total, F.lit(1.0)))


def exceeded() -> dict[str, Column]:
    """Per rule how many cutoffs of its grid the value is above."""
    values = rule_values()
    return {rule: sum((F.when(values[rule] > c, 1).otherwise(0) for c in grid), F.lit(0)) for rule, grid in GRIDS.items()}


def certified_steps(feats: DataFrame, good: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """``stratum, n_good, certified``: how many steps of the path are certified. ``good``: a row per good label."""
    sample = feats.filter("not base_failed").join(good.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id")
    above = F.greatest(*exceeded().values())
    # step s, from 0, rejects what is above STEPS - s cutoffs of some rule; one partial aggregation counts them all
    counts = [F.count_if(above >= STEPS - s).alias(f"gone{s}") for s in range(STEPS)]
    per = cut(sample.groupBy("stratum").agg(F.count(F.lit(1)).alias("n_good"), *counts))
    tails = F.array(*[binomial_tail(F.col("n_good"), F.col(f"gone{s}"), alpha) for s in range(STEPS)])
    per = per.select("stratum", "n_good", tails.alias("tails")).withColumn("worst", F.array_max("tails"))
    # Holm over strata, a row each: those certified to the end, in order of their worst tail, leave their share
    strata = per.count()
    order = Window.orderBy("worst", "stratum")
    ranked = per.withColumn("place", F.row_number().over(order) - 1)
    ended = ranked.filter(F.col("worst") > delta / (F.lit(strata) - F.col("place"))).agg(F.min("place").alias("complete"))
    share = F.when(F.col("complete").isNull(), F.lit(delta)).otherwise(delta / (F.lit(strata) - F.col("complete")))
    level = F.when(F.col("complete").isNull() | (F.col("place") < F.col("complete")), F.lit(1.0)).otherwise(share)
    failed = F.array_position(F.transform("tails", lambda p: p > F.col("level")), True)
    steps = F.when(failed == 0, F.lit(STEPS)).otherwise(failed - 1)
    return ranked.join(F.broadcast(ended)).withColumn("level", level).select("stratum", "n_good", steps.cast("int").alias("certified"))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Every document with its counts, ``base_failed``, ``kept``, the first rule that rejects it (``reason``) and its stratum's
    ``certified`` steps.

    ``labels``: ``doc_id`` and ``quality`` (1 is good), as they stand; other columns are not read.
    """
    feats = cut(features(docs, id_col, text_col, stratum_col))
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("least"), F.max("quality").alias("most")).filter("least = 1 and most = 1").select("doc_id")
    steps = cut(certified_steps(feats, good, alpha, delta))
    side = F.broadcast(steps) if steps.count() <= 10_000 else steps
    joined = feats.join(side.withColumnRenamed("stratum", "cut_stratum"), F.col("stratum").eqNullSafe(F.col("cut_stratum")), "left")
    joined = joined.withColumn("certified", F.coalesce("certified", F.lit(0)))
    over = [F.when((F.col("certified") > 0) & (above >= STEPS + 1 - F.col("certified")), F.lit(rule)) for rule, above in exceeded().items()]
    reason = F.when(F.col("base_failed"), F.lit("base")).otherwise(F.coalesce(*over))
    return joined.withColumn("reason", reason).withColumn("kept", F.col("reason").isNull()).drop("cut_stratum")
