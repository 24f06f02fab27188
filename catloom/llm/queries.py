"""Queries of the training-text operators and, where SQL can express one, its oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from catloom.llm import alignment, exact_dedup, html_text, langid, mixing, neighbours, packing, quality_rules, simhash, spelling, substring, url_filter, warc
from catloom.runtime import table

URL_RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]
#: The large general source is held to a tenth; every other source counts alike.
MIX_WEIGHTS = {"src0": 0.1, **{f"src{k}": 0.9 / 19 for k in range(1, 20)}}


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = packing.pack_documents(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "reason")


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    predicted = langid.predict(docs, langid.fit(docs))
    return predicted.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, manifest = warc.archive(table(spark, sf_dir, "pages"))
    read = warc.read_bundles(spark, folder, manifest)
    return read.select(F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), MIX_WEIGHTS)


def op9_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    found = [op1_pack, op2_quality, op3_urls, op4_language, op5_warc, op6_substring, op7_simhash, op8_mix, op9_exact, op10_main_text, op11_neighbours, op12_alignment, op13_spelling, pipeline]
    return {f.__name__: f for f in found}


_OP3 = r"""
WITH rules(verdict, host, path) AS (
  VALUES ('block','com','/en/'), ('allow','example.com','/en/7'), ('allow','net','/de/'), ('block','example.net','/de/8'), ('block','org','/es/')
), rest AS (
  SELECT page_id, CASE WHEN contains(coalesce(url,''), '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), fits AS (
  SELECT p.page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY p.page_id
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict FROM parts p LEFT JOIN fits f USING (page_id)
"""

_OP5 = """
WITH d AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM d)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(((('0x' || substr(hex, CAST(i // 4 AS INT) * 5 + 1, 5))::BIGINT >> CAST(15 - 5 * (i % 4) AS INT)) & 31) + 1 AS INT), 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM g
"""

_OP6 = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
win AS (SELECT doc_id, i, sha256(array_to_string(words[i:i + 12], ' ')) AS h FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w WHERE len(words) >= 13)),
low AS (SELECT h, min(doc_id) AS low FROM win GROUP BY h),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM win JOIN low USING (h), range(0, 13) r(k) WHERE low < doc_id),
marks AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
kept AS (SELECT w.doc_id, words, CASE WHEN ps IS NULL THEN words ELSE list_filter(words, lambda x, i: NOT list_contains(ps, i)) END AS k FROM w LEFT JOIN marks USING (doc_id))
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - len(k) AS BIGINT) AS n_removed, sha256(coalesce(array_to_string(k, ' '), '')) AS kept_sha256 FROM kept
"""

_OP9 = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

_OP13 = """
WITH RECURSIVE steps(i, c, k) AS (
  SELECT i, i, 0 FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8
), crc AS (SELECT list(c ORDER BY i) AS crc FROM steps WHERE k = 8),
found AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
runs AS (
  SELECT doc_id, run, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS spelled, count(*) AS n
  FROM (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM found WHERE length(run) >= 6) GROUP BY doc_id, run
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, length(spelled) // 2), lambda j: ('0x' || substr(spelled, CAST(2 * j + 1 AS INT), 2))::BIGINT)),
    lambda c, b: xor(c >> 8, crc[xor(c & 255, b) + 1]))) AS h FROM runs, crc
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), cut AS (SELECT word, n, i, substr(word, 1, CAST(i AS INT)) || substr(word, CAST(i AS INT) + 2) AS rest FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)),
shorter AS (SELECT DISTINCT c.word, c.n, w.word AS other, w.n AS m FROM cut c JOIN words w ON c.rest = w.word),
near AS (
  SELECT c.word, d.word AS other, d.n AS m FROM cut c JOIN cut d ON c.rest = d.rest AND c.i = d.i AND c.word <> d.word
  UNION ALL SELECT word, other, m FROM shorter UNION ALL SELECT other, word, n FROM shorter
), ranked AS (SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY m DESC, other) AS r FROM near),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * w.n THEN other END AS form, CASE WHEN m >= 5 * w.n THEN m END AS form_n
  FROM words w LEFT JOIN ranked r ON w.word = r.word AND r.r = 1
), walk(word, last) AS (
  SELECT word, word FROM formed UNION ALL SELECT walk.word, f.form FROM walk JOIN formed f ON f.word = walk.last WHERE f.form IS NOT NULL
), ends AS (SELECT walk.word, walk.last AS root FROM walk JOIN formed f ON f.word = walk.last WHERE f.form IS NULL)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM formed f JOIN ends e USING (word)
"""

_OP2 = r"""
WITH RECURSIVE grids(rule, k, grid) AS (
  VALUES ('symbol_ratio', 1, [0.5, 1, 2, 3, 5, 8, 12, 20, 30, 50]::DOUBLE[]), ('dup_line_ratio', 2, [5, 10, 15, 20, 25, 30, 40, 50, 60, 80]::DOUBLE[]),
         ('repeat_ratio', 3, [2, 4, 6, 8, 10, 12, 15, 20, 25, 28]::DOUBLE[]), ('upper_ratio', 4, [2, 4, 6, 8, 10, 15, 20, 30, 50, 80]::DOUBLE[])
), base AS (
  SELECT doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS w FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM base WHERE len(words) >= 8)
), twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1),
repeated AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(0, 8) r(k) GROUP BY doc_id),
counts AS (
  SELECT b.doc_id, lang AS stratum, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
         (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
         (length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')))::BIGINT AS n_upper
  FROM base b LEFT JOIN repeated r USING (doc_id)
), feats AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    [CASE WHEN n_words > 0 THEN 100.0::DOUBLE * n_symbols / n_words ELSE 0 END, CASE WHEN n_lines > 0 THEN 100.0::DOUBLE * n_dup_lines / n_lines ELSE 0 END,
     CASE WHEN n_words > 0 THEN 100.0::DOUBLE * n_repeat_words / n_words ELSE 0 END, CASE WHEN word_chars > 0 THEN 100.0::DOUBLE * n_upper / word_chars ELSE 0 END] AS v FROM counts
), above AS (
  SELECT doc_id, list(len(list_filter(grid, lambda c: v[k] > c)) ORDER BY k) AS above FROM feats, grids GROUP BY doc_id
), good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1 AND max(quality) = 1),
sample AS (SELECT stratum, list_max(above) AS most FROM feats JOIN above USING (doc_id) JOIN good USING (doc_id) WHERE NOT base_failed),
per AS (SELECT stratum, step, count(*) AS n, count(*) FILTER (most >= 10 - step) AS k FROM sample, range(10) s(step) GROUP BY stratum, step),
tails(stratum, step, n, k, j, term, total) AS (
  SELECT stratum, step, n, k, 0, n * ln(0.98::DOUBLE), exp(n * ln(0.98::DOUBLE)) FROM per
  UNION ALL SELECT stratum, step, n, k, j + 1, term + ln((n - j)::DOUBLE / (j + 1) * (0.02::DOUBLE / 0.98)), total + exp(term + ln((n - j)::DOUBLE / (j + 1) * (0.02::DOUBLE / 0.98))) FROM tails WHERE j < k AND k <= n * 0.02::DOUBLE
), p AS (SELECT stratum, step, CASE WHEN k > n * 0.02::DOUBLE THEN 1.0 ELSE least(max(total), 1.0) END AS p FROM tails GROUP BY stratum, step, n, k),
worst AS (SELECT stratum, max(p) AS worst FROM p GROUP BY stratum),
ranked AS (SELECT *, row_number() OVER (ORDER BY worst, stratum NULLS FIRST) - 1 AS place, count(*) OVER () AS strata FROM worst),
ended AS (SELECT min(place) AS complete FROM ranked WHERE worst > 0.05::DOUBLE / (strata - place)),
levels AS (SELECT stratum, CASE WHEN complete IS NULL OR place < complete THEN 1.0::DOUBLE ELSE 0.05::DOUBLE / (strata - complete) END AS level FROM ranked, ended),
steps AS (SELECT p.stratum, coalesce(min(step) FILTER (p > level), 10) AS certified FROM p JOIN levels l ON p.stratum IS NOT DISTINCT FROM l.stratum GROUP BY p.stratum),
judged AS (
  SELECT f.*, CASE WHEN base_failed THEN 'base' ELSE
    (SELECT min_by(rule, k) FROM grids WHERE coalesce(certified, 0) > 0 AND above[k] >= 11 - certified) END AS reason
  FROM feats f JOIN above USING (doc_id) LEFT JOIN steps s ON f.stratum IS NOT DISTINCT FROM s.stratum
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, reason IS NULL AS kept, reason FROM judged
"""

_OP8 = """
WITH RECURSIVE sized AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
raw AS (SELECT source, CASE WHEN source = 'src0' THEN 38 WHEN regexp_full_match(source, 'src([1-9]|1[0-9])') THEN 18 ELSE 19 END AS w FROM sized),
whole AS (SELECT list(source ORDER BY source NULLS FIRST) AS names, list(w ORDER BY source NULLS FIRST) AS ws, list_reduce(list(w), lambda a, b: gcd(a, b)) AS g FROM raw),
shares AS (SELECT names, list_transform(ws, lambda w: w // g) AS q, list_sum(ws)::BIGINT // g AS period FROM whole),
slots(t, done, pick) AS (
  SELECT -1, list_transform(q, lambda x: 0), 0 FROM shares
  UNION ALL SELECT t + 1, list_transform(done, lambda k, i: CASE WHEN i = pick THEN k + 1 ELSE k END), pick FROM (
    SELECT t, done, list_position(due, list_min(due)) AS pick FROM (
      SELECT t, done, list_transform(q, lambda x, i: CASE WHEN done[i] < x AND done[i] * period // x <= t + 1 THEN ((done[i] + 1) * period + x - 1) // x ELSE 1099511627776 END) AS due
      FROM slots, shares WHERE t + 1 < period))
), pattern AS (
  SELECT names[pick] AS source, q[pick] AS q, period, t AS in_period, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS j FROM slots, shares WHERE t >= 0
), ranked AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(doc_id::VARCHAR), doc_id) - 1 AS rank FROM documents),
blocks AS (SELECT doc_id, source, rank // 16 AS block, rank % 16 AS place FROM ranked)
SELECT doc_id, b.source, block, (block // q) * period + j * period // q AS release, (block // q) * period + ((j + 1) * period + q - 1) // q AS deadline,
  (block // q) * period + in_period AS slot, place::INT AS place
FROM blocks b JOIN pattern p ON b.source IS NOT DISTINCT FROM p.source AND block % q = j
"""


def oracle_sql() -> dict[str, str]:
    found = {"op2_quality": _OP2, "op8_mix": _OP8, "op3_urls": _OP3, "op5_warc": _OP5, "op6_substring": _OP6, "op9_exact": _OP9, "op13_spelling": _OP13}
    if corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
