"""URL rules in a sorted digest array that every executor memory-maps.

A rule is a host and a path prefix, written as one string (``net/de/``). It fits its host and every subdomain if
the path of the url starts with the rule's; of the fitting rules the longest string decides (of equally long ones
the one with the longer host). The index file holds the XXH64 keys of all rules sorted, then verdicts, offsets
and the full strings. It is written once to the shared folder and shipped by ``SparkContext.addFile``: executors
map it, so its pages are shared by all workers of a machine and its size is that of the rule list, not of the
data. A batch of urls is probed with one vectorised binary search per host depth and prefix length that occur
among the rules; every hit is confirmed against the stored string, and runs of equal keys are walked to the end.

Defined results: a null url, or one without ``://``, has an empty host and path and gets the default verdict;
without rules every url does; repeated rows get equal results, a null id is kept; an empty table gives an empty
result; other columns are not read. Of rules given twice, block wins.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from catloom.runtime import checkpoint_root

MAGIC = b"SDA1"
DEFAULT = "allow"


def build_index(rules: list[tuple[str, str]]) -> bytes:
    """The index file of ``(verdict, rule string)`` pairs."""
    merged: dict[str, str] = {}
    for verdict, rule in rules:
        if verdict not in ("allow", "block") or "/" not in rule:
            raise ValueError(f"not a rule: {verdict} {rule}")
        host, _, path = rule.partition("/")
        name = f"{host.lower()}/{path}"
        merged[name] = "block" if "block" in (verdict, merged.get(name)) else "allow"
    entries = sorted((xxh64_intdigest(name.encode()), name, verdict) for name, verdict in merged.items())
    strings = [name.encode() for _, name, _ in entries]
    keys = np.array([k for k, _, _ in entries], dtype="<u8")
    verdicts = np.array([v == "block" for _, _, v in entries], dtype=np.uint8)
    offsets = np.cumsum([0, *map(len, strings)], dtype="<u8")
    shapes = sorted({(s.split(b"/", 1)[0].count(b".") + 1, len(s.split(b"/", 1)[1]) + 1) for s in strings})
    head = MAGIC + struct.pack("<QQ", len(entries), len(shapes))
    return b"".join([head, keys.tobytes(), offsets.tobytes(), np.array(shapes, dtype="<u4").tobytes(), verdicts.tobytes(), *strings])


class DigestArray:
    """A mapped index file."""

    def __init__(self, path: str):
        data = np.memmap(path, dtype=np.uint8, mode="r")
        if bytes(data[:4]) != MAGIC:
            raise ValueError(f"not an index: {path}")
        n, shapes = struct.unpack("<QQ", bytes(data[4:20]))
        at = 20
        self.keys = data[at : at + 8 * n].view("<u8")
        at += 8 * n
        self.offsets = data[at : at + 8 * (n + 1)].view("<u8")
        at += 8 * (n + 1)
        self.shapes = [tuple(x) for x in data[at : at + 8 * shapes].view("<u4").reshape(-1, 2).tolist()]
        at += 8 * shapes
        self.verdicts = data[at : at + n]
        self.strings = data[at + n :]

    def find(self, names: list[bytes]) -> np.ndarray:
        """Position of each name, or -1: binary search over keys, then the stored strings decide."""
        found = np.full(len(names), -1, dtype=np.int64)
        if not len(self.keys) or not names:
            return found
        probes = np.fromiter(map(xxh64_intdigest, names), np.uint64, len(names))
        at = np.searchsorted(self.keys, probes)
        live = np.flatnonzero((at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == probes))
        for i in live.tolist():
            k = int(at[i])
            while k < len(self.keys) and self.keys[k] == probes[i]:
                if self.string(k) == names[i]:
                    found[i] = k
                    break
                k += 1
        return found

    def string(self, k: int) -> bytes:
        return self.strings[int(self.offsets[k]) : int(self.offsets[k + 1])].tobytes()

    def decide(self, hosts: list[str], paths: list[str]) -> tuple[list[str | None], list[str | None]]:
        """The longest fitting rule and its verdict for every url, None without one."""
        best = np.full(len(hosts), -1, dtype=np.int64)
        rank = np.full(len(hosts), -1, dtype=np.int64)
        labels = [h.encode().split(b".") for h in hosts]
        raw = [p.encode() for p in paths]
        for depth, size in self.shapes:
            rows = [i for i, (x, p) in enumerate(zip(labels, raw)) if len(x) >= depth and len(p) >= size and x != [b""]]
            suffixes = [b".".join(labels[i][-depth:]) for i in rows]
            hits = self.find([s + raw[i][:size] for s, i in zip(suffixes, rows)])
            for i, s, k in zip(rows, suffixes, hits.tolist()):
                # the whole rule string counts, then the host
                weight = ((len(s) + size) << 16) + min(len(s), 65535)
                if k >= 0 and weight > rank[i]:
                    best[i], rank[i] = k, weight
        rules = [self.string(k).decode() if k >= 0 else None for k in best.tolist()]
        verdicts = [("block" if self.verdicts[k] else "allow") if k >= 0 else None for k in best.tolist()]
        return rules, verdicts


def publish(spark: SparkSession, index: bytes) -> str:
    """Write the index to the shared folder and have every executor fetch it; gives its file name."""
    name = f"digests-{xxh64_intdigest(index):016x}-{len(index)}.sda"
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark)}/{name}")
    out = path.getFileSystem(conf).create(path, True)
    for at in range(0, len(index), 1 << 20):
        out.write(bytearray(index[at : at + (1 << 20)]))
    out.close()
    spark.sparkContext.addFile(path.toString())
    return name


def split_url(urls: DataFrame, id_col: str, url_col: str) -> DataFrame:
    """``page_id, host, path``: the host up to ``/``, ``?`` or ``#``, A-Z lower-cased, the path up to ``?`` or ``#``."""
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    named = urls.select(F.col(id_col).cast("long").alias("page_id"), url.alias("u"))
    rest = F.expr("CASE WHEN instr(u, '://') > 0 THEN substring(u, instr(u, '://') + 3) ELSE '' END")
    named = named.withColumn("rest", rest)
    host = F.regexp_extract("rest", r"^([^/?#]*)", 1)
    path = F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1)
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return named.select("page_id", lowered.alias("host"), path.alias("path"))


def judge_urls(urls: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", default: str = DEFAULT) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row; an Arrow map, no shuffle."""
    name = publish(urls.sparkSession, build_index(rules))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = DigestArray(SparkFiles.get(name))
        for batch in batches:
            found, verdicts = index.decide(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            columns = [*batch.columns[:3], pa.array(found, pa.string()), pa.array([v or default for v in verdicts], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "host", "path", "rule", "verdict"])

    schema = "page_id long, host string, path string, rule string, verdict string"
    return split_url(urls, id_col, url_col).mapInArrow(run, schema)
