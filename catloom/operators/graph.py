"""Breadth-first reachability over an edge table, and the rules that limit a crawl."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote, unquote, urlparse, urlunparse
from urllib.robotparser import RobotFileParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from catloom.runtime import bounded, cut


def reachable(edges: DataFrame, seeds: DataFrame, max_depth: int = 3, allowed: Column | None = None, denied: Column | None = None, max_nodes: int | None = None) -> DataFrame:
    """``node, depth`` of everything within ``max_depth`` steps; edges have ``src, dst``, seeds ``node``.

    A node is visited once, at its least depth. ``allowed`` and ``denied`` (over ``node``) stop the walk at other
    nodes. ``max_nodes`` ends it after the round that reaches it; nearest nodes come first.
    """

    def admitted(df: DataFrame) -> DataFrame:
        out = df if allowed is None else df.filter(allowed)
        return out if denied is None else out.filter(~denied)

    visited = cut(admitted(seeds.select("node").distinct()).withColumn("depth", F.lit(0)))
    frontier = visited
    for depth in range(1, max_depth + 1):
        reached = edges.join(frontier.select(F.col("node").alias("src")), "src").select(F.col("dst").alias("node")).distinct()
        frontier = cut(admitted(reached.join(visited.select("node"), "node", "left_anti")).withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            break
        visited = cut(visited.unionByName(frontier))
        if max_nodes is not None and visited.count() >= max_nodes:
            return visited.orderBy("depth", "node").limit(max_nodes)
    return visited


RULES = "host string, entry int, agents array<string>, rule int, path string, allow boolean"


def robots_rules(robots: DataFrame) -> DataFrame:
    """``host, entry, agents, rule, path, allow``: the rules of robots files ``(host, body)``, one file a host, in file order.

    Files are read by the standard library's parser, each on its own. The entry for every agent (``*``) comes last, as it is asked last;
    an entry without rules has one that allows everything. Files fetched in a run are stored for the next one: a run
    without stored files has no rules.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parser = RobotFileParser()
                parser.parse((body or "").splitlines())
                for k, entry in enumerate([*parser.entries, *filter(None, [parser.default_entry])]):
                    agents = [a.lower() for a in entry.useragents]
                    listed = [(line.path, line.allowance) for line in entry.rulelines] or [("", True)]
                    rows += [(host, k, agents, i, path, allow) for i, (path, allow) in enumerate(listed)]
            types = [pa.string(), pa.int32(), pa.list_(pa.string()), pa.int32(), pa.string(), pa.bool_()]
            names = [f.split()[0] for f in RULES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    return robots.select(F.col("host").cast("string"), F.col("body").cast("string")).mapInArrow(run, RULES)


@F.arrow_udf(T.StringType())
def _rule_path(urls: pa.Array) -> pa.Array:
    """The part of a url that rules speak of, spelled as the parser spells them."""

    def spelled(url: str | None) -> str | None:
        if url is None:
            return None
        try:
            parts = urlparse(unquote(url))
        except ValueError:
            return "/"
        return quote(urlunparse(("", "", parts.path, parts.params, parts.query, parts.fragment))) or "/"

    return pa.array([spelled(u) for u in urls.to_pylist()], pa.string())


def permitted(urls: DataFrame, rules: DataFrame, url_col: str = "url", agent: str = "*") -> DataFrame:
    """The urls that no stored rule forbids to ``agent``: of the first entry that names it (else the one for all), the first rule
    whose path begins the url's path decides.

    Rules are found by equality: a url is cut at the lengths that its host's rules have, and the pieces are joined on host
    and path, so a url meets the rules that begin it and no others.
    """
    name = agent.split("/")[0].lower()
    named = F.exists("agents", lambda a: (a == "*") | F.contains(F.lit(name), a))
    mine = rules.filter(named).withColumn("first", F.min("entry").over(Window.partitionBy("host"))).filter(F.col("entry") == F.col("first"))
    # of rules with one path the first one decides
    mine = cut(mine.groupBy("host", "path").agg(F.min_by(F.struct("rule", "allow"), "rule").alias("said")))
    sizes = mine.groupBy(F.col("host").alias("__host")).agg(F.array_sort(F.collect_set(F.length("path"))).alias("__sizes"))
    # columns go by position, so that no name clashes
    plain = urls.toDF(*[f"c{i}" for i in range(len(urls.columns))])
    url = F.col(f"c{urls.columns.index(url_col)}")
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    rows = plain.select("*", host.alias("__of"), _rule_path(url).alias("__path"))
    rows = cut(rows.withColumn("__row", F.monotonically_increasing_id()))
    asked = rows.join(bounded(cut(sizes)), F.col("__of") == F.col("__host")).select("__row", "__of", "__path", F.explode(F.filter("__sizes", lambda n: n <= F.length("__path"))).alias("n"))
    asked = asked.select("__row", F.col("__of").alias("host"), F.expr("left(__path, n)").alias("path"))
    denied = asked.join(bounded(mine), ["host", "path"]).groupBy("__row").agg(F.min_by("said.allow", "said.rule").alias("allow")).filter("not allow")
    return rows.join(bounded(cut(denied.select("__row"))), "__row", "left_anti").select(*plain.columns).toDF(*urls.columns)
