"""A run as a graph of named table functions.

A step takes the tables it names and gives one table. Steps of a group do not depend on each other; within the
driver they run side by side, as many at a time as asked for. A step whose inputs are missing or which fails is
reported, and what depends on it is skipped; everything else goes on.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from catloom import schema
from catloom.operators import catalog, consolidate, lineage, quality
from catloom.runtime import cut
from catloom.sources import files


@dataclass(frozen=True)
class Step:
    name: str
    stage: str
    function: Callable[..., DataFrame]
    inputs: tuple[str, ...] = ()
    needs_service: bool = False
    files: tuple[str, ...] = ()


@dataclass
class Result:
    name: str
    status: str
    seconds: float = 0.0
    message: str = ""


@dataclass
class Run:
    tables: dict[str, DataFrame] = field(default_factory=dict)
    results: list[Result] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return all(r.status in ("done", "skipped by choice") for r in self.results)


def waves(steps: list[Step], given: set[str]) -> list[list[Step]]:
    """Steps in groups that can run together; a circle is an error."""
    known, left, out = set(given), list(steps), []
    names = {s.name for s in steps}
    while left:
        ready = [s for s in left if all(i in known or i not in names for i in s.inputs)]
        if not ready:
            raise ValueError(f"circular inputs: {[s.name for s in left]}")
        out.append(ready)
        known |= {s.name for s in ready}
        left = [s for s in left if s not in ready]
    return out


def run(spark: SparkSession, steps: list[Step], given: dict[str, DataFrame], stages: set[str] | None = None, services: bool = True, at_once: int = 6, dry: bool = False) -> Run:
    """Run the steps over the given tables; results are cut from their lineage once each."""
    out = Run(dict(given))

    def one(step: Step) -> Result:
        if stages is not None and step.stage not in stages:
            return Result(step.name, "skipped by choice")
        if step.needs_service and not services:
            return Result(step.name, "skipped by choice", message="needs a service")
        missing = [i for i in step.inputs if i not in out.tables] + [f for f in step.files if not files.exists(spark, f)]
        if missing:
            return Result(step.name, "skipped", message=f"missing {missing}")
        if dry:
            return Result(step.name, "done", message="planned")
        began = time.perf_counter()
        try:
            out.tables[step.name] = cut(step.function(*[out.tables[i] for i in step.inputs]))
        except Exception as error:  # reported, the run goes on
            return Result(step.name, "failed", time.perf_counter() - began, str(error)[:500])
        return Result(step.name, "done", time.perf_counter() - began)

    for group in waves(steps, set(given)):
        with ThreadPoolExecutor(max(1, at_once)) as pool:
            out.results += list(pool.map(one, group))
    return out


def curation_steps() -> list[Step]:
    """From raw fact rows (and feeds) to catalogue, candidates and gates."""
    return [
        Step("canonical", "normalize", lambda raw: lineage.canonicalise(raw)[0], ("raw",)),
        Step("artists", "catalog", catalog.artists, ("canonical",)),
        Step("releases", "catalog", catalog.releases, ("canonical",)),
        Step("works", "catalog", catalog.works, ("canonical",)),
        Step("tracks", "catalog", catalog.tracks, ("canonical",)),
        Step("candidates", "discover", lambda feeds, fact: consolidate.with_status(consolidate.consolidated(feeds), fact), ("feeds", "canonical")),
        Step("corrections", "discover", consolidate.corrections, ("candidates",)),
        Step("routes", "discover", lambda c, fact: consolidate.routed(consolidate.output_rows(c), fact), ("candidates", "canonical")),
        Step(
            "gates", "validate",
            lambda fact, a, r, w, t: quality.gates(fact, {"artists": a, "releases": r, "works": w, "tracks": t}), ("canonical", "artists", "releases", "works", "tracks"),
        ),
    ]


def raw_table(rows: DataFrame) -> DataFrame:
    """Any table with an ``_ord`` as raw fact rows."""
    return schema.filled(schema.evolved(rows)).select("_ord", *schema.FACT)
