"""Registered queries against their oracles at the smallest scale, and the entry without the text subpackage."""

import os
import subprocess
import sys

import pytest

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def cell(v):
    if hasattr(v, "__len__") and not isinstance(v, str):
        return str([cell(x) for x in v])
    if v is None or v != v:
        return "null"
    return str(bool(v)) if type(v).__name__ in ("bool", "bool_") else str(v) if isinstance(v, str) else repr(round(float(v), 9))


def names():
    from catloom.plans import catalogue

    return sorted(catalogue.oracle_sql())


@pytest.fixture(scope="module")
def one_view(spark):
    """The view over orders that most queries start from is made once."""
    from catloom.plans import table_queries, text_queries

    made, before = {}, table_queries.disc

    def disc(session, sf_dir):
        if sf_dir not in made:
            made[sf_dir] = before(session, sf_dir).cache()
        return made[sf_dir]

    users = [m for m in (table_queries, text_queries) if hasattr(m, "disc")]
    for module in users:
        module.disc = disc
    yield
    for module in users:
        module.disc = before
    for df in made.values():
        df.unpersist()


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
@pytest.mark.parametrize("name", names())
def test_oracle(spark, one_view, name):
    import duckdb

    from catloom.plans import catalogue

    db = duckdb.connect()
    for f in os.listdir(SF):
        db.execute(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    mine, theirs = catalogue.queries()[name](spark, SF).toPandas(), db.execute(catalogue.oracle_sql()[name]).fetchdf()
    columns = sorted(mine.columns)
    assert columns == sorted(theirs.columns)
    rows = lambda d: sorted(tuple(map(cell, r)) for r in d[columns].itertuples(index=False))
    assert rows(mine) == rows(theirs)


def test_works_without_the_text_subpackage(tmp_path):
    import shutil

    for part in ("catloom", "__spark_entry__.py"):
        source = os.path.join(ROOT, part)
        (shutil.copytree if os.path.isdir(source) else shutil.copy)(source, tmp_path / part)
    shutil.rmtree(tmp_path / "catloom" / "llm", ignore_errors=True)
    code = "import __spark_entry__ as e; assert 'lineage_fill' in e.queries() and set(e.oracle_sql()) <= set(e.queries()) and not any(n.startswith('op1') for n in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
