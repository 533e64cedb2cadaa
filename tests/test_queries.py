"""Every query against its SQL on the smallest tables."""

import os

import pytest
from pyspark.sql import functions as F

from linkfold.plans.queries import ORACLE, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted([repr([row[i] for i in order]) for row in rows])


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(ORACLE[name])
    assert got == canonical([d[0] for d in result.description], result.fetchall())
    assert got[1], "a query that finds nothing shows nothing"


def test_filters_reach_the_scan(spark, tmp_path):
    """A pattern query reads the copy that is ordered by what it asks for, and the scan gets the filter."""
    from linkfold.engine import Engine
    from linkfold.operators import links
    from linkfold.plans import mapping
    from linkfold.plans.engine_queries import _full_links

    engine = Engine(spark, f"file://{tmp_path}/engine")
    engine.store.replace_links(links.with_hash(_full_links(mapping.chat_links(spark, DATA))))
    for asked, copy in (({"target": "flux://has_message"}, "by-target"), ({"source": "conv://1"}, "by-source"), ({"source": "conv://1", "target": "x"}, "by-source")):
        query = engine.query("link-pattern", **asked)
        plan = query._jdf.queryExecution().executedPlan().toString()
        assert all(copy in f for f in query.inputFiles()) and "Exchange" not in plan
        for column, value in asked.items():
            assert f"EqualTo({column},{value})" in plan
    for by in ("source", "target"):
        # ranges of files do not overlap, so one value is in few of them
        spans = engine.store.links(by).groupBy(F.input_file_name()).agg(F.min(by).alias("lo"), F.max(by).alias("hi")).orderBy("lo").collect()
        assert all(a.hi <= b.lo for a, b in zip(spans, spans[1:], strict=False))


def test_entry_without_the_corpus_operators(tmp_path):
    """With their folders and the pipeline gone, the entry imports and has all other queries; a missing library still shows."""
    import shutil
    import subprocess
    import sys

    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{here}/linkfold", tmp_path / "linkfold", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{here}/__spark_entry__.py", tmp_path)
    told = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.oracle_sql()), len(e.queries()))"], cwd=tmp_path, capture_output=True, text=True)
    assert told.stdout.split() == ["True", str(len(QUERIES))], told.stderr


def test_plans_join_without_pairs_or_rows_in_python(spark):
    plan = QUERIES["fold_links"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "BatchEvalPython" not in plan
