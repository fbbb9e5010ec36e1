"""Every registered query against its DuckDB twin (sf0.001), and the
rows-only queries against their flat forms."""

import subprocess
import sys

import pytest

from tests.conftest import ROOT, SF_SMALL
from tests.oracle_check import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def _names():
    from firesight.plans.oracle import oracle_sql
    return sorted(oracle_sql())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    from __spark_entry__ import oracle_sql, queries
    problems, n, _ = compare(spark, con, name, queries()[name], oracle_sql()[name], SF_SMALL)
    assert not problems, problems


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() == 4
    assert len(df.columns) == 30


def test_every_query_has_an_oracle():
    from firesight.plans.oracle import oracle_sql
    from firesight.plans.queries import queries
    assert set(queries()) == set(oracle_sql())


def test_entry_works_without_the_training_operators():
    """The optional part may be missing as a whole; any other failure to import is raised."""
    code = """
import importlib.abc, sys
class Gone(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path, target=None):
        if name == "corpus_pipeline" or name.split(".")[:2] == ["firesight", "llm"]:
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
names = set(e.queries())
assert "node_status" in names and not any(n.startswith("op") or n == "pipeline" for n in names)
assert set(e.oracle_sql()) == names
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=ROOT)


SPARK_TO_DUCK = {"IntegerType": "INTEGER", "LongType": "BIGINT", "DoubleType": "DOUBLE", "StringType": "VARCHAR",
                 "BooleanType": "BOOLEAN", "TimestampNTZType": "TIMESTAMP",
                 "TimestampType": "TIMESTAMP WITH TIME ZONE"}


def test_column_types_match_oracle(spark, con):
    from firesight.plans.oracle import oracle_sql
    from firesight.plans.queries import queries
    for name, sql in oracle_sql().items():
        got = {f.name: SPARK_TO_DUCK.get(type(f.dataType).__name__, type(f.dataType).__name__)
               for f in queries()[name](spark, SF_SMALL).schema.fields}
        exp = {r[0]: r[1] for r in con.execute("DESCRIBE " + sql).fetchall()}
        assert got == exp, (name, {k: (got.get(k), exp.get(k)) for k in set(got) | set(exp)
                                   if got.get(k) != exp.get(k)})
