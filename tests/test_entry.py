"""The driver's contract, and that the core stands without the training-data subpackage."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
DATA = "/root/testdata/sf0.001"


def test_core_does_not_import_the_subpackage():
    code = "import sys; sys.modules['quire.llm'] = None; import __spark_entry__ as e; assert not any(k.startswith('p2_') for k in e.queries()); assert 'p1_found' in e.queries()"
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT).returncode == 0
    for f in (ROOT / "quire").rglob("*.py"):
        if "llm" not in f.parts:
            assert "quire.llm" not in f.read_text()


def test_sql_belongs_to_queries():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")
def test_core_queries_equal_their_sql(spark):
    import compare
    from quire.plans import registry

    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for f in Path(DATA).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    bad = [n for n, s in registry.oracle_sql().items() if compare.rows(registry.queries()[n](spark, DATA).toPandas()) != compare.rows(con.execute(s).df())]
    assert not bad
