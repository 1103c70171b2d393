"""Every registered query against its SQL twin on the smallest tables."""

import subprocess
import sys
from pathlib import Path

import pytest
from oracle_compare import connect, differences

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the given tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", entry.queries())
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert differences(df, con, sql) == []


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_optional_operators_do_not_take_the_others_with_them():
    """Without a package that only the training-data operators need, all other queries are there."""
    from themeloom.plans.queries import QUERIES

    code = "import sys; sys.modules['public_tokenizers'] = None; sys.modules['ahocorasick'] = None; import __spark_entry__ as e; print(*e.queries())"
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(entry.__file__).parent, capture_output=True, text=True, check=True)
    assert set(done.stdout.split()) == set(QUERIES)
