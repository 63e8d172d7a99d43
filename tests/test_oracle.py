"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry
from tidemark.queries import ORACLES, RUNS


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(RUNS))
def test_query_matches_sql(spark, sf, con, name):
    df = entry.queries()[name](spark, sf)
    assert compare(df, con, ORACLES[name]) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_the_rest_works_without_the_training_data_part():
    import subprocess
    import sys

    code = (
        "import sys; sys.modules['tidemark.llm'] = sys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as e\n"
        "from tidemark.queries import RUNS\n"
        "assert set(e.queries()) == set(RUNS) == set(e.oracle_sql())"
    )
    root = __import__("os").path.dirname(entry.__file__)
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
