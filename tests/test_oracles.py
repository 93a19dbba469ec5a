"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import pytest
from harness import SF_SMALL, compare, duck, type_differences

from jobledger.catalog import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    problems, _ = compare(df, con, ORACLE[name])
    assert not problems, problems
    assert not type_differences(df, con, ORACLE[name])


def test_every_query_has_an_oracle_or_is_rows_only():
    rows_only = set(QUERIES) - set(ORACLE)
    assert rows_only <= {"write_jobs_files"}, rows_only


def test_entry_runs(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns[0] == "queue"
    assert df.count() >= 0
