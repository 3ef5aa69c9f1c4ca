import pytest

import __spark_entry__ as entry
from tests.oracle import connect, rows_of, spark_rows

ORACLES = entry.oracle_sql()


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    got = spark_rows(entry.queries()[name](spark, sf_dir))
    want = rows_of(connect(sf_dir).execute(ORACLES[name]))
    assert got[0] == want[0]
    assert len(got[1]) > 0
    assert got[1] == want[1]


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() >= 15  # all patients of the smallest tables
