"""Every registered query against its SQL over the same small tables."""

import pytest

from checks.compare import actual, expected
from checks.oracle import SQL
from checks.registry import QUERIES


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, sf, name):
    got, want = actual(spark, name, sf), expected(db, SQL[name])
    assert got[0] == want[0]
    assert len(got[1]) > 0
    assert got[1] == want[1]
