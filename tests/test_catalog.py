import oracle
import pytest

from corpusloom.registry import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_rows_are_those_of_the_sql(spark, name):
    oracle.compare(spark, QUERIES[name], ORACLE_SQL[name])
