import duck
import pytest

from folioflow.llm.queries import oracle_sql, queries


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_against_sql(spark, name):
    duck.compare(duck.connect(), spark, queries()[name], oracle_sql()[name])
