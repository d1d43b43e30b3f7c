import __spark_entry__ as E
from courtline import catalog


def test_entry_schema(spark):
    df = E.entry(spark)
    assert len(df.columns) == 54 and df.limit(1).count() == 1


def test_every_query_of_the_catalog_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())
