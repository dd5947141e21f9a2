import __spark_entry__ as entry


def test_every_sql_has_a_query():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 180


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 6
