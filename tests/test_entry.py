import __spark_entry__ as entry


def test_names_and_sql_belong_together():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 60


def test_entry_runs(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    assert rows.count() > 0
