"""Databases that executors can't reach: files in, one statement on the server, files out."""

import pytest

from tidewright.plans import catalogue
from tidewright.sinks import remote

TABLES = "/root/testdata/sf0.001"
ODD = [(1, 'a "b", c', 1.5, bytearray(b"\x00\xff")), (2, "x\r\ny\nz", -0.0, None), (3, "", None, bytearray()), (4, None, 1e-300, None), (5, " ü \\ ' ", 1e20, bytearray(b"q"))]


def test_files_keep_odd_values(spark):
    url, driver = remote.embedded()
    df = spark.createDataFrame(ODD, "id long, text string, d double, raw binary").repartition(3)
    remote.load_files(df, url, "odd", properties=driver, mode="overwrite")
    remote.load_files(df.selectExpr("id + 10 AS id", "text", "d", "raw"), url, "odd", properties=driver)
    for ranges in ({}, {"column": '"id"', "bounds": (1, 16), "parts": 4}):
        got = sorted(tuple(r) for r in remote.unload_files(spark, url, "odd", properties=driver, **ranges).collect())
        assert got == sorted(ODD + [(r[0] + 10, *r[1:]) for r in ODD])


def test_upsert_by_files(spark):
    url, driver = remote.embedded()
    remote.load_files(spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string"), url, "t", properties=driver, mode="overwrite")
    remote.upsert(spark.createDataFrame([(2, "B"), (3, None)], "id long, v string"), url, "t", ["id"], properties=driver, write=remote.load_files)
    remote.upsert(spark.createDataFrame([(1, "no"), (4, "d")], "id long, v string"), url, "t", ["id"], update=False, properties=driver, write=remote.load_files)
    assert sorted(tuple(r) for r in remote.unload_files(spark, url, "t", properties=driver).collect()) == [(1, "a"), (2, "B"), (3, None), (4, "d")]


@pytest.mark.parametrize("name", ["jdbc_roundtrip", "remote_upsert"])
def test_queries_where_tasks_reach_no_database(spark, monkeypatch, name):
    """On a cluster each executor would have an embedded database of its own."""
    direct = sorted(catalogue.QUERIES[name](spark, TABLES).collect())
    monkeypatch.setattr(remote, "reachable", lambda spark: False)
    monkeypatch.setattr("tidewright.sources.sql.write_jdbc", None)
    assert sorted(catalogue.QUERIES[name](spark, TABLES).collect()) == direct
