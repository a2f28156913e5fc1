import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.plans import dialects
from tidewright.sinks import tables
from tidewright.sources import changes as feeds
from tidewright.streaming import upserts


def test_publish_is_all_or_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.publish(spark.range(3), path)
    with pytest.raises(ValueError):
        tables.publish(spark.range(9), path, lambda x: x.count() == 1)
    assert spark.read.parquet(path).count() == 3
    tables.publish(spark.read.parquet(path).union(spark.range(2)), path)
    assert spark.read.parquet(path).count() == 5
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["t"]


def test_versions(spark, tmp_path):
    path = str(tmp_path / "v")
    assert tables.append_version(spark.createDataFrame([(7, "oak"), (8, "elm"), (9, "ash")], "tree int, kind string"), path) == 0
    assert tables.append_version(spark.createDataFrame([(10, "fir")], "tree int, kind string"), path) == 1
    assert tables.read_version(spark, path).count() == 4 and tables.read_version(spark, path, 0).count() == 3


def test_partition_folders(spark, tmp_path):
    df = spark.createDataFrame([("1999-12-31",), ("1999-05-06",), ("2003-07-08",), ("2020-02-29",)], "d string").select(F.col("d").cast("date").alias("date"))
    tables.append(df, str(tmp_path / "t"), [("date", "year")])
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if "=" in p.name) == ["date_year=1999", "date_year=2003", "date_year=2020"]


def test_compaction_keeps_or_removes_sources(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(5).repartition(3).write.parquet(source)
    assert tables.compact(spark, source, str(tmp_path / "a"), keep_source=True) == 5
    assert tables.exists(spark, source)
    tables.compact(spark, source, str(tmp_path / "a"))
    assert not tables.exists(spark, source) and spark.read.parquet(str(tmp_path / "a")).count() == 5


def test_sync_and_partitions(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS synced")
    df = spark.createDataFrame([(1, "x")], "id int, kind string")
    with pytest.raises(ValueError):
        tables.sync_table(spark, "synced", df, create=False)
    assert len(tables.sync_table(spark, "synced", df, ["day"])) == 1
    assert tables.sync_table(spark, "synced", df) == []
    assert "note" in tables.sync_table(spark, "synced", df.withColumn("NOTE", F.lit("n")))[0]
    assert tables.add_partition(spark, "synced", {"day": "2024-01-01"}) == "day=2024-01-01"
    with pytest.raises(ValueError):
        tables.add_partition(spark, "synced", {"month": "1"})
    tables.drop_partition(spark, "synced", {"day": "2024-01-01"})
    spark.sql("DROP TABLE synced")


def test_script_stops_at_failure(spark):
    assert [r for _, r in tables.run_script(spark, "SELECT 1; SELECT FROM WHERE; SELECT 2")] == ["success", "failure"]


def test_an_aborted_append_leaves_nothing(spark, tmp_path, monkeypatch):
    path, moves = str(tmp_path / "t"), []
    tables.append(spark.range(10), path, target_bytes=1 << 20)
    real = tables.move

    def breaks(s, source, target):
        moves.append(target)
        if len(moves) == 2:
            raise ValueError("gone")
        real(s, source, target)

    monkeypatch.setattr(tables, "move", breaks)
    with pytest.raises(ValueError):
        tables.append(spark.range(10, 20).repartition(3), path)
    monkeypatch.undo()
    assert len(moves) == 2 and spark.read.parquet(path).count() == 10
    assert [x.name for x in tmp_path.iterdir()] == ["t"]
    tables.append(spark.range(10, 20), path)
    assert spark.read.parquet(path).count() == 20


def test_a_taken_version_is_a_conflict(spark, tmp_path):
    from tidewright.operators.routing import CommitConflict

    tables.create(spark, str(tmp_path / "v"), "one")
    with pytest.raises(CommitConflict):
        tables.create(spark, str(tmp_path / "v"), "two")
    assert tables.read_text(spark, str(tmp_path / "v")) == "one"


def test_partition_events(spark, tmp_path):
    for name, parts in (("parted", ["day"]), ("flat", [])):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        tables.sync_table(spark, name, spark.createDataFrame([(1,)], "id int"), parts, location=str(tmp_path / name), stored_as="ORC", external=True)
    event = lambda *x: (e := tables.partition_event(spark, *x), e["kind"], bool(e["warning"]))[1:]
    assert [event("parted", "put", {"day": "1"}), event("parted", "put", {"day": "1"}), event("parted", "delete", {"day": "1"})] == [("add_partition", False), ("insert", False), ("drop_partition", False)]
    assert [event("flat", "put"), event("flat", "delete")] == [("insert", False), ("none", True)]
    assert tables.location(spark, "flat").endswith("/flat") and tables.resolve(spark, "default.flat").columns == ["id"]
    with pytest.raises(ValueError):
        tables.sync_table(spark, "other", spark.range(1), external=True)
    for name in ("parted", "flat"):
        spark.sql(f"DROP TABLE {name}")


def test_parquet_options(spark, tmp_path):
    df = spark.sql("SELECT timestamp '2024-01-31 23:30:00' AS at, timestamp '2024-01-31 23:30:00' AS told, 'x' AS s")
    tables.write_parquet(df, str(tmp_path / "t"), page_bytes=4096, dictionary=False, shift_hours=9, patterns={"told": "yyyy/MM/dd HH"})
    row = spark.read.parquet(str(tmp_path / "t")).first()
    assert (str(row.at), row.told, row.s) == ("2024-02-01 08:30:00", "2024/02/01 08", "x")


def test_dialects():
    d = dialects.dialect
    assert d("postgresql").upsert("t", ["id", "v"], ["id"]) == "INSERT INTO t(id, v) VALUES (?, ?) ON CONFLICT (id) DO UPDATE SET v = EXCLUDED.v"
    assert d("postgresql").insert_ignore("t", ["id"], ["id"]) == "INSERT INTO t(id) VALUES (?) ON CONFLICT (id) DO NOTHING"
    assert d("MySQL").insert_ignore("t", ["id"], ["id"]).startswith("INSERT IGNORE INTO t")
    assert d("oracle12").page("t", limit=5, offset=10, order_by="id") == "SELECT * FROM t ORDER BY id OFFSET 10 ROWS FETCH NEXT 5 ROWS ONLY"
    assert "ROWNUM <= 15" in d("oracle").page("t", limit=5, offset=10, order_by="id")
    assert d("generic").page("t", ["a"], "a > 1", limit=5, offset=10, part_column="id") == "SELECT a FROM t WHERE a > 1 AND id >= 10 AND id < 15"
    with pytest.raises(ValueError):
        d("generic").page("t", limit=5, part_column="id")
    with pytest.raises(NotImplementedError):
        d("generic").upsert("t", ["id"], ["id"])
    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("v", T.DecimalType(9, 2))])
    assert d("generic").create("t", schema, ["id"]) == "CREATE TABLE t (id BIGINT NOT NULL, v DECIMAL(9,2), PRIMARY KEY (id))"
    assert d("oracle12").upsert("t", ["id", "v"], ["id"]).startswith("MERGE INTO t t USING (SELECT ? id, ? v FROM DUAL) n ON (t.id = n.id)")


def test_snapshot_modes(spark):
    s = spark.createDataFrame([(1, "a")], "k int, v string")
    c = spark.createDataFrame([(2, "b", "UPSERT", 5)], "k int, v string, _op string, _seq long")
    assert feeds.with_snapshot(s, c).count() == 2
    assert feeds.with_snapshot(s, c, "never").count() == 1
    assert feeds.with_snapshot(s, c, "when_needed", have_offsets=True).count() == 1


SCHEMA = "k int, v string, _op string, seq long"


def test_redelivered_batches_change_nothing(spark, tmp_path):
    feed, path = str(tmp_path / "feed"), str(tmp_path / "t")
    spark.createDataFrame([(1, "a", "UPSERT", 1), (2, "b", "UPSERT", 2), (None, "n", "UPSERT", 9)], SCHEMA).coalesce(1).write.parquet(feed)
    spark.createDataFrame([(1, "c", "UPSERT", 3), (2, "x", "DELETE", 4), (3, "z", "DELETE", 1)], SCHEMA).coalesce(1).write.mode("append").parquet(feed)
    for attempt in range(2):  # a new checkpoint delivers everything again
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(feed)
        upserts.upsert_stream(stream, path, str(tmp_path / f"c{attempt}"), ["k"], "seq", buckets=3).awaitTermination()
        assert sorted((x.k, x.v, x.seq) for x in upserts.read_upserted(spark, path).collect()) == [(1, "c", 3)]
        assert [x._error for x in spark.read.parquet(f"{path}_rejects").collect()] == ["null key"]
    assert len(tables.names_in(spark, f"{path}/_snapshots")) == 2  # older ones go with their folders


@pytest.mark.parametrize("seed", range(3))
def test_batches_in_any_order_keep_deleted_keys_away(spark, tmp_path, seed):
    import random

    r, path = random.Random(seed), str(tmp_path / "t")
    changes = [(r.randrange(6), f"v{i}", r.choice(["UPSERT", "UPSERT", "DELETE"]), i) for i in range(40)]
    last = {k: (v, op, i) for k, v, op, i in changes}
    r.shuffle(changes)
    for n in range(0, 40, 10):
        upserts.upsert_batch(spark.createDataFrame(changes[n : n + 10], SCHEMA), path, ["k"], "seq", buckets=4, number=n)
    assert sorted((x.k, x.v, x.seq) for x in upserts.read_upserted(spark, path).collect()) == sorted((k, v, i) for k, (v, op, i) in last.items() if op == "UPSERT")


def plain_replay(batches):
    """(rows, rejects) of batches of (k, v, op, seq), a change at a time."""
    rows, last, rejects = {}, {}, []
    for batch in batches:
        begun = dict(last)
        for k, v, op, seq in sorted(batch, key=lambda c: (c[3] is None, c[3])):
            if k is None or seq is None or op == "BAD" or (op == "INSERT" and k in rows and seq > begun.get(k, -1)):
                rejects.append((k, v, op, seq))
            elif seq > begun.get(k, -1):
                if op == "DELETE":
                    rows.pop(k, None)
                    last[k] = seq
                elif op in ("INSERT", "UPSERT") or k in rows:
                    rows[k] = (v, seq)
                    last[k] = seq
    return rows, rejects


@pytest.mark.parametrize("seed,bucket_rows", [(1, 5), (2, 30), (3, 1000)])
def test_buckets_split_and_deltas_fold(spark, tmp_path, seed, bucket_rows):
    import random

    r, path = random.Random(seed), str(tmp_path / "t")
    changes = [(r.choice([None, *range(60)]), f"v{i}", r.choice(["UPSERT", "UPSERT", "DELETE", "INSERT", "UPDATE", "BAD"][: 3 if i < 200 else 6]), r.choice([i] * 20 + [None])) for i in range(440)]
    batches = [changes[n : n + 40] for n in range(0, 440, 40)]
    for n, batch in enumerate(batches):
        for _ in range(2 if n == 6 else 1):  # one comes twice
            upserts.upsert_batch(spark.createDataFrame(batch, SCHEMA), path, ["k"], "seq", buckets=1, number=n, bucket_rows=bucket_rows)
    rows, rejects = plain_replay(batches)
    assert {x.k: (x.v, x.seq) for x in upserts.read_upserted(spark, path).collect()} == rows
    assert upserts.read_upserted(spark, path).count() == len(rows)
    told = spark.read.parquet(f"{path}_rejects").select("k", "v", "_op", "seq")
    assert sorted(map(str, (tuple(x) for x in told.collect()))) == sorted(map(str, rejects))
    state = upserts._snapshot(spark, path, upserts._snapshots(spark, path)[-1])
    assert len(state["deltas"]) < len(batches) + 1 and (len(state["buckets"]) > 4 if bucket_rows == 5 else True)
    assert [b["low"] for b in state["buckets"]] == [0, *[b["high"] for b in state["buckets"][:-1]]]
    spark.range(3).write.parquet(f"{path}/data/lost")  # what a run left that failed before its snapshot
    assert "lost" in upserts.clean_upserted(spark, path) and upserts.read_upserted(spark, path).count() == len(rows)


def test_bytes_written_follow_the_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    made = lambda ids, seq: ids.select(F.col("id").cast("int").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit("UPSERT").alias("_op"), F.lit(seq).cast("long").alias("seq"))
    upserts.upsert_batch(made(spark.range(200_000), 1), path, ["k"], "seq")
    before, size = set(tables._files_under(spark, path)), tables.size_of(spark, f"{path}/data")
    upserts.upsert_batch(made(spark.range(0, 200_000, 500), 2), path, ["k"], "seq", number=1)
    new = set(tables._files_under(spark, f"{path}/data")) - {x.removeprefix("data/") for x in before}
    assert sum(tables.size_of(spark, f"{path}/data/{x}") for x in new) < size / 50
    got = upserts.read_upserted(spark, path).groupBy("seq").count().collect()
    assert {x.seq: x["count"] for x in got} == {1: 199_600, 2: 400}


def test_new_and_missing_columns_of_batches(spark, tmp_path):
    path = str(tmp_path / "t")
    for n, (rows, kinds) in enumerate([([(1, "a", "UPSERT", 1), (2, "b", "UPSERT", 1)], SCHEMA), ([(1, 5, "UPSERT", 2)], "k int, w int, _op string, seq long")]):
        upserts.upsert_batch(spark.createDataFrame(rows, kinds), path, ["k"], "seq", number=n)
    assert sorted((x.k, x.v, x.w) for x in upserts.read_upserted(spark, path).collect()) == [(1, None, 5), (2, "b", None)]


def test_a_failed_rename_leaves_the_old_table(spark, tmp_path, monkeypatch):
    path, move, calls = str(tmp_path / "t"), tables.move, []
    tables.publish(spark.range(3), path)

    def failing(spark, source, target):
        calls.append(target)
        if len(calls) == 2:
            raise OSError("injected")
        move(spark, source, target)

    monkeypatch.setattr(tables, "move", failing)
    with pytest.raises(OSError, match="injected"):
        tables.publish(spark.range(9), path)
    assert spark.read.parquet(path).count() == 3 and tables.names_in(spark, str(tmp_path)) == ["t"]


def test_transactions_of_equal_rows_and_maps(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(1000).select(F.lit(1).alias("v"), F.create_map(F.lit("a"), F.lit(1)).alias("m"))
    assert len(upserts.append_transactions(rows, path, 0, 300)) == 4
    sizes = [r["count"] for r in spark.read.parquet(f"{path}/batch=0").groupBy("part").count().collect()]
    assert sorted(sizes) == [100, 300, 300, 300]


def test_transactions_are_all_or_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(100).withColumn("v", F.col("id") % 50)
    bad = lambda df: F.when(F.col("id") == 7, F.lit("bad row"))
    for _ in range(2):  # a repeated batch replaces its own
        done = upserts.append_transactions(rows, path, 0, 30, bad)
        assert len(done) == 3  # of four
        kept, failed = (spark.read.parquet(f"{path}{x}/batch=0") for x in ("", "_failed"))
        assert kept.count() + failed.count() == 100 and failed.where("_error IS NOT NULL").count() == 1 and failed.select("part").distinct().count() == 1


def test_stream_states_take_a_key_s_rows_in_order(spark, tmp_path):
    """A key with more rows in a trigger than an Arrow batch holds is still processed in order, as the batch form does."""
    from tidewright.operators import alerts
    from tidewright.streaming import monitors

    rows = [(1, i, (i * 7) % 40, (i * 7) % 40 % 5 == 0) for i in range(40)]
    df = spark.createDataFrame(rows, "user_id long, event_id long, at_us long, ok boolean").coalesce(1)
    df.write.parquet(str(tmp_path / "feed"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        feed = spark.readStream.schema(df.schema).parquet(str(tmp_path / "feed"))
        upserts.append_stream(monitors.lockout(feed, "user_id", "at_us", "ok", 3, 0, "event_id"), str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    got = {x.at_us: x.outcome for x in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = alerts.lockout(df.withColumn("at", F.timestamp_micros("at_us")), "user_id", "at", F.col("ok"), "at_us", 3, 0).collect()
    assert got == {x.at_us: x.outcome for x in batch}


def test_streams_with_states_in_a_table(spark, tmp_path):
    """Triggers in order, rows of a trigger in none, a hot key in many Arrow batches, a trigger that comes again."""
    import random

    from tidewright.operators import alerts
    from tidewright.streaming import monitors

    r, path = random.Random(8), str(tmp_path / "t")
    rows = [(r.choice([1, 1, 1, 2, 3]), i, 1_000_000 * (i // 2), r.random() < 0.4) for i in range(300)]
    schema = "user_id long, event_id long, at_us long, ok boolean"
    for part in range(3):
        own = rows[100 * part : 100 * part + 100]
        r.shuffle(own)
        spark.createDataFrame(own, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / f"feed/p{part}"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        for part in range(3):  # a restart for each part
            (tmp_path / "now").mkdir(exist_ok=True)
            for x in (tmp_path / f"feed/p{part}").glob("*.parquet"):
                x.rename(tmp_path / "now" / x.name)
            feed = spark.readStream.schema(schema).parquet(str(tmp_path / "now"))
            monitors.lockout_stream(feed, path, str(tmp_path / "c"), "user_id", "at_us", F.col("ok"), "event_id", 3, 20).awaitTermination()
        batch = alerts.lockout(spark.createDataFrame(rows, schema).withColumn("at", F.timestamp_micros("at_us")), "user_id", "at", F.col("ok"), "event_id", 3, 20)
        expected = sorted((x.user_id, x.event_id, x.outcome, x.failures) for x in batch.collect())
        told = lambda: sorted((x.user_id, x.event_id, x.outcome, x.failures) for x in monitors.scan_results(spark, path).collect())
        assert told() == expected and {x[2] for x in expected} == {"allowed", "failed", "locked", "refused"}
        again = spark.createDataFrame(rows[200:], schema).select("user_id", "at_us", "event_id", F.col("ok").alias("_ok"))
        step = lambda state, b: (lambda now, outcome, n: (now, pa.RecordBatch.from_arrays([pa.array(outcome, pa.string()), pa.array(n, pa.int64())], ["outcome", "failures"])))(*alerts.locked_out(state, b.column(1).to_pylist(), b.column(3).to_pylist(), 3, 20_000_000))
        monitors.scan_batch(again, 2, path, ["user_id"], ["at_us", "event_id"], (0, -1), step)
        assert told() == expected
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_alerts_of_a_stream_with_states_in_a_table(spark, tmp_path):
    import random

    from tidewright.operators import alerts
    from tidewright.streaming import monitors

    r = random.Random(3)
    rows = [(r.choice("ab"), 1_000_000 * i, r.choice([None, 1.0, 9.0, 9.5])) for i in range(200)]
    schema = "series string, at_us long, value double"
    for part in range(4):
        spark.createDataFrame(rows[50 * part : 50 * part + 50], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "feed"))
    feed = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "feed"))
    monitors.alert_stream(feed, str(tmp_path / "t"), str(tmp_path / "c"), "series", "at_us", "value", 5.0, 4).awaitTermination()
    got = sorted((x.series, x.at_us) for x in monitors.scan_results(spark, str(tmp_path / "t")).where("fired").collect())
    batch = alerts.threshold_alerts(spark.createDataFrame(rows, schema).withColumn("at", F.timestamp_micros("at_us")), ["series"], "at", "value", F.lit(5.0), 4)
    assert got == sorted((x.series, x.at_us) for x in batch.collect()) and len(got) > 20


def test_routes_of_destinations(spark, tmp_path):
    feed, seen = str(tmp_path / "feed"), {}
    spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "cdc_destination string, n int").write.parquet(feed)
    stream = spark.readStream.schema("cdc_destination string, n int").parquet(feed)
    sinks = {k: (lambda df, _, k=k: seen.setdefault(k, []).extend(sorted(x.n for x in df.collect()))) for k in "ab"}
    upserts.route_stream(stream, str(tmp_path / "c"), sinks).awaitTermination()
    assert seen == {"a": [1, 3], "b": [2]}


def test_statements_are_run_again_by_error_code(spark):
    class Failed(Exception):
        pass

    calls = []

    def run(text):
        calls.append(text)
        if text == "b" and calls.count("b") < 3:
            raise Failed(30_001)  # to be retried
        if text == "c":
            raise Failed(20_001)

    code = lambda error: error.args[0] if isinstance(error, Failed) else None
    assert tables.run_script(spark, "a; b; c; d", 5, code, run) == [("a", "success"), ("b", "success"), ("c", "failure")]
    assert calls == ["a", "b", "b", "b", "c"]
    calls.clear()
    assert tables.run_script(spark, "b", 1, code, run) == [("b", "retry")]
    assert tables.run_script(spark, "SELECT 1; SELECT no_such_column", 2)[-1][1] == "failure"


def test_store_errors_can_be_tried_again(spark, tmp_path, monkeypatch):
    """A rename that fails inside the store comes as an OSError; formats without a provider are refused by name."""
    from py4j.protocol import Py4JJavaError

    with pytest.raises(OSError):
        tables.move(spark, str(tmp_path / "none"), str(tmp_path / "x"))
    try:
        spark._jvm.java.io.File.createTempFile("aaa", "b", spark._jvm.java.io.File("/no/such"))
    except Py4JJavaError as error:
        failure = error

    class Store:
        def rename(self, *_):
            raise failure

    monkeypatch.setattr(tables, "_fs", lambda *_: (Store(), None))
    with pytest.raises(OSError, match="can't rename"):
        tables.move(spark, "a", "b")
    with pytest.raises(ValueError, match="RCFILE"):
        tables.sync_table(spark, "t", spark.range(1), stored_as="RCFILE")


def test_csv_sink_roundtrip_of_any_double(spark, tmp_path):
    """Doubles come back as the database writes them: negative zero, more than two decimals, very large and small ones."""
    duckdb = pytest.importorskip("duckdb")
    from tidewright.plans import catalogue

    values = [-0.0, 0.0, 10.125, -999.99, 9999999.5, 1e7, 123456789.12, 1e15, 1e16, 1.5e20, 0.001, 0.00012, 0.000012, -2.5e-9, None]
    rows = [(i, f" Customer#{i} ", v) for i, v in enumerate(values)]
    spark.createDataFrame(rows, "c_custkey long, c_name string, c_acctbal double").repartition(3).write.parquet(str(tmp_path / "customer.parquet"))
    got = {tuple(r) for r in catalogue.QUERIES["csv_sink_roundtrip"](spark, str(tmp_path)).collect()}
    sql = catalogue.ORACLE_SQL["csv_sink_roundtrip"].replace("FROM customer", f"FROM '{tmp_path}/customer.parquet/*.parquet'")
    assert got == set(duckdb.sql(sql).fetchall())
