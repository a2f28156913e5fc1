import functools
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.operators import align, alerts, changes, fragments, graphs, lineage, routing


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def field(name, kind=None, nullable=True, **meta):
    return T.StructField(name, kind or T.StringType(), nullable, meta)


def test_alignment_policies(spark):
    df = spark.createDataFrame([(1, "a", "z")], "PERSON_ID int, Name string, extra string")
    target = T.StructType([field("personid", T.LongType(), False), field("name"), field("code", T.IntegerType())])
    assert rows(align.aligned(df, target)) == [(1, "a", None)]
    warnings = []
    align.aligned(df, target, unmatched_column="warn", warnings=warnings)
    assert warnings == ["no field for code"]
    for bad in ({"unmatched_field": "fail"}, {"unmatched_column": "fail"}, {"translate": False}):
        with pytest.raises(align.SchemaMismatch):
            align.aligned(df, target, **bad)
    with pytest.raises(align.SchemaMismatch, match="required"):
        align.aligned(df, T.StructType([field("name"), field("must", nullable=False)]))
    with pytest.raises(align.SchemaMismatch, match="normal name"):
        align.aligned(spark.createDataFrame([(1, 2)], "a_b int, AB int"), target)


def test_nested_alignment_without_case(spark):
    df = spark.sql("SELECT named_struct('FIELD1', 1, 'Inner', named_struct('B', 'x', 'a', 2L)) AS R, array(named_struct('K', 1)) AS l")
    target = T.StructType([field("r", T._parse_datatype_string("inner struct<A:long,b:string>, field1 int")), field("l", T._parse_datatype_string("array<struct<k:long>>"))])
    got = align.aligned(df, target).first()
    assert got.r.inner.A == 2 and got.r.inner.b == "x" and got.r.field1 == 1 and got.l[0].k == 1


def test_rows_at_path(spark):
    df = spark.sql("SELECT named_struct('d', array(named_struct('a', 1), named_struct('a', 2))) AS p")
    assert rows(align.rows_at(df, "p.d")) == [(1,), (2,)]
    with pytest.raises(Exception, match="no record at p.d"):
        align.rows_at(spark.sql("SELECT named_struct('d', cast(array() as array<struct<a:int>>)) AS p"), "p.d").collect()


def test_lowered_collision(spark):
    with pytest.raises(align.SchemaMismatch):
        align.lowered(spark.sql("SELECT 1 AS a, 2 AS b").toDF("x", "y").selectExpr("x AS a", "y AS A"))


def brute(target, feed, strict):
    """The replay rules, one change at a time."""
    state, bad = dict(target), []
    for _, key, op, value in sorted(feed):
        there = key in state
        if op == "INSERT" and there:
            bad.append((key, "duplicate key"))
        elif op in ("INSERT", "INSERT_IGNORE") and not there or op == "UPSERT" or op in ("UPDATE", "UPDATE_IGNORE") and there:
            state[key] = value
        elif op in ("DELETE", "DELETE_IGNORE") and there:
            del state[key]
        elif strict and op in ("UPDATE", "DELETE"):
            bad.append((key, "no such key"))
    return sorted(state.items()), sorted(bad)


@pytest.mark.parametrize("strict", [False, True])
def test_replay_agrees_with_rules(spark, strict):
    r = random.Random(5)
    target = [(k, f"t{k}") for k in range(0, 30, 2)]
    feed = [(i, r.randrange(30), r.choice(align.OPERATIONS), f"v{i}") for i in range(400)]
    t = spark.createDataFrame(target, "k int, v string")
    c = spark.createDataFrame(feed, "seq int, k int, _op string, v string")
    after, rejects = changes.replay(t, c, ["k"], "seq", strict=strict)
    expected, bad = brute(target, feed, strict)
    assert rows(after) == expected
    assert sorted((x.k, x._error) for x in rejects.collect()) == bad


def test_replay_null_keys_and_unknown_operations(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    c = spark.createDataFrame([(1, None, "UPSERT", "x"), (2, 1, "TRUNCATE", "y")], "seq int, k int, _op string, v string")
    after, rejects = changes.replay(t, c, ["k"], "seq")
    assert rows(after) == [(1, "a")]
    assert sorted(x._error for x in rejects.collect()) == ["no operation", "null key"]


def test_empty_changes_and_targets(spark):
    t = spark.createDataFrame([], "k int, v string")
    c = spark.createDataFrame([(1, "a")], "k int, v string")
    assert rows(changes.upsert(t, c, ["k"])) == [(1, "a")]
    assert rows(changes.upsert(c, t, ["k"])) == [(1, "a")]
    assert rows(changes.update(t, c, ["k"])) == []
    with pytest.raises(ValueError, match="needs a key"):
        changes.update(t, c, [])


def test_null_key_never_matches_an_update(spark):
    t = spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string")
    c = spark.createDataFrame([(None, "x"), (1, "y")], "k int, v string")
    assert sorted(map(str, rows(changes.update(t, c, ["k"])))) == ["(1, 'y')", "(None, 'a')"]


def test_ignore_null_keeps_values(spark):
    t = spark.createDataFrame([(1, "a", 5)], "k int, v string, n int")
    c = spark.createDataFrame([(1, None, 6)], "k int, v string, n int")
    assert rows(changes.upsert(t, c, ["k"], ignore_null=True)) == [(1, "a", 6)]
    assert rows(changes.upsert(t, c, ["k"])) == [(1, None, 6)]


def test_delete_needs_all_columns_to_match(spark):
    t = spark.createDataFrame([(1, None), (1, "a"), (2, "b")], "k int, v string")
    c = spark.createDataFrame([(1, None), (2, "x")], "k int, v string")
    assert rows(changes.delete_rows(t, c)) == [(1, "a"), (2, "b")]


def test_fragments(spark):
    df = spark.range(0, 25, 1, 7).select((F.col("id") * 7 % 25).alias("k"))
    got = fragments.fragments(df, 10, ["k"], identifier="f").collect()
    assert sorted((x.k, x.fragment_index, x.fragment_count) for x in got) == [(k, k // 10, 3) for k in range(25)]
    assert fragments.fragments(df, 10, ["k"], max_fragments=1).count() == 10


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_numbers_of_wide_rows_with_ties(spark, adaptive):
    """All rows get one number each, in order, whatever the columns and however shuffles coalesce."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        df = spark.range(0, 60_000, 1, 9).select((F.col("id") * 31 % 500).alias("k"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 8).alias("wide"), F.create_map(F.lit("a"), "id").alias("m"))
        got = fragments.with_index(df, ["k"])
        assert got.count() == got.select("_index").distinct().count() == 60_000
        told = got.agg(F.min("_index"), F.max("_index"), F.count_if(F.floor(F.col("_index") / 120) != F.col("k")), F.count("wide"), F.countDistinct(F.col("m")["a"])).first()
        assert tuple(told) == (0, 59_999, 0, 60_000, 60_000)
        assert fragments.fragments(df, 1000, ["k"]).groupBy("fragment_index", "fragment_count").count().where("count = 1000 AND fragment_count = 60").count() == 60
        assert fragments.with_index(df, []).select("_index").distinct().count() == 60_000
        assert fragments.fragments(df.limit(0), 10, ["k"]).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_balanced_ranges_of_a_skewed_key(spark):
    import statistics

    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 != 1, (F.col("id") % 1000) ** 2 / 1000).cast("int").alias("k"), "id").cache()
    ranges = fragments.balanced_predicates(df, "k", 10, then="id")
    sizes = [df.where(x).count() for x in ranges]
    assert sum(sizes) == 30_000 == functools.reduce(lambda a, b: a.unionAll(b), [df.where(x) for x in ranges]).select("id").distinct().count()
    assert max(sizes) <= 2 * statistics.median(sizes)
    dates = df.select(F.date_add(F.lit("2020-01-01"), F.col("k")).alias("d"))
    assert sum(dates.where(x).count() for x in fragments.balanced_predicates(dates, "d", 4)) == 30_000
    assert fragments.balanced_predicates(df.limit(0), "k", 4) and fragments.balanced_predicates(df, "k", 1) == ["(1 = 1 OR k IS NULL)"]


def test_range_predicates_cover_everything(spark):
    df = spark.createDataFrame([(x,) for x in (*range(-5, 40), None)], "k int")
    parts = [df.where(p).collect() for p in fragments.range_predicates("k", 0, 30, 4)]
    assert len(parts) == 4
    assert sum(map(len, parts)) == 46 and len({x for p in parts for x in p}) == 46


def test_retries():
    calls = []

    def fails(times):
        def action():
            calls.append(1)
            if len(calls) <= times:
                raise routing.CommitConflict("conflict")
            return "done"

        return action

    with pytest.raises(routing.CommitConflict):
        routing.retried(fails(99), retries=3, sleep=lambda _: None)
    assert len(calls) == 4
    calls.clear()
    assert routing.retried(fails(2), retries=3, sleep=lambda _: None) == "done" and len(calls) == 3
    calls.clear()
    now = iter(range(0, 1000, 10))
    with pytest.raises(routing.CommitConflict):
        routing.retried(fails(99), retries=50, total=30, sleep=lambda _: None, clock=lambda: next(now))
    assert len(calls) < 10


def test_other_errors_end_a_commit_at_once():
    calls = []

    def action():
        calls.append(1)
        raise OSError("disk full")

    with pytest.raises(OSError):
        routing.retried(action, sleep=lambda _: None)
    assert len(calls) == 1


def test_error_classes():
    assert routing.classify_code(30001).route is routing.Route.RETRY
    assert routing.classify_code(10001) is routing.ErrorType.INVALID_INPUT
    assert routing.classify_sqlstate("08006").route is routing.Route.RETRY
    assert routing.classify_sqlstate("42601").route is routing.Route.FAILURE


def test_stop_or_collect(spark):
    df = spark.createDataFrame([(1, None), (2, "bad")], "k int, _error string")
    with pytest.raises(Exception, match="bad"):
        routing.first_error_stops(df).collect()
    published = []
    assert not routing.all_or_nothing(df, published.append) and not published
    assert routing.all_or_nothing(df.where("k = 1"), published.append) and len(published) == 1


def test_upstream_distance(spark):
    nodes = spark.createDataFrame([("m", "merge"), ("a", "x"), ("b", "x"), ("c", "x"), ("s", "sink"), ("t", "sink")], "id string, type string")
    edges = spark.createDataFrame([("m", "a"), ("a", "b"), ("b", "c"), ("c", "s"), ("m", "t"), ("t", "t")], "src string, dst string")
    sinks = nodes.where("type = 'sink'")
    assert rows(graphs.without_upstream(sinks, nodes, edges, F.col("type") == "merge", 3)) == [("s", "sink")]
    assert rows(graphs.without_upstream(sinks, nodes, edges, F.col("type") == "merge", 4)) == []


def test_lineage(spark):
    log = spark.createDataFrame([("insert overwrite table Db.Out with c as (select * from a.b) select * from c join d -- from no\n where x = 'from z'",), ("select 1",)], "statement string")
    got = lineage.lineage(log).collect()
    assert (got[0].input_tables, got[0].output_tables) == (["a.b", "d"], ["db.out"])
    assert (got[1].input_tables, got[1].output_tables) == ([], [])


def test_lockout_rules():
    at = [0, 1, 2, 3, 100, 101, 200]
    ok = [False, False, False, True, False, True, True]
    state, got, _ = alerts.locked_out((0, -1), at[:3], ok[:3], 2, 50)
    more = alerts.locked_out(state, at[3:], ok[3:], 2, 50)[1]
    assert got + more == ["failed", "locked", "refused", "refused", "locked", "refused", "allowed"]


def test_lockout_of_unknown_and_disabled_users(spark):
    tries = spark.createDataFrame([("a", 1, False), ("b", 2, False), ("c", 3, True), ("d", 4, True), (None, 5, True)], "user string, i int, ok boolean").withColumn("at", F.timestamp_seconds("i"))
    users = spark.createDataFrame([("a", True), ("b", False), ("c", True), ("d", None)], "user string, enabled boolean")
    got = alerts.lockout(tries, "user", "at", F.col("ok"), "i", users=users).collect()
    assert {r.i: r.outcome for r in got} == {1: "failed", 2: "disabled", 3: "allowed", 4: "disabled", 5: "unknown"}


def test_scans_carry_their_state_over_batches(spark):
    """Batches of two rows give what one batch gives, for keys that begin and end anywhere, null keys too."""
    import random

    r = random.Random(6)
    rows = [(r.choice(["a", "b", "c", None]), i, r.choice([1, 9, 9, None])) for i in range(60)]
    df = spark.createDataFrame(rows, "s string, i int, v int").withColumn("at", F.timestamp_seconds("i"))
    expected = []
    for key in ("a", "b", "c", None):
        last = None
        for _, i, v in (x for x in rows if x[0] == key):
            if not (v or 0) > 5:
                last = None
            elif last is None or i >= last + 3:
                expected.append(i)
                last = i
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in (2, 10_000):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            assert sorted(x.i for x in alerts.threshold_alerts(df, ["s"], "at", "v", F.lit(5), 3).collect()) == sorted(expected)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_ignore_null_replay(spark):
    t = spark.createDataFrame([(1, "a", "b"), (2, "c", "d"), (3, "e", "f")], "k int, x string, y string")
    c = [(1, None, "B", "UPDATE", 1), (1, "A", None, "UPSERT", 2), (2, "C", None, "UPDATE", 1), (2, None, None, "DELETE", 2), (2, None, "D", "UPSERT", 3), (3, "E", None, "UPDATE", 1), (3, None, None, "DELETE", 2), (4, "n", None, "INSERT", 1), (4, None, "m", "UPDATE", 2)]
    after, rejects = changes.replay(t, spark.createDataFrame(c, "k int, x string, y string, _op string, seq int"), ["k"], "seq", ignore_null=True)
    assert sorted(map(tuple, after.collect())) == [(1, "A", "B"), (2, None, "D"), (4, "n", "m")] and rejects.count() == 0


def test_commands_take_lines_that_end_at_line_feeds_alone(spark):
    from tidewright.operators import rows

    values = ["a\u2028b", "c\x0bd", "two\nlines", "", "é"]
    got = rows.piped(spark.createDataFrame([(x,) for x in values], "value string").coalesce(1), ["cat"]).collect()
    assert sorted((r.value, r._route) for r in got) == sorted((x, "failure" if "\n" in x else "success") for x in values)


def test_all_messages_and_extra_fields_stay(spark):
    from tidewright.operators import routing
    from tidewright.sources import delimited

    bad = spark.range(30).select(F.lit("u").alias("unit"), F.concat(F.lit("message "), F.col("id").cast("string")).alias("_error"))
    assert len(routing.errors_by(bad, "unit").first().messages) == 30
    fields = spark.createDataFrame([(["1", "2", "3", "4"],), (["5"],)], "fields array<string>")
    got = delimited.named_fields(fields, ["a"]).collect()
    assert got[0].unknown_fields == {"unknown_field_index_1": "2", "unknown_field_index_2": "3", "unknown_field_index_3": "4"} and got[1].unknown_fields == {}
    wide = delimited.named_fields(fields, ["a"], most=3).first()
    assert (wide.unknown_field_index_1, wide.unknown_field_index_2, wide.unknown_fields) == ("2", "3", {"unknown_field_index_3": "4"})
    assert delimited.named_fields(fields, ["a"], extra="drop").columns == ["a"]


def test_alerts_rearm(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([1, 9, 9, 9, 9, 1, 9, None, 9])], "s string, i int, v int").withColumn("at", F.timestamp_seconds("i"))
    got = alerts.threshold_alerts(df, ["s"], "at", "v", F.lit(5), 3)
    assert [x.i for x in got.orderBy("i").collect()] == [1, 4, 6, 8]


def test_metrics_are_counted_while_rows_are_used(spark, tmp_path):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("g"), F.when(F.col("id") % 10 == 0, F.lit("bad")).alias("_error"))
    df.write.parquet(str(tmp_path / "in"))
    rows_in = spark.read.parquet(str(tmp_path / "in"))
    seen, told = routing.observed(rows_in, "g", [0, 1, 2, None])
    good = seen.where("_error IS NULL")
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and good.count() == 900
    expected = {r.g: (r.rows_in, r.rows_failed, r.rows_out) for r in routing.metrics(df, ["g"]).collect()}
    assert told() == {"all": (1000, 100, 900), "by": {**expected, None: (0, 0, 0)}}
    feed = spark.readStream.schema(rows_in.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = routing.observed_stream(feed, "load", "g", [1]).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert routing.stream_metrics(query, "load", [1]) == {"all": (1000, 100, 900), "by": {1: expected[1]}}
    assert routing.stream_metrics(query, "other") == {"all": (0, 0, 0), "by": {}}


def test_messages_of_a_unit_are_bounded_beside_a_full_table(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("unit"), F.when(F.col("id") % 3 < 2, F.format_string("message %04d", (F.col("id") % 700).cast("int"))).alias("_error")).unionByName(spark.createDataFrame([(None, "no unit")], "unit long, _error string"))
    got = {r.unit: (r.rows_failed, r.messages) for r in routing.errors_by(df, "unit", most=4).collect()}
    every = {r.unit: (r.rows_failed, r.messages) for r in routing.errors_by(df, "unit").collect()}
    assert got == {u: (n, m[:4]) for u, (n, m) in every.items()} and set(got) == {0, 1, None} and len(every[0][1]) > 400
    assert routing.error_table(df, "unit").agg(F.sum("n")).first()[0] == 2001
