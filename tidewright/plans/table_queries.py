"""Queries of joins, aggregates, keyed changes, sinks, routing, streams and monitoring."""

from __future__ import annotations

import uuid

from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewright.functions import text
from tidewright.operators import alerts, changes, graphs, routing, rows
from tidewright.plans.registry import query, table, work_folder
from tidewright.sinks import remote, tables
from tidewright.sinks.commit_log import LoggedTable
from tidewright.sources import change_stream, delimited, sql
from tidewright.streaming import monitors, upserts


def order_key():
    return F.col("o_orderkey")


def _orders(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def _changes(spark, d):
    """Two changes for each third order, one for every other third; the later one wins. Some orders are new."""
    o = _orders(spark, d)
    new = o.select("o_orderkey", "o_custkey", F.lit("N").alias("o_orderstatus"), F.round(F.col("o_totalprice") * 2, 2).alias("o_totalprice"), (order_key() * 10 + 1).alias("seq"))
    old = o.where(order_key() % 3 == 0).select("o_orderkey", "o_custkey", F.lit("X").alias("o_orderstatus"), F.col("o_totalprice"), (order_key() * 10).alias("seq"))
    return new.where(order_key() % 3 != 1).unionByName(old)


def _base(spark, d):
    return _orders(spark, d).where(order_key() % 10 < 8)


_ROUND2 = "round(o_totalprice * 2, 2)"


@query(f"""SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 <> 1 THEN 'N' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 3 <> 1 THEN {_ROUND2} ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderkey % 10 < 8 OR o_orderkey % 3 <> 1""")
def upsert(spark, d):
    return changes.apply_changes(_base(spark, d), _changes(spark, d), ["o_orderkey"], "UPSERT", "seq")


@query(f"""SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 <> 1 THEN 'N' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 3 <> 1 THEN {_ROUND2} ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderkey % 10 < 8""")
def update(spark, d):
    return changes.apply_changes(_base(spark, d), _changes(spark, d), ["o_orderkey"], "UPDATE", "seq")


@query("""SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 10 < 8 UNION ALL SELECT o_orderkey, 'N' FROM orders WHERE o_orderkey % 10 >= 8 AND o_orderkey % 3 <> 0""")
def insert(spark, d):
    new = _orders(spark, d).withColumn("o_orderstatus", F.lit("N"))
    twice = new.unionByName(new.where(order_key() % 3 == 0))
    return changes.insert(_base(spark, d), twice, ["o_orderkey"])[0].select("o_orderkey", "o_orderstatus")


@query("""SELECT _error, count(*) AS n FROM (SELECT 'duplicate key' AS _error, o_orderkey FROM orders WHERE o_orderkey % 10 < 8 OR o_orderkey % 3 = 0 UNION ALL SELECT 'duplicate key', o_orderkey FROM orders WHERE o_orderkey % 3 = 0) GROUP BY 1""")
def insert_rejects(spark, d):
    new = _orders(spark, d)
    return changes.insert(_base(spark, d), new.unionByName(new.where(order_key() % 3 == 0)), ["o_orderkey"])[1].groupBy("_error").agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 10 < 8 THEN o_orderstatus WHEN o_orderkey % 3 = 0 THEN 'X' ELSE 'N' END AS o_orderstatus FROM orders WHERE o_orderkey % 10 < 8 OR o_orderkey % 3 <> 1""")
def insert_ignore(spark, d):
    return changes.apply_changes(_base(spark, d), _changes(spark, d), ["o_orderkey"], "INSERT_IGNORE", "seq").select("o_orderkey", "o_orderstatus")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE NOT (o_orderkey % 7 = 0 OR o_orderkey % 5 = 0 AND o_orderstatus = 'O')""")
def delete_full_row(spark, d):
    o = _orders(spark, d).select("o_orderkey", F.when(order_key() % 7 != 0, F.col("o_orderstatus")).alias("o_orderstatus"))
    gone = o.where(order_key() % 7 == 0).unionByName(o.where(order_key() % 5 == 0).select("o_orderkey", F.when(order_key() % 7 != 0, F.lit("O")).alias("o_orderstatus")))
    return changes.delete_rows(o, gone)


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 5 <> 0")
def delete_by_key(spark, d):
    o = _orders(spark, d)
    return changes.delete_keys(o, o.where(order_key() % 5 == 0), ["o_orderkey"]).select("o_orderkey")


def _mixed(spark, d):
    """For key % 6: 0 delete, 1 update, 2 delete then insert, 3 delete then update, 4 upsert then update, 5 insert."""
    o = _orders(spark, d)
    steps = F.element_at(F.array(*[F.array(*[F.lit(x) for x in row]) for row in (("DELETE",), ("UPDATE",), ("DELETE", "INSERT"), ("DELETE", "UPDATE"), ("UPSERT", "UPDATE"), ("INSERT",))]), (order_key() % 6 + 1).cast("int"))
    each = o.select("o_orderkey", "o_custkey", F.posexplode(steps).alias("i", "_op"), "o_totalprice")
    return each.select("o_orderkey", "o_custkey", F.concat(F.lit("S"), F.col("i").cast("string")).alias("o_orderstatus"), "o_totalprice", "_op", (order_key() * 10 + F.col("i")).alias("seq"))


@query("""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 1 THEN 'S0' WHEN 2 THEN 'S1' WHEN 4 THEN 'S1' WHEN 5 THEN CASE WHEN o_orderkey % 10 < 8 THEN o_orderstatus ELSE 'S0' END END AS o_orderstatus
FROM orders WHERE o_orderkey % 6 IN (2, 4, 5) OR o_orderkey % 6 = 1 AND o_orderkey % 10 < 8""")
def mixed_replay(spark, d):
    return changes.replay(_base(spark, d), _mixed(spark, d), ["o_orderkey"], "seq")[0].select("o_orderkey", "o_orderstatus")


@query("""SELECT _error, count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 6 = 5 THEN CASE WHEN o_orderkey % 10 < 8 THEN 'duplicate key' END WHEN o_orderkey % 6 IN (0, 1, 2) AND o_orderkey % 10 >= 8 THEN 'no such key' WHEN o_orderkey % 6 = 3 THEN 'no such key' END AS _error FROM orders
UNION ALL SELECT 'no such key' FROM orders WHERE o_orderkey % 6 = 3 AND o_orderkey % 10 >= 8) WHERE _error IS NOT NULL GROUP BY 1""")
def store_ops(spark, d):
    return changes.replay(_base(spark, d), _mixed(spark, d), ["o_orderkey"], "seq", strict=True)[1].groupBy("_error").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'U' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def ignore_null_update(spark, d):
    o = _orders(spark, d).select("o_orderkey", "o_orderstatus")
    return changes.update(o, o.select("o_orderkey", F.when(order_key() % 2 == 0, "U").alias("o_orderstatus")), ["o_orderkey"], ignore_null=True)


@query("SELECT user_id, max(event_id) AS event_id, max_by(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def last_change_wins(spark, d):
    return changes.last_per_key(table(spark, d, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id")


@query("SELECT r_regionkey, r_name, coalesce(len(list_distinct(list(n_nationkey) FILTER (n_nationkey IS NOT NULL AND n_nationkey % 5 <> 0))), 0) AS members FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY r_regionkey, r_name")
def group_members(spark, d):
    n = table(spark, d, "nation").where(F.col("n_nationkey") % 5 != 0).select(F.col("n_regionkey").alias("group_id"), F.col("n_nationkey").alias("user_id"))
    r = table(spark, d, "region").select(F.col("r_regionkey").alias("group_id"), "r_name")
    return graphs.members_of_groups(r, n).select(F.col("group_id").alias("r_regionkey"), "r_name", F.size("members").cast("long").alias("members"))


@query("SELECT l_orderkey AS group_id, count(*) AS n FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_suppkey = 7) GROUP BY l_orderkey")
def group_fellows(spark, d):
    m = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("group_id"), F.col("l_suppkey").alias("user_id"))
    return graphs.fellows(m, 7).groupBy("group_id").agg(F.count("*").alias("n"))


def _checked(spark, d):
    e = table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    return e.withColumn("_error", F.when(F.col("k") % 10 == 0, "connection timeout").when(F.col("value") < 5, "value too small"))


_CHECKED = "(SELECT *, CASE WHEN CAST(json_extract(props, '$.k') AS BIGINT) % 10 = 0 THEN 'connection timeout' WHEN value < 5 THEN 'value too small' END AS e FROM events)"


@query(f"SELECT event_type, count(*) AS rows_in, count(e) AS rows_failed, count(*) - count(e) AS rows_out FROM {_CHECKED} GROUP BY event_type")
def load_metrics(spark, d):
    return routing.metrics(_checked(spark, d), ["event_type"])


@query(f"SELECT event_type, count(*) AS rows_in, count(e) AS rows_failed, count(*) - count(e) AS rows_out FROM {_CHECKED} GROUP BY event_type UNION ALL SELECT 'written', count(*), 0, count(*) FROM {_CHECKED} WHERE e IS NULL")
def observed_metrics(spark, d):
    """Metrics that are counted while the good rows are written."""
    rows, at = _checked(spark, d), work_folder(spark, "loaded")
    kinds = sorted(r[0] for r in rows.select("event_type").distinct().collect())  # a handful
    seen, told = routing.observed(rows, "event_type", kinds)
    seen.where("_error IS NULL").drop("_error").write.parquet(at)
    metrics = spark.createDataFrame([(k, *n) for k, n in told()["by"].items()], "event_type string, rows_in long, rows_failed long, rows_out long")
    n = F.count("*")
    return metrics.unionByName(spark.read.parquet(at).agg(F.lit("written").alias("event_type"), n.alias("rows_in"), F.lit(0).cast("long").alias("rows_failed"), n.alias("rows_out")))


@query(f"SELECT CAST(user_id % 20 AS BIGINT) AS unit, e AS _error, count(*) AS n FROM {_CHECKED} WHERE e IS NOT NULL GROUP BY 1, 2")
def error_table(spark, d):
    return routing.error_table(_checked(spark, d).withColumn("unit", F.col("user_id") % 20), "unit")


@query(f"SELECT CAST(user_id % 20 AS BIGINT) AS unit, count(*) AS rows_failed, string_agg(DISTINCT e, '; ' ORDER BY e) AS messages FROM {_CHECKED} WHERE e IS NOT NULL GROUP BY 1")
def errors_by_unit(spark, d):
    return routing.errors_by(_checked(spark, d).withColumn("unit", F.col("user_id") % 20), "unit").withColumn("messages", F.concat_ws("; ", "messages"))


@query(f"SELECT CASE e WHEN 'connection timeout' THEN 'retry' WHEN 'value too small' THEN 'failure' ELSE 'success' END AS route, count(*) AS n FROM {_CHECKED} GROUP BY 1")
def route_rejects(spark, d):
    return routing.routed(_checked(spark, d)).groupBy(F.col("_route").alias("route")).agg(F.count("*").alias("n"))


@query("SELECT n_name, r_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE o_totalprice > 1000 GROUP BY n_name, r_name")
def passthrough_joins(spark, d):
    for name in ("orders", "customer", "nation", "region"):
        table(spark, d, name).createOrReplaceTempView(f"{name}_in")
    return spark.sql("SELECT n_name, r_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders_in JOIN customer_in ON o_custkey = c_custkey JOIN nation_in ON c_nationkey = n_nationkey JOIN region_in ON n_regionkey = r_regionkey WHERE o_totalprice > 1000 GROUP BY n_name, r_name")


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, count(DISTINCT l_suppkey) AS suppliers, sum(l_quantity) AS quantity FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def passthrough_cube(spark, d):
    return table(spark, d, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.count_distinct("l_suppkey").alias("suppliers"), F.sum("l_quantity").alias("quantity"))


@query("SELECT n_regionkey, n_name, count(*) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY GROUPING SETS ((n_regionkey), (n_regionkey, n_name), ())")
def passthrough_grouping_sets(spark, d):
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    r, n = F.col("n_regionkey"), F.col("n_name")
    return s.groupingSets([[r], [r, n], []], r, n).agg(F.count("*").alias("n"))


@query("SELECT event_id, row_number() OVER w AS place, round(sum(value) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS recent, lag(event_type) OVER w AS before FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)")
def passthrough_windows(spark, d):
    w = Window.partitionBy("user_id").orderBy("event_id")
    return table(spark, d, "events").select("event_id", F.row_number().over(w).cast("long").alias("place"), F.round(F.sum("value").over(w.rowsBetween(-2, 0)), 4).alias("recent"), F.lag("event_type").over(w).alias("before"))


@query("(SELECT o_custkey AS k FROM orders INTERSECT SELECT c_custkey FROM customer WHERE c_acctbal > 0) UNION ALL (SELECT l_partkey FROM lineitem EXCEPT SELECT p_partkey FROM part WHERE p_size > 25)")
def passthrough_setops(spark, d):
    t = lambda n: table(spark, d, n)
    both = t("orders").select(F.col("o_custkey").alias("k")).intersect(t("customer").where("c_acctbal > 0").select("c_custkey"))
    return both.union(t("lineitem").select("l_partkey").subtract(t("part").where("p_size > 25").select("p_partkey")))


@query("SELECT c_custkey, c_acctbal FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 200000)")
def passthrough_anti_join(spark, d):
    big = table(spark, d, "orders").where("o_totalprice > 200000")
    return table(spark, d, "customer").join(big, F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey", "c_acctbal")


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 100")
def top_k(spark, d):
    return table(spark, d, "lineitem").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber").limit(100).select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("SELECT p_partkey, p_name, CASE WHEN p_partkey % 2 = 0 THEN 'new' || p_partkey END AS note FROM part")
def schema_drift(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_name")
    source = p.where("p_partkey % 2 = 0").withColumn("NOTE", F.concat(F.lit("new"), F.col("p_partkey").cast("string")))
    wide, new = tables.with_drift(p, source)
    return changes.update(wide, source.toDF(*[c.lower() for c in source.columns]), ["p_partkey"]) if new else wide


@query("SELECT p_brand, count(*) AS n, count(*) FILTER (p_size > 25) AS noted FROM part GROUP BY p_brand")
def table_sync(spark, d):
    import uuid

    name, at = f"sync_{uuid.uuid4().hex}", work_folder(spark, "sync")
    p = table(spark, d, "part").select("p_partkey", "p_size", "p_brand")
    tables.sync_table(spark, name, p, ["p_brand"], location=at)
    noted = p.withColumn("note", F.when(F.col("p_size") > 25, "large"))
    tables.sync_table(spark, name, noted)
    noted.select("p_partkey", "p_size", "note", "p_brand").write.mode("append").partitionBy("p_brand").parquet(at)
    read = spark.read.parquet(at)
    out = read.groupBy("p_brand").agg(F.count("*").alias("n"), F.count("note").alias("noted"))
    spark.sql(f"DROP TABLE {name}")
    return out


@query("SELECT strftime(ts, '%Y-%m') AS ts_month, strftime(ts, '%Y-%m-%d') AS ts_day, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1, 2")
def partition_transforms(spark, d):
    path = work_folder(spark, "lake")
    tables.append(table(spark, d, "events").select("event_id", "ts"), path, [("ts", "month"), ("ts", "day")])
    read = spark.read.option("basePath", path).schema("event_id long, ts timestamp, ts_month string, ts_day string").parquet(path)
    return read.groupBy("ts_month", "ts_day").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("SELECT CAST(v AS INTEGER) AS version, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS ids FROM orders, (VALUES (0), (1), (2)) AS t(v) WHERE o_orderkey % 3 <= v GROUP BY v")
def versioned_append(spark, d):
    path = work_folder(spark, "versions")
    made = [tables.append_version(_orders(spark, d).where(order_key() % 3 == i), path) for i in range(3)]
    each = [tables.read_version(spark, path, v).agg(F.lit(v).alias("version"), F.count("*").alias("n"), F.sum("o_orderkey").alias("ids")) for v in made]
    return each[0].unionByName(each[1]).unionByName(each[2])


@query("SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderstatus")
def compaction(spark, d):
    path = work_folder(spark, "parts")
    for i in range(3):
        _orders(spark, d).where(order_key() % 3 == i).repartition(4).write.mode("append").parquet(path)
    tables.compact(spark, path, f"{path}_one", target_bytes=1 << 20)
    return spark.read.parquet(f"{path}_one").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("""SELECT o_orderkey, o_orderstatus, o_custkey, CAST(o_totalprice AS DOUBLE) AS price FROM orders WHERE o_custkey BETWEEN 100 AND 400 AND o_totalprice > 150000""")
def planned_compaction(spark, d):
    """Many small files of a logged table become few, clustered by two columns, and are read by both."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_custkey", F.col("o_totalprice").cast("double").alias("price"))
    t = LoggedTable(spark, work_folder(spark, "logged"), ["o_orderstatus"], ["o_custkey", "price"])
    for i in range(3):
        t.append(orders.where(F.col("o_orderkey") % 3 == i))
    t.compact(1 << 20)
    t.compact(1 << 16, cluster=["o_custkey", "price"])
    return t.read([("o_custkey", ">=", 100), ("o_custkey", "<=", 400), ("price", ">", 150000.0)])


@query("SELECT c_custkey AS custkey, c_name AS name, CAST(c_acctbal AS VARCHAR) AS acctbal FROM customer")
def csv_sink_roundtrip(spark, d):
    path = work_folder(spark, "csv")
    tables.write_csv(table(spark, d, "customer").select("c_custkey", "c_name", text.plain_double("c_acctbal")), path, names=["custkey", "name", "acctbal"], sep=";", quote_all=True)
    read = delimited.read_csv(spark, path, "custkey long, name string, acctbal string", sep=";")
    return read.withColumn("acctbal", text.plain_double(F.col("acctbal").cast("double")))


@query("SELECT p_partkey, p_brand, p_size FROM part")
def orc_roundtrip(spark, d):
    path = work_folder(spark, "orc")
    tables.write_orc(table(spark, d, "part").select(F.col("p_partkey").alias("P_PARTKEY"), "p_brand", "p_size"), path, "zlib")
    return spark.read.orc(path)


def _stream_source(spark, d, files=4):
    path = work_folder(spark, "feed")
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    e.withColumn("_op", F.when(F.col("event_type") == "error", "DELETE").otherwise("UPSERT")).repartitionByRange(files, "event_id").write.parquet(path)
    return path, spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 2).parquet(path)


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r = 1 AND event_type <> 'error'")
def stream_upsert(spark, d):
    path, feed = _stream_source(spark, d)
    run = upserts.upsert_stream(feed, f"{path}_table", f"{path}_checkpoint", ["user_id"], "event_id")
    run.awaitTermination()
    return upserts.read_upserted(spark, f"{path}_table").select("user_id", "event_id", "event_type")


@query("""SELECT o_orderkey AS k, o_orderstatus AS status, CASE WHEN o_orderkey BETWEEN 1000 AND 3000 THEN CAST(0 AS DOUBLE) ELSE CAST(o_totalprice AS DOUBLE) END AS price FROM orders WHERE o_orderkey % 97 <> 0
UNION ALL SELECT -o_orderkey, 'N', CAST(1 AS DOUBLE) FROM orders WHERE o_custkey % 50 = 0""")
def log_merge(spark, d):
    """Appends, then an upsert, a delete and another append, each a commit of a table with a log."""
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").cast("double").alias("price"), "o_custkey")
    t = LoggedTable(spark, work_folder(spark, "logged"), stats=["k"])
    t.append(orders.drop("o_custkey").repartitionByRange(8, "k"))
    t.merge(orders.where("k BETWEEN 1000 AND 3000").select("k", "status", F.lit(0.0).alias("price")), ["k"])
    t.merge(orders.where("k % 97 = 0").select("k"), ["k"], "DELETE")
    t.append(orders.where("o_custkey % 50 = 0").select((-F.col("k")).alias("k"), F.lit("N").alias("status"), F.lit(1.0).alias("price")))
    return t.read()


@query("SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity FROM lineitem WHERE l_orderkey >= 2000 AND l_orderkey < 2600 AND l_quantity > 10")
def log_filtered_read(spark, d):
    """A read of the files alone whose statistics allow the conditions, of a partitioned table."""
    t = LoggedTable(spark, work_folder(spark, "logged"), partition_by=["l_returnflag"], stats=["l_orderkey", "l_quantity"])
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    t.append(lines.where("l_orderkey < 2300"))
    t.append(lines.where("l_orderkey >= 2300"))
    return t.read([("l_orderkey", ">=", 2000), ("l_orderkey", "<", 2600), ("l_quantity", ">", 10)])


@query("SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY event_type")
def stream_once(spark, d):
    path = work_folder(spark, "feed")
    e = table(spark, d, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    e.unionByName(e.where("event_id % 3 = 0")).write.parquet(path)
    feed = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    upserts.append_stream(upserts.once_within(feed, "ts", ["event_id"], "1 day"), f"{path}_out", f"{path}_checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}_out").groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("""SELECT event_id AS seq, '{"user_id":' || user_id || '}' AS cdc_key, event_type FROM events""")
def change_stream_rows(spark, d):
    """A change table as a stream of capped triggers, stopped after its first ones and gone on with from its checkpoint."""
    path = work_folder(spark, "changes")
    events = table(spark, d, "events").select(F.col("event_id").alias("seq"), F.to_json(F.struct("user_id")).alias("cdc_key"), F.to_json(F.struct("event_type")).alias("value"), F.lit("events").alias("cdc_destination"))
    halves = [events.where(F.col("seq") % 2 == i).repartitionByRange(3, "seq").sortWithinPartitions("seq") for i in (0, 1)]
    change_stream.register(spark)
    for i, half in enumerate(halves):
        half.write.json(f"{path}/{i}")
        for name in tables.names_in(spark, f"{path}/{i}"):
            if name.endswith(".json"):
                tables.move(spark, f"{path}/{i}/{name}", f"{path}/{i}-{name}")
        tables.remove(spark, f"{path}/{i}")
        feed = spark.readStream.format("change_table").options(path=path, max_rows=20_000, rows_per_task=5_000).load()
        run = upserts.append_stream(feed, f"{path}_out", f"{path}_checkpoint", available_now=False)
        run.processAllAvailable()
        run.stop()
    return spark.read.parquet(f"{path}_out").select("seq", "cdc_key", F.get_json_object("value", "$.event_type").alias("event_type"))


def _daily(spark, d):
    e = table(spark, d, "events")
    return e.groupBy("event_type", F.date_trunc("day", F.col("ts").cast("timestamp")).alias("day")).agg(F.round(F.avg("value"), 6).alias("level"))


_ALERTS = """WITH RECURSIVE daily AS (SELECT event_type, date_trunc('day', ts) AS day, round(avg(value), 6) AS level FROM events GROUP BY ALL),
s AS (SELECT *, sum(CASE WHEN level > 50 THEN 0 ELSE 1 END) OVER (PARTITION BY event_type ORDER BY day) AS stretch FROM daily),
up AS (SELECT * FROM s WHERE level > 50),
fired AS (SELECT event_type, stretch, min(day) AS day FROM up GROUP BY event_type, stretch
  UNION ALL SELECT f.event_type, f.stretch, (SELECT min(u.day) FROM up u WHERE u.event_type = f.event_type AND u.stretch = f.stretch AND u.day >= f.day + INTERVAL 3 DAY) FROM fired f WHERE f.day IS NOT NULL)
SELECT event_type, strftime(day, '%Y-%m-%d') AS day FROM fired WHERE day IS NOT NULL"""


@query(_ALERTS)
def threshold_alerts(spark, d):
    found = alerts.threshold_alerts(_daily(spark, d), ["event_type"], "day", "level", F.lit(50.0), 3 * 86400)
    return found.select("event_type", F.date_format("day", "yyyy-MM-dd").alias("day"))


@query(_ALERTS)
def stream_alerts(spark, d):
    path = work_folder(spark, "levels")
    _daily(spark, d).select("event_type", F.unix_micros("day").alias("at_us"), "level").coalesce(1).write.parquet(path)
    feed = spark.readStream.schema("event_type string, at_us long, level double").parquet(path)
    upserts.append_stream(monitors.threshold_alerts(feed, "event_type", "at_us", "level", 50.0, 3 * 86400), f"{path}_out", f"{path}_checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}_out").select(F.col("series").alias("event_type"), F.date_format(F.timestamp_micros("at_us"), "yyyy-MM-dd").alias("day"))


@query("SELECT event_type, count(*) FILTER (p > 50) AS alerts, round(max(p), 4) AS most FROM (SELECT event_type, value * 100 / 100.0 AS p FROM events) GROUP BY event_type")
def usage_payloads(spark, d):
    e = table(spark, d, "events").withColumn("used", alerts.percent_used(F.col("value"), F.lit(100.0)))
    told = alerts.payloads(e, "host-1", "disk", F.lit(50.0), ["used"], {"team": "data"})
    used = F.get_json_object("payload", "$.values.used").cast("double")
    return told.groupBy("event_type").agg(F.count_if(used > 50).alias("alerts"), F.round(F.max(used), 4).alias("most"))


_LOCKOUT = """WITH RECURSIVE e AS (SELECT user_id, event_id, epoch_us(ts) AS t_us, event_type <> 'error' AS ok, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
s AS (SELECT user_id, event_id, i, CASE WHEN ok THEN 0 ELSE 1 END AS failures, CASE WHEN NOT ok AND 1 >= 2 THEN t_us + 86400000000 ELSE -1 END AS until, CASE WHEN ok THEN 'allowed' ELSE 'failed' END AS outcome FROM e WHERE i = 1
  UNION ALL SELECT e.user_id, e.event_id, e.i, CASE WHEN e.t_us < s.until THEN s.failures WHEN e.ok THEN 0 ELSE s.failures + 1 END,
    CASE WHEN e.t_us >= s.until AND NOT e.ok AND s.failures + 1 >= 2 THEN e.t_us + 86400000000 ELSE s.until END,
    CASE WHEN e.t_us < s.until THEN 'refused' WHEN e.ok THEN 'allowed' WHEN s.failures + 1 >= 2 THEN 'locked' ELSE 'failed' END
  FROM s JOIN e ON e.user_id = s.user_id AND e.i = s.i + 1)
"""


@query(_LOCKOUT + "SELECT user_id, event_id, outcome, CAST(failures AS BIGINT) AS failures FROM s")
def lockout(spark, d):
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return alerts.lockout(e, "user_id", "ts", F.col("event_type") != "error", "event_id", most=2, lock_s=86400)


@query(_LOCKOUT + "SELECT outcome, count(*) AS n FROM s GROUP BY outcome")
def stream_lockout(spark, d):
    path = work_folder(spark, "attempts")
    table(spark, d, "events").select("event_id", "user_id", (F.unix_micros(F.col("ts").cast("timestamp"))).alias("at_us"), (F.col("event_type") != "error").alias("ok")).repartitionByRange(3, "at_us").sortWithinPartitions("at_us").write.parquet(path)
    feed = spark.readStream.schema("event_id long, user_id long, at_us long, ok boolean").parquet(path)
    upserts.append_stream(monitors.lockout(feed, "user_id", "at_us", "ok", 2, 86400, "event_id"), f"{path}_out", f"{path}_checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}_out").groupBy("outcome").agg(F.count("*").alias("n"))


def _graph(spark, d):
    """Suppliers feed nations, nations feed regions, every third customer feeds its nation."""
    name = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    s, n, c = (table(spark, d, x) for x in ("supplier", "nation", "customer"))
    edges = s.select(name("s", "s_suppkey").alias("src"), name("n", "s_nationkey").alias("dst")).unionByName(n.select(name("n", "n_nationkey").alias("src"), name("r", "n_regionkey").alias("dst"))).unionByName(c.where("c_custkey % 3 = 0").select(name("c", "c_custkey").alias("src"), name("n", "c_nationkey").alias("dst")))
    ids = [s.select(name("s", "s_suppkey").alias("id")), n.select(name("n", "n_nationkey").alias("id")), c.select(name("c", "c_custkey").alias("id")), table(spark, d, "region").select(name("r", "r_regionkey").alias("id"))]
    return ids[0].unionByName(ids[1]).unionByName(ids[2]).unionByName(ids[3]), edges


_GRAPH = """WITH RECURSIVE edges AS (SELECT 's' || s_suppkey AS src, 'n' || s_nationkey AS dst FROM supplier UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer WHERE c_custkey % 3 = 0),
nodes AS (SELECT 's' || s_suppkey AS id FROM supplier UNION ALL SELECT 'n' || n_nationkey FROM nation UNION ALL SELECT 'c' || c_custkey FROM customer UNION ALL SELECT 'r' || r_regionkey FROM region)"""


@query(_GRAPH + " SELECT id FROM nodes WHERE id IN (SELECT dst FROM edges) AND id NOT IN (SELECT src FROM edges)")
def graph_dead_ends(spark, d):
    return graphs.dead_ends(*_graph(spark, d))


@query(_GRAPH + ", up AS (SELECT id AS start, id, 0 AS hops FROM nodes WHERE id LIKE 'r%' UNION SELECT up.start, e.src, up.hops + 1 FROM up JOIN edges e ON e.dst = up.id WHERE up.hops < 2) SELECT start, hops, count(DISTINCT id) AS n FROM up WHERE hops > 0 GROUP BY start, hops")
def graph_upstream_within(spark, d):
    nodes, edges = _graph(spark, d)
    found = graphs.upstream_within(nodes.where("id LIKE 'r%'"), edges, 2)
    return found.groupBy("start", "hops").agg(F.count("*").alias("n"))


@query(_GRAPH + " SELECT n.id FROM nodes n WHERE n.id LIKE 'n%' AND NOT EXISTS (SELECT 1 FROM edges WHERE dst = n.id AND src LIKE 's%' AND CAST(substr(src, 2) AS BIGINT) % 10 = 0)")
def graph_without_upstream(spark, d):
    nodes, edges = _graph(spark, d)
    return graphs.without_upstream(nodes.where("id LIKE 'n%'"), nodes, edges, F.col("id").rlike("^s[0-9]*0$"), 2)


@query("""SELECT rule, count(*) AS n FROM (SELECT 'task_cap' AS rule FROM part WHERE p_size > 40 UNION ALL SELECT 'pool_share' FROM part WHERE p_size > 30 UNION ALL SELECT 'zero_schedule' FROM part WHERE p_type LIKE '%STEEL%' AND p_partkey % 3 = 0 UNION ALL SELECT 'pool_ceiling' FROM part WHERE p_size > 2 * (p_partkey % 7 + 1)) GROUP BY rule""")
def governance_checks(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("tasks"), F.col("p_type").alias("type"), (F.col("p_partkey") % 3).alias("period_s"), F.col("p_size").alias("threads"), (F.col("p_partkey") % 7 + 1).alias("cores"))
    found = [graphs.over_cap(p, 40), graphs.over_share(p, 101, 30), graphs.unscheduled(p, "STEEL"), graphs.pool_over_cores(p, 2)]
    rules = found[0].select("rule")
    for f in found[1:]:
        rules = rules.unionByName(f.select("rule"))
    return rules.groupBy("rule").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, o_orderstatus || '!' AS status FROM orders")
def piped_rows(spark, d):
    lines = _orders(spark, d).select(F.concat_ws("\t", F.col("o_orderkey").cast("string"), F.concat("o_orderstatus", F.lit("!"))).alias("value"))
    parts = F.split("value", "\t")
    return rows.piped(lines, ["cat"]).where("_route = 'success'").select(parts[0].cast("long").alias("o_orderkey"), parts[1].alias("status"))


@query("SELECT 'failure' AS route, 3 AS status, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS ids FROM orders")
def piped_failures(spark, d):
    lines = _orders(spark, d).select(F.col("o_orderkey").cast("string").alias("value"))
    failed = rows.piped(lines, ["sh", "-c", "cat > /dev/null; exit 3"])
    return failed.groupBy(F.col("_route").alias("route"), "status").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("long")).alias("ids"))


@query("SELECT c_custkey, upper(c_name) || '/' || c_nationkey AS tag FROM customer")
def row_function(spark, d):
    return rows.mapped(table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey"), lambda r: {"c_custkey": r["c_custkey"], "tag": f"{r['c_name'].upper()}/{r['c_nationkey']}"}, "c_custkey long, tag string")


@query("SELECT c_custkey, upper(c_name) AS name, c_nationkey % 5 AS part FROM customer")
def column_hook(spark, d):
    hook = lambda df: {"name": F.upper(df["c_name"]), "part": df["c_nationkey"] % 5}
    return rows.with_columns(table(spark, d, "customer"), hook).select("c_custkey", "name", "part")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS k, o_orderstatus AS status FROM orders")
def extract_chunks(spark, d):
    path = work_folder(spark, "chunks")
    sql.extract_csv(_orders(spark, d).select("o_orderkey", "o_orderstatus"), path, 1000)
    return spark.read.schema("k string, status string").csv(path)


@query("SELECT event_id, epoch_us(ts) AS micros FROM events")
def int96_roundtrip(spark, d):
    path = work_folder(spark, "int96")
    tables.write_parquet(table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts")), path, int96=True)
    return spark.read.parquet(path).select("event_id", F.unix_micros("ts").alias("micros"))


@query("SELECT s_suppkey, CAST(CAST(s_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS balance, '2024-01-01' AS day FROM supplier")
def text_types(spark, d):
    return tables.as_text_types(table(spark, d, "supplier").select("s_suppkey", F.col("s_acctbal").cast("decimal(12,2)").alias("balance"), F.lit("2024-01-01").cast("date").alias("day")))


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'new' ELSE c_name END AS c_name FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 2 = 0")
def remote_upsert(spark, d):
    """A staging table is written by tasks where they reach the embedded database, else imported by it from files."""
    url, driver = remote.embedded()
    direct = remote.reachable(spark)
    write = sql.write_jdbc if direct else remote.load_files
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    write(c.where("c_custkey % 3 <> 0"), url, "target", properties=driver, mode="overwrite")
    remote.execute(spark, url, 'CREATE INDEX target_key ON target ("c_custkey")', driver)
    changed = c.where("c_custkey % 2 = 0").withColumn("c_name", F.lit("new"))
    remote.upsert(changed, url, "target", ["c_custkey"], properties=driver, write=write)
    remote.upsert(c.withColumn("c_name", F.lit("ignored")).where("c_custkey % 3 <> 0"), url, "target", ["c_custkey"], update=False, properties=driver, write=write)
    low, high = c.agg(F.min("c_custkey"), F.max("c_custkey")).first()
    return (sql.jdbc if direct else remote.unload_files)(spark, url, "target", column='"c_custkey"', bounds=(low or 0, (high or 0) + 1), parts=8, properties=driver)


@query("SELECT n_name, count(*) AS n FROM (SELECT * FROM nation UNION ALL SELECT * FROM nation WHERE n_nationkey % 2 = 0) GROUP BY n_name")
def concat_files(spark, d):
    path = work_folder(spark, "files")
    n = table(spark, d, "nation")
    n.write.parquet(f"{path}/a")
    n.where("n_nationkey % 2 = 0").write.parquet(f"{path}/b")
    return sql.parquet(spark, f"{path}/*").groupBy("n_name").agg(F.count("*").alias("n"))


@query("SELECT CAST(l_linenumber AS BIGINT) AS day, count(*) AS n FROM lineitem WHERE l_linenumber <> 2 GROUP BY l_linenumber")
def partition_events(spark, d):
    import uuid

    name, at = f"events_{uuid.uuid4().hex}", work_folder(spark, "events")
    line = table(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("string").alias("day"))
    tables.sync_table(spark, name, line, ["day"], location=at)
    line.write.mode("append").partitionBy("day").parquet(at)
    for (day,) in line.select("day").distinct().collect():  # one row a partition
        tables.add_partition(spark, name, {"day": day})
    tables.drop_partition(spark, name, {"day": "2"})
    spark.table(name).groupBy(F.col("day").cast("long").alias("day")).agg(F.count("*").alias("n")).write.parquet(f"{at}_out")
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(f"{at}_out")


@query("""WITH days AS (SELECT DISTINCT l_linenumber AS day FROM lineitem)
SELECT kind, count(*) AS n FROM (SELECT 'put add_partition' AS kind FROM days UNION ALL SELECT 'put insert' FROM days WHERE day > 3 UNION ALL SELECT 'delete drop_partition' FROM days WHERE day % 2 = 0
UNION ALL SELECT 'row' FROM lineitem WHERE l_linenumber % 2 = 1 UNION ALL SELECT 'plain put insert' UNION ALL SELECT 'plain delete none (warning)') GROUP BY kind""")
def partition_event_kinds(spark, d):
    """What puts and deletes of files mean for a partitioned table and for a plain one, and the rows that are left."""
    name, at = f"events_{uuid.uuid4().hex}", work_folder(spark, "events")
    line = table(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("string").alias("day"))
    for table_, parts in ((name, ["day"]), (f"{name}_plain", [])):
        tables.sync_table(spark, table_, line, parts, location=f"{at}/{table_}")
    line.write.partitionBy("day").mode("append").parquet(f"{at}/{name}")
    days = sorted(r.day for r in line.select("day").distinct().collect())  # a partition each
    told = [("", tables.partition_event(spark, name, "put", {"day": x})) for x in days]
    told += [("", tables.partition_event(spark, name, "put", {"day": x})) for x in days if int(x) > 3]
    told += [("", tables.partition_event(spark, name, "delete", {"day": x})) for x in days if int(x) % 2 == 0]
    told += [("plain ", tables.partition_event(spark, f"{name}_plain", x)) for x in ("put", "delete")]
    kinds = spark.createDataFrame([(f"{p}{e['event']} {e['kind']}{' (warning)' if e['warning'] else ''}",) for p, e in told], "kind string")
    kinds.unionByName(spark.table(name).select(F.lit("row").alias("kind"))).groupBy("kind").agg(F.count("*").alias("n")).write.parquet(f"{at}_out")
    for table_ in (name, f"{name}_plain"):
        spark.sql(f"DROP TABLE {table_}")
    return spark.read.parquet(f"{at}_out")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey % 4 IN (0, 1, 2)")
def script_runs(spark, d):
    """A script that makes and fills a table and stops at its first bad statement."""
    import uuid

    name, at = f"script_{uuid.uuid4().hex}", work_folder(spark, "script")
    table(spark, d, "customer").select("c_custkey", "c_name").createOrReplaceTempView("customer_in")
    script = f"CREATE TABLE {name} USING parquet LOCATION '{at}' AS SELECT * FROM customer_in WHERE c_custkey % 2 = 0; INSERT INTO {name} SELECT * FROM customer_in WHERE c_custkey % 4 = 1; SELECT no_such_column FROM {name}; INSERT INTO {name} SELECT * FROM customer_in"
    told = tables.run_script(spark, script)
    assert [route for _, route in told] == ["success", "success", "failure"], told
    rows = tables.resolve(spark, tables.location(spark, name).removeprefix("file:"))
    spark.sql(f"DROP TABLE {name}")
    return rows


@query("SELECT CASE (event_id % 6) WHEN 1 THEN 'failure' WHEN 2 THEN 'failure' WHEN 3 THEN 'retry' WHEN 4 THEN 'failure' ELSE 'retry' END AS route, CASE (event_id % 6) WHEN 3 THEN 'TEMPORAL_INPUT_FAILURE' WHEN 0 THEN 'TEMPORAL_FAILURE' WHEN 5 THEN 'TEMPORAL_FAILURE' ELSE 'INVALID_INPUT' END AS kind, count(*) AS n FROM events GROUP BY 1, 2")
def error_classes(spark, d):
    """Events routed by the class of an error code."""
    kinds = {group: routing.classify_code(group * 10_000 + 1) for group in range(6)}
    look = lambda part: F.create_map(*[F.lit(x) for g, k in kinds.items() for x in (g, part(k))])
    group = F.floor((F.col("event_id") % 6 * 10_000 + 1) / 10_000).cast("int")
    told = table(spark, d, "events").select(look(lambda k: k.route.value)[group].alias("route"), look(lambda k: k.name)[group].alias("kind"))
    return told.groupBy("route", "kind").agg(F.count("*").alias("n"))


@query(f"SELECT 'continued' AS how, count(*) FILTER (e IS NULL) AS n FROM {_CHECKED} UNION ALL SELECT 'rolled back', 0 UNION ALL SELECT 'whole', count(*) FROM {_CHECKED} WHERE e IS NULL UNION ALL SELECT 'stopped', count(*) FROM events WHERE false")
def failure_policies(spark, d):
    """Bad rows routed, a publication undone by them, one without any, and a load that stops at the first."""
    path, rows = work_folder(spark, "policies"), _checked(spark, d)
    good = rows.where("_error IS NULL")
    publish = lambda name: lambda df: tables.publish(df, f"{path}/{name}")
    assert not routing.all_or_nothing(rows, publish("bad")) and routing.all_or_nothing(good, publish("good"))
    try:
        stopped = routing.first_error_stops(rows).count()
    except PySparkException as error:  # the row's own error, and no other
        if error.getCondition() != "USER_RAISED_EXCEPTION" or not any(x in str(error) for x in ("connection timeout", "value too small")):
            raise
        stopped = 0
    count = lambda df, how: df.agg(F.lit(how).alias("how"), F.count("*").alias("n"))
    undone = 0 if not tables.exists(spark, f"{path}/bad") else 1
    return count(good, "continued").unionByName(count(spark.range(undone), "rolled back")).unionByName(count(spark.read.parquet(f"{path}/good"), "whole")).unionByName(count(spark.range(stopped), "stopped"))


@query(_LOCKOUT + "SELECT CASE user_id % 10 WHEN 0 THEN 'unknown' WHEN 1 THEN 'disabled' ELSE outcome END AS outcome, count(*) AS n FROM s GROUP BY 1")
def lockout_users(spark, d):
    """Attempts of users that aren't known or not enabled are refused without counting."""
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    users = e.select("user_id").distinct().where("user_id % 10 <> 0").withColumn("enabled", F.col("user_id") % 10 != 1)
    told = alerts.lockout(e, "user_id", "ts", F.col("event_type") != "error", "event_id", most=2, lock_s=86400, users=users)
    return told.groupBy("outcome").agg(F.count("*").alias("n"))


@query("SELECT n_nationkey, n_name FROM nation")
def catalog_table(spark, d):
    """A table found again by its namespace and name."""
    import uuid

    name, at = f"catalog_{uuid.uuid4().hex}", work_folder(spark, "catalog")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    tables.sync_table(spark, name, n, location=at, stored_as="ORC", external=True)
    n.write.mode("append").orc(at)
    spark.catalog.refreshTable(name)
    tables.resolve(spark, f"default.{name}").write.parquet(f"{at}_read")
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(f"{at}_read")
