"""Queries of sources, alignment and coercion."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions import coerce, text, types
from tidewright.operators import align, changes, fragments, lineage
from tidewright.plans.registry import query, table, work_folder
from tidewright.sinks import remote
from tidewright.sources import changes as feeds
from tidewright.sources import delimited, sql


@query("""SELECT doc_id, lang, md5(text || ' "q" ^| @@' || chr(10) || '"') AS text_md5 FROM documents""")
def scan_delimited_roundtrip(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", F.concat("text", F.lit(' "q" ^| @@\n"')).alias("text"))
    path = work_folder(spark, "delimited")
    delimited.write(docs, path, header=True)
    rows = delimited.scan(spark, path, ["doc_id", "lang", "text"], charset="UTF-8", header=True, expected_cols=3)
    return rows.select(F.col("doc_id").cast("long"), "lang", F.md5("text").alias("text_md5"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS k, o_orderstatus AS status FROM orders")
def scan_delimited_blocks(spark, d):
    path = work_folder(spark, "delimited")
    delimited.write(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), path, quote_mode="never")
    return delimited.scan_unquoted(spark, path, ["k", "status"])


@query("SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total, min(o_orderkey) AS low FROM orders GROUP BY o_orderstatus")
def csv_typed_scan(spark, d):
    path = work_folder(spark, "csv")
    table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", F.concat(F.lit('a,"b"\n'), "o_orderpriority").alias("note")).write.csv(path, header=True, escape='"')
    rows = delimited.read_csv(spark, path, "o_orderkey long, o_orderstatus string, o_totalprice double, note string", multi_line=True, escape='"')
    return rows.groupBy("o_orderstatus").agg(F.count("note").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.min("o_orderkey").alias("low"))


def _lines(spark, d):
    e = table(spark, d, "events")
    more = F.when(F.col("event_id") % 7 == 0, ',"x, ""y"""').otherwise("")
    return e.select(F.concat(F.col("event_id").cast("string"), F.lit(","), "event_type", more).alias("value"))


@query("SELECT event_type, count(*) FILTER (event_id % 7 <> 0) AS good, count(*) FILTER (event_id % 7 = 0) AS bad FROM events GROUP BY event_type")
def csv_field_count_guard(spark, d):
    rows = delimited.width_guard(delimited.csv_fields(_lines(spark, d)), 2)
    return rows.groupBy(F.get("fields", 1).alias("event_type")).agg(F.count_if(F.col("_error").isNull()).alias("good"), F.count_if(F.col("_error").isNotNull()).alias("bad"))


@query("""SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CASE WHEN event_id % 7 = 0 THEN 'x, "y"' END AS unknown_field_index_2 FROM events""")
def csv_extra_columns(spark, d):
    rows = delimited.named_fields(delimited.csv_fields(_lines(spark, d)).drop("value"), ["event_id", "event_type"])
    return rows.select("event_id", "event_type", F.col("unknown_fields")["unknown_field_index_2"].alias("unknown_field_index_2"))


@query(r"""WITH v AS (SELECT 'p_size' AS c, CAST(p_size AS VARCHAR) AS x FROM part UNION ALL SELECT 'p_name', p_name FROM part UNION ALL SELECT 'p_retailprice', CAST(p_retailprice AS VARCHAR) FROM part UNION ALL SELECT 'p_partkey', CAST(p_partkey AS VARCHAR) FROM part)
SELECT c AS column_name, CASE WHEN bool_and(regexp_full_match(x, '-?\d+')) THEN CASE WHEN max(TRY_CAST(x AS DOUBLE)) <= 127 THEN 'tinyint' WHEN max(TRY_CAST(x AS DOUBLE)) <= 32767 THEN 'smallint' ELSE 'int' END WHEN bool_and(TRY_CAST(x AS FLOAT) IS NOT NULL) THEN 'float' ELSE 'string' END AS type_name FROM v GROUP BY c""")
def infer_types(spark, d):
    return types.infer_columns(table(spark, d, "part").select("p_size", "p_name", "p_retailprice", "p_partkey"))


@query("SELECT 'OBJECT<k: BIGINT>' AS type_name FROM (SELECT count(*) AS n FROM events WHERE json_type(props, '$.k') = 'UBIGINT' OR json_type(props, '$.k') = 'BIGINT') WHERE n > 0")
def infer_json_type(spark, d):
    return types.infer_json(table(spark, d, "events"), "props")


@query("""WITH k AS (SELECT user_id % 25 AS g, event_id % 11 = 0 AND user_id % 25 < 12 AS text, event_id % 13 = 0 AND user_id % 25 BETWEEN 6 AND 18 AS flag FROM events),
t AS (SELECT g, count(*) FILTER (text) AS texts, count(*) FILTER (flag AND NOT text) AS flags, count(*) FILTER (NOT text AND NOT flag) AS numbers FROM k GROUP BY g)
SELECT g, CASE WHEN (texts > 0)::INT + (flags > 0)::INT + (numbers > 0)::INT > 1 THEN 'OBJECT<k: VARIANT>' WHEN texts > 0 THEN 'OBJECT<k: STRING>' WHEN flags > 0 THEN 'OBJECT<k: BOOLEAN>' ELSE 'OBJECT<k: BIGINT>' END AS type_name FROM t""")
def infer_json_by_group(spark, d):
    """Types that differ by what a group's rows hold: numbers alone, or texts and truth values among them."""
    g = F.col("user_id") % 25
    e = table(spark, d, "events").select(g.alias("g"), F.when((F.col("event_id") % 11 == 0) & (g < 12), '{"k": "x"}').when((F.col("event_id") % 13 == 0) & g.between(6, 18), '{"k": true}').otherwise(F.concat(F.lit('{"k": '), F.col("event_id").cast("string"), F.lit("}"))).alias("j"))
    return types.infer_json(e, "j", ["g"])


@query("SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_totalprice > 1000.5 AND o_orderdate >= TIMESTAMP '1995-01-01' AND o_custkey <> 7 GROUP BY o_orderstatus")
def sql_params(spark, d):
    args = sql.parameters(spark, {"sql.args.1.type": "8", "sql.args.1.value": "1000.5", "sql.args.2.type": "93", "sql.args.2.value": "788918400000", "sql.args.3.type": "-5", "sql.args.3.value": "7"})
    return sql.sql_source(spark, "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders_in WHERE o_totalprice > ? AND o_orderdate >= ? AND o_custkey <> ? GROUP BY o_orderstatus", args, views={"orders_in": table(spark, d, "orders")})


@query("""WITH r AS (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS f FROM orders)
SELECT CAST(f AS BIGINT) AS fragment_index, CAST(max(f) OVER () + 1 AS BIGINT) AS fragment_count, n, low, high FROM (SELECT f, count(*) AS n, min(o_orderkey) AS low, max(o_orderkey) AS high FROM r GROUP BY f)""")
def fragment_results(spark, d):
    rows = fragments.fragments(table(spark, d, "orders").select("o_orderkey"), 1000, ["o_orderkey"], identifier="f")
    return rows.groupBy("fragment_index", "fragment_count").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high"))


@query("""WITH r AS (SELECT *, row_number() OVER (ORDER BY source NULLS FIRST, doc_id) - 1 AS i, count(*) OVER () AS n FROM documents)
SELECT doc_id, source, lang, text, CAST(i // 700 AS BIGINT) AS fragment_index, CAST((n + 699) // 700 AS BIGINT) AS fragment_count FROM r""")
def fragment_wide_rows(spark, d):
    """Whole texts in fragments, ordered by a column with few values and a tie-breaker."""
    rows = fragments.fragments(table(spark, d, "documents").select("doc_id", "source", "lang", "text"), 700, ["source", "doc_id"])
    return rows.select("doc_id", "source", "lang", "text", "fragment_index", "fragment_count")


@query("SELECT l_suppkey < 5 AS few, CAST(count(*) AS BIGINT) AS n, CAST(sum(l_orderkey) AS BIGINT) AS orders FROM lineitem GROUP BY ALL")
def balanced_ranges(spark, d):
    """Every row once, through ranges of a key that is skewed, however they are cut."""
    rows = table(spark, d, "lineitem").withColumn("k", F.when(F.col("l_suppkey") >= 5, F.col("l_suppkey")).otherwise(3))
    ranges = fragments.balanced_predicates(rows, "k", 12, then="l_orderkey")
    each = [rows.where(x).select(F.lit(i).alias("range"), "k", "l_orderkey") for i, x in enumerate(ranges)]
    return functools.reduce(DataFrame.unionAll, each).groupBy((F.col("k") < 5).alias("few")).agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("orders"))


@query("SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem WHERE l_orderkey >= 100 AND l_orderkey < 5100 GROUP BY l_returnflag")
def range_page(spark, d):
    return fragments.range_page(table(spark, d, "lineitem"), "l_orderkey", 100, 5000).groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 100")
def page_offset(spark, d):
    return fragments.page(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.col("o_orderkey")], 50, 100)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def jdbc_roundtrip(spark, d):
    """By cursors and batches where tasks reach the embedded database, else by the server's import and export of files."""
    url, driver = remote.embedded()
    direct = remote.reachable(spark)
    rows = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    (sql.write_jdbc if direct else remote.load_files)(rows, url, "customers", properties=driver, mode="overwrite")
    low, high = rows.agg(F.min("c_custkey"), F.max("c_custkey")).first()
    return (sql.jdbc if direct else remote.unload_files)(spark, url, "customers", column='"c_custkey"', bounds=(low or 0, (high or 0) + 1), parts=4, properties=driver)


@query("""WITH s AS (SELECT o_orderkey, 'db' || o_custkey % 5 || '.t' || o_orderkey % 3 AS dst, 'orders' || o_orderkey % 7 AS a, 'raw.customer' || o_custkey % 3 AS b FROM orders)
SELECT src, dst, count(*) AS n FROM (SELECT a AS src, dst FROM s UNION ALL SELECT b, dst FROM s) GROUP BY src, dst""")
def query_lineage(spark, d):
    o = table(spark, d, "orders")
    name = lambda prefix, c, m: F.concat(F.lit(prefix), (F.col(c) % m).cast("string"))
    statement = F.concat(F.lit("-- from nowhere\nINSERT INTO "), name("db", "o_custkey", 5), name(".T", "o_orderkey", 3), F.lit(" WITH c AS (SELECT 'from x' FROM "), name("orders", "o_orderkey", 7), F.lit(") SELECT * FROM c JOIN `raw`."), name("customer", "o_custkey", 3), F.lit(" /* join y */"))
    return lineage.edges(o.select("o_orderkey", statement.alias("statement")), "o_orderkey").groupBy("src", "dst").agg(F.count("*").alias("n"))


def _events(spark, d):
    """Change envelopes of orders; every 11th is a tombstone."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    row = F.struct("o_orderkey", "o_orderstatus", "o_totalprice")
    k = F.col("o_orderkey")
    op = F.element_at(F.array(*[F.lit(x) for x in "cudr"]), (k % 4 + 1).cast("int"))
    marked = o.select("*", F.when(op != "d", row).alias("after"), F.when(op.isin("u", "d"), row).alias("before"), (k * 10).alias("seq"), op.alias("op"))
    out = feeds.envelopes(marked, "after", "before", F.col("op"), ["o_orderkey"], "shop.orders", "seq", "postgres")
    number = F.get_json_object("cdc_key", "$.o_orderkey").cast("long")
    out = out.withColumn("cdc_destination", F.when(number % 5 == 0, "shop.other").otherwise(F.col("cdc_destination")))
    return out.withColumn("value", F.when(number % 11 != 0, F.col("value")))


@query("""SELECT CASE o_orderkey % 4 WHEN 0 THEN 'INSERT' WHEN 1 THEN 'UPDATE' WHEN 2 THEN 'DELETE' ELSE 'UPSERT' END AS _op, count(*) AS n, round(sum(o_totalprice), 2) AS total, CAST(max(o_orderkey) * 10 AS BIGINT) AS last_seq
FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 5 <> 0 GROUP BY 1""")
def cdc_parse_route(spark, d):
    rows = feeds.parsed(_events(spark, d), "o_orderkey bigint, o_orderstatus string, o_totalprice double", ["shop\\.ord.*", "crm\\..*"])
    return rows.groupBy("_op").agg(F.count("*").alias("n"), F.round(F.sum("row.o_totalprice"), 2).alias("total"), F.max("_seq").alias("last_seq"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 1 THEN 'Z' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 3 <> 0""")
def snapshot_plus_changes(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    k = F.col("o_orderkey")
    feed = o.where(k % 3 != 2).select("o_orderkey", F.lit("Z").alias("o_orderstatus"), F.when(k % 3 == 0, "DELETE").otherwise("UPDATE").alias("_op"), k.alias("_seq"))
    both = feeds.with_snapshot(o, feed)
    empty = o.limit(0)
    return changes.replay(empty, both, ["o_orderkey"], "_seq")[0]


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def normalised_names(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("CCUSTKEY"), F.col("c_acctbal").alias("C_AcctBal"), F.col("c_name").alias("cName"), "c_mktsegment")
    target = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()), T.StructField("c_acctbal", T.DoubleType())])
    return align.aligned(c, target)


@query("SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS quantity, l_returnflag AS flag, CAST(l_linenumber AS BIGINT) + 1 AS first_tag FROM lineitem")
def case_insensitive_nested(spark, d):
    line = table(spark, d, "lineitem")
    given = line.select("l_orderkey", "l_linenumber", F.struct(F.struct(F.col("l_returnflag").alias("FLAG")).alias("Inner"), F.col("l_quantity").alias("QUANTITY"), F.array(F.struct((F.col("l_linenumber") + 1).alias("Tag"))).alias("tags")).alias("Body"))
    target = T.StructType([T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()), T.StructField("body", T._parse_datatype_string("quantity bigint, inner struct<flag:string,absent:int>, TAGS array<struct<tag:bigint>>"))])
    return align.aligned(given, target).select("l_orderkey", "l_linenumber", "body.quantity", F.col("body.inner.flag").alias("flag"), F.get("body.TAGS", 0)["tag"].alias("first_tag"))


@query("SELECT s_suppkey, s_name, CAST(NULL AS VARCHAR) AS comment, 'unknown' AS region FROM supplier")
def unmatched_columns(spark, d):
    target = T.StructType([T.StructField("s_suppkey", T.LongType(), False), T.StructField("s_name", T.StringType()), T.StructField("comment", T.StringType()), T.StructField("region", T.StringType(), False, {"default": "unknown"})])
    return align.aligned(table(spark, d, "supplier"), target, unmatched_column="ignore")


@query("SELECT s_suppkey AS supplier_id, s_name FROM supplier")
def alias_lookup(spark, d):
    target = T.StructType([T.StructField("supplier_id", T.LongType(), True, {"aliases": ["sid", "s_suppkey"]}), T.StructField("s_name", T.StringType())])
    return align.aligned(table(spark, d, "supplier"), target)


@query("SELECT l_returnflag AS flag, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_returnflag")
def nested_path_rows(spark, d):
    line = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_returnflag").alias("flag"), "l_quantity")).alias("lines"))
    rows = align.rows_at(line.select(F.struct("lines").alias("payload")), "payload.lines")
    return rows.groupBy("flag").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


@query("""SELECT CASE o_orderstatus WHEN 'O' THEN 'INSERT' WHEN 'F' THEN 'UPSERT' END AS op, count(*) AS n, count(*) FILTER (o_orderstatus NOT IN ('O', 'F')) AS errors FROM orders GROUP BY 1""")
def statement_types(spark, d):
    o = table(spark, d, "orders").select(F.struct(F.when(F.col("o_orderstatus") == "O", "insert").when(F.col("o_orderstatus") == "F", "Upsert").otherwise("truncate").alias("type")).alias("meta"))
    return align.with_operation(o, "meta.type").groupBy(F.col("_op").alias("op")).agg(F.count("*").alias("n"), F.count("_error").alias("errors"))


@query("""SELECT k % 3 AS kinds, count(*) AS n, count(*) FILTER (k % 3 = 1) AS errors FROM (SELECT o_orderkey AS k FROM orders) GROUP BY 1""")
def single_distinct_value(spark, d):
    k = F.col("o_orderkey")
    o = table(spark, d, "orders").select((k % 3).alias("kinds"), F.when(k % 3 == 1, F.array(F.lit("insert"), F.lit("delete"))).otherwise(F.array(F.lit("insert"), F.lit("insert"))).alias("ops"))
    return align.with_operation(o, "ops").groupBy("kinds").agg(F.count("*").alias("n"), F.count("_error").alias("errors"))


@query("SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'NONE' ELSE c_mktsegment END AS segment FROM customer")
def default_fill(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    return align.filled(c, {"segment": "NONE"})


@query("SELECT event_id, 'batch-1' AS load, 2024 AS year FROM events")
def static_partitions(spark, d):
    return align.with_static_partitions(table(spark, d, "events").select("event_id", F.lit("old").alias("load")), {"load": "batch-1", "year": 2024})


@query("""SELECT coalesce(e, 'ok') AS outcome, count(*) AS n FROM (SELECT CASE WHEN c_custkey % 10 = 0 AND c_custkey % 4 = 0 THEN 'null key id, null name' WHEN c_custkey % 10 = 0 THEN 'null key id' WHEN c_custkey % 4 = 0 THEN 'null name' END AS e FROM customer) GROUP BY 1""")
def null_policy(spark, d):
    k = F.col("c_custkey")
    c = table(spark, d, "customer").select(F.when(k % 10 != 0, k).alias("id"), F.when(k % 4 != 0, F.col("c_name")).alias("name"))
    return align.null_checked(c, ["id"], ["name"]).groupBy(F.coalesce("_error", F.lit("ok")).alias("outcome")).agg(F.count("*").alias("n"))


@query("""SELECT coalesce(e, 'ok') AS outcome, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids, count(*) FILTER (flag) AS flags FROM (
SELECT CASE WHEN k % 9 = 0 THEN NULL ELSE k END AS id, CASE k % 4 WHEN 0 THEN true WHEN 1 THEN false END AS flag,
  CASE WHEN k % 9 = 0 AND k % 4 = 2 THEN 'id, flag' WHEN k % 9 = 0 THEN 'id' WHEN k % 4 = 2 THEN 'flag' END AS e FROM (SELECT event_id AS k FROM events)) GROUP BY 1""")
def coerce_matrix(spark, d):
    k = F.col("event_id")
    e = table(spark, d, "events").select(F.when(k % 9 == 0, "n/a").otherwise(k.cast("string")).alias("id"), F.when(k % 4 == 0, "TRUE").when(k % 4 == 1, "false").when(k % 4 == 2, "1").alias("flag"), F.date_format("ts", coerce.DEFAULT_PATTERN).alias("at"))
    rows = coerce.coerce_rows(e, {"id": "bigint", "flag": "boolean", "at": "timestamp"})
    return rows.groupBy(F.coalesce("_error", F.lit("ok")).alias("outcome")).agg(F.count("*").alias("n"), F.sum("id").alias("ids"), F.count_if("flag").alias("flags"))


@query("SELECT o_orderkey AS k, o_totalprice AS amount, CAST(NULL AS VARCHAR) AS name FROM orders UNION ALL SELECT c_custkey, NULL, c_name FROM customer")
def schema_merge(spark, d):
    a = table(spark, d, "orders").select(F.col("o_orderkey").cast("int").alias("k"), F.col("o_totalprice").alias("amount"))
    b = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    return types.union_by_merged_schema(a, b)


@query("""SELECT CASE k % 4 WHEN 0 THEN 'int' WHEN 1 THEN 'double' WHEN 2 THEN 'boolean' ELSE 'string' END AS kind, count(*) AS n, count(DISTINCT CASE k % 4 WHEN 0 THEN CAST(k AS VARCHAR) WHEN 1 THEN CAST(k AS VARCHAR) || '.5' WHEN 2 THEN 'true' ELSE 'v' || k END) AS n_values FROM (SELECT o_orderkey AS k FROM orders) GROUP BY 1""")
def union_branch(spark, d):
    k = F.col("o_orderkey").cast("string")
    v = F.when(F.col("o_orderkey") % 4 == 0, k).when(F.col("o_orderkey") % 4 == 1, F.concat(k, F.lit(".5"))).when(F.col("o_orderkey") % 4 == 2, "True").otherwise(F.concat(F.lit("v"), k))
    rows = table(spark, d, "orders").select(coerce.branch(v, ["int", "double", "boolean", "string"]).alias("b"))
    return rows.groupBy("b.kind").agg(F.count("*").alias("n"), F.count_distinct("b.value").alias("n_values"))


@query("SELECT count(*) FILTER (l_orderkey * 10000 <= 16777216) AS in_float, count(*) FILTER (l_orderkey * 1000000000000 <= 9007199254740992) AS in_double, count(*) AS n FROM lineitem")
def numeric_fit(spark, d):
    k = F.col("l_orderkey")
    return table(spark, d, "lineitem").agg(F.count_if(types.fits_float(k * 10000)).alias("in_float"), F.count_if(types.fits_double(k * 1000000000000)).alias("in_double"), F.count_if(types.in_float_range(F.col("l_quantity"))).alias("n"))


@query("""SELECT l_orderkey, l_linenumber, CAST(CAST(round(CAST(l_tax AS DECIMAL(18,4)) * CAST(l_discount AS DECIMAL(18,4)), 3) AS DECIMAL(9,3)) AS VARCHAR) AS rounded, CAST(CASE WHEN CAST(l_tax AS DECIMAL(18,4)) * CAST(l_discount AS DECIMAL(18,4)) = round(CAST(l_tax AS DECIMAL(18,4)) * CAST(l_discount AS DECIMAL(18,4)), 3) THEN CAST(CAST(l_tax AS DECIMAL(18,4)) * CAST(l_discount AS DECIMAL(18,4)) AS DECIMAL(9,3)) END AS VARCHAR) AS exact FROM lineitem""")
def decimal_rescale(spark, d):
    v = F.col("l_tax").cast("decimal(18,4)") * F.col("l_discount").cast("decimal(18,4)")
    line = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", v.alias("v"))
    return line.select("l_orderkey", "l_linenumber", coerce.decimal_rounded(F.col("v"), 9, 3).cast("string").alias("rounded"), coerce.decimal_exact(F.col("v"), 9, 3).cast("string").alias("exact"))


@query("SELECT event_id, strftime(CASE WHEN event_id % 3 = 2 THEN NULL WHEN event_id % 2 = 0 THEN date_trunc('second', ts) ELSE date_trunc('millisecond', ts) END, '%Y-%m-%d %H:%M:%S') AS at FROM events")
def timestamp_patterns(spark, d):
    k, pattern = F.col("event_id"), "yyyy/MM/dd HH:mm:ss"
    e = table(spark, d, "events").select("event_id", F.when(k % 3 == 2, "soon").when(k % 2 == 0, F.date_format("ts", pattern)).otherwise(F.concat(F.lit(" "), F.unix_millis(F.col("ts").cast("timestamp")).cast("string"))).alias("t"))
    options = coerce.patterns_of_formats([{"column-name": "t", "timestamp-pattern": pattern, "type": "TIMESTAMP"}])
    return e.select("event_id", F.date_format(coerce.to_timestamp(F.col("t"), coerce.pattern_for("t", options)), "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("SELECT event_id, epoch_us(ts) + 9 * 3600000000 AS later FROM events")
def add_hours(spark, d):
    return table(spark, d, "events").select("event_id", F.unix_micros(coerce.add_hours(F.col("ts").cast("timestamp"), 9)).alias("later"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS by_pattern, strftime(o_orderdate, '%Y-%m-%d') AS by_millis, strftime(o_orderdate, '%Y-%m-%d') AS by_day, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.000000Z' AS micros FROM orders""")
def date_rules(spark, d):
    o = table(spark, d, "orders").withColumn("at", F.date_trunc("second", F.col("o_orderdate").cast("timestamp")))
    day = F.datediff(F.col("at").cast("date"), F.lit("1970-01-01").cast("date"))
    text_of = lambda c: F.date_format(c, "yyyy-MM-dd")
    return o.select("o_orderkey", text_of(coerce.to_date(F.date_format("at", "yyyyMMdd"), "yyyyMMdd")).alias("by_pattern"), text_of(coerce.to_date(F.unix_millis("at").cast("string"))).alias("by_millis"), text_of(coerce.lake_date(day)).alias("by_day"), coerce.micros_text(coerce.lake_timestamp(F.unix_millis("at"))).alias("micros"))


@query("SELECT c_custkey, substr(m, 1, 8) || '-' || substr(m, 9, 4) || '-' || substr(m, 13, 4) || '-' || substr(m, 17, 4) || '-' || substr(m, 21) AS id, CAST(16 AS INTEGER) AS size, c_name AS back FROM (SELECT *, md5(c_name) AS m FROM customer)")
def uuid_binary(spark, d):
    raw = coerce.uuid_bytes(F.md5("c_name"))
    return table(spark, d, "customer").select("c_custkey", coerce.uuid_text(coerce.fixed_length(raw, 16)).alias("id"), F.octet_length(raw).alias("size"), F.decode(coerce.to_binary(F.base64(coerce.to_binary(F.hex("c_name"), "hex")), "base64"), "UTF-8").alias("back"))


@query("""SELECT doc_id, md5('"' || replace(text, '"', '""') || '"') AS always, md5(CASE WHEN contains(text, '"') OR contains(text, ', ') THEN '"' || replace(text, '"', '""') || '"' ELSE text END) AS needed, md5(replace(replace(text, chr(13) || chr(10), ' '), chr(10), ' ')) AS flat FROM documents""")
def quote_fields(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", F.md5(text.quoted(t, "always")).alias("always"), F.md5(text.quoted(t, "as_needed", ", ", "@@\n")).alias("needed"), F.md5(text.flat_lines(t)).alias("flat"))


@query("SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS VARCHAR) AS year, l_returnflag AS flag FROM lineitem")
def path_partitions(spark, d):
    line = table(spark, d, "lineitem")
    path = F.concat(F.lit("/lake/t/year="), F.year("l_shipdate").cast("string"), F.lit("/flag="), "l_returnflag", F.lit("/part-0"))
    return line.select("l_orderkey", "l_linenumber", text.path_partitions(path).alias("p")).select("l_orderkey", "l_linenumber", F.col("p")["year"].alias("year"), F.col("p")["flag"].alias("flag"))


@query("SELECT c_custkey, 3 AS n, 'set a=' || c_custkey AS first, 'x;' || c_mktsegment AS last FROM customer")
def statement_split(spark, d):
    s = F.concat(F.lit("set a="), F.col("c_custkey").cast("string"), F.lit(r"; b ; ; x\;"), "c_mktsegment", F.lit(" ;"))
    return table(spark, d, "customer").select("c_custkey", text.statements_column(s).alias("s")).select("c_custkey", F.size("s").alias("n"), F.get("s", 0).alias("first"), F.element_at("s", -1).alias("last"))


@query("SELECT p_partkey, p_size * 20.0 AS share, p_size * 1048576.0 AS bytes FROM part")
def size_thresholds(spark, d):
    size = F.col("p_size").cast("string")
    return table(spark, d, "part").select("p_partkey", text.threshold(F.concat(size, F.lit("%")), F.lit(2000.0)).alias("share"), text.threshold(F.concat(size, F.lit(" mb")), F.lit(0.0)).alias("bytes"))


@query(r"SELECT p_partkey, CASE WHEN regexp_matches(x, '^[0-9]') THEN '_' || x ELSE x END AS name FROM (SELECT p_partkey, regexp_replace(p_size || p_name, '[^A-Za-z0-9_]', '_', 'g') AS x FROM part)")
def identifiers(spark, d):
    return table(spark, d, "part").select("p_partkey", text.identifier_column(F.concat(F.col("p_size").cast("string"), "p_name")).alias("name"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey AS INTEGER) END AS value, CASE WHEN c_custkey % 2 <> 0 THEN c_name END AS text FROM customer")
def lenient_values(spark, d):
    raw = F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey").cast("string")).otherwise(F.col("c_name"))
    return table(spark, d, "customer").select("c_custkey", coerce.lenient(raw, "int").alias("v")).select("c_custkey", "v.value", "v.text")


@query("SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d %H:%M:%S') AS second, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS milli, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS micro FROM events")
def timestamp_types(spark, d):
    e = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    names = {"day": "DATE", "second": "TIMESTAMP", "milli": "TIMESTAMP_MILLIS", "micro": "TIMESTAMP_MICROS"}
    return e.select("event_id", *[F.date_format("ts", coerce.NAMED_PATTERNS[k]).alias(c) for c, k in names.items()])


@query("SELECT o_orderkey, epoch_ms(CAST(o_orderdate AS TIMESTAMP)) AS same_day, epoch_ms(CAST(o_orderdate AS TIMESTAMP)) - 18000000 AS same_instant, epoch_ms(CAST(o_orderdate AS TIMESTAMP)) AS basic, epoch_ms(CAST(o_orderdate AS TIMESTAMP)) AS ordinal FROM orders")
def iso_times(spark, d):
    """Wall-clock days and instants in UTC, by the named ISO formats."""
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    by = lambda form, name: F.unix_millis(coerce.to_timestamp(F.date_format("day", form), name))
    offset = F.unix_millis(coerce.to_timestamp(F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit("T00:00:00+05:00")), "ISO_OFFSET_DATE_TIME"))
    return o.select("o_orderkey", F.unix_millis(coerce.same_day_in_utc(F.col("day"), "Asia/Tokyo")).alias("same_day"), offset.alias("same_instant"), by("yyyyMMdd", "BASIC_ISO_DATE").alias("basic"), by("yyyy-DDD", "ISO_ORDINAL_DATE").alias("ordinal"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS told, CAST(epoch_ms(CAST(o_orderdate AS TIMESTAMP)) AS VARCHAR) AS millis, '[' || o_orderkey || ', ' || o_custkey || ']' AS both_keys, o_orderpriority AS bytes,
CASE WHEN o_orderstatus IN ('O', 'F') THEN o_orderstatus END AS known, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS trimmed FROM orders""")
def text_forms(spark, d):
    o = table(spark, d, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    raw = o.withColumn("trimmed", F.when(F.col("o_orderkey") % 3 == 0, F.lit('""')).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit('"'), "o_orderpriority", F.lit('"'))).otherwise(F.col("o_orderpriority")))
    return delimited.trimmed_values(raw, ["trimmed"]).select(
        "o_orderkey", coerce.to_text(F.col("day"), "date", "dd/MM/yyyy").alias("told"), coerce.to_text(F.col("day"), "date").alias("millis"), coerce.to_text(F.array("o_orderkey", "o_custkey"), "array<bigint>").alias("both_keys"),
        coerce.to_text(F.encode("o_orderpriority", "UTF-8"), "binary").alias("bytes"), coerce.one_of(F.col("o_orderstatus"), ["O", "F"]).alias("known"), "trimmed",
    )


@query("SELECT o_orderkey, epoch_ms(CAST(o_orderdate AS TIMESTAMP)) AS millis, CASE WHEN epoch_ms(CAST(o_orderdate AS TIMESTAMP)) BETWEEN -2147483648 AND 2147483647 THEN CAST(epoch_ms(CAST(o_orderdate AS TIMESTAMP)) AS VARCHAR) END AS small FROM orders")
def date_numbers(spark, d):
    day = F.col("o_orderdate").cast("date")
    return table(spark, d, "orders").select("o_orderkey", coerce.date_number(day).alias("millis"), coerce.date_number(day, "int").cast("string").alias("small"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS key, CASE c_custkey % 4 WHEN 0 THEN 'can''t coerce r.KEY' WHEN 1 THEN 'can''t coerce r.TAGS[]' WHEN 2 THEN 'can''t coerce r.BY key' END AS error FROM customer""")
def nested_rejects(spark, d):
    """Nested values that can't be coerced are named row by row."""
    key, kind = F.col("c_custkey").cast("string"), F.col("c_custkey") % 4
    tags = F.array(F.when(kind == 1, "x").otherwise(key), F.lit("7"))
    by = F.create_map(F.when(kind == 2, "no number").otherwise(key), F.lit(1))
    rows = table(spark, d, "customer").select("c_custkey", F.struct(F.when(kind == 0, "none").otherwise(key).alias("key"), tags.alias("tags"), by.alias("by")).alias("r"))
    told = align.reshaped_rows(rows, T.StructType.fromDDL("c_custkey BIGINT, r STRUCT<KEY: BIGINT, TAGS: ARRAY<INT>, BY: MAP<INT, INT>>"))
    return told.select("c_custkey", F.col("r.KEY").cast("string").alias("key"), F.col("_error").alias("error"))


@query("""SELECT view_name AS name, 'CREATE EXTERNAL TABLE IF NOT EXISTS ' || view_name || ' (' || string_agg('`' || lower(column_name) || '` ' || CASE data_type WHEN 'VARCHAR' THEN 'STRING' WHEN 'INTEGER' THEN 'INT' ELSE data_type END, ', ' ORDER BY column_index) || ') STORED AS ORC' AS ddl
FROM (SELECT table_name AS view_name, column_name, data_type, column_index FROM duckdb_columns() WHERE table_name IN ('nation', 'region')) GROUP BY view_name""")
def table_ddl(spark, d):
    from tidewright.functions.types import hive_ddl

    return spark.createDataFrame([(n, hive_ddl(table(spark, d, n).schema, n, True)) for n in ("nation", "region")], "name string, ddl string")


@query("SELECT CAST(c_custkey AS VARCHAR) AS k, c_name AS name FROM customer ORDER BY c_custkey OFFSET 25")
def skipped_rows(spark, d):
    """The first rows of a file are left out by their place in it."""
    path = work_folder(spark, "skipped")
    delimited.write(table(spark, d, "customer").select("c_custkey", "c_name").repartition(1).sortWithinPartitions("c_custkey"), path)
    return delimited.scan(spark, path, ["k", "name"], charset="UTF-8", skip_rows=25).select("k", "name")


@query("SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 500 ORDER BY c_custkey LIMIT 40 OFFSET 10")
def dialect_page(spark, d):
    """A page by the text of a dialect that is loaded by its name."""
    from tidewright.plans.dialects import dialect

    text_of = dialect("postgresql").page("customer_in", ["c_custkey", "c_name"], "c_acctbal > 500", limit=40, offset=10, order_by="c_custkey")
    return sql.sql_source(spark, text_of, views={"customer_in": table(spark, d, "customer")})
