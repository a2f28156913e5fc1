import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions import coerce, text, types


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first().x


def test_booleans_are_strict(spark):
    assert [one(spark, coerce.to_boolean(F.col("v")), v=v) for v in ("TRUE", "false", "1", "yes", None)] == [True, False, None, None, None]
    assert one(spark, coerce.to_boolean(F.col("v"), lenient=True), v="yes") is False


def test_decimals(spark):
    assert one(spark, coerce.decimal_rounded(F.col("v"), 9, 2), v="1.005") == Decimal("1.01")
    assert one(spark, coerce.decimal_rounded(F.col("v"), 9, 2), v="-1.005") == Decimal("-1.01")
    assert one(spark, coerce.decimal_exact(F.col("v"), 9, 2), v="1.5") == Decimal("1.50")
    assert one(spark, coerce.decimal_exact(F.col("v"), 9, 2), v="1.005") is None
    assert one(spark, coerce.decimal_exact(F.col("v"), 3, 2), v="123.4") is None


@pytest.mark.parametrize(("value", "pattern", "hours", "expected"), [("20240102030405", "yyyyMMddHHmmss", 0, (2024, 1, 2, 3, 4, 5)), ("20240102030405", "yyyyMMddHHmmss", 9, (2024, 1, 2, 12, 4, 5)), ("2024/01/02 03:04:05", "yyyy/MM/dd HH:mm:ss", 9, (2024, 1, 2, 12, 4, 5)), (" 1704164645000 ", "yyyy/MM/dd", 0, (2024, 1, 2, 3, 4, 5)), ("2024-01-02 03:04:05", None, 0, (2024, 1, 2, 3, 4, 5)), ("soon", None, 0, None), ("", None, 0, None)])
def test_timestamps(spark, value, pattern, hours, expected):
    got = one(spark, F.date_format(coerce.add_hours(coerce.to_timestamp(F.col("v"), pattern), hours), "yyyy-MM-dd HH:mm:ss"), v=value)
    assert got == (dt.datetime(*expected).strftime("%Y-%m-%d %H:%M:%S") if expected else None)


def test_pattern_options():
    options = {"column.all.pattern": "a", "column.x.pattern": "b"}
    assert coerce.pattern_for("x", options) == "a"
    assert coerce.pattern_for("x", {"column.x.pattern": "b"}) == "b"
    assert coerce.pattern_for("y", {"column.x.pattern": "b"}) == coerce.DEFAULT_PATTERN
    assert coerce.patterns_of_formats([{"column-name": "x", "type": "DATE"}]) == {"column.x.pattern": "yyyy-MM-dd"}


def test_binary_forms(spark):
    id_ = "00112233-4455-6677-8899-aabbccddeeff"
    assert bytes(one(spark, coerce.uuid_bytes(F.col("v")), v=id_)) == bytes.fromhex(id_.replace("-", ""))
    assert one(spark, coerce.uuid_text(coerce.uuid_bytes(F.col("v"))), v=id_) == id_
    assert bytes(one(spark, coerce.to_binary(F.col("v"), "base64"), v="aGk=")) == b"hi"
    assert one(spark, coerce.fixed_length(coerce.to_binary(F.col("v")), 3), v="hi") is None
    assert one(spark, coerce.one_of(F.col("v"), ["a", "b"]), v="c") is None


def test_texts_of_values(spark):
    assert one(spark, coerce.to_text(F.array(F.lit(1), F.lit(2)), "array<int>"), v=0) == "[1, 2]"
    assert one(spark, coerce.to_text(F.lit(dt.date(1970, 1, 2)), "date"), v=0) == "86400000"
    assert one(spark, coerce.to_text(F.lit(dt.date(1970, 1, 2)), "date", "yyyy/MM/dd"), v=0) == "1970/01/02"


def test_lake_rules(spark):
    assert one(spark, coerce.lake_date(F.lit(1)), v=0) == dt.date(1970, 1, 2)
    assert one(spark, F.unix_millis(coerce.lake_timestamp(F.lit(1500))), v=0) == 1500
    for value in ("2024-01-02T03:04:05Z", "2024-01-02T03:04:05"):
        assert one(spark, F.unix_seconds(coerce.lake_timestamp_text(F.col("v"))), v=value) == 1704164645


def test_wider_types():
    assert types.wider(T.ByteType(), T.LongType()) == T.LongType()
    assert types.wider(T.LongType(), T.FloatType()) == T.FloatType()
    assert types.wider(T.DecimalType(9, 4), T.DecimalType(12, 2)) == T.DecimalType(12, 4)
    assert types.wider(T.DoubleType(), T.DecimalType(12, 2)) == T.DecimalType(12, 2)
    assert types.wider(T.BooleanType(), T.DateType()) is None
    assert types.wider(T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType())) == T.ArrayType(T.LongType())


def test_schema_merge_order_null_alias_default():
    a = T.StructType([T.StructField("id", T.IntegerType(), False), T.StructField("x", T.StringType(), False, {"aliases": ["y"], "default": "d"})])
    b = T.StructType([T.StructField("new", T.DateType()), T.StructField("id", T.LongType(), False), T.StructField("x", T.IntegerType(), True, {"aliases": ["z"], "default": "e"})])
    m = types.merged(a, b)
    assert m.names == ["id", "x", "new"]
    assert m["id"].dataType == T.LongType() and not m["id"].nullable
    assert m["x"].dataType == T.StringType() and m["x"].nullable and m["x"].metadata == {"aliases": ["y", "z"], "default": "d"}


def test_union_branch(spark):
    kinds = ["int", "boolean", "string"]
    got = [one(spark, coerce.branch(F.col("v"), kinds), v=v) for v in ("7", "True", "x", "7.5")]
    assert [tuple(x) for x in got] == [("int", "7"), ("boolean", "true"), ("string", "x"), ("string", "7.5")]


def test_text_rules(spark):
    assert text.statements(r"a; b\;c ;; d") == ["a", "b;c", "d"]
    assert text.arguments('a "b c" d\te"f"') == ["a", "b c", "d", "ef"]
    assert (text.identifier("1a b"), text.table_identifier("a.b c"), text.column_label("a.b.c")) == ("_1a_b", "a_b_c", "c")
    assert one(spark, text.path_partitions(F.col("v")), v="/t/a=1/b=x y/f") == {"a": "1", "b": "x y"}
    assert one(spark, text.threshold(F.col("v"), F.lit(200.0)), v="80%") == 160
    assert one(spark, text.threshold(F.col("v"), F.lit(0.0)), v="10 GB") == 10 * 2**30
    assert one(spark, text.quoted(F.col("v")), v='a"b') == '"a""b"'
    assert one(spark, text.quoted(F.col("v"), "never"), v='a"b') == 'a"b'


def test_coerce_rows_names_fields(spark):
    df = spark.createDataFrame([("1", "true", None), ("x", "1", "y")], "a string, b string, c string")
    good, bad = coerce.coerce_rows(df, {"a": "int", "b": "boolean", "c": "date"}).collect()
    assert tuple(good) == (1, True, None, None)
    assert bad._error == "a, b, c"


def test_infer_types(spark):
    df = spark.createDataFrame([("1", "1.5", "x", "", "true"), (" 300 ", "2", "1", "", "false")], "a string, b string, c string, d string, e string")
    assert {r.column_name: r.type_name for r in types.infer_columns(df).collect()} == {"a": "smallint", "b": "float", "c": "string", "d": "boolean", "e": "boolean"}


def test_ddl():
    schema = T.StructType([T.StructField("Id", T.LongType()), T.StructField("m", T.MapType(T.StringType(), T.IntegerType()))])
    assert types.hive_ddl(schema, "db.t") == "CREATE TABLE IF NOT EXISTS db_t (`id` BIGINT, `m` MAP<STRING,INT>) STORED AS ORC"


def test_texts_that_begin_like_no_number_are_not_cast(spark):
    """A failing cast costs an exception; what is compatible stays the same."""
    from pyspark.sql import functions as F

    from tidewright.functions import types

    texts = [None, "", "x", "large ring", "12", "+7", "-3.5", ".5", "1e3", "NaN", "inf", "-Infinity", "Infinity", "\t4", "\x0b5\x01", "0x1p3", "1d", "2024-01-02", "-2024-01-02", "+2024-01-02", "2024", "T12:30", "12:30:01", "T1:2", "2024-01-02T03:04:05Z", "now", "epoch", "today", "t", "yes", "\u00a07", "\u0661", "128", "99999999999"]
    df = spark.createDataFrame([(x,) for x in texts], "v string")
    kinds = [k for k in types.LATTICE if k not in ("boolean", "string")]
    own = df.select("v", *[types.compatible(F.col("v"), k).alias(k) for k in kinds]).collect()
    plain = df.select("v", *[(F.col("v").isNull() | F.col("v").try_cast(k).isNotNull()).alias(k) for k in kinds]).collect()
    assert own == plain
    assert all("rlike" in str(types.compatible(F.col("v"), k)).lower() for k in kinds)
