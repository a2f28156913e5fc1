import random

import pytest

from tidewright.sources import delimited


def reference(text, col, row, quote='"'):
    """Character by character, from the rules alone."""
    rows, fields, cell, i, inside, begun = [], [], "", 0, False, False
    dirty = False
    while i < len(text):
        if inside:
            if text.startswith(quote * 2, i):
                cell, i = cell + quote, i + 2
            elif text.startswith(quote, i):
                inside, i = False, i + 1
            else:
                cell, i = cell + text[i], i + 1
        elif not begun and text.startswith(quote, i):
            inside, begun, dirty, i = True, True, True, i + 1
        elif text.startswith(col, i):
            fields.append(cell)
            cell, begun, dirty, i = "", False, True, i + len(col)
        elif text.startswith(row, i):
            rows.append([*fields, cell])
            fields, cell, begun, dirty, i = [], "", False, False, i + len(row)
        else:
            cell, begun, dirty, i = cell + text[i], True, True, i + 1
    if dirty:
        rows.append([*fields, cell])
    return rows


def test_parse_agrees_with_rules_on_random_text():
    r = random.Random(42)
    parts = ["^|", "@@\n", '"', '""', "a", "é한", "\n", "^", "|", "@", " x "]
    for _ in range(3000):
        text = "".join(r.choice(parts) for _ in range(r.randrange(14)))
        assert list(delimited.parse(text, "^|", "@@\n")) == reference(text, "^|", "@@\n"), repr(text)


def test_roundtrip_in_cp949_with_skips(spark, tmp_path):
    rows = [(str(i), f"한글 {i}", 'say "x" ^| y\n@@\nz', None) for i in range(40)]
    df = spark.createDataFrame(rows, "id string, name string, memo string, none string").coalesce(1)
    text = "".join("^|".join('"' + (v or "").replace('"', '""') + '"' for v in row) + "@@\n" for row in rows)
    path = tmp_path / "in.txt"
    path.write_bytes(("junk@@\njunk^|two@@\nid^|name^|memo^|none@@\n" + text).encode("CP949"))
    got = delimited.scan(spark, str(path), ["id", "name", "memo", "none"], expected_cols=4, skip_rows=2, header=True).orderBy("row_index").collect()
    assert [tuple(x)[:4] for x in got] == [(a, b, c, "") for a, b, c, _ in rows]
    delimited.write(df, str(tmp_path / "out"), header=True)
    back = delimited.scan(spark, str(tmp_path / "out"), ["id", "name", "memo", "none"], charset="UTF-8", header=True)
    assert sorted(tuple(x)[:4] for x in back.collect()) == sorted((a, b, c, "") for a, b, c, _ in rows)


def test_wrong_width_names_the_row(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1^|2@@\n3@@\n")
    with pytest.raises(Exception, match="row 1 has 1 fields, not 2"):
        delimited.scan(spark, str(tmp_path / "a.txt"), charset="UTF-8", expected_cols=2).collect()


def test_end_before_header(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1^|2@@\n")
    with pytest.raises(Exception, match="ends before its header"):
        delimited.scan(spark, str(tmp_path / "a.txt"), charset="UTF-8", skip_rows=3, header=True).collect()
    assert delimited.scan(spark, str(tmp_path / "a.txt"), charset="UTF-8", skip_rows=3).count() == 0


def test_width_guard_can_fail(spark):
    lines = delimited.csv_fields(spark.createDataFrame([("1,2",), ("",), ("1,2,3",)], "value string"))
    assert [x._error for x in delimited.width_guard(lines, 2).collect()] == [None, None, "3 fields, not 2"]
    with pytest.raises(Exception, match="3 fields, not 2"):
        delimited.width_guard(lines, 2, fail=True).collect()


def test_quoted_csv_values(spark):
    rows = delimited.csv_fields(spark.createDataFrame([('"a,""b""",,c',)], "value string")).first().fields
    assert rows == ['a,"b"', "", "c"]
    trimmed = delimited.trimmed_values(spark.createDataFrame([('"x"', "", '"')], "a string, b string, c string")).first()
    assert tuple(trimmed) == ("x", None, '"')


def test_blocks_give_what_the_whole_text_gives(spark, tmp_path):
    """Block ends inside delimiters, quotes and characters of several bytes."""
    import random

    r = random.Random(2)
    text = "".join(r.choice(['"', '""', "^|", "^", "@@\n", "@", "가", "x", " y"]) for _ in range(900))
    whole = list(delimited.parse(text, "^|", "@@\n"))
    for size in (1, 2, 3, 7, 100):
        blocks = [text[i : i + size] for i in range(0, len(text), size)]
        assert list(delimited.parse_blocks(iter(blocks), "^|", "@@\n")) == whole
    (tmp_path / "a.txt").write_bytes(text.encode("cp949"))
    got = delimited.scan(spark, str(tmp_path / "a.txt"), block_bytes=5).orderBy("row_index").collect()
    assert [x.fields for x in got] == whole


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "600", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.mark.parametrize("seed", range(6))
def test_one_file_in_many_splits(spark, tmp_path, small_splits, seed):
    """Splits inside quotes, rows over several splits, unclosed quotes, files with and without a last delimiter."""
    r = random.Random(seed)
    quotes = ['"', '""'] if seed % 2 else ['"q"', '"a@@\nb"']
    text = "".join(r.choice([*quotes, "^|", "^", "@@\n", "@", "가나", "x", " y", "words " * 9]) for _ in range(1500))
    if seed == 4:
        text += '^|"' + "never closed @@\n" * 120
    if seed == 5:
        text = 'a^|"' + "long ^| @@\n" * 200 + '"@@\nb^|c'
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a +%41.txt").write_bytes(text.encode("cp949"))
    (tmp_path / "in" / "b.txt").write_bytes(("h@@\n" + text + "@@\n").encode("cp949"))
    got = delimited.scan(spark, str(tmp_path / "in"))
    assert got.rdd.getNumPartitions() > 8 or seed == 5
    rows = sorted(got.collect(), key=lambda x: (x.path, x.row_index))
    for name, content in (("a +%41.txt", text), ("b.txt", "h@@\n" + text + "@@\n")):
        own = [x for x in rows if x.path.endswith("/" + name)]
        assert [x.row_index for x in own] == list(range(len(own)))
        assert [x.fields for x in own] == reference(content, "^|", "@@\n")
    skipped = delimited.scan(spark, str(tmp_path / "in" / "b.txt"), skip_rows=2, header=True).orderBy("row_index").collect()
    assert [x.fields for x in skipped] == reference("h@@\n" + text + "@@\n", "^|", "@@\n")[3:]


def test_quoted_fields_in_splits_by_column(spark, tmp_path, small_splits):
    (tmp_path / "a.txt").write_text('1^|"2"@@\n' * 400)
    rows = delimited.scan(spark, str(tmp_path / "a.txt"), ["a", "b"], charset="UTF-8", expected_cols=2)
    assert rows.count() == 400 and rows.select("a", "b").distinct().collect() == [("1", "2")]


def test_where_splits_can_be():
    assert delimited.splits_anywhere("CP949", "^|", "@@\n", '"') and delimited.splits_anywhere("UTF-8", "||", "\r\n", '"') is False
    for charset, col, row in (("UTF-16", "^|", "@@\n"), ("shift_jis", "^|", "@@\n"), ("CP949", "AB", "@@\n"), ("UTF-8", "^|", "|@"), ("UTF-8", "가나", "@@\n"), ("UTF-8", "^|", '@"')):
        assert not delimited.splits_anywhere(charset, col, row, '"'), (charset, col, row)


def test_wide_rows_and_unclosed_quotes_take_linear_time():
    import time

    def seconds(n):
        began = time.process_time()
        assert len(next(delimited.parse("x^|" * n + "y@@\n", "^|", "@@\n"))) == n + 1
        assert len(list(delimited.parse_blocks(iter(['"' + "z" * 50] + ["z" * 50] * n), "^|", "@@\n"))) == 1
        return time.process_time() - began

    seconds(1000)
    assert seconds(80_000) < 30 * max(seconds(8_000), 0.01)
