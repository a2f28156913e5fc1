"""Commits of several writers, merges that leave files alone, reads that skip files."""

import pytest
from pyspark.sql import functions as F

from tidewright.operators.routing import CommitConflict
from tidewright.sinks import commit_log
from tidewright.sinks.commit_log import LoggedTable


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def made(spark, low, high, v="a", step=1):
    return spark.range(low, high, step, 1).select(F.col("id").alias("k"), F.concat(F.lit("p "), (F.col("id") % 3).cast("string")).alias("part"), F.lit(v).alias("v"))


def content(spark, t):
    """Bytes' checksum of each live file."""
    fs = lambda x: f"{t.path}/{x}"
    return {r.file: spark.read.format("binaryFile").load(fs(r.file)).select(F.sha2("content", 256)).first()[0] for r in t.files().collect()}


def test_merge_writes_the_touched_files_alone(spark, tmp_path):
    t = LoggedTable(spark, str(tmp_path / "t"), stats=["k"])
    t.append(made(spark, 0, 400).repartitionByRange(8, "k"))
    before = content(spark, t)
    assert len(before) == 8 and t.files().agg(F.sum("rows")).first()[0] == 400
    _, touched = t.merge(made(spark, 60, 90, "b", 10).unionByName(made(spark, 1000, 1002, "new")), ["k"])
    after = content(spark, t)
    assert 1 <= len(touched) <= 2 and {x: y for x, y in before.items() if x not in touched}.items() <= after.items() and not set(touched) & set(after)
    expected = {k: "b" if k in (60, 70, 80) else "a" for k in range(400)} | {1000: "new", 1001: "new"}
    assert {r.k: r.v for r in t.read().collect()} == expected and t.read().count() == 402
    t.merge(made(spark, 0, 50), ["k"], "DELETE")
    t.merge(made(spark, 390, 2000, "c"), ["k"], "UPDATE")
    assert {r.k: r.v for r in t.read().collect()} == {k: "c" if k >= 390 else v for k, v in expected.items() if k >= 50}
    assert rows(t.read(version=0)) == rows(made(spark, 0, 400))


def test_reads_open_matching_files_only(spark, tmp_path):
    t = LoggedTable(spark, str(tmp_path / "t"), ["part"], ["k", "part"])
    for i in range(12):  # the tenth commit's manifest holds all
        t.append(made(spark, 10 * i, 10 * i + 10))
    got = t.read([("k", ">=", 35), ("k", "<", 52), ("part", "=", "p 1")])
    assert rows(got) == [(k, "p 1", "a") for k in range(35, 52) if k % 3 == 1]
    assert len(got.inputFiles()) == 2 and t.files().count() == 36
    assert t._commit(10)["whole"] and LoggedTable(spark, t.path).read().count() == 120
    assert t.read([("k", ">", 500)]).count() == 0


def test_two_writers_interleave(spark, tmp_path, monkeypatch):
    """An append goes on behind another commit; a merge whose partitions were changed starts again."""
    t = LoggedTable(spark, str(tmp_path / "t"), ["part"], ["k"])
    t.append(made(spark, 0, 30))
    other, plain, runs = LoggedTable(spark, t.path), LoggedTable._commit_files, []

    def late(self, *args):
        if self is t and len(runs) < 2:
            runs.append(args[0])
            other.append(made(spark, 100 * len(runs), 100 * len(runs) + 3, "other"))
        return plain(self, *args)

    monkeypatch.setattr(LoggedTable, "_commit_files", late)
    assert t.append(made(spark, 30, 31)) == 2 and runs == [0]
    t.merge(made(spark, 3, 9, "m").unionByName(made(spark, 200, 201, "m")), ["k"])
    assert runs == [0, 2]
    got = {r.k: r.v for r in t.read().collect()}
    assert got == {k: "m" if 3 <= k < 9 or k == 200 else "a" if k < 31 else "other" for k in [*range(31), 100, 101, 102, 200, 201, 202]}
    assert t.read().count() == len(got)
    lost = t.clean(keep=1)
    assert lost and t.read().count() == len(got)


def test_a_delete_depends_on_its_own_partitions_alone(spark, tmp_path, monkeypatch):
    t = LoggedTable(spark, str(tmp_path / "t"), ["part"], ["k"])
    t.append(made(spark, 0, 30))
    plain, runs = LoggedTable._commit_files, []

    def late(self, *args):
        if self is t and not runs:
            runs.append(1)
            LoggedTable(spark, t.path).append(made(spark, 31, 32))  # partition p 1
        return plain(self, *args)

    monkeypatch.setattr(LoggedTable, "_commit_files", late)
    version, _ = t.merge(made(spark, 0, 1), ["k"], "DELETE")  # partition p 0: no new start
    assert version == 2 and sorted(r.k for r in t.read().collect()) == [*range(1, 30), 31]


def test_a_number_is_taken_once(spark, tmp_path):
    t = LoggedTable(spark, str(tmp_path / "t"))
    t.append(made(spark, 0, 3))
    with pytest.raises(CommitConflict):
        commit_log.create(spark, f"{t.path}/_commits/{0:012d}.json", "{}")
    t.append(made(spark, 3, 5).withColumn("w", F.lit(1)))  # a new column
    assert rows(t.read().groupBy("w").count().fillna(0)) == [(0, 3), (1, 2)]
    with pytest.raises(FileNotFoundError):
        LoggedTable(spark, str(tmp_path / "none")).read()


@pytest.mark.parametrize("parts", [[], ["part"]])
def test_compaction_packs_small_files_and_leaves_large_ones(spark, tmp_path, parts):
    t = LoggedTable(spark, str(tmp_path / "t"), parts, ["k"])
    t.append(made(spark, 0, 60_000).withColumn("w", F.sha2(F.col("k").cast("string"), 256)).coalesce(1))
    large = content(spark, t)
    for i in range(6):
        t.append(made(spark, 100_000 + 10 * i, 100_000 + 10 * i + 10))
    least = min(r.bytes for r in t.files().where("rows > 100").collect())
    before, n = rows(t.read().select("k", "v", "w")), t.files().count()
    t.compact(least)
    after = content(spark, t)
    assert large.items() <= after.items() and len(after) < n and rows(t.read().select("k", "v", "w")) == before
    assert len(after) == len(large) + max(1, 3 * len(parts)) and t.compact(least) is None
    kept = [r.k for r in t._rows([x for x in after if x not in large], t.schema()).select("k", "part").collect()]
    if not parts:  # order of files and of rows in them
        first = [r.file for r in t.files(6).where("rows < 100").orderBy("file").collect()]
        assert kept == [r.k for x in first for r in t._rows([x], t.schema()).collect()]
    t.append(made(spark, 5, 6))
    assert t.merge(made(spark, 100_000, 100_003, "m"), ["k"], "UPDATE")[1] and t.read().where("v = 'm'").count() == 3


def test_clustered_files_are_skipped_by_either_column(spark, tmp_path):
    t = LoggedTable(spark, str(tmp_path / "t"), [], ["a", "b"])
    df = spark.range(40_000).select((F.col("id") * 7919 % 1000).alias("a"), (F.col("id") * 104_729 % 977).alias("b"), F.when(F.col("id") % 50 > 0, F.col("id")).alias("c"))
    t.append(df)
    t.compact(t.files().agg(F.sum("bytes")).first()[0] // 16, cluster=["a", "b"])
    n = t.files().count()
    assert n >= 12 and t.read().exceptAll(df).isEmpty() and t.read().count() == 40_000
    for column in "ab":
        got = t.read([(column, "<", 100)])
        assert len(got.inputFiles()) <= n // 2 and got.count() == df.where(F.col(column) < 100).count()


def test_compaction_goes_on_behind_appends_but_not_behind_merges(spark, tmp_path, monkeypatch):
    t = LoggedTable(spark, str(tmp_path / "t"), [], ["k"])
    for i in range(3):
        t.append(made(spark, 10 * i, 10 * i + 10))
    plain, act = LoggedTable._commit_files, []

    def late(self, *args):
        if self is t and act:
            act.pop()(LoggedTable(spark, t.path))
        return plain(self, *args)

    monkeypatch.setattr(LoggedTable, "_commit_files", late)
    act.append(lambda other: other.append(made(spark, 50, 52)))
    assert t.compact(1 << 20) == 4 and t.files().count() == 2
    act.append(lambda other: other.merge(made(spark, 0, 1), ["k"], "DELETE"))
    with pytest.raises(commit_log.ReadChanged):
        t.compact(1 << 20)
    assert sorted(r.k for r in t.read().collect()) == [*range(1, 30), 50, 51]


def test_rank_halves_its_cuts(spark):
    """Eight steps for 255 cuts, not 255, and the same ranks."""
    from pyspark.sql import functions as F

    from tidewright.sinks.commit_log import _rank

    values = [None, float("nan"), float("-inf"), -1.0, 0.0, 2.0, 2.5, 6.9, 7.0, 99.0, float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for cuts in ([], [2.0], [0.0, 2.0, 2.0, 2.0, 7.0], [float(x // 2) for x in range(255)]):
        rank = _rank(F.col("v"), cuts)
        assert "filter(" not in rank._jc.toString()
        ranks = {repr(r.v): r.rank for r in df.select("v", rank.alias("rank")).collect()}
        assert ranks == {repr(v): 0 if v is None else len(cuts) if v != v else sum(c <= v for c in cuts) for v in values}
