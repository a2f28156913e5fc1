"""A change table as a stream: caps, restarts, committed offsets."""

import json

import pytest

from tidewright.sources.change_stream import ChangeReader, register


def write(folder, name, low, high):
    folder.mkdir(exist_ok=True)
    text = "".join(json.dumps({"seq": i, "cdc_key": f"k{i % 7}", "value": {"n": i} if i % 2 else f"v\n{i}", "cdc_destination": "t"}) + "\n" for i in range(low, high))
    (folder / "tmp").write_text(text)
    (folder / "tmp").rename(folder / name)


def run(spark, feed, out, checkpoint, **options):
    stream = spark.readStream.format("change_table").options(path=str(feed), **options).load()
    query = stream.writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(checkpoint)).start()
    query.processAllAvailable()
    sizes = [p.numInputRows for p in query.recentProgress if p.numInputRows]
    query.stop()
    return sizes


def seqs(spark, out):
    return sorted(r.seq for r in spark.read.parquet(str(out)).collect())


def test_restarts_neither_lose_nor_repeat_events(spark, tmp_path):
    register(spark)
    feed, out, check = tmp_path / "feed", tmp_path / "out", tmp_path / "c"
    write(feed, "000.json", 0, 55)
    write(feed, "001.json", 55, 130)
    assert run(spark, feed, out, check, max_rows=50, rows_per_task=20) == [50, 50, 30]
    assert seqs(spark, out) == list(range(130))
    write(feed, "002.json", 130, 131)
    write(feed, "003.json", 131, 260)
    sizes = run(spark, feed, out, check, max_rows=50, rows_per_task=20)  # the same checkpoint
    assert seqs(spark, out) == list(range(260)) and max(sizes) <= 50 and sum(sizes) == 130
    row = spark.read.parquet(str(out)).where("seq = 3").first()
    assert (row.cdc_key, row.value, row.cdc_destination) == ("k3", '{"n": 3}', "t")


def test_a_new_checkpoint_goes_on_from_committed_offsets(spark, tmp_path):
    register(spark)
    feed, kept = tmp_path / "feed", str(tmp_path / "offsets")
    write(feed, "000.json", 0, 90)
    run(spark, feed, tmp_path / "o1", tmp_path / "c1", max_rows=40, offsets=kept)
    done = ChangeReader({"path": str(feed), "offsets": kept})._committed()
    assert 0 < done <= 90  # the last batch's commit may come after the query's end
    write(feed, "001.json", 90, 120)
    run(spark, feed, tmp_path / "o2", tmp_path / "c2", max_rows=40, offsets=kept)
    assert seqs(spark, tmp_path / "o2") == list(range(done, 120))
    run(spark, feed, tmp_path / "o3", tmp_path / "c3", max_rows=40, offsets=kept, start="earliest")
    assert seqs(spark, tmp_path / "o3") == list(range(120))


def test_offsets_go_on_without_a_planned_batch(tmp_path):
    """A reader that Spark restarts behind its checkpoint offers ever further offsets, so the query can't stand still."""
    write(tmp_path / "feed", "000.json", 0, 500)
    reader = ChangeReader({"path": str(tmp_path / "feed"), "max_rows": "100"})
    assert [reader.latestOffset()["events"] for _ in range(3)] == [100, 200, 300]
    parts = reader.partitions({"events": 290}, {"events": 310})
    assert [(p.begin, p.end) for p in parts] == [(290, 310)] and [r[0] for r in reader.read(parts[0])] == list(range(290, 310))
    assert reader.partitions({"events": 5}, {"events": 5}) == []
    with pytest.raises(ValueError):
        ChangeReader({"path": "x", "start": "committed"})
    assert ChangeReader({"path": str(tmp_path / "feed"), "start": "latest"}).initialOffset() == {"events": 500}


def test_a_part_is_read_without_the_events_before_it(tmp_path, monkeypatch):
    """A trigger's cost doesn't grow with the file that it is in."""
    from tidewright.sources import change_stream

    write(tmp_path / "feed", "000.json", 0, 30_000)
    write(tmp_path / "feed", "001.json", 30_000, 60_000)
    reader, seen, lines = ChangeReader({"path": str(tmp_path / "feed")}), [], change_stream._lines

    def counted(stream):
        for line in lines(stream):
            seen.append(line)
            yield line

    monkeypatch.setattr(change_stream, "_lines", counted)
    for a, b in ((0, 10), (2_499, 2_503), (28_000, 28_500), (29_999, 30_001), (59_000, 60_000), *((x, x + 1) for x in range(3_000, 30_000, 997))):
        seen.clear()
        assert [r[0] for p in reader.partitions({"events": a}, {"events": b}) for r in reader.read(p)] == list(range(a, b))
        assert len(seen) < 15_000
    every = reader.partitions({"events": 0}, {"events": 60_000})
    assert [r[0] for p in every for r in reader.read(p)] == list(range(60_000))
