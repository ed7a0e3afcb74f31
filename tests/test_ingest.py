"""Upserts of daily snapshots and the feed data source."""

import pathlib

import pytest
from pyspark.sql import functions as F

from naviscope import session
from naviscope.operators import risk
from naviscope.sources import feed, feed_source
from naviscope.streaming import feed_stream

HEAD = "Code;A;B;Scheme Name;Day\n"
NAMES = ["Code", "A", "B", "Scheme Name", "Day"]


@pytest.fixture
def snapshots(spark, tmp_path):
    source, target, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    dimension = spark.createDataFrame([("F", "7")], "family string, family_id string")

    def run(name=None, body="", state=state):
        if name:
            (tmp_path / "in" / name).write_text(HEAD + body)
        feed_stream.upsert(spark, source, target, state, dimension, NAMES)
        rows = feed_stream.read_snapshots(spark, target)
        return sorted((r["day"], r["code"], r["a"]) for r in rows.collect())

    return run, pathlib.Path(target)


def folders(spark):
    here = pathlib.Path(session.run_folder(spark).removeprefix("file://"))
    return {p.name for p in here.iterdir() if p.name.startswith(("sectioned", "upsert-"))} if here.exists() else set()


def test_a_second_file_of_a_day_replaces_its_rows(spark, snapshots, tmp_path):
    run, target = snapshots
    before = folders(spark)
    first = run("a.txt", "T (C)\nF\n1;a;b;X;2024-01-01\n2;a;b;Y;2024-01-01\n1;a;b;X;2024-01-02\nbad;row\n;x;y;Z;2024-01-01\n9;x;y;Z; \n")
    assert first == [("2024-01-01", "1", "a"), ("2024-01-01", "2", "a"), ("2024-01-02", "1", "a")]
    assert sorted(r["line"] for r in spark.read.parquet(f"{target}/rejects").collect()) == ["9;x;y;Z;", ";x;y;Z;2024-01-01", "bad;row"]
    old = {p.name: p.stat().st_mtime_ns for p in (target / "rows").glob("day=2024-01-02/*.parquet")}
    second = run("b.txt", "F\n1;new;b;X;2024-01-01\n1;newer;b;X;2024-01-01\n3;a;b;Z;2024-01-03\n")
    assert second == [("2024-01-01", "1", "newer"), ("2024-01-01", "2", "a"), ("2024-01-02", "1", "a"), ("2024-01-03", "3", "a")]
    # The day that the second file doesn't hold keeps its file.
    assert old == {p.name: p.stat().st_mtime_ns for p in (target / "rows").glob("day=2024-01-02/*.parquet")}
    # Nothing new changes nothing; nor do the same files, taken in once more in the same order.
    assert run() == second
    assert folders(spark) == before


def test_a_batch_that_is_run_again_changes_nothing(spark, snapshots, tmp_path):
    run, target = snapshots
    first = run("a.txt", "F\n1;a;b;X;d1\n2;a;b;Y;d2\n")
    (latest,) = (tmp_path / "state" / "commits").glob("0")
    for f in (tmp_path / "state" / "commits").iterdir():
        f.unlink()
    assert run() == first and latest.exists()


def test_ingest_leaves_no_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text(HEAD + "F\n1;a;b;X;d1\n")
    before = folders(spark)
    dimension = spark.createDataFrame([("F", "7")], "family string, family_id string")
    feed_stream.ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), dimension, NAMES)
    assert spark.read.parquet(str(tmp_path / "out" / "rows")).count() == 1 and folders(spark) == before


def lines_of(df):
    return sorted((r["file"].removeprefix("file:").replace("///", "/"), r["line"]) for r in df.collect())


@pytest.mark.parametrize("range_bytes", [5, 64, 1 << 20])
def test_ranges_give_the_lines_of_the_text_reader(spark, tmp_path, range_bytes):
    (tmp_path / "a.txt").write_text("one\n\ntwo é漢\r\nlast without an end")
    (tmp_path / "b.txt").write_text("\n\nx\n" + "long " * 100 + "\n")
    (tmp_path / "empty.txt").write_text("")
    (tmp_path / "_hidden").write_text("no\n")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "c.txt").write_text("c\n")
    found = feed_source.read_feed(spark, str(tmp_path), rangeBytes=range_bytes)
    plain = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(str(tmp_path)).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    assert lines_of(found) == lines_of(plain)
    in_order = [r["line"] for r in found.where("file LIKE '%a.txt'").orderBy("block", "pos").collect()]
    assert in_order == ["one", "", "two é漢\r", "last without an end"]


def test_one_large_file_is_read_by_many_tasks(spark, tmp_path):
    path = tmp_path / "large.txt"
    path.write_text("".join(f"line {i}\n" for i in range(30_000)))
    found = feed_source.read_feed(spark, str(path), rangeBytes=20_000)
    assert found.rdd.getNumPartitions() > 10
    assert [r["line"] for r in found.orderBy("block", "pos").collect()] == [f"line {i}" for i in range(30_000)]
    same = feed.read_lines(spark, str(path))
    assert lines_of(found) == lines_of(same)
    with pytest.raises(Exception, match="path"):
        spark.read.format("sectioned_feed").load().count()


def test_stream_takes_each_file_once(spark, tmp_path):
    source, state = tmp_path / "in", str(tmp_path / "state")
    source.mkdir()
    out = str(tmp_path / "out")

    def run(name, text):
        (source / name).write_text(text)
        query = feed_source.stream_feed(spark, str(source), rangeBytes=5).select("line").writeStream.format("parquet").option("checkpointLocation", state).option("path", out).trigger(processingTime="0 seconds").start()
        query.processAllAvailable()
        query.stop()
        return sorted(r["line"] for r in spark.read.parquet(out).collect())

    assert run("a.txt", "one\ntwo\n") == ["one", "two"]
    assert run("b.txt", "three\n") == ["one", "three", "two"]


def test_a_month_is_added_from_its_own_prices(spark, tmp_path):
    prices = [(k, f"2024-{m:02d}", 100.0 + (7 * k + 3 * m * m) % 11) for k in range(8) for m in range(1, 8) if (k + m) % 5]
    df = spark.createDataFrame([(*p,) for p in prices], "scheme_idx long, month string, price double")
    groups = spark.createDataFrame([(k, "ab"[k % 2]) for k in range(8)], "scheme_idx long, category string")
    returns = risk.period_returns(df, ["scheme_idx"], "month", "price").join(groups, "scheme_idx")
    whole = risk.risk_measures(returns, risk.benchmark_returns(returns, ["category"], "month"), "scheme_idx", ["category"], "month")
    store = risk.MomentStore(spark, str(tmp_path / "store"), "scheme_idx", ["category"], "month", "price")
    store.load(df.where("month < '2024-05'"), groups)
    for month, before in (("2024-05", "2024-04"), ("2024-06", "2024-05"), ("2024-07", "2024-06"), ("2024-07", "2024-06")):
        store.add(df.where(F.col("month") == month), groups, month, before)

    found, wanted = (sorted(map(tuple, frame.collect())) for frame in (store.measures(), whole))
    assert len(found) == 8
    for a, b in zip(found, wanted):
        assert a == pytest.approx(b, rel=1e-9)


def test_clear_run_removes_what_was_stored(spark, tmp_path):
    path = session.new_folder(spark, "probe")
    spark.range(3).write.parquet(path)
    assert session.folder_exists(spark, path)
    session.remove_folder(spark, path)
    session.remove_folder(spark, path)
    assert not session.folder_exists(spark, path)
