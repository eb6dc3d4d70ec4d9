"""Files in and out, and the stream."""

from __future__ import annotations

import datetime as dt
import json

import pytest

from paceline.sources import files, store
from paceline.streaming import minute_feed


def test_archive_and_wayback(spark, tmp_path):
    (tmp_path / "a.csv").write_text('ID,Date_Time,Sensor_ID,Hourly_Counts\n7,"November 01, 2019 05:00:00 PM",34,300\n')
    r = files.read_archive(spark, str(tmp_path / "a.csv")).first()
    assert (r.row_id, r.location_id, r.ts_local, r.pedestriancount, r.direction_1, r.source) == (7, 34, dt.datetime(2019, 11, 1, 17), 300, None, "archive")
    (tmp_path / "w.csv").write_text("location_id;sensing_date;hourday;direction_1;direction_2;pedestriancount\n4;2022-02-03;9;1;2;3\n")
    r = files.read_wayback(spark, str(tmp_path / "w.csv")).first()
    assert (r.ts_local, r.pedestriancount) == (dt.datetime(2022, 2, 3, 9), 3)
    live = spark.createDataFrame([(4, dt.date(2022, 2, 3), 9, 1.0, 2.0, 3)], "location_id long, sensing_date date, hourday int, direction_1 double, direction_2 double, pedestriancount long")
    live.write.parquet(str(tmp_path / "live"))
    assert files.read_live(spark, str(tmp_path / "live")).drop("source").exceptAll(files.read_wayback(spark, str(tmp_path / "w.csv")).drop("source")).count() == 0


def test_weather_last_file_wins(spark, tmp_path):
    for name, v in (("a.json", 1.0), ("b.json", 2.0)):
        (tmp_path / name).write_text(json.dumps({"utc_offset_seconds": 36000, "hourly": {"time": ["2024-01-01T10:00"], "rain": [v]}}))
    r = files.read_weather(spark, str(tmp_path), ["rain"]).collect()
    assert [tuple(x) for x in r] == [(dt.datetime(2024, 1, 1, 0), 2.0)]


def test_no_archive_is_empty_and_typed(spark, tmp_path):
    df = files.read_minutes(spark, str(tmp_path / "none"))
    assert df.count() == 0
    assert df.schema["polled_at"].dataType.typeName() == "timestamp_ntz"


def test_annotations(spark, tmp_path):
    (tmp_path / "a.txt").write_text('0 0 10 4 20 5 1 0 0 "Biker"\n')
    r = files.read_annotations(spark, str(tmp_path / "a.txt"), "s", "v").first()
    assert (r.x, r.y, r.frame, r.lost, r.label) == (2.0, 15.0, 5, True, "Biker")


def test_ways_keep_those_in_the_box(spark):
    s = "way_id long, nodes array<struct<id: long, x: double, y: double>>"
    df = spark.createDataFrame([(1, [(1, 0.0, 0.0), (1, 0.0, 0.0), (2, 9.0, 9.0)]), (2, [(3, 0.0, 0.0)]), (3, [(4, 8.0, 8.0), (5, 9.0, 9.0)])], s)
    got = files.ways(df, -1, -1, 1, 1).collect()
    assert [(r.way_id, r.node_ids) for r in got] == [(1, [1, 2])]


def test_manifest_and_history(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/x.bin").write_bytes(b"abc")
    m = files.manifest(spark, str(tmp_path / "in/*"), "u", "now")
    assert (m.first().file, m.first().bytes) == ("x.bin", 3)
    assert files.unlike(m, m.limit(0)).count() == 1
    assert files.unlike(m, m).count() == 0
    at = str(tmp_path / "history")
    assert files.last_run(spark, at, "run_at string, n long").count() == 0
    for day, n in (("2024-01-02", 5), ("2024-01-01", 4)):
        files.append_history(spark.createDataFrame([(day, n)], "run_at string, n long"), at)
    assert files.last_run(spark, at, "run_at string, n long").first().n == 5
    assert files.config_hash({"a": 1, "b": 2}) == files.config_hash({"b": 2, "a": 1})
    assert files.is_current({"inputs": {"a": "1"}}, {"a": "1"})
    assert not files.is_current(None, {})


def test_csv_rounds(spark, tmp_path):
    files.write_csv(spark.createDataFrame([(1.234567,)], "v double"), str(tmp_path / "o"))
    assert spark.read.option("header", True).csv(str(tmp_path / "o")).first().v == "1.2346"
    files.write_table(spark.createDataFrame([(1, 2024)], "v int, year int"), str(tmp_path / "t"), ["year"])
    assert (tmp_path / "t/year=2024").is_dir()


def test_filter_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "ts timestamp_ntz").write.parquet(str(tmp_path / "t"))
    df = files.read_since(spark, str(tmp_path / "t"), "ts", "2024-01-02")
    assert "GreaterThanOrEqual(ts" in df._jdf.queryExecution().executedPlan().toString()


def poll(minute: int, n: int, polled: int):
    base = dt.datetime(2024, 1, 1, 12)
    return (1, base + dt.timedelta(minutes=minute), n, 0, n, base + dt.timedelta(minutes=polled))


SCHEMA = "location_id long, sensing_datetime timestamp_ntz, direction_1 long, direction_2 long, total_of_directions long, polled_at timestamp_ntz"


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0)])
def test_stream_equals_batch_in_any_order(spark, tmp_path, order):
    polls = [[poll(0, 5, 30), poll(1, 2, 30)], [poll(0, 5, 10), poll(800, 1, 900)], [poll(1, 3, 40)]]
    src, out, ck = (str(tmp_path / p) for p in ("src", "out", "ck"))
    for k in order:
        spark.createDataFrame(polls[k], SCHEMA).coalesce(1).write.mode("append").parquet(src)
        minute_feed.run(spark, src, out, ck, "Australia/Melbourne").awaitTermination()
    got = sorted((r.sensing_datetime, r.total_of_directions, r.polled_at) for r in spark.read.parquet(out).collect())
    assert got == sorted((m, n, p) for _, m, n, _, _, p in (poll(0, 5, 10), poll(1, 2, 30), poll(1, 3, 40), poll(800, 1, 900)))
    assert spark.read.parquet(out).select("sensing_date").distinct().count() == 2


def test_merging_again_changes_nothing(spark, tmp_path):
    rows = minute_feed.normalise(spark.createDataFrame([poll(0, 5, 30)], SCHEMA), "Australia/Melbourne")
    at = str(tmp_path / "a")
    assert minute_feed.merge_into(at, rows) == 1
    assert minute_feed.merge_into(at, rows) == 0


def test_blocks_of_a_stream(spark, tmp_path):
    spark.createDataFrame([poll(0, 5, 30), poll(4, 2, 30), poll(5, 1, 30)], SCHEMA).write.parquet(str(tmp_path / "s"))
    stream = minute_feed.block_counts(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "s")))
    q = stream.writeStream.format("memory").queryName("blocks_of_a_stream").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.total for r in spark.table("blocks_of_a_stream").collect()) == [1, 7]


@pytest.mark.parametrize(("now", "since"), [("2024-01-01 10:05:00", None), ("2024-01-01 10:20:00", dt.datetime(2024, 1, 1, 7, 20))])
def test_poll_since(spark, now, since):
    assert minute_feed.poll_since(spark, now).first().since == since


def test_pages(spark):
    df = spark.createDataFrame([(1, '<a href="x">A</a><a href="y">B</a>'), (2, None)], "i int, html string")
    got = files.rows_of_pages(df, "html", r'<a href="([^"]*)">([^<]*)</a>', {"h": 1, "t": 2}, ["i"]).select("i", "h", "t").collect()
    assert [tuple(r) for r in got] == [(1, "x", "A"), (1, "y", "B")]


def test_conditional_writes(tmp_path):
    s = store.LocalStore(str(tmp_path / "s"))
    assert store.update(s, "a", lambda held: (held or b"") + b"1")
    _, token = s.read("a")
    s.write("a", b"12", token)
    with pytest.raises(store.Conflict):
        s.write("a", b"13", token)
    assert s.read("a")[0] == b"12"
    assert not store.update(s, "a", lambda held: held)
    calls = []

    def change(held):
        calls.append(held)
        if len(calls) == 1:
            s.write("a", b"other", s.token("a"))
        return (held or b"") + b"!"

    assert store.update(s, "a", change)
    assert s.read("a")[0] == b"other!"
    assert store.sync(s, str(tmp_path / "to")) == ["a"]
    assert store.sync(s, str(tmp_path / "to")) == []
