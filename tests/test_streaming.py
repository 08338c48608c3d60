from datetime import datetime, timedelta

from tonnage.streaming import events


def test_stream_equals_batch(spark, tmp_path):
    start = datetime(2024, 1, 1)
    rows = [(k, start + timedelta(minutes=17 * k), k % 3, "view" if k % 2 else "click", float(k)) for k in range(200)]
    rows.append((999, start + timedelta(days=30), 1, "end", 0.0))  # moves the watermark past all windows
    table = spark.createDataFrame(rows, events.EVENTS)
    table.write.parquet(str(tmp_path / "in"))
    stream = events.tumbling(events.read_events(spark, str(tmp_path / "in")))
    query = events.to_parquet(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    query.awaitTermination(120)
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    expected = {tuple(r) for r in events.tumbling(table).collect() if r["event_type"] != "end"}
    assert expected and got == expected  # the last event's window is still open


def test_repeated_events_count_once(spark, tmp_path):
    start = datetime(2024, 1, 1)
    table = spark.createDataFrame([(k % 10, start, 1, "view", 1.0) for k in range(30)], events.EVENTS)
    table.write.parquet(str(tmp_path / "in"))
    query = events.to_parquet(events.first_seen(events.read_events(spark, str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    query.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10
