import json

import pytest
from pyspark.sql import functions as F

from tidemart.session import scratch_path
from tidemart.sources import writers
from tidemart.streaming import changes, event_time, logs, sinks


class Feed:
    """A folder of text files read as a stream, one file per micro-batch."""

    def __init__(self, spark, name):
        self.spark, self.path = spark, scratch_path(spark, name)

    def add(self, *lines):
        self.spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode(
            "append").text(self.path)
        return self

    def stream(self):
        return (self.spark.readStream.schema("value string").option("maxFilesPerTrigger", 1)
                .format("text").load(self.path))


def test_files_exactly_once_after_restart(spark):
    feed = Feed(spark, "feed").add("a", "b")
    out, mark = scratch_path(spark, "out"), scratch_path(spark, "mark")
    sinks.run_to_end(sinks.to_files(feed.stream(), out, mark, once=True))
    sinks.run_to_end(sinks.to_files(feed.stream(), out, mark, once=True))
    feed.add("c")
    sinks.run_to_end(sinks.to_files(feed.stream(), out, mark, once=True))
    assert sorted(r.value for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_failed_batch_is_not_half_written(spark):
    feed = Feed(spark, "fail").add("1", "2", "x")
    out, mark = scratch_path(spark, "out"), scratch_path(spark, "mark")
    strict = feed.stream().select(F.col("value").cast("int").alias("n"))
    try:
        sinks.run_to_end(sinks.to_files(strict, out, mark, once=True))
        raise AssertionError("the cast must fail")
    except Exception as error:
        assert "CAST_INVALID_INPUT" in str(error)
    lenient = feed.stream().select(F.col("value").try_cast("int").alias("n"))
    sinks.run_to_end(sinks.to_files(lenient, out, mark, once=True))
    assert sorted((r.n for r in spark.read.parquet(out).collect()), key=str) == [1, 2, None]


def test_event_times(spark):
    df = spark.createDataFrame([('{"ts":1704067200000}',), ('{"ts":"bad"}',), ("garbled",), (None,),
                                ('{"timestamp":60}',), ('{"block_timestamp":1,"timestamp":60}',),
                                ('[{"window_start_time":1000},{"window_start_time":5}]',), ("[]",)],
                               "value string")
    v = F.col("value")
    got = [tuple(None if x is None else int(x) for x in r) for r in df.select(
        F.unix_millis(event_time.field_millis(v, "ts")),
        F.unix_millis(event_time.field_seconds(v, "block_timestamp", "timestamp")),
        F.unix_millis(event_time.first_window_start(v))).collect()]
    assert got == [(1704067200000, None, None), (None, None, None), (None, None, None),
                   (None, None, None), (None, 60000, None), (None, 1000, None),
                   (None, None, 1000), (None, None, None)]


def test_rejects_complement_watermarked(spark):
    df = spark.createDataFrame([('{"ts":1}',), ("x",)], "value string")
    time = event_time.field_millis(F.col("value"), "ts")
    assert event_time.with_watermark(df, time, 5).count() == 1
    assert event_time.rejects(df, time).count() == 1


def test_repeats_within_watermark(spark):
    lines = ['{"id":"a","ts":1000}', '{"id":"a","ts":2000}', '{"id":"b","ts":3000}']
    feed = Feed(spark, "repeat").add(*lines)
    feed.add('{"id":"a","ts":4000}')
    timed = event_time.with_watermark(feed.stream(), event_time.field_millis(F.col("value"), "ts"), 60)
    unique = event_time.without_repeats(
        timed.withColumn("id", F.get_json_object("value", "$.id")), ["id"])
    out, mark = scratch_path(spark, "out"), scratch_path(spark, "mark")
    sinks.run_to_end(sinks.to_files(unique.select("id"), out, mark, once=True))
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_day_buckets(spark):
    feed = Feed(spark, "bucket").add('{"ts":1704067200}', '{"ts":1704067200000}', "garbled", "{}")
    out, mark = scratch_path(spark, "out"), scratch_path(spark, "mark")
    sinks.run_to_end(sinks.to_day_buckets(feed.stream(), "ts", out, mark, once=True))
    got = spark.read.parquet(out).groupBy("day").count().collect()
    assert {r.day: r["count"] for r in got} == {"20240101": 2, "error_bucket": 2}


def test_log_split_routes(spark):
    line = json.dumps({"common": {"uid": "1"}, "page": {"page_id": "home"}, "displays": [
        {"item": "3"}], "err": {"error_code": 7}, "ts": 1})
    df = spark.createDataFrame([(1, line), (2, "garbled"), (3, None)], "id int, value string")
    got = {(r.id, r.route): r.value for r in logs.split_log(df).collect()}
    assert set(got) == {(1, "page"), (1, "display"), (1, "err"), (2, "dirty"), (3, "dirty")}
    assert json.loads(got[1, "err"]) == {"common": {"uid": "1"}, "err": {"error_code": 7}, "ts": 1}
    assert got[2, "dirty"] == "garbled"
    topics = logs.with_topic(logs.split_log(df).where("route = 'err'"), {"err": "topic-err"})
    assert [r.topic for r in topics.collect()] == ["topic-err"]


def change(op, key, value, ts, pos):
    row = {"user_id": key, "name": value}
    return json.dumps({"before": row if op == "d" else None, "after": None if op == "d" else row,
                       "op": op, "ts": ts, "pos": pos})


def test_changes_out_of_order_and_repeated(spark):
    feed = Feed(spark, "cdc").add(change("c", 1, "a", 10, 1), change("u", 1, "b", 20, 2),
                                  change("c", 2, "x", 10, 3), "garbled")
    feed.add(change("d", 2, "x", 30, 5), change("u", 3, "n", 5, 6))
    feed.add(change("u", 2, "late", 20, 4), change("u", 1, "older", 15, 9))
    path, mark = scratch_path(spark, "table"), scratch_path(spark, "mark")
    stream = changes.parse_changes(feed.stream(), "struct<user_id: bigint, name: string>", "user_id")
    apply = changes.apply_batch(path, "user_id", 2)
    sinks.run_to_end(sinks.per_batch(stream, apply, mark, once=True))
    expected = [(1, "b"), (3, "n")]
    assert sorted(map(tuple, changes.current_rows(spark, path, "user_id").select("user_id", "name").collect())
                  ) == expected
    # A batch that is applied again changes nothing.
    again = changes.parse_changes(spark.read.text(feed.path),
                                  "struct<user_id: bigint, name: string>", "user_id")
    apply(again, 0)
    assert sorted(map(tuple, changes.current_rows(spark, path, "user_id").select("user_id", "name").collect())
                  ) == expected


def test_a_batch_cut_short_leaves_the_table(spark, monkeypatch):
    schema = "struct<user_id: bigint, name: string>"

    def rows(*lines):
        df = spark.createDataFrame([(x,) for x in lines], "value string")
        return changes.parse_changes(df, schema, "user_id")

    def state():
        return sorted(map(tuple, changes.current_rows(spark, path, "user_id").collect()))

    def stop(*_):
        raise RuntimeError("stopped")

    path = scratch_path(spark, "crash")
    apply = changes.apply_batch(path, "user_id", 4)
    apply(rows(change("c", 1, "a", 1, 1), change("c", 2, "b", 1, 2)), 0)
    second = rows(change("u", 1, "z", 2, 3), change("d", 2, "b", 2, 4))
    broken = second.withColumn("name", F.when(F.col("user_id") == 2, F.raise_error(F.lit("stopped")).cast("string"))
                               .otherwise(F.col("name")))
    with pytest.raises(Exception, match="stopped"):  # the write itself fails
        apply(broken, 1)
    assert state() == [(1, "a"), (2, "b")]
    for _ in range(2):  # the replay, and a replay of the replay
        apply(second, 1)
        assert state() == [(1, "z")]
    apply(rows(change("u", 3, "c", 1, 5)), 2)
    fourth = rows(change("u", 1, "n", 3, 6))
    for at in ("replace_table", "_remove"):  # compaction stops before the swap, and before the batches are removed
        with monkeypatch.context() as m:
            m.setattr(changes, at, stop)
            with pytest.raises(RuntimeError):
                apply(fourth, 3)
        assert state() == [(1, "n"), (3, "c")]
    renamed = writers._rename
    with monkeypatch.context() as m:  # ... and between the two renames of the swap
        m.setattr(writers, "_rename", lambda fs, a, b: renamed(fs, a, b) if "__previous" in b.toString() else stop())
        with pytest.raises(RuntimeError):
            apply(fourth, 3)
    assert state() == [(1, "n"), (3, "c")]
    apply(fourth, 3)
    apply(rows(change("u", 2, "late", 1, 9)), 4)  # older than the delete, which compaction keeps
    assert state() == [(1, "n"), (3, "c")]
    assert spark.read.parquet(f"{path}/changes").select("batch").distinct().count() == 2


def test_changes_without_use_are_rejected(spark):
    lines = [change("c", 1, "a", 1, 1), "garbled", '{"op":"d","after":{"user_id":1}}', '{"op":"c"}', None]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    schema = "struct<user_id: bigint, name: string>"
    good = changes.parse_changes(df, schema, "user_id").count()
    assert (good, changes.rejected_changes(df, schema, "user_id").count()) == (1, 4)


def test_running_totals_keep_the_last_state(spark):
    feed = Feed(spark, "totals").add("a", "b")
    feed.add("c")
    out, mark = scratch_path(spark, "out"), scratch_path(spark, "mark")
    counted = feed.stream().agg(F.count("*").alias("n"))
    sinks.run_to_end(sinks.per_batch(counted, sinks.keep_latest_result(out), mark,
                                     mode="complete", once=True))
    assert [r.n for r in sinks.latest_result(spark, out).collect()] == [3]
    write = sinks.keep_latest_result(out)
    for number in (2, 3, 4):
        write(spark.range(number).agg(F.count("*").alias("n")), number)
    assert [r.n for r in sinks.latest_result(spark, out).collect()] == [4]
    assert spark.read.parquet(out).select("batch").distinct().count() == 2
