"""Sessions, minute counts, expiring bans, words inside texts."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemart.operators.sessions import gap_sessions
from tidemart.operators.substrings import words_inside
from tidemart.plans.moderation import grade_inside
from tidemart.session import scratch_path
from tidemart.streaming import sinks, windows

BASE = datetime(2024, 1, 1)


def _measures():
    return [F.count("*").cast("bigint").alias("n"), F.min("id").alias("first_id")]


def _at(seconds):
    return BASE + timedelta(seconds=seconds)


def _plain_sessions(rows, gap):
    """(key, first second, last second, rows) by one pass over the sorted rows of each key."""
    out = []
    for key in sorted({k for k, t, _ in rows if k is not None and t is not None}):
        run = None
        for t, _ in sorted((t, i) for k, t, i in rows if k == key and t is not None):
            if run and t - run[1] <= gap:
                run = (run[0], t, run[2] + 1)
            else:
                out += [(key, *run)] if run else []
                run = (t, t, 1)
        out.append((key, *run))
    return out


def _frame(spark, rows):
    return spark.createDataFrame([(k, None if t is None else _at(t), i) for k, t, i in rows],
                                 "k string, t timestamp, id long")


def _seen(found, gap):
    return sorted((r.k, int((r.session_start - BASE).total_seconds()),
                   int((r.session_end - BASE).total_seconds()) - gap, r.n) for r in found.collect())


def test_sessions_of_a_hot_key_equal_one_pass(spark):
    rng = random.Random(7)
    rows = [("hot", t // 2 if t < 1500 else t * 3, t) for t in range(2500)]  # one very long session, then a longer one
    rows += [(rng.choice("abc"), rng.randint(0, 900), i) for i in range(2500, 2700)]
    rows += [("edge", 0, 1), ("edge", 10, 2), ("edge", 21, 3), (None, 5, 4), ("a", None, 5)] + rows[:50]
    df = _frame(spark, rows).repartition(6)
    want = _plain_sessions(rows, 10)
    assert _seen(gap_sessions(df, "k", "t", 10, _measures(), part_rows=200), 10) == want
    assert _seen(windows.sessions(df, "k", "t", 10, _measures()), 10) == want
    clash = df.withColumn("begin", F.lit(1)).withColumn("session_start", F.lit(2))
    assert _seen(gap_sessions(clash, "k", "t", 10, _measures(), part_rows=200), 10) == want
    assert gap_sessions(df.where("false"), "k", "t", 10, _measures()).count() == 0


class Deliveries:
    """A folder of rows read as a stream; each run takes what is new."""

    def __init__(self, spark, schema, give):
        self.spark, self.schema, self.give = spark, schema, give
        self.source, self.out, self.mark = (scratch_path(spark, x) for x in ("rows", "windows", "mark"))

    def run(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.source)
        stream = self.give(self.spark.readStream.schema(self.schema).parquet(self.source))
        sinks.run_to_end(sinks.to_files(stream, self.out, self.mark, once=True))
        return self.spark.read.schema(stream.schema).parquet(self.out)


def test_a_bridge_joins_open_sessions_after_a_restart(spark):
    feed = Deliveries(spark, "k string, t timestamp, id long",
                      lambda s: windows.sessions(s, "k", "t", 10, _measures(), delay_seconds=30))
    assert feed.run([("a", _at(0), 1), ("a", _at(20), 2), ("b", _at(1), 3)]).count() == 0
    assert feed.run([("a", _at(10), 4)]).count() == 0  # late, but within the delay: one session of three rows
    got = feed.run([("c", _at(100), 5)])
    assert _seen(got, 10) == [("a", 0, 20, 3), ("b", 1, 1, 1)]
    assert _seen(feed.run([("a", _at(5), 6), ("c", _at(300), 7)]), 10) == [
        ("a", 0, 20, 3), ("b", 1, 1, 1), ("c", 100, 100, 1)]  # given out once, the row after that is late


def test_routes_by_lateness(spark):
    rows = [(1, _at(0), _at(60)), (2, _at(0), _at(61)), (3, _at(1), _at(0)), (4, None, _at(0)), (5, _at(0), None), (6, _at(0), _at(0))]
    df = spark.createDataFrame(rows, "id int, t timestamp, arrival timestamp")
    routes = windows.by_lateness(df, "t", "arrival", 60).orderBy("id")
    assert [r.route for r in routes.collect()] == ["ok", "late", "ahead", "reject", "reject", "ok"]


def test_no_row_on_the_ok_route_is_dropped(spark):
    rng = random.Random(2)
    schema = "k string, t timestamp, id long, arrival timestamp"
    rows = sorted(((rng.choice("xy"), a - rng.choice([0, 3, 30, 59, 60, 61, 500]), i, a)
                   for i, a in enumerate(sorted(rng.randint(0, 3000) for _ in range(400)))), key=lambda r: r[3])

    def counts(stream):
        return windows.window_counts(windows.by_lateness(stream, "t", "arrival", 60).where("route = 'ok'"),
                                     ["k"], "t", "1 minute", 60)

    feed = Deliveries(spark, schema, counts)
    for i in range(0, 400, 100):
        feed.run([(k, _at(t), n, _at(a)) for k, t, n, a in rows[i:i + 100]])
    got = feed.run([("end", _at(10000), 999, _at(10000))]).where("k <> 'end'")
    assert got.agg(F.sum("row_count")).first()[0] == sum(a - t <= 60 for _, t, _, a in rows)


def _plain_bans(rows):
    length, out = {"P0": 365, "P1": 60}, []
    for user in sorted({u for u, t, g in rows if u is not None and t is not None and g in length}):
        run = None
        for t, g in sorted((t, g) for u, t, g in rows if u == user and t is not None and g in length):
            if run and t <= run[1]:
                run = (run[0], max(run[1], t + length[g]), min(run[2], g), run[3] + 1)
            else:
                out += [(user, *run)] if run else []
                run = (t, t + length[g], g, 1)
        out.append((user, *run))
    return out


def _bans(found):
    day = timedelta(days=1)
    return sorted((r.user_id, (r.banned_from - BASE) / day, (r.expires - BASE) / day, r.worst_grade, r.offences)
                  for r in found.collect())


BAN_SCHEMA = "user_id long, offended_at timestamp, grade string"


def _offences(rows):
    return [(u, None if t is None else BASE + timedelta(days=t), g) for u, t, g in rows]


def test_bans_of_a_table(spark):
    rng = random.Random(5)
    rows = [(1, rng.randint(0, 40000) / 8, rng.choice(["P1", "P2"])) for _ in range(3000)]  # a hot user
    rows += [(rng.randint(2, 9), rng.randint(0, 24000) / 8, rng.choice(["P0", "P1", "P2", None])) for _ in range(150)]
    rows += [(20, 0.0, "P0"), (20, 1.0, "P1"), (20, 365.0, "P1"), (20, 425.125, "P1"), (None, 1.0, "P0"), (21, None, "P0"), (22, 1.0, "P2")]
    assert _bans(windows.ban_periods(spark.createDataFrame(_offences(rows), BAN_SCHEMA).repartition(5))) == _plain_bans(rows)


def test_a_ban_expires_in_the_stream_and_survives_a_restart(spark):
    feed = Deliveries(spark, BAN_SCHEMA, lambda s: windows.ban_periods(s, delay_seconds=60))
    assert feed.run(_offences([(1, 0.0, "P1"), (2, 0.0, "P0"), (3, 0.0, "P2"), (1, 1.0, "P1")])).count() == 0
    # Prolonged once: 60 days from day 50; the longer ban of user 2 is not cut by a shorter one.
    assert feed.run(_offences([(1, 50.0, "P1"), (2, 100.0, "P1")])).count() == 0
    assert _bans(feed.run(_offences([(4, 111.0, "P1")]))) == [(1, 0.0, 110.0, "P1", 3)]
    assert _bans(feed.run(_offences([(1, 150.0, "P0"), (5, 600.0, "P1")]))) == [
        (1, 0.0, 110.0, "P1", 3), (1, 150.0, 515.0, "P0", 1), (2, 0.0, 365.0, "P0", 2), (4, 111.0, 171.0, "P1", 1)]


def _contained(texts, words):
    listed = {w.lower() for w in words if w}
    return sorted({(k, w) for k, t in texts if k is not None and t is not None for w in listed if w in t.lower()})


def test_words_inside_texts_equal_a_search_of_every_word(spark):
    rng = random.Random(3)

    def some(n):
        return "".join(rng.choice("abcß😀 .é\n") for _ in range(n))

    texts = [(i, some(rng.choice([0, 1, 3, 40, 400]))) for i in range(60)]
    texts += [(100, some(9000)), (None, "abc"), (101, None), (1, some(30)), texts[5], (102, "x" * 63 + "Needle" + "y" * 70)]
    words = [some(rng.randint(1, 6)) for _ in range(300)] + ["", None, "NEEDLE", "needle", "n" * 90, "a", "😀", "$%("]
    t = spark.createDataFrame(texts, "part long, text string").withColumn("word", F.lit("mine"))
    w = spark.createDataFrame([(x,) for x in words], "word string")
    for gram, piece in ((4, 64), (2, 1024)):
        got = words_inside(t, w, "part", "text", gram=gram, piece=piece)
        assert sorted(map(tuple, got.collect())) == _contained(texts, words)
    assert words_inside(t, w.where("false"), "part", "text").count() == 0
    assert words_inside(t.where("false"), w, "part", "text").count() == 0


def test_a_million_words_and_a_long_text(spark):
    n = 1_000_000
    listed = spark.range(n).select(F.substring(F.md5(F.col("id").cast("string")), 1, 9).alias("word"))
    planted = [r.word for r in listed.limit(40).collect()]
    texts = [(i, f"lorem{w}ipsum" * 3) for i, w in enumerate(planted[:30])]
    texts.append((99, "dolor sit " * 50_000 + planted[35] + " amet" * 50_000))
    found = words_inside(spark.createDataFrame(texts, "id int, text string"), listed, "id", "text")
    got = {tuple(r) for r in found.collect()}
    assert got >= {(i, w) for i, w in enumerate(planted[:30])} | {(99, planted[35])}
    assert all(w in dict(texts)[i] for i, w in got)


def test_a_word_with_two_grades_has_its_strongest(spark):
    words = spark.createDataFrame([("bad", "P2"), ("BAD", "P1"), ("worse", "P0")], "word string, grade string")
    texts = spark.createDataFrame([(1, "unBADly"), (2, "good"), (3, "worsened, bad")], "comment_id int, review_text string")
    assert sorted(map(tuple, grade_inside(texts, words).collect())) == [(1, "P1"), (3, "P0")]


def test_no_pair_join_in_the_plan(spark):
    texts = spark.range(100).select(F.col("id"), F.lit("some text").alias("text"))
    words = spark.range(100).select(F.concat(F.lit("word"), "id").alias("word"))
    plan = words_inside(texts, words, "id", "text")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
