"""Point-in-time join, histories in any order of delivery, snapshot differences."""

import random

from pyspark.sql import functions as F

from tidemart.operators import history


def test_as_of_with_a_hot_key_and_versions_out_of_order(spark):
    rng = random.Random(4)
    versions = [("hot", rng.randint(0, 400), i, f"v{i}") for i in range(300)]
    versions += [(k, rng.randint(0, 400), 1000 + i, f"w{i}") for i, k in enumerate("aabbc")] + [(None, 5, 1, "n")]
    facts = [("hot", rng.randint(-5, 420), i) for i in range(900)]
    facts += [(rng.choice(["a", "b", "c", "none", None]), rng.choice([None, 3, 200, 401]), i) for i in range(900, 960)]
    facts += facts[:5]  # repeated rows
    v = spark.createDataFrame(versions, "k string, since int, seq int, name string").repartition(5)
    f = spark.createDataFrame(facts, "k string, at int, id int").withColumn("side", F.lit("mine"))
    got = history.as_of(f, v, "k", "at", ["since", "seq"], ["name"], part_rows=60)
    assert got.columns == ["k", "at", "id", "side", "name"]

    def held(k, at):
        found = [x for x in versions if k is not None and at is not None and x[0] == k and x[1] <= at]
        return max(found, key=lambda x: x[1:3])[3] if found else None

    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr((k, at, i, "mine", held(k, at))) for k, at, i in facts)
    assert history.as_of(f, v.where("false"), "k", "at", ["since", "seq"], ["name"]).where("name IS NULL").count() == len(facts)
    assert "BroadcastNestedLoopJoin" not in got._jdf.queryExecution().toString()


def test_any_order_of_deliveries_gives_the_same_history(spark):
    rng = random.Random(1)
    rows = [(k, f"2024-01-{rng.randint(1, 28):02d}", n, rng.choice(["x", "y", None])) for n in range(120) for k in (1, rng.randint(2, 4))]
    log = spark.createDataFrame(rows, "id int, start_date string, n int, level string")
    want = sorted(map(repr, history.history_of(log, "id", ["level"], "n").collect()))
    for seed in range(2):
        first = log.where(F.pmod(F.xxhash64(F.lit(seed), "id", "n"), F.lit(3)) > 0)
        late = log.where(F.pmod(F.xxhash64(F.lit(seed), "id", "n"), F.lit(3)) == 0)
        kept = history.history_of(first, "id", ["level"], "n")
        assert sorted(map(repr, history.revise_history(kept, first, late, "id", ["level"], "n").collect())) == want
    small = spark.createDataFrame([(1, "2024-01-01", 1, "a"), (1, "2024-01-05", 2, "a"), (1, "2024-01-03", 3, "b")],
                                  log.schema)
    got = [tuple(r) for r in history.history_of(small, "id", ["level"], "n").orderBy("start_date").collect()]
    assert got == [(1, "a", "2024-01-01", "2024-01-02"), (1, "b", "2024-01-03", "2024-01-04"),
                   (1, "a", "2024-01-05", "9999-12-31")]


def test_snapshot_changes(spark):
    schema = "id int, part string, v string"
    old = spark.createDataFrame([(i, "p", f"v{i}") for i in range(500)] + [(None, "q", None)], schema)
    new = spark.createDataFrame([(i, "p", f"v{i}") for i in range(3, 500)] + [(None, "q", "now"), (600, "p", None)],
                                schema).withColumn("v", F.when(F.col("id") == 7, None).otherwise(F.col("v")))
    got = {(r.id, r.part): r.change for r in history.snapshot_changes(old, new, ["id", "part"], 64).collect()}
    assert got == {**{(i, "p"): "D" for i in range(3)}, (7, "p"): "U", (None, "q"): "U", (600, "p"): "I"}
    assert history.snapshot_changes(old, old.repartition(3), ["id", "part"]).count() == 0
    assert history.snapshot_changes(old.limit(0), old, ["id", "part"]).count() == 501
