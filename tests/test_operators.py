import random
from datetime import date

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemart.functions import keys, text
from tidemart.functions.days import (
    SECONDS_LIMIT, day_bucket, day_numbers, day_part, horizon_start, shift, shop_time)
from tidemart.functions.money import mean_floor, money, ratio
from tidemart.operators import cells, exact, horizons, lookup, merging, ranking


def one(df):
    return df.collect()[0]


# ---- ranks and successors ---------------------------------------------------------------------

def test_top_ranks_keeps_ties(spark):
    rows = [("a", "p1", 9), ("a", "p2", 7), ("a", "p3", 5), ("a", "p4", 5), ("a", "p5", 1),
            (None, "p6", 2), (None, "p7", 3)]
    df = spark.createDataFrame(rows, "g string, p string, n bigint")
    got = {(r.p, r.rk) for r in ranking.top_ranks(df, ["g"], "n", 3).collect()}
    assert got == {("p1", 1), ("p2", 2), ("p3", 3), ("p4", 3), ("p7", 1), ("p6", 2)}


def test_top_ranks_equals_plain_rank_on_hot_group(spark):
    rnd = random.Random(7)
    rows = [("hot" if rnd.random() < 0.5 else f"g{rnd.randrange(20)}", i, rnd.randrange(6))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, p bigint, n bigint")
    order = Window.partitionBy("g").orderBy(F.col("n").desc())
    plain = df.withColumn("rk", F.rank().over(order)).where("rk <= 3")
    ours = ranking.top_ranks(df, ["g"], "n", 3)
    assert (sorted((r.g, r.p, r.n, r.rk) for r in ours.collect())
            == sorted((r.g, r.p, r.n, r.rk) for r in plain.collect()))


def test_top_ranks_does_not_shuffle_whole_groups(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("n"))
    plan = ranking.top_ranks(df, ["g"], "n", 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_next_values_across_slices(spark):
    rnd = random.Random(3)
    rows = [("hot" if rnd.random() < 0.6 else f"s{rnd.randrange(30)}",
             rnd.randrange(0, 3_000_000), i, rnd.choice(["a", "b", None])) for i in range(2000)]
    df = spark.createDataFrame(rows, "s string, ts bigint, id bigint, v string")
    order = Window.partitionBy("s").orderBy("ts", "id")
    plain = df.select("id", F.lead("v", 1).over(order).alias("n1"),
                      F.lead("v", 2).over(order).alias("n2"), F.lead("v", 3).over(order).alias("n3"))
    expected = sorted(map(tuple, plain.collect()), key=lambda r: r[0])
    for slice_rows in (1, 2, 50, 10_000):
        ours = ranking.next_values(df, ["s"], "ts", "id", "v", ["n1", "n2", "n3"], slice_rows)
        got = sorted(map(tuple, ours.select("id", "n1", "n2", "n3").collect()),
                     key=lambda r: r[0])
        assert got == expected


def test_a_dense_sequence_is_spread(spark):
    """One session within one second: no task gets more than its slice."""
    df = spark.range(20_000).select(F.lit("s").alias("s"), F.lit(5).cast("bigint").alias("ts"),
                                    "id", (F.col("id") * 2).alias("v"))
    ours = ranking.next_values(df, ["s"], "ts", "id", "v", ["n1"], slice_rows=500)
    assert ours.where("n1 = v + 2").count() == 19_999
    assert "__slice" in ours._jdf.queryExecution().optimizedPlan().toString()
    assert [r.place for r in ours.where("id in (0, 777, 19999)").orderBy("id").collect()] == [0, 777, 19_999]


def test_first_and_latest_rows(spark):
    df = spark.createDataFrame([("a", 10, 1, "x"), ("a", 9, 2, "y"), ("a", 10, 3, "z"),
                                ("b", 1, 4, None)], "k string, ts bigint, id bigint, v string")
    first = {r.k: r.v for r in ranking.first_rows(df, ["k"], ["ts", "id"]).collect()}
    last = {r.k: r.v for r in ranking.latest_rows(df, ["k"], ["ts", "id"]).collect()}
    assert first == {"a": "y", "b": None}
    assert last == {"a": "z", "b": None}


def test_lead_default(spark):
    df = spark.createDataFrame([(1, "2024-01-01"), (1, "2024-01-02"), (1, "2024-01-04")],
                               "u int, ds string")
    got = [r.x for r in ranking.lead_within(df, ["u"], ["ds"], "ds", 2, "9999-12-31", "x")
           .orderBy("ds").collect()]
    assert got == ["2024-01-04", "9999-12-31", "9999-12-31"]


# ---- lookups, merging, cells ------------------------------------------------------------------

def test_membership(spark):
    words = spark.createDataFrame([("bad",), ("good",), ("",), (None,)], "w string")
    members = spark.createDataFrame([("bad",), ("bad",), ("",)], "m string")
    flags = {r.w: r.is_member for r in lookup.member_flags(words, "w", members, "m").collect()}
    assert flags == {"bad": True, "good": False, "": False, None: False}
    assert [r.w for r in lookup.only_members(words, "w", members, "m").collect()] == ["bad"]
    empty = members.where("false")
    assert not any(r.is_member for r in lookup.member_flags(words, "w", empty, "m").collect())


def test_decode_respects_parent(spark):
    dic = spark.createDataFrame([("1", "one", "A"), ("1", "uno", "B")],
                                "dic_code string, dic_name string, parent_code string")
    df = spark.createDataFrame([("1",), ("2",), (None,)], "c string")
    got = {r.c: r.n for r in lookup.decode(df, "c", dic, "B", "n").collect()}
    assert got == {"1": "uno", "2": None, None: None}


def test_union_distinct_is_idempotent(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([("y", 2), ("z", 3)], "v string, k int")
    once = merging.union_distinct(a, b)
    twice = merging.union_distinct(once, b)
    assert sorted(map(tuple, once.select("k", "v").collect())) == [(1, "x"), (2, "y"), (3, "z")]
    assert sorted(map(tuple, twice.select("k", "v").collect())) == [(1, "x"), (2, "y"), (3, "z")]


def test_merge_validity(spark):
    old = spark.createDataFrame(
        [(1, "a", None, "2024-01-01"), (2, "b", "m", "2024-01-01"), (3, "c", None, "2024-01-01")],
        "id int, name string, mail string, start_date string")
    changed = spark.createDataFrame([(2, "b2", "m"), (3, "c", None), (4, "d", None)],
                                    "id int, name string, mail string")
    got = {(r.id, r.name, r.start_date, r.end_date, r.ds)
           for r in merging.merge_validity(old, changed, "id", "2024-02-01").collect()}
    far = "9999-12-31"
    assert got == {
        (1, "a", "2024-01-01", far, far),
        (2, "b", "2024-01-01", "2024-01-31", "2024-01-31"),
        (2, "b2", "2024-02-01", far, far),
        (3, "c", "2024-01-01", far, far),  # changed row without a difference
        (4, "d", "2024-02-01", far, far)}


def test_sum_branches(spark):
    a, b = spark.range(3).agg(F.count("*").alias("x")), spark.range(0).agg(F.count("*").alias("y"))
    assert tuple(one(merging.sum_branches([a, b], ["x", "y", "z"]))) == (3, 0, 0)


def test_cells_round_trip(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", 5)], "k int, name string, n int")
    long = cells.rows_to_cells(df, F.col("k").cast("string"), skip=("k",))
    assert long.count() == 3
    rows = {r.row_key: r.row_json for r in cells.cells_to_rows(long).collect()}
    assert rows == {"1": '{"row_key":"1","name":"a"}',
                    "2": '{"row_key":"2","n":"5","name":"b"}'}
    assert [r.row_key for r in cells.cells_to_rows(long, limit=1).collect()] == ["1"]
    assert one(cells.count_rows(long)).row_count == 2
    assert cells.one_row(long, "2").count() == 2


def test_by_horizon_and_fan_out(spark):
    df = spark.createDataFrame([("c", 1, 2)], "k string, a int, b int")
    rows = horizons.by_horizon(df, ["k"], {7: {"n": F.col("a")}, 30: {"n": F.col("b")}})
    assert sorted(map(tuple, rows.collect())) == [("c", 7, 1), ("c", 30, 2)]
    assert horizons.fan_out(df, (1, 7, 30)).count() == 3


# ---- expressions ------------------------------------------------------------------------------

def test_days():
    assert shift("2024-03-01", -1) == "2024-02-29"
    assert horizon_start("2024-01-01", 7) == "2023-12-26"


def test_day_numbers(spark):
    df = spark.createDataFrame([(date(2023, 12, 30), date(2024, 1, 1)),
                                (date(2024, 1, 2), date(2024, 1, 1))], "a date, b date")
    got = [r.d for r in df.select(day_numbers(F.col("a"), F.col("b")).alias("d")).collect()]
    assert got == [[20231230, 20231231, 20240101], []]


def test_day_bucket_seconds_and_millis(spark):
    df = spark.createDataFrame([(SECONDS_LIMIT - 1,), (SECONDS_LIMIT,), (1_704_067_200,),
                                (1_704_067_200_000,), (None,)], "t bigint")
    got = [r.b for r in df.select(day_bucket(F.col("t")).alias("b")).collect()]
    assert got == ["day=22861120", "day=19700426", "day=20240101", "day=20240101",
                   "error_bucket"]


def test_shop_time_crosses_midnight(spark):
    df = spark.createDataFrame([(1_704_124_800_000,)], "t bigint")  # 2024-01-01 16:00 UTC
    row = one(df.select(shop_time(F.col("t")).cast("string").alias("s"),
                        day_part(shop_time(F.col("t"))).alias("p")))
    assert (row.s, row.p) == ("2024-01-02 00:00:00", "night")


def test_ratio_and_mean(spark):
    df = spark.createDataFrame([(1, 8), (57, 200), (0, 0), (5, 0)], "a bigint, b bigint")
    got = [(None if r.q is None else str(r.q), r.m) for r in df.select(
        ratio(F.col("a"), F.col("b")).alias("q"),
        mean_floor(F.col("b"), F.col("a")).alias("m")).collect()]
    assert got == [("0.13", 8), ("0.29", 3), (None, None), (None, 0)]


def test_masking(spark):
    df = spark.createDataFrame(
        [("Ann", "13800001111", "a-b@x.example.com"), ("B", "12345678901", "no-at-sign"),
         (None, None, None), ("", "138000011112", "a@b")], "n string, p string, e string")
    got = [tuple(r) for r in df.select(text.mask_name(F.col("n")), text.mask_phone(F.col("p")),
                                       text.mask_email(F.col("e"))).collect()]
    assert got == [("A*", "138*", "*@x.example.com"), ("B*", None, None), (None, None, None),
                   ("*", None, None)]


def test_product_name(spark):
    df = spark.createDataFrame(
        [("acme丨Trail Runner 2 男士跑鞋 轻量 X9 白/黑 42",), ("plain name",),
         ("brand丨only latin",)], "n string")
    got = [tuple(r.p) for r in df.select(text.product_name_parts(F.col("n")).alias("p")).collect()]
    assert got == [("acme丨Trail Runner 2", "Trail Runner 2", "男士跑鞋 轻量 X9 白/黑 42"),
                   (None, None, "plain name"), (None, None, "brand丨only latin")]


def test_blank_and_permitted(spark):
    df = spark.createDataFrame([("",), (" \t\n",), (None,), ("好评a1#",), ("a b",), ("（x）",),
                                ("abc\n",)], "s string")
    got = [tuple(r) for r in df.select(text.is_blank(F.col("s")),
                                       text.is_permitted(F.col("s"))).collect()]
    assert got == [(True, False), (True, False), (True, False), (False, True), (False, False),
                   (False, True), (False, False)]


def test_camel_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "order_id int, NAME int, split_total_amount int")
    assert text.camel_columns(df).columns == ["orderId", "name", "splitTotalAmount"]


def test_hash_buckets(spark):
    import hashlib
    values = ["a", "42", "0xDAC17F958D2EE523A2206206994597C13D831EC7"]
    df = spark.createDataFrame([(v,) for v in values], "k string")
    plain = [r.b for r in df.select(keys.hash_bucket(F.col("k"), 100).alias("b")).collect()]
    assert plain == [f"{int(hashlib.md5(v.encode()).hexdigest()[-3:], 16) % 100:04d}"
                     for v in values]
    hot = [r.b for r in df.select(keys.spread_bucket(F.col("k")).alias("b")).collect()]
    assert hot[2] == "9002"
    assert hot[0] == f"{int(hashlib.md5(b'a').hexdigest()[-3:], 16) % 128:04d}"


def test_token_amount(spark):
    big = "1" + "7f" * 60
    cases = {"0x0": "0", "0xff": "255", "0x" + "f" * 16: str(2**64 - 1), "0x" + "f" * 64: str(2**256 - 1),
             "0x" + "0" * 48 + "0de0b6b3a7640000": str(10**18), "0XfF": "255", "0x" + big: str(int(big, 16)),
             "12": "12", "0012": "12", "9" * 50: "9" * 50, "0xzz": None, "1.5": None, "-3": None, "": None,
             "0x": None, "1\n": None, None: "0"}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: r.a for r in df.select("t", keys.token_amount(F.col("t")).alias("a")).collect()}
    assert got == cases
    units = {"1500000000000000000": "1.500000000000000000", "1": "0.000000000000000001",
             "0x" + "f" * 64: f"{str(2**256 - 1)[:-18]}.{str(2**256 - 1)[-18:]}"}
    df = spark.createDataFrame([(k,) for k in units], "t string")
    assert {r.t: r.a for r in df.select("t", keys.token_amount(F.col("t"), in_units=True).alias("a"))
            .collect()} == units


def test_exact_sums(spark):
    import random
    rng = random.Random(3)
    values = [str(rng.getrandbits(rng.choice([3, 30, 64, 256, 400]))) for _ in range(300)] + [None, "0"]
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values)] + [(None, "7"), (9, None)],
                               "g int, a string")
    got = {r.g: (r.a, r.n) for r in exact.sum_texts(df, ["g"], "a", F.count("*").alias("n")).collect()}
    want = {g: (str(sum(int(v or 0) for v in values[g::3])), len(values[g::3])) for g in range(3)}
    assert got == {**want, None: ("7", 1), 9: (None, 1)}


def test_log_words(spark):
    w1, w2 = "a" * 64, "b" * 64
    df = spark.createDataFrame([("0x" + w1 + w2,), ("0x" + w1 + "b" * 10,), ("",), (None,)],
                               "d string")
    got = [r.w for r in df.select(keys.log_words(F.col("d")).alias("w")).collect()]
    assert got == [["0x" + w1, "0x" + w2], ["0x" + w1], [], []]


def test_history_append(spark):
    df = spark.createDataFrame([('["a"]', "b"), (None, "c"), ('["a","b"', "c"), ("no list", "c")],
                               "h string, e string")
    got = [r.h for r in df.select(keys.history_append(F.col("h"), F.col("e")).alias("h")).collect()]
    assert got == ['["a","b"]', '["c"]', None, None]


def test_row_key(spark):
    import hashlib
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    digest = hashlib.md5(b"1").hexdigest()
    row = one(df.select(keys.row_key([("a", True), "b"], "_").alias("k"),
                        keys.row_key(["a", "b"], "", digest=True).alias("d")))
    assert row.k == f"{digest}_x"
    assert row.d == hashlib.md5(b"1x").hexdigest()
    pairs = spark.createDataFrame([(None, "x"), ("x", None)], "a string, b string")
    assert len({r.k for r in pairs.select(keys.row_key(["a", "b"], "_").alias("k")).collect()}) == 2


def test_mean_floor_is_exact(spark):
    row = one(spark.range(1).select(mean_floor(F.lit(2**60 + 7), F.lit(1)).alias("m"),
                                    mean_floor(F.lit(5), F.lit(0)).alias("z")))
    assert (row.m, row.z) == (2**60 + 7, None)


def test_many_buckets(spark):
    got = {r.b for r in spark.range(20_000).select(
        keys.hash_bucket(F.col("id"), 10_000).alias("b")).collect()}
    assert len(got) > 8_000


def test_money_is_exact(spark):
    assert str(one(spark.range(1).select(money(F.lit("0.125")).alias("m"))).m) == "0.13"
