"""Frequent sequences against brute force, with a hot group."""

import random
from itertools import product

from tidemart.operators.sequences import frequent_sequences
from tidemart.plans import behaviour

SCHEMA = "sid string, ts long, id long, page string, path string"


def holds(pages, wanted):
    rest = iter(pages)
    return all(w in rest for w in wanted)


def brute(rows, one_in, longest):
    """Every sequence over all pages, however rare its parts are."""
    groups = {}
    for r in sorted((r for r in rows if None not in (r[0], r[1], r[3])), key=lambda r: (r[0], r[1], r[2], r[3])):
        groups.setdefault(r[0], []).append(r[3])
    pages = sorted({p for g in groups.values() for p in g})
    out = {}
    for n in range(1, longest + 1):
        for wanted in product(pages, repeat=n):
            support = sum(holds(g, wanted) for g in groups.values())
            if support and support * one_in >= len(groups):
                out[wanted] = support
    return out


def result(df):
    rows = df.collect()
    assert all(len(r.path) == r.length for r in rows)
    out = {tuple(r.path): r.support for r in rows}
    assert len(out) == len(rows)
    return out


def test_support_equals_brute_force_with_a_hot_group_and_ties(spark):
    rng = random.Random(8)
    rows = [("hot", rng.randint(0, 40), i, rng.choice("abcd"), "x") for i in range(400)]
    rows += [(f"s{rng.randint(0, 60)}", rng.randint(0, 5), i, rng.choice("aaabbcd"), "y") for i in range(400, 800)]
    rows += [(None, 1, 900, "a", "z"), ("s1", None, 901, "b", "z"), ("s2", 3, 902, None, "z"), ("only", 1, 903, None, "z")]
    rows += rows[395:420]  # repeated rows
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = result(frequent_sequences(df, "sid", "ts", "id", "page", one_in=5, longest=4, part_rows=50))
    assert got == brute(rows, 5, 4)
    assert max(map(len, got)) == 4


def test_grows_until_nothing_is_frequent(spark):
    rows = [(f"s{i}", t, t, p, "x") for i in range(9) for t, p in enumerate("abcabcab" if i < 4 else "ba")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = result(frequent_sequences(df, "sid", "ts", "id", "page", one_in=3))
    assert got == brute(rows, 3, 8)
    assert got[tuple("abcabcab")] == 4 and got["b", "a"] == 9
    assert set(result(frequent_sequences(df, "sid", "ts", "id", "page", one_in=1))) == {("a",), ("b",), ("b", "a")}
    assert frequent_sequences(df.where("false"), "sid", "ts", "id", "page", one_in=3).count() == 0


def test_a_hot_group_is_spread(spark):
    """400,000 views of one session beside 2,000 short ones: its views count once per path and are cut in ranges."""
    hot = spark.range(400_000).selectExpr("'hot' sid", "id ts", "id", "concat('p', pmod(xxhash64(id), 6)) page")
    rest = spark.range(6000).selectExpr("concat('s', id % 2000) sid", "id ts", "id", "concat('p', id div 2000) page")
    got = result(frequent_sequences(hot.union(rest), "sid", "ts", "id", "page", one_in=10, longest=3))
    assert got == {("p0",): 2001, ("p1",): 2001, ("p2",): 2001, ("p0", "p1"): 2001, ("p0", "p2"): 2001,
                   ("p1", "p2"): 2001, ("p0", "p1", "p2"): 2001}


def test_paths_of_a_log_with_gaps(spark):
    line = '{"common":{"sid":"%s"},"page":{"page_id":"%s"},"ts":%d}'
    pages = {"s1": ["home", "cart", "order"], "s2": ["home", "search", "cart"], "s3": ["cart"]}
    lines = [line % (s, p, 1704100000000 + i) for s, ps in pages.items() for i, p in enumerate(ps)]
    log = spark.createDataFrame([(i, text) for i, text in enumerate(lines)], "id long, log string")
    got = {(r.path, r.page_count, r.session_count) for r in behaviour.frequent_paths(log, one_in=2).collect()}
    assert got == {("home", 1, 2), ("cart", 1, 3), ("home>cart", 2, 2)}
