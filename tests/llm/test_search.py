"""Exact and approximate vector search against brute force."""

import math
from collections import defaultdict

import numpy as np
import pytest

from tidemart.llm import ann
from tidemart.llm.ann import Centroids, nearest
from tidemart.llm.queries import QUERIES
from tidemart.llm.topk import BallTree, top_k
from tidemart.llm.vectors import Top

SCHEMA = "vec_id long, embedding array<float>, rank int, score string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x") for i, v in rows], SCHEMA)


def exact(rows, k, step, whole):
    """Brute force over usable rows: (query_id, rank) -> (vec_id, score)."""
    good = [(i, np.asarray(v, np.float32).astype(float)) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    if whole:
        good = [(i, np.floor(64 * v)) for i, v in good]
    else:
        good = [(i, v) for i, v in good if v.any()]
    out = []
    for at, (q, vec) in enumerate(good):
        if q % step == 0:
            found = sorted((-float(vec @ v), i) for j, (i, v) in enumerate(good)
                           if j != at and len(v) == len(vec))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


def odd_rows(seed=0, count=150, size=8):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=size).round(2).tolist()) for i in range(count)]
    rows += [(i + 1000, rows[5][1]) for i in range(60)]  # a large group of equal vectors
    rows += [(2000, None), (2001, []), (2002, [1.0, None] * 4), (2003, [float("nan")] * size),
             (2004, [float("inf")] * size), (2005, [0.0] * size), (None, [1.0] * size)]
    return rows


@pytest.mark.parametrize("shard_rows", [40, 4096])
def test_top_k_equals_brute_force(spark, shard_rows):
    rows = odd_rows()
    got = top_k(table(spark, rows), k=7, step=10, shard_rows=shard_rows, block_rows=8).collect()
    assert sorted(tuple(r) for r in got) == exact(rows, 7, 10, True)


def test_top_k_few_rows_other_lengths_repeats(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0, 0.0]), (2, [1.0]), (20, [3.0])]
    got = sorted(tuple(r) for r in top_k(table(spark, rows), k=3, step=10).collect())
    assert got == exact(rows, 3, 10, True)


def test_top_k_beyond_double(spark):
    rows = [(0, [2.0 ** 40, 3.0]), (1, [1.0, 5.0]), (2, [2.0 ** 20, 1.0])]
    got = [tuple(r) for r in top_k(table(spark, rows), k=2, step=10).collect()]
    big = (1 << 46) * (1 << 26) + 192 * 64
    assert sorted(got) == [(0, 1, 2, min(big, 2 ** 63 - 1)), (0, 2, 1, (1 << 46) * 64 + 192 * 320)]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert top_k(empty).count() == 0
    assert nearest(empty).count() == 0
    assert nearest(table(spark, [(1, [0.0]), (2, None)])).count() == 0


def test_ball_tree_bounds_hold():
    rng = np.random.default_rng(1)
    points, queries = rng.normal(size=(300, 5)), rng.normal(size=(9, 5))
    tree = BallTree(points, leaf=16)
    bounds = tree.bounds(queries)
    for node, rows in tree.leaves:
        assert (bounds[:, node] >= (queries @ points[rows].T).max(axis=1)).all()
    top = Top(np.arange(9) + 1000, 4, np.full(9, np.nan))
    tree.search(queries, points, np.arange(300), np.arange(300), top, np.arange(9))
    want = np.sort(queries @ points.T, axis=1)[:, ::-1][:, :4]
    assert np.allclose(top.scores, want)


def test_nearest_is_exact_where_few_lists_are(spark):
    rows = odd_rows(3)
    got = sorted(tuple(r) for r in nearest(table(spark, rows), k=5, step=10).collect())
    want = exact(rows, 5, 10, False)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want])


def test_nearest_keeps_vectors_of_every_length(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST_ROWS", 100)  # 300 and 250 rows have an index, 60 and 1 none
    rng = np.random.default_rng(7)
    rows, at = [], 0
    for d, n in ((6, 300), (3, 250), (4, 60), (2, 1)):
        rows += [(at + i, rng.normal(size=d).tolist()) for i in range(n)]
        at += n
    rows += [(10, None), (20, [0.0, 0.0]), (1000, rows[0][1])]
    got = defaultdict(list)
    for r in nearest(table(spark, rows), k=5, step=10, target=1.0).collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    hits = wanted = 0
    usable = [(i, np.array(v)) for i, v in rows if v is not None and any(v)]
    for q, v in usable:
        if q % 10 == 0:
            best = sorted(((-float(v @ w), i) for i, w in usable if i != q and len(w) == len(v)))[:5]
            hits += len({i for _, i in best} & {i for i, _ in got[q]})
            wanted += len(best)
    assert hits >= 0.95 * wanted and not got[610]


def test_graph_finds_all_lists_in_the_ratio():
    rng = np.random.default_rng(2)
    index = Centroids(rng.normal(size=(3000, 6)), 64, 6.0)
    assert len(index.centres) == 64
    missed = total = 0
    for q in rng.normal(size=(50, 6)):
        point = np.append(q, 0.0)
        far = np.sqrt(((index.centres - point) ** 2).sum(axis=1))
        want = set(np.flatnonzero(far <= far.min() * 1.2).tolist())
        missed += len(want - set(index.near(point, 1.2)[0].tolist()))
        total += len(want)
    assert missed <= 0.02 * total


def test_nearest_recall(spark):
    folder = "/root/testdata/sf0.1"
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select(
        "vec_id", "embedding").collect()]
    got = {(r["query_id"], r["vec_id"]) for r in QUERIES["op7_nearest"](spark, folder).collect()}
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    hits = wanted = 0
    for at in np.flatnonzero(ids % 20 == 0):
        score = x @ x[at]
        score[at] = -np.inf
        best = ids[np.lexsort((ids, -score))[:20]]
        hits += sum((ids[at], b) in got for b in best)
        wanted += 20
    assert hits / wanted >= 0.9
