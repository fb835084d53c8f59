"""Ball trees and R-trees against brute force over all rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from inboxlens.llm import products
from inboxlens.llm.ball_tree import BallCells, BallTree, top_products
from inboxlens.llm.products import ANY, FAR, OTHER, SAME, best_first
from inboxlens.llm.rtree import BoxCells, RTree, hard_negatives

from .helpers import same_rows

KIND = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def rows_with_ties(n=700, dim=6, seed=1):
    """Clusters, many equal vectors (a third of all rows share one), many equal scores."""
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(8, dim)) / 2
    x = np.round((centers[rng.integers(8, size=n)] + rng.normal(size=(n, dim)) / 8) * 64) / 64
    x[rng.random(n) < 1 / 3] = x[0]
    return [(i, v.tolist(), int(rng.integers(4))) for i, v in enumerate(x.astype(np.float32))]


ODD = [(5000, None, 1), (5001, [None] * 6, 1), (5002, [NAN] + [1.0] * 5, 1), (5003, [INF] + [1.0] * 5, 1), (5004, [0.0] * 6, 1), (5050, [0.0] * 6, 1),
       (5005, [1.0, 2.0], 1), (5100, [2.0, 1.0], 2), (5006, [-1.0, 2.0], 2), (5007, [], 1), (5150, [], 2), (None, [1.0] * 6, 1), (5008, [1.0] * 6, None),
       (5009, [0.5] * 6, 1), (5009, [0.5] * 6, 1), (5200, [0.25] * 6, 3), (5200, [0.25] * 6, 3), (5250, [1.0] * 6, None)]


def usable(rows, labelled):
    out = set()
    for i, v, label in rows:
        if i is not None and v is not None and not any(c is None or not np.isfinite(c) for c in v) and not (labelled and label is None):
            out.add((i, tuple(int(np.floor(256 * float(np.float32(c)))) for c in v), label))
    return out


def ranked(query, rows):
    i, v, _ = query
    return sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w, _ in rows if j != i and len(w) == len(v))


def brute_products(rows, k):
    rows = {(i, v, None) for i, v, _ in usable(rows, False)}
    return [(q[0], r + 1, j, -s) for q in rows if q[0] % 50 == 0 for r, (s, j) in enumerate(ranked(q, rows)[:k])]


def brute_negatives(rows):
    rows, out = usable(rows, True), []
    for q in rows:
        if q[0] % 50 == 0:
            same, other = ([r for r in rows if (r[2] == q[2]) == want] for want in (True, False))
            negatives = ranked(q, other)
            for s, positive in ranked(q, same)[:5]:
                inside = [(-n, j) for n, j in negatives if 50 * -s <= 100 * -n <= 95 * -s]
                out += [(q[0], positive, r + 1, j, -s, n) for r, (n, j) in enumerate(inside[:3])]
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, KIND).repartition(5).withColumn("score", F.lit("clash")).withColumn("id", F.lit("clash")).withColumn("cell", F.lit(1))


@pytest.fixture
def tiny(monkeypatch):
    """Several cells, shards, blocks and merges."""
    for name, value in (("SHARD", 32), ("SAMPLE", 100), ("BLOCK", 4), ("MEET", 5), ("HELD", 16)):
        monkeypatch.setattr(products, name, value)


def test_top_products(spark, tiny):
    rows = rows_with_ties() + ODD
    df = table(spark, rows)
    got = top_products(df, df.where("vec_id % 50 = 0"))
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    same_rows(got.collect(), brute_products(rows, 5))


def test_hard_negatives(spark, tiny):
    rows = rows_with_ties(seed=2) + ODD
    df = table(spark, rows)
    got = hard_negatives(df, df.where("vec_id % 50 = 0"))
    expected = brute_negatives(rows)
    assert len(expected) > 50
    same_rows(got.collect(), expected)


def test_all_rows_ask_by_default(spark):
    rows = [(i, [float(i % 5), 1.0], i % 2) for i in range(30)]
    df = spark.createDataFrame(rows, KIND)
    assert top_products(df, k=2).groupBy("query_id").count().where("count = 2").count() == 30
    assert hard_negatives(df).select("anchor_id").distinct().count() > 0


def test_whole_numbers_beyond_float_range(spark):
    rows = [(0, [3e6, 1.0], 0), (1, [3e6, 2.0], 0), (2, [3e6, 3.0], 0), (3, [-3e6, 1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    same_rows(top_products(df, df.where("vec_id = 0"), 2).collect(),
              [(0, 1, 2, 768000000**2 + 256 * 768), (0, 2, 1, 768000000**2 + 256 * 512)])
    with pytest.raises(ValueError):
        top_products(spark.createDataFrame([(0, [1e9], 0)], KIND))


def test_empty_tables(spark):
    df = spark.createDataFrame([], KIND)
    assert top_products(df).count() == 0 and hard_negatives(df).count() == 0
    only = spark.createDataFrame([(0, [1.0], 1)], KIND)
    assert top_products(only).count() == 0 and hard_negatives(only).count() == 0
    assert top_products(only, only.limit(0)).count() == 0


@pytest.mark.parametrize("build", [lambda x, y: BallTree(x, y, 4), lambda x, y: RTree(x, y, 4, 3)])
def test_trees_hold_every_row_and_bound_its_score(build):
    rng = np.random.default_rng(3)
    for n in (1, 3, 4, 5, 61, 200):
        x, labels, q = rng.integers(-50, 50, (n, 5)).astype(float), rng.integers(0, 3, n), rng.integers(-50, 50, (7, 5)).astype(float)
        tree = build(x, labels)
        assert sorted(tree.order) == list(range(n))
        scores, (least, most) = x[tree.order] @ q.T, tree.bounds(q)

        def check(node):
            if tree.kids[node]:
                rows = [r for kid in tree.kids[node] for r in check(kid)]
            else:
                rows = list(range(*tree.spans[node]))
                assert 0 < len(rows) <= 4
            assert (scores[rows] >= least[node] - 1e-6).all() and (scores[rows] <= most[node] + 1e-6).all()
            if tree.labels():
                own = labels[tree.order][rows]
                assert (tree.labels()[0][node], tree.labels()[1][node]) == (own.min(), own.max())
            return rows

        assert sorted(check(0)) == list(range(n))


def test_far_nodes_are_passed_over():
    """Clusters far apart: a query reads the leaves of its own, whatever their number."""
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(50, 16)) * 1000
    x = np.floor(np.repeat(centers, 100, axis=0) + rng.normal(size=(5000, 16)))
    labels = np.repeat(np.arange(50), 100)
    q = x[::2500]
    for build, rule in ((BallTree, ANY), (RTree, ANY), (RTree, SAME)):
        tree, read = build(x, labels), []

        class Rows(np.ndarray):
            def __getitem__(self, at):
                if isinstance(at, slice):
                    read.append(at)
                return super().__getitem__(at)

        m = len(q)
        own = labels[tree.order]
        best_first(tree, tree.order, x[tree.order].view(Rows), own, q, labels[::2500], np.full(m, -FAR * 1.0), np.full(m, FAR * 1.0), np.full(m, -FAR * 1.0), 5, rule)
        assert 0 < len(read) < sum(not kids for kids in tree.kids) / 2, (build, rule)


def test_cells_hold_all_rows_and_a_hot_label():
    rng = random.Random(5)
    x = np.array([[rng.randrange(100), rng.randrange(5)] for _ in range(500)])
    labels = np.array([7 if i % 3 else i for i in range(500)])
    for cells in (BoxCells(2, x, labels, 16), BallCells(2, x, labels, 16)):
        cell = cells.assign(x, labels)
        assert len(set(cell.tolist())) > 4 and 0 <= cell.min() and cell.max() < 20
