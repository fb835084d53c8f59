import numpy as np
from pyspark.sql import functions as F

from inboxlens.llm import neighbours
from inboxlens.llm.neighbours import _placed, fitted_width, meeting, nearest, probe_sets

KIND = "vec_id long, embedding array<float>, label int"


def exact(ids, x, queries, k):
    out = {}
    for q in queries:
        score = x.astype(float) @ x[ids.index(q)].astype(float)
        order = sorted((-s, i) for s, i in zip(score, ids) if i != q)[:k]
        out[q] = [i for _, i in order]
    return out


def vectors(n=3000, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)).astype(np.float32)
    return x * rng.uniform(0.5, 1.5, (n, 1)).astype(np.float32)


def test_probe_order():
    sets = probe_sets(4, 20)
    assert sets[0] == () and sets[1] == (0,) and len(set(sets)) == 20
    assert all(7 - j not in s for s in sets for j in s)


def test_recall_and_exact_scores(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CHUNK", 64)
    x = vectors()
    ids = list(range(len(x)))
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in zip(ids, x)], KIND)
    got = nearest(df, df.where("vec_id % 50 = 0"), 10).collect()
    true = exact(ids, x, range(0, len(x), 50), 10)
    found = {q: [r for r in got if r.query_id == q] for q in true}
    assert np.mean([len({r.vec_id for r in found[q]} & set(true[q])) / 10 for q in true]) >= 0.9
    for q, rows in found.items():
        rows.sort(key=lambda r: r.rank)
        assert [r.rank for r in rows] == list(range(1, 11))
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        assert np.allclose([r.score for r in rows], [x[q].astype(float) @ x[r.vec_id].astype(float) for r in rows], rtol=1e-12)


def test_odd_rows_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [0.0, 0.0], 1), (3, None, 1), (4, [None, 1.0], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1),
            (7, [], 1), (8, [3.0, 1.0], 1), (8, [3.0, 1.0], 1), (None, [1.0, 1.0], 1), (9, [3.0, -1.0], 1), (10, [1.0, 0.0, 0.0], 1), (20, [0.0, 2.0], 1)]
    df = spark.createDataFrame(rows, KIND).withColumn("score", F.lit("clash"))
    got = nearest(df, df.where("vec_id % 20 = 0"), 20).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [
        (0, 1, 8, 3.0), (0, 2, 9, 3.0), (0, 3, 20, 0.0), (0, 4, 1, -1.0),
        (20, 1, 8, 2.0), (20, 2, 0, 0.0), (20, 3, 1, 0.0), (20, 4, 9, -2.0)]
    assert nearest(df.limit(0), df.limit(0)).count() == 0


def clustered(n, dim=16, size=40):
    """Clusters of 40 rows each, so a query's 20 nearest are close whatever n."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(n // size, dim))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    x = np.repeat(centres, size, axis=0) + rng.normal(scale=0.02, size=(n, dim))
    return (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)


def test_visits_fall_with_the_size_of_a_clustered_table(spark):
    shares = []
    for n in (800, 12800):
        x = clustered(n)
        df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], KIND)
        step = n // 40
        asked = list(range(0, n, step))
        got = nearest(df, df.where(f"vec_id % {step} = 0"), 20).collect()
        true = exact(list(range(n)), x, asked, 20)
        assert np.mean([len({r.vec_id for r in got if r.query_id == q} & set(true[q])) / 20 for q in asked]) >= 0.9
        packed = spark.createDataFrame([(i, v.tobytes()) for i, v in enumerate(x)], "id long, vec binary")
        y = x.astype(float)
        norm = np.linalg.norm(y, axis=1)
        largest = norm.max()
        width = fitted_width(packed, packed.where(f"id % {step} = 0"), largest, np.float32)
        rows = _placed(y, norm, largest, False)
        shares.append(np.mean([meeting(np.broadcast_to(_placed(y[q:q + 1], norm[q:q + 1], largest, True), rows.shape), rows,
                                       neighbours.TABLES, neighbours.FUNCTIONS, width, neighbours.PROBES).mean() for q in asked]))
    assert shares[1] < shares[0] / 4 and shares[1] < 0.05, shares


def test_one_common_vector(spark):
    """A third of all rows are equal: ties at the best score go to the smallest vec_ids."""
    df = spark.range(400).selectExpr("id as vec_id", "if(id % 3 = 0, array(1f, 1f, 0f), array(float(sin(id)) / 2, float(cos(id)) / 2, 1f)) as embedding")
    got = nearest(df, df.where("vec_id = 0"), 5).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(i, 2.0) for i in (3, 6, 9, 12, 15)]


def test_visits_are_never_broadcast(spark, monkeypatch):
    """A query's 160 visits carry its vector, which Spark's estimate of their size leaves out."""
    plans, stored = [], neighbours.stored

    def seen(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return stored(df, name)

    monkeypatch.setattr(neighbours, "stored", seen)
    monkeypatch.setattr(neighbours, "CHUNK", 64)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors(600))], KIND)
    for size in (1 << 28, 0):
        monkeypatch.setattr(neighbours, "ROUND", size, raising=False)
        assert nearest(df, df.where("vec_id % 50 = 0"), 10, width=1.0).count() == 120
    found = [p for name, p in plans if name == "found"]
    assert found
    for plan in found:
        depth = None
        for line in plan.splitlines():
            at = next((i for i, c in enumerate(line) if c.isalpha() or c == "*"), 0)
            if depth is not None and at <= depth:
                depth = None
            if depth is None and "BroadcastExchange" in line:
                depth = at
            assert depth is None or "MapInArrow" not in line, plan


def test_tables_searched_one_after_another(spark, monkeypatch):
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors(1500))], KIND)
    rows = []
    for size in (1 << 28, 0):
        monkeypatch.setattr(neighbours, "ROUND", size)
        rows.append(sorted(map(tuple, nearest(df, df.where("vec_id % 50 = 0"), 10, width=1.2).collect())))
    assert rows[0] == rows[1] and len(rows[0]) == 300


def test_repeated_rows_take_no_place_in_a_chunk(spark):
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors(600))], KIND)
    asked = df.where("vec_id % 100 = 0")
    once, thrice = (sorted(map(tuple, nearest(x, asked, 10, width=9.0).collect())) for x in (df, df.union(df).union(df)))
    assert once == thrice and len(once) == 60


def test_rough_scores_lose_no_pair():
    rng = np.random.default_rng(3)
    for size, dtype in ((1.0, np.float32), (1e-120, float), (1e-150, float), (1e120, float)):
        x = (rng.normal(size=(2000, 24)) * rng.uniform(0.5, 1.5, (2000, 1))).astype(dtype).astype(float) * size
        x[1000:1300] = x[0]  # ties
        ids, asked = np.arange(2000), np.arange(0, 2000, 50)
        score = np.einsum("qd,vd->qv", x[asked], x)
        for least in (np.full(40, -np.inf), np.sort(score, axis=1)[:, -30]):
            q, v, s = (np.concatenate(c) for c in zip(*neighbours._Chunk(ids, x, 10).met(asked, x[asked], least)))
            q, v, s = neighbours._best(q, v, s, 10)
            true = [(a, b, score[i, b]) for i, a in enumerate(asked) for b in [j for j in np.lexsort((ids, -score[i])) if j != a][:10]]
            assert list(zip(q, v, s)) == true
