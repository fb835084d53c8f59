from collections import defaultdict
from math import floor

import pytest
from pyspark.sql import functions as F

from inboxlens.llm.mixing import mix_sources, mixed_documents, source_targets

from .helpers import odd_docs, odd_rows, words


def targets_by_rounds(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Share by weight, stop at the limit, share the excess again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = share * sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        rest = sum(weight[s] for s in order if s not in full)
        target = {s: most * sizes[s] if s in full else left * weight[s] / rest for s in order}
        above = {s for s in order if s not in full and target[s] > most * sizes[s]}
        if not above:
            return target
        full |= above


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 5, "b": 1000, "c": 3, None: 40}, {"x": 0, "y": 7},
                                   {f"s{i}": (i * 37) % 91 for i in range(20)}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in source_targets(df).collect()}
    assert got == pytest.approx(targets_by_rounds(sizes))


def test_mix(spark, tmp_path):
    rows = odd_rows()
    docs = odd_docs(spark, tmp_path, rows)
    got = mix_sources(docs).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    target = targets_by_rounds(sizes)
    assert sorted((r.doc_id is None, r.doc_id or 0, r["size"]) for r in got) == sorted((r[0] is None, r[0] or 0, len(words(r[1]))) for r in rows)
    taken = defaultdict(int)
    by_id = {r[0]: r[3] for r in rows if r[0] is not None}
    for r in got:
        assert 0 <= r.taken <= 2 * r["size"]
        if r.doc_id is not None:
            assert r.target == pytest.approx(target[by_id[r.doc_id]]) and r.source_size == sizes[by_id[r.doc_id]]
        taken[round(r.target, 6)] += r.taken
    assert dict(taken) == {k: floor(k) for k in {round(t, 6) for t in target.values()}}
    assert sorted(map(tuple, mix_sources(docs.repartition(5)).collect()), key=repr) == sorted(map(tuple, got), key=repr)


def test_mixed_documents(spark, tmp_path):
    docs = odd_docs(spark, tmp_path)
    out = mixed_documents(docs)
    assert out.columns == [c for c in docs.columns if c != "__row"]
    size = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    per = {r.source: r.n for r in out.groupBy("source").agg(F.sum(size).alias("n")).collect()}
    plan = mix_sources(docs.select("doc_id", "source", "text"))
    assert sum(per.values()) == plan.agg(F.sum("taken")).head()[0]
    whole = {(r.doc_id, r.text) for r in docs.collect()}
    cut = [r for r in out.collect() if (r.doc_id, r.text) not in whole]
    assert len(cut) <= len(per)  # one cut per source
    assert all(any(i == r.doc_id and (t or "").startswith(r.text) for i, t in whole) for r in cut)


def test_small_buckets(spark, monkeypatch):
    from inboxlens.llm import mixing
    docs = spark.range(500).selectExpr("id as doc_id", "repeat('w ', int(id % 9)) as text", "if(id % 3 = 0, 'hot', concat('s', id % 4)) as source")
    before = sorted(map(tuple, mix_sources(docs).collect()))
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", 4)
    assert sorted(map(tuple, mix_sources(docs).collect())) == before


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mix_sources(empty).count() == 0 and mixed_documents(empty).count() == 0
