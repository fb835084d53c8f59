import os
import random

import numpy as np
import pandas as pd
import pytest

from inboxlens.llm.components import components
from inboxlens.llm.shared import drop, ragged, runs, stored, window_hashes, word_hashes

from .helpers import roots, same_rows


def test_word_and_window_hashes_stand_for_the_words():
    rng = random.Random(1)
    values = [b" ".join(rng.choice([b"a", b"bb", b"ccc"]) for _ in range(rng.randrange(60))) for _ in range(100)]
    values += [b"", b"  x ", b"a\tb\n c", b"y" * 200_000 + b" z"]
    _, _, counts, (hashes,) = word_hashes(values)
    all_words = [w for v in values for w in v.split()]
    assert counts.tolist() == [len(v.split()) for v in values]
    for n in (1, 2, 5, 16, 35):
        windows = window_hashes(hashes, n).tolist()
        seen = {}
        for i, h in enumerate(windows):
            assert seen.setdefault(tuple(all_words[i:i + n]), h) == h
        assert len(set(seen.values())) == len(seen)


def test_runs_and_ragged():
    assert list(runs([b"x" * 10] * 5, 22)) == [(0, 2), (2, 4), (4, 5)]
    assert ragged(np.array([5, 0, 9]), np.array([2, 0, 1])).tolist() == [5, 6, 9]


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7)]
    links += [(1000, x) for x in range(1001, 1200)]
    got = components(spark.createDataFrame(links, "a long, b long").repartition(6)).collect()
    nodes = {x for link in links for x in link}
    same_rows(got, [(x, r) for x, r in roots(nodes, links).items() if x != r])


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_over_many_tasks(spark, monkeypatch):
    import inboxlens.llm.components as c
    monkeypatch.setattr(c, "LINKS_PER_TASK", 8)
    test_components(spark)


def graph(kind, n):
    rng = random.Random(5)
    label = list(range(n))
    rng.shuffle(label)
    links = {"path": lambda: [(label[i], label[i + 1]) for i in range(n - 1)],
             "star around the largest": lambda: [(n, i) for i in range(n)],
             "chains of three": lambda: [(label[3 * i + j], label[3 * i + j + 1]) for i in range(n // 3 - 1) for j in (0, 1)],
             "random": lambda: [(rng.randrange(n), rng.randrange(n)) for _ in range(n)]}[kind]()
    rng.shuffle(links)
    return links


@pytest.mark.parametrize("kind", ["path", "star around the largest", "chains of three", "random"])
def test_components_of_many_links(spark, monkeypatch, kind):
    """More links than one task takes, with the library's own constant."""
    import inboxlens.llm.components as c
    rounds = []
    real = c.stars
    monkeypatch.setattr(c, "stars", lambda links: rounds.append(real(links)) or rounds[-1])
    links = graph(kind, 480_000 if kind == "chains of three" else 310_000)
    assert len(links) > 300_000 > c.LINKS_PER_TASK
    df = spark.createDataFrame(pd.DataFrame(links, columns=["a", "b"]))
    got = {r.node: r.comp for r in components(df).collect()}
    nodes = {x for link in links for x in link}
    assert got == {x: r for x, r in roots(nodes, links).items() if x != r}
    assert rounds[0][1] <= 20  # log2 of the number of links, and the last one that changes nothing


def test_dropped_tables_are_gone(spark):
    table = stored(spark.range(10), "short")
    path = table.inputFiles()[0]
    drop(table)
    assert not os.path.exists(path.removeprefix("file://"))
    drop(spark.range(3).limit(0))  # never stored: nothing to delete
