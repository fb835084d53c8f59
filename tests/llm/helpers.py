"""Odd documents that every operator must cope with, and small brute-force helpers."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])
CLASHES = ["row", "key", "id", "size", "kept", "n", "name", "target", "__row", "comp", "place", "kept_text"]
SPACES = " \t\n\x0b\x0c\r"


def words(text):
    out = [""]
    for c in text or "":
        if c in SPACES:
            out.append("")
        else:
            out[-1] += c
    return [w for w in out if w]


def odd_rows(seed=0, n=40):
    """Copies, near copies, shared passages, nulls, empty and very long texts, repeated rows."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéßñ語") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    text = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    passage, base = text(45), text(120)
    rows = []
    for i in range(n):
        t = text(rng.randint(1, 90))
        if i % 5 == 0:
            t = f"{t}\n{passage}\n{text(5)}"
        if i % 4 == 1:
            changed = base.split()
            changed[rng.randrange(len(changed))] = rng.choice(vocabulary)
            t = " ".join(changed)
        rows.append((100 - i, t, "en", f"s{i % 3}" if i % 7 else None, len(t)))
    rows += [(200 + i, base, "en", "s0", 1) for i in range(6)]
    rows += [(300, base.upper().replace(" ", "\t ", 3), None, "s1", None), (301, None, "de", "s1", 0), (302, None, None, None, None),
             (303, "", "de", "s2", 0), (304, " \n\t ", "de", "s2", 4), (305, "one", "de", "s2", 3), (306, "one", "de", "s2", 3),
             (307, "two words", "de", "s2", 9), (None, "no id here at all but six", "de", "s2", 9), (None, None, None, None, None),
             (308, text(6000), "en", "s0", 1), (309, "x" * 20000, "en", "s0", 1), (310, "la " * 300, "en", "s0", 1),
             (311, "crlf\r\nline\x85nel\xa0nbsp\x1cfs", "en", "s0", 1)]
    return rows + [rows[3], rows[3], (305, "one", "de", "s2", 3)]


def odd_docs(spark, folder, rows=None, clashes=True):
    """Written and read back, so that it is the same each time it is read."""
    df = spark.createDataFrame(odd_rows() if rows is None else rows, DOCS).repartition(3)
    if clashes:
        for c in CLASHES:
            df = df.selectExpr("*", f"'clash' as `{c}`")
    path = str(folder / f"docs{random.random()}")
    df.write.parquet(path)
    return spark.read.parquet(path)


def roots(nodes, links):
    parent = {x: x for x in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in nodes}


def same_rows(got, expected):
    order = lambda rows: sorted(map(tuple, rows), key=repr)
    assert order(got) == order(expected)
