import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from inboxlens.llm.quality import STATISTICS, RuleModel, good_documents, quality_scores, text_statistics, tree_rules
from inboxlens.llm.toxicity import fit_ordinal, toxicity

from .helpers import odd_docs


def corpus(spark, n=300):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    docs, labels = [], []
    for i in range(n):
        t = [word() for _ in range(rng.randint(5, 60))]
        bad, toxic = i % 5 == 0, i % 4 == 1
        if bad:
            t = [w + "###" for w in t]
        if toxic:
            for _ in range(rng.randint(1, 6)):
                t.insert(rng.randrange(len(t)), rng.choice(["Stinker", "stinkers,", "rotten"]))
        docs.append((i, " ".join(t)))
        labels.append((i, int(not bad), int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def held_out(df):
    assert df.where("held_out <> (crc32(cast(cast(doc_id as string) as binary)) % 3 = 1)").count() == 0
    return df.where("held_out")


def test_quality(spark, tmp_path):
    docs, labels = corpus(spark)
    got = held_out(quality_scores(docs, labels)).join(labels, "doc_id")
    assert got.count() > 50 and got.where("predicted <> quality").count() <= 1
    assert got.where("predicted <> int(score >= 0.5) or score < 0 or score > 1").count() == 0
    odd = odd_docs(spark, tmp_path).withColumn("stat_upper", F.lit("clash"))
    scores = quality_scores(odd, labels.union(labels).union(spark.createDataFrame([(None, 1, 1), (3, None, None)], labels.schema)))
    assert scores.count() == odd.count() and scores.where("score is null or held_out is null").count() == 0
    good = good_documents(docs.withColumn("row", F.lit(1)), labels)
    assert good.columns == ["doc_id", "text", "row"] and 230 <= good.count() <= 245
    # nothing to learn from
    flat = quality_scores(docs, labels.limit(0))
    assert {r.score for r in flat.select("score").distinct().collect()} == {0.5}
    assert quality_scores(docs.limit(0), labels).count() == 0


def test_rules_are_tree_paths():
    debug = """DecisionTreeClassificationModel: uid=x, depth=2
  If (feature 0 <= 0.5)
   If (feature 1 <= 2.0)
    Predict: 0.0
   Else (feature 1 > 2.0)
    Predict: 1.0
  Else (feature 0 > 0.5)
   Predict: 1.0
"""
    a, b = ("a", "<=", 0.5), ("a", ">", 0.5)
    assert tree_rules(debug, ["a", "b"]) == {(a,), (b,), (a, ("b", "<=", 2.0)), (a, ("b", ">", 2.0))}


def test_compiled_score(spark):
    model = RuleModel(-1.0, (((("a", "<=", 0.5), ("b", ">", 2.0)), 2.0), ((("a", ">", 0.5),), 1e-7)))
    got = spark.createDataFrame([(0.1, 3.0), (0.1, 1.0), (0.9, 0.0)], "a double, b double").select(model.score().alias("s")).collect()
    assert [r.s for r in got] == pytest.approx([1 / (1 + math.exp(-1.0)), 1 / (1 + math.exp(1.0)), 1 / (1 + math.exp(1 - 1e-7))])


def test_statistics():
    assert text_statistics(b" \n") == [0.0] * len(STATISTICS)
    s = dict(zip(STATISTICS, text_statistics(b"Aa Aa b|\n12 $.\nAa Aa b|")))
    assert s["log_words"] == math.log(8) and s["top_word"] == 0.5 and s["repeated"] == 2 / 7 * 7 / 8 and s["pipes"] == 0.25
    assert s["repeated_lines"] == pytest.approx(1 / 3) and s["ended_lines"] == pytest.approx(1 / 3)


def test_ordinal_fit_finds_the_order():
    rng = np.random.default_rng(3)
    n = 2000
    x = rng.integers(0, 4, n).astype(float)
    eta = 2.0 * x
    y = (rng.random(n) < 1 / (1 + np.exp(3 - eta))).astype(int)
    y += (y == 1) & (rng.random(n) < (1 / (1 + np.exp(5 - eta))) / (1 / (1 + np.exp(3 - eta))))
    w, t = fit_ordinal(np.arange(n), np.zeros(n, dtype=int), x, y, 1, 3, lasso=0)
    assert w[0] == pytest.approx(2.0, abs=0.3) and t == pytest.approx([3.0, 5.0], abs=0.5) and t[0] < t[1]


def test_toxicity(spark, tmp_path):
    docs, labels = corpus(spark)
    got = held_out(toxicity(docs, labels)).join(labels, "doc_id").join(docs, "doc_id")
    assert got.where("predicted <> toxic").count() <= 1
    assert got.where("severity < 0 or severity > 2 or abs(severity - score) > 1").count() == 0
    told = F.regexp_count("text", F.lit("(?i)stink|rotten"))
    assert got.where("toxic = 1").select(F.corr("severity", told)).head()[0] > 0.5
    odd = odd_docs(spark, tmp_path)
    scores = toxicity(odd, labels.union(spark.createDataFrame([(None, 1, 1), (3, None, None)], labels.schema)))
    assert scores.count() == odd.count() and scores.where("score is null or severity is null").count() == 0
    assert toxicity(docs, labels.limit(0)).select("score").distinct().count() == 1
    assert toxicity(docs.limit(0), labels).count() == 0
