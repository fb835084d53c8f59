"""Quality classifier: a sparse ensemble of rules over text statistics.

A random forest on the labelled rows' statistics gives tree paths; each path is
a conjunctive rule. A lasso logistic regression weighs the rules and drops most
of them. What is left is compiled into one Spark column expression over the
statistics.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass
from operator import eq

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import extended, small, stored, texts_of

SAMPLE = 20_000  # labelled rows at most that the model is fitted on
STATISTICS = ("log_words", "word_length", "upper", "digits", "marks", "symbols", "pipes", "other_bytes", "distinct",
              "top_word", "repeated", "repeated_lines", "line_words", "ended_lines")
_UPPER, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
_MARKS, _SYMBOLS, _OTHER = b".,;:!?'\"()-", b"#$%&*@^~<>=+_\\/{}[]", bytes(range(128, 256))


def text_statistics(text: bytes) -> list[float]:
    """The statistics of one text; all are 0 for a text without words."""
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, size = len(words), len(text)
    share = lambda kind: (size - len(text.translate(None, kind))) / size
    counts = Counter(words)
    lines = [x for x in map(bytes.strip, text.split(b"\n")) if x]
    return [math.log(n), sum(map(len, words)) / n, share(_UPPER), share(_DIGITS), share(_MARKS), share(_SYMBOLS), text.count(b"|") / n,
            share(_OTHER), len(counts) / n, max(counts.values()) / n, sum(map(eq, words, words[1:])) / n,
            1 - len(set(lines)) / len(lines), math.log(1 + n / len(lines)), sum(x[-1:] in b".!?" for x in lines) / len(lines)]


def with_statistics(docs: DataFrame, prefix: str = "stat_") -> DataFrame:
    """Add one double column per statistic of ``text`` (null counts as empty)."""
    stats = [prefix + s for s in STATISTICS]
    names = [c for c in docs.columns if c not in stats]
    docs = docs.select(*[F.col(f"`{c}`") for c in names])
    at = names.index("text")

    def run(batches):
        for b in small(batches):
            found = [text_statistics(t) for t in texts_of(b.column(at))]
            columns = [pa.array([x[i] for x in found], pa.float64()) for i in range(len(stats))]
            yield pa.RecordBatch.from_arrays([*b.columns, *columns], names=[*names, *stats])

    return docs.mapInArrow(run, extended(docs, **{s: "double" for s in stats}))


Rule = tuple[tuple[str, str, float], ...]  # (statistic, "<=" or ">", value), ...


def tree_rules(debug: str, names: list[str]) -> set[Rule]:
    """The path to each node of a tree, as a rule with one bound per side."""
    rules, path = set(), []
    for line in debug.splitlines():
        m = re.match(r"\s*(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if m:
            depth = len(line) - len(line.lstrip())
            path = [x for x in path if x[0] < depth]
            path.append((depth, (names[int(m[1])], m[2], float(m[3]))))
            bounds: dict[tuple[str, str], float] = {}
            for _, (name, op, value) in path:
                pick = min if op == "<=" else max
                bounds[name, op] = pick(bounds.get((name, op), value), value)
            rules.add(tuple(sorted((*k, v) for k, v in bounds.items())))
    return rules


def rule_sql(rule: Rule) -> str:
    return " and ".join(f"`{name}` {op} {value!r}D" for name, op, value in rule)


@dataclass(frozen=True)
class RuleModel:
    """Weighted rules; ``intercept`` alone if there was nothing to learn from."""

    intercept: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        """Probability of label 1 as an expression over the statistics."""
        total = " + ".join([f"{self.intercept!r}D", *(f"case when {rule_sql(r)} then {w!r}D else 0D end" for r, w in self.weights)])
        return F.expr(f"1D / (1D + exp(-({total})))")


def fit_rules(rows: DataFrame, names: list[str], label: str = "label", sample: int = SAMPLE, trees: int = 24, depth: int = 3,
              lasso: float = 5e-4) -> RuleModel:
    """Fit on ``rows`` (statistics and a 0/1 label), on ``sample`` of them at most
    (those with the smallest hash of their values)."""
    rows = stored(rows.select(*names, F.col(label).cast("double").alias("label"))
                  .orderBy(F.xxhash64(*names, label)).limit(sample), "quality-train")
    n, ones = rows.agg(F.count("*"), F.sum("label")).head()
    if not n or ones in (0, n):
        share = ((ones or 0) + 1) / (n + 2)
        return RuleModel(math.log(share / (1 - share)), ())
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(rows)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, subsamplingRate=0.7, seed=1, maxBins=64).fit(vectors)
    rules = sorted(set().union(*(tree_rules(t.toDebugString, names) for t in forest.trees)))
    held = [F.expr(f"cast({rule_sql(r)} as double)").alias(f"r{i}") for i, r in enumerate(rules)]
    table = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(rows.select("label", *held))
    table = table.select("label", "features").repartition(max(1, n // 5000)).persist()
    model = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=60).fit(table)
    table.unpersist()
    weights = model.coefficients.toArray().tolist()
    return RuleModel(float(model.intercept), tuple((r, w) for r, w in zip(rules, weights) if w))


def fit_on_labels(docs: DataFrame, labels: DataFrame, statistics: DataFrame | None = None, **options) -> RuleModel:
    """Learn ``quality`` from the labelled rows outside the held-out fold.

    ``statistics``: those of ``docs`` with doc_id, if already computed. Rows
    without doc_id or label are left out; a doc_id labelled twice counts once,
    with the mean label rounded up."""
    names = ["stat_" + s for s in STATISTICS]
    statistics = with_statistics(docs.select("doc_id", "text")) if statistics is None else statistics
    truth = (labels.where("doc_id is not null and quality is not null and not (" + HELD_OUT + ")").groupBy("doc_id")
             .agg((F.avg("quality") >= 0.5).cast("double").alias("label")))
    return fit_rules(statistics.select("doc_id", *names).join(truth, "doc_id"), names, **options)


HELD_OUT = "coalesce(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, false)"


def quality_scores(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Score every row of ``docs`` (doc_id, text) for quality, from ``labels``
    (doc_id, quality): doc_id, held_out, score, predicted.

    The score is the probability of label 1. Empty and null texts have all
    statistics at 0 and get a score like any other; a null doc_id is not held
    out. Without labels of both kinds all rows get the same score. Other columns
    are ignored; an empty table gives an empty result."""
    stats = stored(with_statistics(docs.select(F.col("doc_id").cast("long"), "text")).drop("text"), "statistics")
    model = fit_on_labels(docs, labels, stats, **options)
    scored = stats.select("doc_id", F.expr(HELD_OUT).alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def good_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` predicted as label 1, with all their columns."""
    names = docs.columns
    stats = stored(with_statistics(docs.select("doc_id", "text")).drop("text"), "statistics")
    model = fit_on_labels(docs, labels, stats, **options)
    return with_statistics(docs).where(model.score() >= 0.5).select(*[F.col(f"`{c}`") for c in names])
