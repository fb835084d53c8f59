"""Toxicity grades by cumulative-link ordinal regression.

A text's features are its words and their first letters (compounds keep the
stem they start with), each with the logarithm of its count. The model has one
weight per feature, shared by all grades, and one threshold per step between
grades: P(grade > j) = 1 / (1 + exp(threshold_j - weights * features)). It
returns the expected severity, the sum of these probabilities.

The given labels say toxic or not. Two grades of toxic are made from them for
training: 1 where telling words (far commoner in toxic rows) occur up to as
often as in the median toxic row, 2 above.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import batch, small, stored, texts_of

SAMPLE = 20_000  # labelled rows at most that the model is fitted on
FEATURES = 2_000  # at most, those that tell toxic from other rows best
LEAST_ROWS = 5  # that hold a feature
LEAST_CHI = 24.0  # chi-square of a feature against the label: chance finds one among 10**6
PREFIXES = (4, 5, 6, 7)  # letters
HELD_OUT = "coalesce(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, false)"


def _plain() -> bytes:
    """Lower case (A-Z), and white space for ASCII marks."""
    return bytes(c + 32 if 65 <= c < 91 else c if c >= 128 or 97 <= c < 123 or 48 <= c < 58 else 32 for c in range(256))


def words_of(text: bytes) -> list[str]:
    return text.translate(_plain()).decode("utf-8", "replace").split()


def feature_counts(words: list[str]) -> Counter:
    """Counts of the words and of their prefixes (marked by a trailing ~)."""
    counts = Counter(words)
    for word, n in list(counts.items()):
        for size in PREFIXES:
            if len(word) > size:
                counts[word[:size] + "~"] += n
    return counts


@dataclass(frozen=True)
class OrdinalModel:
    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def above(self, words: list[str]) -> list[float]:
        """P(grade > j) for each threshold."""
        total = 0.0
        if self.weights:
            get, hits = self.weights.get, {}
            for word, n in Counter(words).items():
                for f in (word, *(word[:size] + "~" for size in PREFIXES if len(word) > size)):
                    if get(f) is not None:
                        hits[f] = hits.get(f, 0) + n
            total = sum(get(f) * np.log1p(n) for f, n in hits.items())
        return [float(1 / (1 + np.exp(min(max(t - total, -500), 500)))) for t in self.thresholds]


def fit_ordinal(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grades: np.ndarray, features: int, grades_n: int,
                steps: int = 400, rate: float = 0.1, lasso: float = 2e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of greatest likelihood (proximal Adam), from the
    entries (row, column, value) of a sparse matrix and each row's grade."""
    n = len(grades)
    share = np.array([(np.sum(grades > j) + 0.5) / (n + 1) for j in range(grades_n - 1)])
    start = np.log((1 - share) / share)
    p = np.concatenate((np.zeros(features), [start[0]], np.log(np.maximum(np.diff(start), 1e-2))))
    first, second = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        gaps = np.exp(p[features + 1:])
        t = np.concatenate(([-np.inf], p[features] + np.concatenate(([0.0], np.cumsum(gaps))), [np.inf]))
        eta = np.bincount(rows, values * p[columns], n)
        cdf = lambda x: 1 / (1 + np.exp(-np.clip(x, -500, 500)))
        hi, lo = cdf(t[grades + 1] - eta), cdf(t[grades] - eta)
        like = np.maximum(hi - lo, 1e-12)
        d_hi, d_lo = hi * (1 - hi) / like, lo * (1 - lo) / like
        g_eta = (d_hi - d_lo) / n
        g_t = np.array([np.sum(d_lo[grades == j + 1]) - np.sum(d_hi[grades == j]) for j in range(grades_n - 1)]) / n
        g = np.concatenate((np.bincount(columns, values * g_eta[rows], features), [g_t.sum()],
                            [gaps[j] * g_t[j + 1:].sum() for j in range(grades_n - 2)]))
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        p -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        p[:features] = np.sign(p[:features]) * np.maximum(np.abs(p[:features]) - rate * lasso, 0)
    return p[:features], p[features] + np.concatenate(([0.0], np.cumsum(np.exp(p[features + 1:]))))


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES) -> OrdinalModel:
    """Fit on labelled rows outside the held-out fold, ``sample`` of them at most
    (those with the smallest hash of doc_id; of rows with one doc_id, the one
    whose text has the smallest hash)."""
    truth = (labels.where("doc_id is not null and toxic is not null and not (" + HELD_OUT + ")").groupBy("doc_id")
             .agg(F.max("toxic").cast("int").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    schema = pa.schema([("toxic", pa.int32()), ("features", pa.list_(pa.string())), ("counts", pa.list_(pa.int32()))])

    def count(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                found = [feature_counts(words_of(t)) for t in texts_of(part.column(1))]
                yield batch(schema, part.column(0), [list(c) for c in found], [list(c.values()) for c in found])

    rows = docs.select("doc_id", "text").join(F.broadcast(truth), "doc_id")  # at most ``sample`` rows of two numbers
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))  # of a doc_id that is repeated
    rows = rows.groupBy("doc_id", "toxic").agg(one.alias("one")).select("toxic", F.col("one.text").alias("text"))
    rows = stored(rows.select("toxic", "text").mapInArrow(count, "toxic int, features array<string>, counts array<int>"), "toxic-train")
    n, ones = rows.agg(F.count("*"), F.sum("toxic")).head()
    if not n or ones in (0, n):
        share = ((ones or 0) + 1) / (n + 2)
        return OrdinalModel({}, (float(np.log((1 - share) / share)), 10.0))
    held = (rows.select("toxic", F.explode("features").alias("feature")).groupBy("feature")
            .agg(F.sum("toxic").alias("pos"), F.count("*").alias("df")).where(F.col("df") >= LEAST_ROWS))
    rate = F.col("df") / F.lit(n)
    gap = F.col("pos") / ones - (F.col("df") - F.col("pos")) / (n - ones)
    chi = F.pow(gap, 2) / (rate * (1 - rate) + 1e-9) * (ones * (n - ones) / n)
    best = held.where(chi >= LEAST_CHI).orderBy(F.desc(chi), "feature").limit(features).collect()  # bounded: ``features``
    index = {r.feature: i for i, r in enumerate(best)}
    odds = {r.feature: (r.pos + 0.5) / (ones + 1) / ((r.df - r.pos + 0.5) / (n - ones + 1)) for r in best}
    telling = {f for f, x in odds.items() if x >= 8 and not f.endswith("~")}

    def entries(batches):
        out = pa.schema([("toxic", pa.int32()), ("telling", pa.int64()), ("columns", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])
        for b in batches:
            cols, vals, told = [], [], []
            for names, counts in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                hit = [(index[f], c) for f, c in zip(names, counts) if f in index]
                cols.append([i for i, _ in hit])
                vals.append([float(np.log1p(c)) for _, c in hit])
                told.append(sum(c for f, c in zip(names, counts) if f in telling))
            yield batch(out, b.column(0), told, cols, vals)

    if not index:
        return OrdinalModel({}, (float(np.log((n - ones) / ones)), 10.0))
    matrix = rows.mapInArrow(entries, "toxic int, telling long, columns array<int>, values array<double>").toArrow()  # at most ``sample`` rows
    toxic, told = matrix["toxic"].to_numpy(), matrix["telling"].to_numpy()
    lists = matrix["columns"].combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    grades = np.where(toxic == 1, 1 + (told > np.median(told[toxic == 1])), 0)
    weights, thresholds = fit_ordinal(np.repeat(np.arange(len(grades)), lengths), lists.flatten().to_numpy(),
                                      matrix["values"].combine_chunks().flatten().to_numpy(), grades, len(index), 3)
    return OrdinalModel({f: float(w) for f, w in zip(index, weights) if w}, tuple(float(t) for t in thresholds))


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Grade every row of ``docs`` (doc_id, text), learning from ``labels``
    (doc_id, toxic): doc_id, held_out, severity (expected, 0 to 2), score
    (probability of grade 1 or more), grade (the likeliest) and predicted (1 if
    score >= 0.5, else 0).

    A null or empty text has no features and gets the base rate. Without labels
    of both kinds all rows get the same score. Other columns are ignored; an
    empty table gives an empty result."""
    model = fit_toxicity(docs, labels, **options)

    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("severity", pa.float64()), ("score", pa.float64()), ("grade", pa.int32())])
        for b in small(batches):
            above = [model.above(words_of(t)) for t in texts_of(b.column(1))]
            single = [[1 - a[0], *(x - y for x, y in zip(a, a[1:])), a[-1]] for a in above]
            yield batch(schema, b.column(0), map(sum, above), [a[0] for a in above], [x.index(max(x)) for x in single])

    out = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, severity double, score double, grade int")
    return out.select("doc_id", F.expr(HELD_OUT).alias("held_out"), "severity", "score", "grade",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
