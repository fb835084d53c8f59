"""Hard negatives by R-trees packed sort-tile-recursively.

A hard negative of an anchor and one of its positives is a row of another label
whose score, the inner product with the anchor, lies in a window below the
positive's. Every shard of the vectors gets an R-tree: rows are sorted and tiled
by label, then by the coordinates that vary most, packed into leaves, and runs of
boxes into boxes. A box knows the least and largest label and the least and
largest value of each coordinate; added up by the sign of the anchor's, these
give an interval that holds the score of every row inside. Boxes are searched in
the order of that interval's upper end; those whose interval misses the window,
that hold no row of a wanted label, or that end strictly below the kth score
found so far, are passed over (see ``products``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .products import FAR, OTHER, SAME, Vectors, few_of_equals, index, probes_of, search, whole_vectors
from .shared import batch, drop, small, stored

LEAF = 128
FANOUT = 8
TILED = 3  # label and coordinates that rows are sorted by


class Boxes:
    """Boxes by the least and largest of each coordinate and of the labels."""

    def __init__(self, least: np.ndarray, most: np.ndarray, first: np.ndarray, last: np.ndarray):
        self.least, self.most, self.first, self.last = least, most, first, last

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        up, down = np.maximum(q, 0).T, np.minimum(q, 0).T
        return self.least @ up + self.most @ down, self.most @ up + self.least @ down

    def labels(self) -> tuple[np.ndarray, np.ndarray]:
        return self.first, self.last


def _tiled(keys: list[np.ndarray], rows: np.ndarray, pages: int) -> np.ndarray:
    """Rows in the order of the tiles: slabs of equal size by the first key, each
    tiled by the others."""
    rows = rows[np.argsort(keys[0][rows], kind="stable")]
    if len(keys) == 1 or pages <= 1:
        return rows
    slabs = max(1, round(pages ** (1 / len(keys))))
    cuts = [len(rows) * i // slabs for i in range(slabs + 1)]
    return np.concatenate([_tiled(keys[1:], rows[a:b], -(-pages // slabs)) for a, b in zip(cuts[:-1], cuts[1:])])


def _varied(x: np.ndarray) -> np.ndarray:
    """Coordinates, those that vary most first."""
    return np.argsort(-x.astype(float).var(axis=0), kind="stable")


class RTree(Boxes):
    def __init__(self, x: np.ndarray, labels: np.ndarray, leaf: int = LEAF, fanout: int = FANOUT):
        keys = [labels, *(x[:, c] for c in _varied(x)[:TILED - 1])]
        self.order = _tiled(keys, np.arange(len(x)), -(-len(x) // leaf))
        x, labels = x[self.order], labels[self.order]
        starts = np.arange(0, len(x), leaf)
        boxes = [(np.minimum.reduceat(x, starts), np.maximum.reduceat(x, starts), np.minimum.reduceat(labels, starts), np.maximum.reduceat(labels, starts))]
        while len(boxes[-1][0]) > 1:
            at = np.arange(0, len(boxes[-1][0]), fanout)
            boxes.append(tuple(f.reduceat(c, at) for f, c in zip((np.minimum, np.maximum) * 2, boxes[-1])))
        # nodes from the root down: each level's boxes stand behind those above
        first = np.cumsum([0, *(len(level[0]) for level in boxes[::-1])])
        self.kids: list[range | tuple] = []
        self.spans: list[tuple[int, int]] = []
        for above, level in enumerate(boxes[::-1]):
            for i in range(len(level[0])):
                if above + 1 < len(boxes):
                    below = len(boxes[::-1][above + 1][0])
                    self.kids.append(range(first[above + 1] + i * fanout, first[above + 1] + min((i + 1) * fanout, below)))
                    self.spans.append((0, 0))
                else:
                    self.kids.append(())
                    self.spans.append((i * leaf, min((i + 1) * leaf, len(x))))
        super().__init__(*(np.concatenate(c) for c in zip(*boxes[::-1])))


class BoxCells:
    """Cells cut by a sample's labels into slabs, and these by their widest coordinate."""

    def __init__(self, dim: int, sample: np.ndarray, labels: np.ndarray, wanted: int):
        slabs = max(1, round(wanted**0.5))
        runs = -(-wanted // slabs) if dim else 1
        self.dim, self.runs = dim, runs
        ordered = np.sort(labels)
        self.slab_cuts = ordered[[len(ordered) * i // slabs for i in range(1, slabs)]] if len(ordered) else np.empty(0, labels.dtype)
        slab = np.searchsorted(self.slab_cuts, labels, side="right")
        self.by, self.cuts = [], []
        for s in range(slabs if len(ordered) else 1):
            own = sample[slab == s] if (slab == s).any() else sample
            self.by.append(int(_varied(own)[0]) if dim and len(own) else 0)
            line = np.sort(own[:, self.by[-1]]) if dim and len(own) else np.empty(0)
            self.cuts.append(line[[len(line) * i // runs for i in range(1, runs)]] if len(line) else np.empty(0))

    def assign(self, x: np.ndarray, labels: np.ndarray) -> np.ndarray:
        slab, cell = np.searchsorted(self.slab_cuts, labels, side="right"), np.zeros(len(x), dtype=np.int32)
        for s in np.unique(slab):
            at = slab == s
            run = np.searchsorted(self.cuts[s], x[at, self.by[s]], side="right") if len(self.cuts[s]) else 0
            cell[at] = s * self.runs + run
        return cell


def _outline(cells: BoxCells, placed: DataFrame, vectors: Vectors) -> Boxes:
    """The cells as boxes: what their cuts say, and in the other coordinates what
    holds for all rows."""
    schema = pa.schema([("at", pa.int32()), ("least", pa.int64()), ("most", pa.int64())])

    def run(batches):
        least, most = np.full(cells.dim + 1, FAR), np.full(cells.dim + 1, -FAR)
        for b in small(batches):
            x = np.column_stack((b.column(0).to_numpy(), vectors.matrix(b.column(1), cells.dim).astype(np.int64)))
            if len(x):
                least, most = np.minimum(least, x.min(axis=0)), np.maximum(most, x.max(axis=0))
        yield batch(schema, pa.array(np.arange(cells.dim + 1, dtype=np.int32)), pa.array(least), pa.array(most))

    ends = (placed.where("cell >= 0").select("label", "vec").mapInArrow(run, "at int, least long, most long")
            .groupBy("at").agg(F.min("least"), F.max("most")).orderBy("at").collect())  # a row per coordinate
    label, *whole = [r[1:] for r in ends] or [(0, 0)] * (cells.dim + 1)
    n = len(cells.cuts) * cells.runs
    least, most = (np.tile(np.array([w[i] for w in whole], dtype=vectors.number), (n, 1)) for i in (0, 1))
    first, last = np.full(n, label[0], dtype=np.int64), np.full(n, label[1], dtype=np.int64)
    for s, cuts in enumerate(cells.cuts):
        for r in range(cells.runs):
            c = s * cells.runs + r
            if s > 0:
                first[c] = max(first[c], cells.slab_cuts[s - 1])
            if s < len(cells.slab_cuts):
                last[c] = min(last[c], cells.slab_cuts[s] - 1)
            if len(cuts) and r > 0:
                least[c, cells.by[s]] = max(least[c, cells.by[s]], cuts[r - 1])
            if len(cuts) and r < len(cuts):
                most[c, cells.by[s]] = min(most[c, cells.by[s]], cuts[r] - 1)
    return Boxes(least, most, first, last)


def hard_negatives(vectors: DataFrame, anchors: DataFrame | None = None, positives: int = 5, negatives: int = 3,
                   low: int = 50, high: int = 95) -> DataFrame:
    """Hard negatives of ``vectors`` (vec_id, embedding, label): anchor_id,
    positive_id, rank (from 1), negative_id, positive_score, negative_score.

    ``anchors`` (default: all rows) is vec_id of the anchors; they are rows of
    ``vectors``. Each component x counts as floor(256 * x), x as double, and a
    row's score is its exact inner product with the anchor; higher scores come
    first, ties by smaller vec_id. An anchor's positives are its first
    ``positives`` other rows of its label; for each of them the first
    ``negatives`` rows of other labels come with
    low * positive_score <= 100 * negative_score <= high * positive_score.

    Rows without vec_id or label, with a null vector or with a null or
    non-finite component take no part. Vectors of another length than the
    anchor's have no score. Rows repeated exactly count once; rows of one vec_id
    that differ are candidates each, and the first by label and bytes is the
    anchor. Pairs without negatives give no row. Other columns are ignored; an
    empty table gives an empty result."""
    found = whole_vectors(vectors, F.col("label"))
    rows = found.rows
    asked = rows if anchors is None else rows.join(anchors.select(F.col("vec_id").cast("long").alias("id")).distinct(), "id", "left_semi")
    probes, queries = probes_of(asked)
    # an anchor is among its own equals, hence one more
    shards = index(found, few_of_equals(rows, max(positives + 1, negatives)), BoxCells, _outline, RTree)
    span = [F.lit(x).cast("long").alias(name) for name, x in (("window", 0), ("lo", -FAR), ("hi", FAR))]
    best = search(shards, probes.select("*", *span), positives + 1, SAME)
    others = F.slice(F.filter("best", lambda r: r["id"] != F.col("query")), 1, positives)
    pairs = (queries.join(best, queries.probe == best.id).select("query", "probe", F.explode(others).alias("row"))
             .select("query", "probe", F.col("row.id").alias("positive_id"), (-F.col("row.neg")).alias("positive_score")))
    pairs = stored(pairs, "pairs")

    p = "cast(window as decimal(20, 0))"  # the products may leave 64 bits
    windows = (pairs.select(F.col("probe").alias("id"), F.col("positive_score").alias("window")).distinct()
               .withColumn("lo", F.expr(f"cast(ceil({p} * {low} / 100) as bigint)"))
               .withColumn("hi", F.expr(f"cast(floor({p} * {high} / 100) as bigint)")).where("lo <= hi"))
    windows = stored(probes.join(windows, "id"), "windows")
    near = search(shards, windows, negatives, OTHER)
    shards.drop()
    drop(rows)
    near = near.select(F.col("id").alias("probe"), F.col("window").alias("positive_score"), "best")
    return (pairs.join(near, ["probe", "positive_score"]).select("query", "positive_id", "positive_score", F.posexplode("best").alias("at", "row"))
            .select(F.col("query").alias("anchor_id"), "positive_id", (F.col("at") + 1).alias("rank"), F.col("row.id").alias("negative_id"),
                    "positive_score", (-F.col("row.neg")).alias("negative_score")))
