"""Exact top-k search by inner product with ball trees.

Every shard of the vectors gets a ball tree: a node is a centre and the radius
around it, halved along the line between two far points. The inner product of a
query with any point of a ball is at most that with the centre plus the query's
norm times the radius. Nodes are searched in the order of that bound, and a node
whose bound is below the kth score found so far, in this shard or, through the
first wave, in another, is passed over (see ``products``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .products import ANY, FAR, Vectors, few_of_equals, index, probes_of, search, whole_vectors
from .shared import batch, drop, small

LEAF = 128


def _split(x: np.ndarray, rows: np.ndarray) -> np.ndarray | None:
    """The direction between two far points of these rows; None if all are equal."""
    own = x[rows]
    far = own[np.argmax(((own - own[0]) ** 2).sum(axis=1))]
    other = own[np.argmax(((own - far) ** 2).sum(axis=1))]
    return other - far if (other != far).any() else None


class Balls:
    """Balls by centre and radius, with bounds widened by what rounding can do."""

    def __init__(self, centers: np.ndarray, radii: np.ndarray):
        self.centers, self.radii = centers, radii

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        q = q.astype(float)
        norm = np.sqrt((q * q).sum(axis=1))
        middle = self.centers @ q.T
        reach = self.radii[:, None] * norm
        slack = 1e-9 * (np.sqrt((self.centers**2).sum(axis=1))[:, None] * norm + np.abs(reach)) + 1e-6
        return middle - reach - slack, middle + reach + slack

    def labels(self):
        return None


class BallTree(Balls):
    def __init__(self, x: np.ndarray, labels: np.ndarray | None = None, leaf: int = LEAF):
        x = x.astype(float)
        self.order = np.arange(len(x))
        self.kids: list[tuple] = []
        self.spans: list[tuple[int, int]] = []
        centers, radii = [], []
        todo = [(0, len(x), -1)]
        while todo:
            a, b, parent = todo.pop()
            rows, node = self.order[a:b], len(self.kids)
            if parent >= 0:
                self.kids[parent] += (node,)
            centers.append(x[rows].mean(axis=0))
            radii.append(np.sqrt(((x[rows] - centers[-1]) ** 2).sum(axis=1).max()))
            self.kids.append(())
            self.spans.append((a, b))
            line = _split(x, rows) if b - a > leaf else None
            if line is not None:
                half = (b - a) // 2
                self.order[a:b] = rows[np.argpartition(x[rows] @ line, half)]
                todo += [(a + half, b, node), (a, a + half, node)]
        super().__init__(np.array(centers), np.array(radii))


class BallCells:
    """Cells cut by hyperplanes, halving a sample along the line between far points."""

    def __init__(self, dim: int, sample: np.ndarray, labels: np.ndarray, wanted: int):
        sample = sample.astype(float)
        self.dim, self.cuts, self.centers = dim, {}, []  # node -> (direction, place, left, right) or a cell
        todo, node = [(np.arange(len(sample)), 1)], 1
        while todo:
            rows, node = todo.pop(0)
            line = _split(sample, rows) if len(rows) > 1 and len(todo) + len(self.centers) + 1 < wanted else None
            if line is None:
                self.cuts[node] = len(self.centers)
                self.centers.append(sample[rows].mean(axis=0) if len(rows) else np.zeros(dim))
                continue
            at = sample[rows] @ line
            place = np.median(at)
            left = at < place if (at < place).any() else at <= place
            self.cuts[node] = (line, place, bool((at < place).any()))
            todo += [(rows[left], 2 * node), (rows[~left], 2 * node + 1)]

    def assign(self, x: np.ndarray, labels: np.ndarray) -> np.ndarray:
        x, cell = x.astype(float), np.zeros(len(x), dtype=np.int32)
        todo = [(np.arange(len(x)), 1)]
        while todo:
            rows, node = todo.pop()
            cut = self.cuts[node]
            if isinstance(cut, int):
                cell[rows] = cut
            elif len(rows):
                at = x[rows] @ cut[0]
                left = at < cut[1] if cut[2] else at <= cut[1]
                todo += [(rows[left], 2 * node), (rows[~left], 2 * node + 1)]
        return cell


def _outline(cells: BallCells, placed: DataFrame, vectors: Vectors) -> Balls:
    """The cells as balls that hold all their rows."""
    centers = np.array(cells.centers)
    schema = pa.schema([("cell", pa.int32()), ("radius", pa.float64())])

    def run(batches):
        most = np.full(len(centers), -np.inf)
        for b in small(batches):
            x = vectors.matrix(b.column(1), cells.dim).astype(float)
            cell = b.column(0).to_numpy()
            np.maximum.at(most, cell, np.sqrt(((x - centers[cell]) ** 2).sum(axis=1)))
        used = np.flatnonzero(most >= 0)
        yield batch(schema, used.astype(np.int32), most[used])

    far = placed.where("cell >= 0").select("cell", "vec").mapInArrow(run, "cell int, radius double").groupBy("cell").agg(F.max("radius"))
    radii = np.zeros(len(centers))
    for cell, radius in far.collect():  # a row per cell
        radii[cell] = radius
    return Balls(centers, radii)


def top_products(vectors: DataFrame, queries: DataFrame | None = None, k: int = 5) -> DataFrame:
    """For each query the k rows of ``vectors`` (vec_id, embedding) with the
    largest inner product: query_id, rank (from 1), vec_id, score.

    ``queries`` (default: all rows) is vec_id of those to search for; they are
    rows of ``vectors``. Each component x counts as floor(256 * x), x as double;
    scores are exact whole numbers, ties go to the smaller vec_id. A query's own
    vec_id is no candidate. Only vectors of the query's length are candidates.
    Vectors that are null or hold null or non-finite components, and rows without
    vec_id, take no part. Rows that repeat vec_id and vector count once; rows of
    one vec_id with different vectors are candidates each, and the first vector
    by bytes is the query. Other columns are ignored; an empty table gives an
    empty result."""
    found = whole_vectors(vectors)
    rows = found.rows
    asked = rows if queries is None else rows.join(queries.select(F.col("vec_id").cast("long").alias("id")).distinct(), "id", "left_semi")
    probes, queries = probes_of(asked)
    # one more than k: the query itself is among its equals
    shards = index(found, few_of_equals(rows, k + 1), BallCells, _outline, BallTree)
    span = [F.lit(x).cast("long").alias(name) for name, x in (("window", 0), ("lo", -FAR), ("hi", FAR))]
    best = search(shards, probes.select("*", *span), k + 1, ANY)
    shards.drop()
    drop(rows)
    others = F.slice(F.filter("best", lambda r: r["id"] != F.col("query")), 1, k)
    return (queries.join(best, queries.probe == best.id).select(F.col("query").alias("query_id"), F.posexplode(others).alias("at", "row"))
            .select("query_id", (F.col("at") + 1).alias("rank"), F.col("row.id").alias("vec_id"), (-F.col("row.neg")).alias("score")))
