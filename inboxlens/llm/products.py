"""Exact search for the largest inner products of vectors of whole numbers.

What the tree operators share: vectors are made whole (floor of 256 times each
component), equal ones are brought down to as many as can be among the best,
and the rest are dealt out into cells and, within a cell, by hash into shards of
about ``SHARD`` vectors. Each shard gets a tree of its own in the task that
searches it. ``Probe`` rows visit shards in two waves: first one shard of the
cell that bounds the largest score, then, with the kth score found there, all
shards of cells whose bound is not below it. Both waves keep the ``k`` best of
each probe per task, so that few rows are merged.

The cells are laid by a sample of ``SAMPLE`` vectors (by hash of vec_id), but
hold every vector. Nothing is dropped: a cell, a shard and a tree's node are
passed over only if their bound shows that they hold none of the k best.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import batch, drop, small, stored

SCALE = 256
SHARD = 16384  # vectors of a tree, about
SAMPLE = 8192  # vectors that the cells are laid by
CELLS = 512  # at most
BLOCK = 256  # probes that search a tree together
MEET = 65536  # probes that visit a copy of a shard, about
HELD = 1 << 18
ANY, SAME, OTHER = "any", "same", "other"  # labels of a probe's rows
FAR = 1 << 62  # beyond every score

_ROWS = pa.schema([("id", pa.int64()), ("label", pa.int64()), ("dim", pa.int32()), ("vec", pa.binary())])
_FOUND = pa.schema([("id", pa.int64()), ("window", pa.int64()), ("negs", pa.list_(pa.int64())), ("ids", pa.list_(pa.int64()))])
_PROBE = ["id", "label", "window", "lo", "hi", "floor", "dim", "vec"]
_ROUTED = "id long, label long, window long, lo long, hi long, floor long, dim int, vec binary, cell int"


class Tree(Protocol):
    """A shard's tree: ``order`` of the rows, ``kids`` (nodes of each node, none
    for a leaf) and ``spans`` (a leaf's run of rows); node 0 is the root."""

    order: np.ndarray
    kids: list[range | tuple]
    spans: list[tuple[int, int]]

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and largest score of each (node, probe)."""

    def labels(self) -> tuple[np.ndarray, np.ndarray] | None:
        """The least and largest label of each node, if the tree knows."""


class Cells(Protocol):
    """Where vectors of ``dim`` components go; outlines are trees without kids."""

    dim: int

    def assign(self, x: np.ndarray, labels: np.ndarray) -> np.ndarray: ...


@dataclass(frozen=True)
class Vectors:
    """Stored rows id, label, dim and vec (bytes of ``kind``); scores are
    computed as ``number``, which holds them exactly."""

    rows: DataFrame
    kind: np.dtype
    number: np.dtype

    def matrix(self, column: pa.Array, dim: int) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), dtype=self.kind).reshape(len(column), dim).astype(self.number)

    def bare(self) -> "Vectors":
        """Without the table, for the tasks."""
        return Vectors(None, self.kind, self.number)


def whole_vectors(vectors: DataFrame, label=None) -> Vectors:
    """Vectors of ``vectors`` (vec_id, embedding) that take part, components made whole.

    Rows without vec_id, label (if given) or vector, and those with null or
    non-finite components take no part. Components whose scores could leave 64
    bits raise a ValueError."""
    label = F.lit(0) if label is None else label
    rows = (vectors.select(F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("label"),
                           F.col("embedding").cast("array<double>").alias("x"))
            .where("id is not null and label is not null and x is not null"))
    finite = f"transform(filter(x, v -> abs(v) < double('inf')), v -> abs(v) * {SCALE} + 1)"
    top, square = rows.agg(F.expr(f"max(array_max({finite}))"), F.expr(f"max(aggregate({finite}, 0d, (s, v) -> s + v * v))")).head()
    if (square or 0) >= FAR:
        raise ValueError("components are too large: scores do not fit in 64 bits")
    kind = next(np.dtype(t) for t in (np.int16, np.int32, np.int64) if (top or 0) < np.iinfo(t).max)
    number = np.dtype(np.float64 if (square or 0) < 1 << 53 else np.int64)

    def pack(batches):
        for b in small(batches):
            lengths = b.column(2).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = b.column(2).flatten().to_numpy(zero_copy_only=False).astype(float)  # a null component is NaN
            ends = np.cumsum(lengths)
            bad = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
            ok = bad[ends] == bad[ends - lengths]
            whole = np.floor(SCALE * np.where(np.isfinite(flat), flat, 0)).astype(kind)
            vecs = [whole[e - n:e].tobytes() for e, n, good in zip(ends, lengths, ok) if good]
            keep = pa.array(ok)
            yield batch(_ROWS, b.column(0).filter(keep), b.column(1).filter(keep), pa.array(lengths[ok].astype(np.int32)), vecs)

    packed = rows.mapInArrow(pack, "id long, label long, dim int, vec binary").distinct()
    return Vectors(stored(packed, "vectors"), kind, number)


def few_of_equals(rows: DataFrame, k: int) -> DataFrame:
    """Of equal vectors of a label the k smallest ids: no other can be among the k best."""
    equal = Window.partitionBy("label", "dim", "vec").orderBy("id")
    return rows.withColumn("nth", F.row_number().over(equal)).where(F.col("nth") <= k).drop("nth")


def probes_of(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored probes (id, label, dim, vec), one for equal vectors of a label, and
    the probe of each query: query, label, probe. A query whose vec_id has
    several rows asks for the first of its vectors, by label and bytes."""
    first = rows.groupBy(F.col("id").alias("query")).agg(F.min(F.struct("label", "dim", "vec")).alias("f")).select("query", "f.*")
    queries = stored(first, "queries")
    probes = stored(queries.groupBy("label", "dim", "vec").agg(F.min("query").alias("id")), "probes")
    asked = queries.join(probes, ["label", "dim", "vec"]).select("query", "label", F.col("id").alias("probe"))
    return probes, stored(asked, "asked")


def _sample(vectors: Vectors) -> tuple[int, np.ndarray, np.ndarray]:
    """The commonest length, and the sample's vectors of that length with their labels."""
    rows = vectors.rows.orderBy(F.xxhash64("id", "vec"), "id").limit(SAMPLE).toArrow()
    dims = rows.column("dim").to_numpy()
    dim = int(np.bincount(dims).argmax()) if len(dims) else 0
    rows = rows.filter(pa.array(dims == dim))
    return dim, vectors.matrix(rows.column("vec"), dim), rows.column("label").to_numpy()


def _place(cells: Cells, vectors: Vectors):
    """Rows with their cell; those of another length go to cell -1."""
    def run(batches):
        for b in small(batches):
            cell = np.full(b.num_rows, -1, dtype=np.int32)
            at = np.flatnonzero(b.column(2).to_numpy() == cells.dim)
            if len(at):
                rows = b.take(pa.array(at))
                cell[at] = cells.assign(vectors.matrix(rows.column(3), cells.dim), rows.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell)], names=[*b.schema.names, "cell"])
    return run


@dataclass(frozen=True)
class Index:
    """``rows``: stored id, label, dim, vec, cell, sub; ``sizes``: stored dim,
    cell and number of shards; ``outlines``: bounds of the cells of ``dim``."""

    vectors: Vectors
    rows: DataFrame
    sizes: DataFrame
    dim: int
    outlines: Tree
    build: Callable[[np.ndarray, np.ndarray], Tree]

    def drop(self) -> None:
        drop(self.rows)
        drop(self.sizes)


def index(vectors: Vectors, rows: DataFrame, lay: Callable, outline: Callable, build: Callable) -> Index:
    """Place ``rows`` of ``vectors`` in cells.

    lay(sample, labels, n) lays n cells; outline(cells, rows, vectors) gives
    their bounds from all placed rows; build(x, labels) a shard's tree."""
    dim, sample, labels = _sample(vectors)
    wanted = min(CELLS, max(16, rows.count() // SHARD))
    cells = lay(dim, sample, labels, wanted)
    placed = stored(rows.mapInArrow(_place(cells, vectors.bare()), "id long, label long, dim int, vec binary, cell int"), "placed")
    sizes = stored(placed.groupBy("dim", "cell").agg(F.ceil(F.count("*") / SHARD).cast("int").alias("subs")), "sizes")
    return Index(vectors.bare(), placed, sizes, dim, outline(cells, placed, vectors.bare()), build)


def _open(tree: Tree, q: np.ndarray, labels: np.ndarray, lo: np.ndarray, hi: np.ndarray, rule: str):
    """Nodes that can hold rows for each probe, and the largest score there."""
    least, most = tree.bounds(q)
    inside = (most >= lo) & (least <= hi)
    known = tree.labels()
    if known is not None and rule != ANY:
        a, b = known[0][:, None], known[1][:, None]
        inside &= (a <= labels) & (labels <= b) if rule == SAME else (a != b) | (a != labels)
    return inside, np.minimum(most, hi)


def best_first(tree: Tree, ids: np.ndarray, x: np.ndarray, row_labels: np.ndarray, q: np.ndarray, labels: np.ndarray,
               lo: np.ndarray, hi: np.ndarray, floor: np.ndarray, k: int, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids of the k best rows of each probe with a score from lo to hi
    that is not below ``floor``; ids, x and row_labels are in the tree's order.

    The queue takes the node with the largest bound of any probe that still needs
    it. A probe needs a node whose bound is not strictly below its kth score."""
    m, none = len(q), -FAR
    inside, most = _open(tree, q, labels, lo, hi, rule)
    need = np.maximum(lo, floor)
    scores = np.full((m, k), none, dtype=x.dtype)
    found = np.full((m, k), np.iinfo(np.int64).max)
    queue: list[tuple[float, int]] = []

    def push(node):
        open_ = inside[node] & (most[node] >= need)
        if open_.any():
            heapq.heappush(queue, (-most[node][open_].max(), node))

    push(0)
    while queue:
        _, node = heapq.heappop(queue)
        at = np.flatnonzero(inside[node] & (most[node] >= need))
        if not len(at):
            continue
        if tree.kids[node]:
            for kid in tree.kids[node]:
                push(kid)
            continue
        a, b = tree.spans[node]
        s = q[at] @ x[a:b].T
        ok = (s >= need[at, None]) & (s <= hi[at, None])
        if rule != ANY:
            ok &= (row_labels[a:b] == labels[at, None]) == (rule == SAME)
        hit = ok.any(axis=1)
        if not hit.any():
            continue
        at = at[hit]
        s = np.concatenate((scores[at], np.where(ok[hit], s[hit], none)), axis=1)
        i = np.concatenate((found[at], np.broadcast_to(ids[a:b], (len(at), b - a))), axis=1)
        order = np.lexsort((i, -s), axis=1)[:, :k]
        scores[at], found[at] = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)
        need[at] = np.maximum(need[at], scores[at, k - 1])
    return scores, found


def _best(probe: np.ndarray, window: np.ndarray, score: np.ndarray, found: np.ndarray, k: int):
    """The k best of each (probe, window), ties to the smaller id."""
    order = np.lexsort((found, -score, window, probe))
    probe, window, score, found = (c[order] for c in (probe, window, score, found))
    first = np.flatnonzero(np.concatenate(([True], (np.diff(probe) != 0) | (np.diff(window) != 0))))
    rank = np.arange(len(probe)) - np.repeat(first, np.diff(np.append(first, len(probe))))
    return tuple(c[rank < k] for c in (probe, window, score, found))


def _search(vectors: Vectors, build: Callable, k: int, rule: str):
    """Sorted rows: a shard's vectors (flag 0), then the probes that visit it."""
    def run(batches):
        held, n, limit, at, parts, tree = [], 0, HELD, None, [], None
        for b in small(batches):
            if not b.num_rows:
                continue
            key = np.column_stack([b.column(i).to_numpy() for i in range(4)])
            flag = b.column(4).to_numpy()
            cuts = np.flatnonzero((np.diff(key, axis=0) != 0).any(axis=1) | (np.diff(flag) != 0)) + 1
            for start, end in zip([0, *cuts], [*cuts, b.num_rows]):
                name, part = tuple(key[start]), b.slice(start, end - start)
                x = vectors.matrix(part.column(11), int(name[0]))
                own, labels = part.column(5).to_numpy(), part.column(6).to_numpy()
                if flag[start] == 0:  # may go on in the next batch
                    if name != at:
                        at, parts, tree = name, [], None
                    parts.append((own, labels, x))
                    continue
                if name != at:
                    continue
                if tree is None:
                    ids, row_labels, rows = map(np.concatenate, zip(*parts))
                    tree, parts = build(rows, row_labels), []
                    ids, row_labels, rows = ids[tree.order], row_labels[tree.order], rows[tree.order]
                window = part.column(7).to_numpy()
                lo, hi, floor = (part.column(i).to_numpy().astype(vectors.number) for i in (8, 9, 10))
                for i in range(0, len(x), BLOCK):
                    o = slice(i, i + BLOCK)
                    scores, found = best_first(tree, ids, rows, row_labels, x[o], labels[o], lo[o], hi[o], floor[o], k, rule)
                    got = scores > -FAR
                    line = np.nonzero(got)[0]
                    held.append((own[o][line], window[o][line], scores[got].astype(np.int64), found[got]))
                    n += len(line)
                    if n > limit:
                        held = [_best(*map(np.concatenate, zip(*held)), k)]
                        n = len(held[0][0])
                        limit = max(HELD, 2 * n)
        if n:
            probe, window, score, found = _best(*map(np.concatenate, zip(*held)), k)
            first = np.flatnonzero(np.concatenate(([True], (np.diff(probe) != 0) | (np.diff(window) != 0))))
            ends = pa.array(np.append(first, len(probe)).astype(np.int32))
            yield batch(_FOUND, pa.array(probe[first]), pa.array(window[first]),
                        pa.ListArray.from_arrays(ends, pa.array(-score)), pa.ListArray.from_arrays(ends, pa.array(found)))
    return run


def _routes(vectors: Vectors, dim: int, outlines: Tree, rule: str, first: bool):
    """Probe rows for each cell to visit: the one with the largest bound, or all
    whose bound is not below the probe's floor."""
    names = [*_PROBE, "cell"]

    def run(batches):
        for b in small(batches):
            dims = b.column(6).to_numpy()
            other = np.flatnonzero(dims != dim)
            if len(other):
                rows = b.take(pa.array(other))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.full(len(other), -1, np.int32))], names=names)
            own = np.flatnonzero(dims == dim)
            for i in range(0, len(own), BLOCK):
                rows = b.take(pa.array(own[i:i + BLOCK]))
                q, labels = vectors.matrix(rows.column(7), dim), rows.column(1).to_numpy()
                lo, hi, floor = (rows.column(c).to_numpy().astype(vectors.number) for c in (3, 4, 5))
                inside, most = _open(outlines, q, labels, lo, hi, rule)
                inside &= most >= floor
                if first:  # equal bounds: each probe begins elsewhere
                    turn = (np.arange(len(most))[:, None] + rows.column(0).to_numpy()) % len(most)
                    best = np.lexsort((turn, -np.where(inside, most, -np.inf)), axis=0)[0]
                    cell, line = best, np.arange(len(q))
                    keep = inside[best, line]
                    cell, line = cell[keep], line[keep]
                else:
                    cell, line = np.nonzero(inside)
                rows = rows.take(pa.array(line))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(cell.astype(np.int32))], names=names)
    return run


def _wave(index: Index, visits: DataFrame, k: int, rule: str, blocks: int) -> DataFrame:
    """Stored id, window and best of the probes that visit (dim, cell, sub)."""
    place, tail = ["dim", "cell", "sub", "block", "flag"], ["id", "label", "window", "lo", "hi", "floor", "vec"]
    nil = [F.lit(0).cast("long").alias(c) for c in ("window", "lo", "hi", "floor")]
    data = (index.rows.join(index.sizes, ["dim", "cell"])
            .select("dim", "cell", F.pmod(F.xxhash64("id"), "subs").cast("int").alias("sub"),
                    F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(0).alias("flag"), "id", "label", *nil, "vec"))
    asked = visits.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int")).withColumn("flag", F.lit(1))
    met = data.union(asked.select(*place, *tail)).repartition(*place[:4]).sortWithinPartitions(*place)
    found = met.mapInArrow(_search(index.vectors, index.build, k, rule), "id long, window long, negs array<long>, ids array<long>")
    return stored(_merged(found.select("id", "window", F.expr("transform(negs, (n, i) -> struct(n as neg, ids[i] as id))").alias("best")), k), "found")


def _merged(found: DataFrame, k: int) -> DataFrame:
    best = F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k)
    return found.groupBy("id", "window").agg(best.alias("best"))


def search(index: Index, probes: DataFrame, k: int, rule: str = ANY) -> DataFrame:
    """Stored id, window and ``best`` of each probe that finds rows: the k best as
    sorted structs (neg, id) of the negative score and the row's id.

    ``probes``: stored id, label, window (tells apart probes of one id), lo and
    hi (the scores that count), dim and vec."""
    blocks = max(1, -(-probes.count() // MEET))
    start = probes.withColumn("floor", F.lit(-FAR)).select(*_PROBE)
    routed = start.mapInArrow(_routes(index.vectors, index.dim, index.outlines, rule, True), _ROUTED).join(index.sizes, ["dim", "cell"])
    routed = routed.withColumn("sub", F.pmod("id", "subs").cast("int"))
    first = _wave(index, routed, k, rule, blocks)

    kth = F.when(F.size("best") == k, -F.element_at("best", k)["neg"])
    known = start.drop("floor").join(first.select("id", "window", kth.alias("kth")), ["id", "window"], "left")
    known = known.withColumn("floor", F.coalesce("kth", F.lit(-FAR))).select(*_PROBE)
    more = known.mapInArrow(_routes(index.vectors, index.dim, index.outlines, rule, False), _ROUTED).join(index.sizes, ["dim", "cell"])
    more = more.withColumn("sub", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)))
    seen = routed.select("id", "window", "dim", "cell", "sub")
    more = more.join(seen, seen.columns, "left_anti")
    second = _wave(index, more, k, rule, blocks)
    found = stored(_merged(first.union(second), k), "found")
    drop(first)
    drop(second)
    return found
