"""Approximate nearest neighbours by multiprobe p-stable hashing.

Nearness is the inner product. Vectors are scaled by the largest norm and get
one more component that makes all norms equal, so a larger inner product is a
smaller distance. Each of ``TABLES`` tables hashes a vector with ``FUNCTIONS``
rounded Gaussian projections to a bucket. A query visits its own bucket and
those reached by steps over the nearest cell borders, in the order of their
estimated success. All tables' candidates are reranked by the exact inner
product of the original vectors.

The width of the cells is fitted to the data: the narrowest at which a sample of
``SAMPLE`` queries meets the wanted share of its exact nearest rows. The nearer a
query's neighbours are, as in clusters or large tables, the less it visits.

Buckets are dealt out in chunks, so a bucket that holds a third of all rows is
many tasks; tasks keep the ``k`` best of each query only, which loses nothing.
Tables that are more than ``ROUND`` bytes together are searched one after another,
and only rows that reach a query's k-th best score so far leave a later task.
A query that finds fewer than ``k`` rows is compared with all rows, in blocks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import batch, drop, mix, small, stored

TABLES = 8
FUNCTIONS = 8
WIDTHS = [round(0.05 * 1.15 ** i, 3) for i in range(38)]  # of a cell, where the largest norm is 1: to about 9, nearly all rows
RECALL = 0.96  # of the sample; the contract's least is 0.9
SAMPLE = 64  # queries
PROBES = 20
CHUNK = 2048  # rows; up to 8 times as many in large tables
HELD = 1 << 19
ROUND = 1 << 28  # bytes that are shuffled at once, or one table if that is more

_PACKED = pa.schema([("query_id", pa.int64()), ("vecs", pa.list_(pa.int64())), ("scores", pa.list_(pa.float64()))])
_LISTS = "query_id long, vecs array<long>, scores array<double>"


def probe_sets(functions: int, probes: int) -> list[tuple[int, ...]]:
    """Sets of border steps by expected score: index j stands for the j-th
    nearest of a query's 2 * functions cell borders."""
    m = functions
    score = [j * (j + 1) / (4 * (m + 1) * (m + 2)) for j in range(1, m + 1)]
    score += [1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2)) for j in range(m + 1, 2 * m + 1)]
    out: list[tuple[int, ...]] = [()]
    heap = [(score[0], (0,))]
    while heap and len(out) < probes:
        total, chosen = heapq.heappop(heap)
        if all(2 * m - 1 - j not in chosen for j in chosen):  # not both borders of one cell
            out.append(chosen)
        last = chosen[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (total - score[last] + score[last + 1], chosen[:-1] + (last + 1,)))
            heapq.heappush(heap, (total + score[last + 1], chosen + (last + 1,)))
    return out


def _projection(table: int, dim: int, functions: int, width: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng((8, table, dim))
    return (rng.normal(size=(dim + 1, functions)) / width, rng.random(functions),
            rng.integers(1, 2**62, functions, dtype=np.uint64) * np.uint64(2) + np.uint64(1))


def _bucket(cells: np.ndarray, odd: np.ndarray) -> np.ndarray:
    return mix((cells.astype(np.uint64) * odd).sum(axis=1, dtype=np.uint64)).view(np.int64)


def _matrix(column: pa.Array, dtype) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows and matrix of the vectors of each length."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    lengths = np.diff(ends) // np.dtype(dtype).itemsize
    if len(lengths) and (lengths == lengths[0]).all():
        x = np.frombuffer(column.buffers()[2], dtype=np.uint8)[ends[0]:ends[-1]].view(dtype)
        return {int(lengths[0]): (np.arange(len(lengths)), x.reshape(len(lengths), -1).astype(float))}
    raw = column.to_pylist()
    return {int(d): (at := np.flatnonzero(lengths == d), np.frombuffer(b"".join(raw[i] for i in at), dtype=dtype).reshape(len(at), d).astype(float))
            for d in np.unique(lengths)}


def _placed(x: np.ndarray, norm: np.ndarray, largest: float, query: bool) -> np.ndarray:
    """Rows scaled to at most 1, and queries to 1, with the component that makes norms equal."""
    rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(0, 1 - (norm / largest) ** 2))
    return np.column_stack((x / (norm[:, None] if query else largest), rest))


def _probed(f: np.ndarray, sets: list[tuple[int, ...]]) -> Iterator[np.ndarray]:
    """The cells that queries at ``f`` visit, likeliest first."""
    cells, functions = np.floor(f).astype(np.int64), f.shape[1]
    low = f - cells
    order = np.argsort(np.concatenate((low, 1 - low), axis=1), axis=1, kind="stable")
    line = np.arange(len(f))
    for chosen in sets:
        moved = cells.copy()
        for j in chosen:
            border = order[:, j]
            moved[line, border % functions] += np.where(border < functions, -1, 1)
        yield moved


def meeting(queries: np.ndarray, rows: np.ndarray, tables: int, functions: int, width: float, probes: int) -> np.ndarray:
    """Whether each query visits the row beside it (both as ``_placed``) in some table."""
    met = np.zeros(len(rows), dtype=bool)
    sets = probe_sets(functions, probes)
    for t in range(tables):
        a, shift, _ = _projection(t, rows.shape[1] - 1, functions, width)
        cells = np.floor(rows @ a + shift).astype(np.int64)
        for moved in _probed(queries @ a + shift, sets):
            met |= (moved == cells).all(axis=1)
    return met


def _sample_nearest(data: DataFrame, asked: DataFrame, k: int, dtype, sample: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a sampled query and each of its k exact nearest rows, by length of
    the vectors: ``sample * k`` pairs at most. Every row is compared, in its place."""
    chosen = asked.dropDuplicates(["id"]).orderBy(F.xxhash64("id"), "id").limit(sample).toArrow()
    by_dim = {d: (chosen.column(0).to_numpy()[at], x) for d, (at, x) in _matrix(chosen.column(1).combine_chunks(), dtype).items()} if chosen.num_rows else {}
    schema = pa.schema([("query", pa.int64()), ("score", pa.float64()), ("id", pa.int64()), ("vec", pa.binary())])

    def run(batches):
        held: dict[int, tuple] = {}
        for b in batches:
            if not b.num_rows:
                continue
            ids = b.column(0).to_numpy()
            for d, (at, x) in _matrix(b.column(1), dtype).items():
                for q, vector in zip(*by_dim.get(d, ((), ()))):
                    score, row, vec = x @ vector, ids[at], x
                    if len(row) > 4 * k:
                        few = np.argpartition(-score, 2 * k)[:2 * k + 1]  # and the query's own row
                        score, row, vec = score[few], row[few], vec[few]
                    if q in held:
                        score, row, vec = (np.concatenate(c) for c in zip(held[q], (score, row, vec)))
                    best = np.lexsort((row, -score))
                    best = best[row[best] != q][:2 * k]  # repeated rows may be among them
                    held[q] = score[best], row[best], vec[best]
        for q, (score, row, vec) in held.items():
            yield batch(schema, [q] * len(row), score, row, [v.astype(dtype).tobytes() for v in vec])

    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "id")  # 2 * k rows a query and task
    found = (data.select("id", "vec").mapInArrow(run, "query long, score double, id long, vec binary")
             .dropDuplicates(["query", "id"]).withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
             .select("query", "vec").toArrow())
    if not found.num_rows:
        return []
    vectors = {int(q): v for ids, x in by_dim.values() for q, v in zip(ids, x)}
    query = found.column(0).to_numpy()
    return [(np.array([vectors[int(q)] for q in query[at]]), x)
            for at, x in _matrix(found.column(1).combine_chunks(), dtype).values()]


def fitted_width(data: DataFrame, asked: DataFrame, largest: float, dtype, k: int = 20, tables: int = TABLES, functions: int = FUNCTIONS,
                 probes: int = PROBES, recall: float = RECALL, sample: int = SAMPLE) -> float:
    """The narrowest of WIDTHS at which sampled queries meet ``recall`` of their
    exact nearest rows (the widest, if there is none)."""
    pairs = [(_placed(q, np.linalg.norm(q, axis=1), largest, True), _placed(x, np.linalg.norm(x, axis=1), largest, False))
             for q, x in _sample_nearest(data, asked, k, dtype, sample)]
    total = sum(len(q) for q, _ in pairs)
    for width in WIDTHS:
        if sum(int(meeting(q, x, tables, functions, width, probes).sum()) for q, x in pairs) >= recall * total:
            return width
    return WIDTHS[-1]


def _hash(tables: Sequence[int], functions: int, width: float, sets: list[tuple[int, ...]] | None, largest: float, dtype):
    """Part and bucket of vectors (sets None) or of the visits of queries, with the columns of each row behind."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            for dim, (at, x) in _matrix(b.column(1), dtype).items():
                x = _placed(x, np.linalg.norm(x, axis=1), largest, sets is not None)
                rows = b if len(at) == b.num_rows else b.take(pa.array(at))
                for t in tables:
                    a, shift, odd = _projection(t, dim, functions, width)
                    f = x @ a + shift
                    for cells in [np.floor(f).astype(np.int64)] if sets is None else _probed(f, sets):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), t, dtype=np.int32)), pa.array(_bucket(cells, odd)), *rows.columns],
                                                         names=["part", "bucket", *rows.schema.names])
    return run


def _names(*args):
    """Part and bucket of vectors, alone."""
    run = _hash(*args)
    return lambda batches: (b.select([0, 1]) for b in run(batches))


def _best(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int):
    """The k best of each query, each vector once, at its best score."""
    order = np.lexsort((-score, vec, query))
    query, vec, score = query[order], vec[order], score[order]
    new = np.concatenate(([True], (np.diff(query) != 0) | (np.diff(vec) != 0)))
    query, vec, score = query[new], vec[new], score[new]
    order = np.lexsort((vec, -score, query))
    query, vec, score = query[order], vec[order], score[order]
    first = np.flatnonzero(np.concatenate(([True], np.diff(query) != 0)))
    rank = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
    return query[rank < k], vec[rank < k], score[rank < k]


def _packed(query: np.ndarray, vec: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    """A row for each query of rows as ``_best`` returns them."""
    first = np.flatnonzero(np.concatenate(([True], np.diff(query) != 0)))
    ends = pa.array(np.append(first, len(query)).astype(np.int32))
    return batch(_PACKED, pa.array(query[first]), pa.ListArray.from_arrays(ends, pa.array(vec)), pa.ListArray.from_arrays(ends, pa.array(score)))


class _Chunk:
    """Vectors of one length that lie in one chunk, ready to be compared."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int):
        if len(np.unique(ids)) < len(ids):  # equal rows once
            order = np.lexsort((*x.T, ids))
            ids, x = ids[order], x[order]
            new = np.concatenate(([True], (np.diff(ids) != 0) | (x[1:] != x[:-1]).any(axis=1)))
            ids, x = ids[new], x[new]
        self.ids, self.x = ids, x
        self.rows = (k + 1) * int(np.unique(ids, return_counts=True)[1].max())  # that may be a query's k best or its own
        self.scale = np.abs(x).max()
        self.small = np.ascontiguousarray((x / self.scale).astype(np.float32))
        self.norm = np.linalg.norm(self.small.astype(float), axis=1).max()

    def met(self, ids: np.ndarray, q: np.ndarray, floor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Query, vector and exact score of all pairs that can be among a query's
        k best and reach its floor; ties stay. Pairs are sorted out by single-precision
        scores with a margin for their rounding."""
        n, dim = self.x.shape
        step = max(1, (1 << 21) // n)
        for i in range(0, len(q), step):
            ask, own, least = q[i:i + step], ids[i:i + step], floor[i:i + step]
            scale = np.abs(ask).max(axis=1)
            if len(ask) * n <= 1 << 10 or scale.min() * self.scale < 1e-280:
                score = np.einsum("qd,vd->qv", ask, self.x)
                at = np.flatnonzero(score >= least[:, None])
            else:
                small = ask / scale[:, None]
                margin = (dim + 8) * 2.0 ** -23 * np.linalg.norm(small, axis=1) * self.norm + 1e-30
                rough = small.astype(np.float32) @ self.small.T
                cut = np.clip(least / scale / self.scale - margin, -1e30, 1e30)
                keep = rough >= cut.astype(np.float32)[:, None]
                if n > 2 * self.rows and (many := np.flatnonzero(np.count_nonzero(keep, axis=1) > 2 * self.rows)).size:
                    kth = np.partition(rough[many], n - self.rows, axis=1)[:, n - self.rows]
                    keep[many] &= rough[many] >= (kth - 2 * margin[many]).astype(np.float32)[:, None]
                at = np.flatnonzero(keep)
            part = max(1, (1 << 21) // dim)
            for j in range(0, len(at), part):
                qi, vi = np.divmod(at[j:j + part], n)
                score = np.einsum("nd,nd->n", ask[qi], self.x[vi])  # the same sum wherever a pair meets
                good = (score >= least[qi]) & (own[qi] != self.ids[vi])
                yield own[qi[good]], self.ids[vi[good]], score[good]


def _rerank(k: int, dtype):
    """Sorted rows: a chunk's vectors (floor null), then the queries that visit it,
    each with the score that its k best so far reach (its floor)."""
    def run(batches):
        held, n, limit = [], 0, HELD
        known, reached = np.empty(0, dtype=np.int64), np.empty(0)  # queries with k rows held here, and the score of the last
        name, rows, chunk = None, [], None

        def best():
            nonlocal known, reached
            q, v, s = _best(*map(np.concatenate, zip(*held)), k)
            last = np.flatnonzero(np.concatenate((np.diff(q) != 0, [True])))
            full = last[np.diff(np.concatenate(([-1], last))) == k]
            new, at = np.unique(np.concatenate((q[full], known)), return_index=True)  # of both, the one found now
            known, reached = new, np.concatenate((s[full], reached))[at]
            return q, v, s

        for b in small(batches):
            if not b.num_rows:
                continue
            part, bucket, sub, ids = (b.column(i).to_numpy() for i in (0, 1, 2, 4))
            asks, floors = b.column(3).is_valid().to_numpy(zero_copy_only=False), b.column(3).fill_null(0).to_numpy()
            vectors = _matrix(b.column(5), dtype)
            change = (np.diff(part) != 0) | (np.diff(bucket) != 0) | (np.diff(sub) != 0)
            cuts = [0, *(np.flatnonzero(change | (np.diff(asks) != 0)) + 1), b.num_rows]
            for r, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
                last = r == len(cuts) - 2
                if not asks[lo] and not last and (change[hi - 1] or not asks[hi]):
                    continue  # nobody asks
                here = (part[lo], bucket[lo], sub[lo])
                if asks[lo] and here != name:
                    continue  # nothing there
                mine = {d: (ids[at[i:j]], x[i:j], floors[at[i:j]]) for d, (at, x) in vectors.items()
                        for i, j in [np.searchsorted(at, (lo, hi))] if i < j}
                if not asks[lo]:
                    rows, chunk = ([*rows, mine] if here == name else [mine]), None
                    name = here
                    continue
                if chunk is None:
                    chunk = {d: _Chunk(*(np.concatenate([x[d][i] for x in rows if d in x]) for i in (0, 1)), k) for d in set().union(*rows)}
                for d, (own, q, floor) in mine.items():
                    if d not in chunk:
                        continue
                    if len(known):
                        at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                        floor = np.where(known[at] == own, np.maximum(floor, reached[at]), floor)
                    for found in chunk[d].met(own, q, floor):
                        if not len(found[0]):
                            continue
                        held.append(found)
                        n += len(found[0])
                        if n > limit or len(held) > HELD >> 4:
                            held = [best()]
                            n = len(held[0][0])
                            if n > 8 * HELD:
                                yield _packed(*held[0])
                                held, n = [], 0
                            limit = max(HELD, 2 * n)
        if n:
            yield _packed(*best())
    return run


def _merge(k: int):
    """The k best of each query from the sorted lists that tasks have found."""
    def run(batches):
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            lengths = b.column(1).value_lengths().to_numpy()
            rows = (np.repeat(b.column(0).to_numpy(), lengths), b.column(1).flatten().to_numpy(), b.column(2).flatten().to_numpy())
            held = rows if held is None else tuple(map(np.concatenate, zip(held, rows)))
            done = held[0] != held[0][-1]  # the last query may go on in the next batch
            if done.any():
                yield _packed(*_best(*(x[done] for x in held), k))
                held = tuple(x[~done] for x in held)
        if held is not None:
            yield _packed(*_best(*held, k))
    return run


def _search(data: DataFrame, queries: DataFrame, k: int, dtype) -> DataFrame:
    """Lists of the best rows of ``data`` (part, bucket, sub, id, vec) that meet each
    of ``queries`` (the same and floor) in a task: each task keeps its own k best."""
    cols = ["part", "bucket", "sub", "floor", "id", "vec"]
    rows = data.withColumn("floor", F.lit(None).cast("double")).select(*cols).union(queries.select(*cols))
    return rows.repartition("part", "bucket", "sub").sortWithinPartitions("part", "bucket", "sub", "floor").mapInArrow(_rerank(k, dtype), _LISTS)


def _merged(lists: DataFrame, k: int) -> DataFrame:
    return lists.repartition("query_id").sortWithinPartitions("query_id").mapInArrow(_merge(k), _LISTS)


def _rounds(tables: int, probes: int, moved: int) -> list[tuple[list[int], int, int]]:
    """Tables and range of probes that are shuffled together, ``moved`` bytes a table.
    If not all go at once, the queries' own buckets in one table come first: their
    floors keep the lists of the other rounds short."""
    if moved * tables <= ROUND:
        return [(list(range(tables)), 0, probes)]
    size = max(1, ROUND // max(moved, 1))
    rounds = [([0], 0, 1), ([0], 1, probes)] + [(list(range(t, min(t + size, tables))), 0, probes) for t in range(1, tables, size)]
    return [r for r in rounds if r[1] < r[2]]


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, tables: int = TABLES, functions: int = FUNCTIONS,
            width: float | None = None, probes: int = PROBES, recall: float = RECALL) -> DataFrame:
    """For each query (vec_id, embedding) its k nearest found rows of ``vectors``
    (vec_id, embedding): query_id, rank (from 1), vec_id, score.

    ``width`` of the cells: if None, as wide as a sample of the queries needs for
    ``recall`` (``fitted_width``).
    Nearest is the largest inner product in double precision, ties to the
    smaller vec_id. Rows with the query's own vec_id are no candidates, repeated
    rows count once, and only vectors of the query's length are. Vectors that
    are null, empty or zero, or hold null or non-finite components, and rows
    without vec_id take no part. Other columns are ignored; empty tables give an
    empty result."""
    double = "double" in vectors.schema["embedding"].dataType.simpleString() or "double" in queries.schema["embedding"].dataType.simpleString()
    dtype, element = (np.float64, "double") if double else (np.float32, "float")
    packed = pa.schema([("id", pa.int64()), ("vec", pa.binary()), ("norm", pa.float64())])

    def pack(batches):
        for b in batches:
            ids, column = b.column(0), b.column(1)
            lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
            values = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)  # null components are NaN
            starts = np.cumsum(lengths) - lengths
            there = ids.is_valid().to_numpy(zero_copy_only=False) & (lengths > 0)
            for dim in np.unique(lengths[there]):
                at = np.flatnonzero(there & (lengths == dim))
                x = values[starts[at][:, None] + np.arange(dim)]
                norms = np.sqrt([v.dot(v) for v in x.astype(float)])
                good = (norms > 0) & np.isfinite(norms)
                x, ends = x[good], np.arange(good.sum() + 1, dtype=np.int32) * np.int32(dim * x.itemsize)
                yield batch(packed, ids.take(pa.array(at[good])), pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(x.tobytes())]), norms[good])

    def usable(df):
        df = df.select(F.col("vec_id").cast("long"), F.col("embedding").cast(f"array<{element}>"))
        return df.mapInArrow(pack, "id long, vec binary, norm double")

    data, asked = stored(usable(vectors), "vectors"), stored(usable(queries), "queries")
    largest, n, n_bytes = data.agg(F.max("norm"), F.count("*"), F.sum(F.length("vec"))).head()
    visits, visit_bytes = asked.agg(F.count("*") * probes, F.sum(F.length("vec")) * probes).head()
    largest, n_bytes, visit_bytes = largest or 1.0, n_bytes or 0, visit_bytes or 0
    data, asked = data.drop("norm"), asked.drop("norm")
    if width is None:
        width = fitted_width(data, asked, largest, dtype, k, tables, functions, probes, recall)

    chunk = max(CHUNK, min(8 * CHUNK, n // 64, (n << 22) // max(n_bytes, 1)))
    row = "part int, bucket long, id long, vec binary"
    large = None
    if n > chunk:  # a row per ``chunk`` rows and table at most, broadcast
        large = stored(data.mapInArrow(_names(range(tables), functions, width, None, largest, dtype), "part int, bucket long")
                       .groupBy("part", "bucket").agg(F.ceil(F.count("*") / chunk).cast("int").alias("subs")).where("subs > 1"), "large")

    def dealt(rows, sub):
        """Rows with the chunks of their bucket that they go to. Only ``large`` may be
        broadcast: the rows are many times what Spark takes them for."""
        if large is None:
            return rows.withColumn("sub", F.lit(0))
        return rows.join(F.broadcast(large), ["part", "bucket"], "left").withColumn("sub", sub(F.coalesce("subs", F.lit(1))))

    sets, best = probe_sets(functions, probes), None
    for chosen, first, last in _rounds(tables, probes, n_bytes + visit_bytes + 48 * (n + visits)):
        if best is None:
            asking = asked.withColumn("floor", F.lit(float("-inf")))
        else:
            floors = best.where(F.size("vecs") == k).select(F.col("query_id").alias("id"), F.element_at("scores", k).alias("floor"))
            asking = asked.join(floors, "id", "left").select("id", "vec", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))
        index = data.mapInArrow(_hash(chosen, functions, width, None, largest, dtype), row)
        visit = asking.mapInArrow(_hash(chosen, functions, width, sets[first:last], largest, dtype), f"{row}, floor double")
        lists = _search(dealt(index, lambda subs: F.pmod(F.xxhash64("id"), subs).cast("int")),
                        dealt(visit, lambda subs: F.explode(F.sequence(F.lit(0), subs - 1))), k, dtype)
        before, best = best, stored(_merged(lists if best is None else best.union(lists), k), "found")
        if before is not None:
            drop(before)

    def ranked(lists):
        return lists.select("query_id", F.posexplode(F.arrays_zip("vecs", "scores")).alias("rank", "found")).select(
            "query_id", (F.col("rank") + 1).alias("rank"), F.col("found.vecs").alias("vec_id"), F.col("found.scores").alias("score"))

    found = best.where(F.size("vecs") == k)
    few = stored(asked.join(found.select(F.col("query_id").alias("id")), "id", "left_anti"), "short")
    if few.isEmpty():
        return ranked(found)
    blocks = max(1, n // chunk)
    block = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    place = F.lit(-1).alias("part"), F.lit(0).alias("sub")
    whole = _search(data.select(*place, block.alias("bucket"), "id", "vec"),
                    few.select(*place, every.alias("bucket"), "id", "vec", F.lit(float("-inf")).alias("floor")), k, dtype)
    return ranked(found.union(_merged(whole, k)))
