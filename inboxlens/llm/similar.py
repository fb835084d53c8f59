"""Links between similar items, found through MinHash signatures.

An item has a signature of ``k`` coordinates. Two items count as candidates if
at least ``matches`` coordinates agree. Items are posted under keys made of
coordinates (an inverted index); candidates meet under a common key, and each
candidate pair is confirmed on the full texts. What is returned is the links
that connect the items, not all pairs:

1. Under each key, all members are compared with one pivot, the member that
   shares most with others. This is linear however large a key's list is.
2. Lists whose members are still in several components go on: the members
   outside the largest component are compared with all members, until they
   belong together. Collisions are counted on the signatures first; only rows
   with a candidate left fetch their texts, and the comparison on full sets
   happens where the rows meet, so no pair becomes a row unless it is a link.
   A pair that meets under several keys is compared under the first one only.
3. A list with very many members outside its largest component is first posted
   again under longer keys, the key and one more coordinate. A pair with
   ``matches`` agreements still meets, and a passage that unlike texts share
   falls apart, so nobody is compared with a whole hot list.

Lists are dealt out in chunks, never held whole.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .shared import batch, drop, mix, small, stored, texts_of

CHUNK = 4096  # members of a list compared in one go
BLOCK = 1024  # and of those outside the largest component
OUTSIDE = 16 * BLOCK  # of these a list may have, or else it is posted anew
DEPTH = 3  # how often
BITMAP_BYTES = 64 << 20
BASES = 256  # first keys of an item, at most

_PAIRS = pa.schema([("p", pa.int64()), ("q", pa.int64())])
_FIRST = pa.schema([("key", pa.int64()), ("id", pa.int64())])
_POSTS = pa.schema([("key", pa.int64()), ("base", pa.int32()), ("last", pa.int32()), ("ext", pa.int32()), ("id", pa.int64())])
_PLACE = pa.schema([("key", pa.int64()), ("chunk", pa.int32()), ("block", pa.int32()), ("flag", pa.int32()), ("id", pa.int64())])


@dataclass(frozen=True)
class Scheme:
    """How items are posted and compared.

    coordinates: those of each first key (tuples of indices); matches: agreeing
    coordinates that a candidate needs; dtype: of a coordinate; percent: the
    least similarity (100 * intersection >= percent * union); sets: sorted
    distinct shingle hashes of each text; marked: if not 0, a signature has one
    more value, a mark, not 0 where coordinates depend on each other so that
    their agreements tell little: a pair of marked items needs ``marked`` only."""

    k: int
    matches: int
    percent: int
    dtype: type
    coordinates: tuple[tuple[int, ...], ...]
    sets: Callable[[list[bytes]], list[np.ndarray]]
    marked: int = 0


def _signatures(column: pa.Array, scheme: Scheme) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=scheme.dtype).reshape(-1, scheme.k + (scheme.marked > 0))


def _needed(scheme: Scheme, x: np.ndarray, y: np.ndarray) -> np.ndarray | int:
    """Agreements that pairs of signatures need."""
    return np.where((x[..., scheme.k] > 0) & (y[..., scheme.k] > 0), scheme.marked, scheme.matches) if scheme.marked else scheme.matches


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'int' if f.type == pa.int32() else 'long'}" for f in schema)


def _post(scheme: Scheme):
    """Items under their first keys, which end in ``base``, the number of the key's coordinates."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            sig, n = _signatures(b.column(1), scheme).astype(np.uint64), b.num_rows
            for base, coordinates in enumerate(scheme.coordinates):
                key = np.full(n, base + 1, dtype=np.uint64)
                for c in coordinates:
                    key = mix(key ^ mix(sig[:, c] + np.uint64(c << 40)))
                key = key & ~np.uint64(BASES - 1) | np.uint64(base)
                yield batch(_FIRST, pa.array(key.view(np.int64)), b.column(0))
    return run


def _post_anew(scheme: Scheme):
    """Each member of a list under longer keys: the next agreeing coordinate.

    With ``matches`` agreements at most k - matches coordinates differ, so the
    (ext + 1)-th agreement outside the base is among the first
    k - matches + ext + 1 of those. Likewise with ``marked`` of marked items."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            key, base, last, ext = (b.column(i).to_numpy() for i in range(4))
            key, sig = key.view(np.uint64), _signatures(b.column(5), scheme).astype(np.uint64)
            inside = np.array([[c in own for c in range(scheme.k)] for own in scheme.coordinates])[base]
            rank = np.cumsum(~inside, axis=1) - 1
            needed = _needed(scheme, sig, sig)
            for c in range(scheme.k):
                go = ~inside[:, c] & (c > last) & (rank[:, c] <= scheme.k - needed + ext)
                new = mix(key[go] + mix(sig[go, c] + np.uint64(c << 40)))
                yield batch(_POSTS, pa.array(new.view(np.int64)), pa.array(base[go]), pa.array(np.full(go.sum(), c, np.int32)),
                            pa.array(ext[go] + np.int32(1)), b.column(4).filter(pa.array(go)))
    return run


def _close(scheme: Scheme):
    """Pairs that agree in enough coordinates and can reach the similarity by size."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            sigs = [_signatures(b.column(i), scheme) for i in (4, 5)]
            agree = (sigs[0] == sigs[1])[:, :scheme.k].sum(axis=1)
            x, y = b.column(2).to_numpy(), b.column(3).to_numpy()
            ok = (agree >= _needed(scheme, *sigs)) & (100 * np.minimum(x, y) >= scheme.percent * np.maximum(x, y))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], schema=_PAIRS).filter(pa.array(ok))
    return run


def _candidates(scheme: Scheme, rows: tuple, out: tuple, base: int, last: int, ext: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index pairs (outside member, member) to compare in this list, best first,
    and their agreements: of two components, with enough agreements, within
    reach by size, and meeting under no earlier key."""
    step, found = max(1, (1 << 21) // (len(out[0]) * scheme.k)), []
    early = np.array([c <= last and c not in scheme.coordinates[base] for c in range(scheme.k)])
    for lo in range(0, len(rows[0]), step):
        ids, comps, sizes, sigs = (x[lo:lo + step] for x in rows)
        agree = out[3][:, None, :scheme.k] == sigs[None, :, :scheme.k]
        n = agree.sum(axis=2)
        x, y = out[2][:, None], sizes[None, :]
        ok = (n >= _needed(scheme, out[3][:, None, :], sigs[None, :, :])) & (out[1][:, None] != comps[None, :]) & (100 * np.minimum(x, y) >= scheme.percent * np.maximum(x, y))
        i, j = np.nonzero(ok)
        if len(i):
            hits = agree[i, j]
            first = hits[:, early].sum(axis=1) == ext
            for earlier in scheme.coordinates[:base]:
                first &= ~hits[:, list(earlier)].all(axis=1)
            i, j = i[first], j[first]
            found.append((i, j + lo, n[i, j]))
    if not found:
        return (np.empty(0, np.int64),) * 3
    i, j, n = map(np.concatenate, zip(*found))
    order = np.argsort(-n, kind="stable")
    return i[order], j[order], n[order]


def _lists(batches, columns: Callable[[pa.RecordBatch], tuple]):
    """Sorted rows (key, chunk, block, flag, base, last, ext, ...) as pairs of the
    members outside the largest component (flag 0) and a run of members."""
    at, out = None, None
    for b in small(batches):
        if not b.num_rows:
            continue
        key, chunk, block, flag, base, last, ext = (b.column(i).to_numpy() for i in range(7))
        values = columns(b)
        change = (np.diff(key) != 0) | (np.diff(chunk) != 0) | (np.diff(block) != 0) | (np.diff(flag) != 0)
        cuts = np.concatenate(([0], np.flatnonzero(change) + 1, [len(key)]))
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            new, rows = (key[lo], chunk[lo], block[lo]), tuple(x[lo:hi] for x in values)
            if flag[lo] == 0:  # may go on from the last batch
                out = rows if new != at else tuple(x + y if isinstance(x, list) else np.concatenate((x, y)) for x, y in zip(out, rows))
                at = new
            elif new == at:
                yield new, (int(base[lo]), int(last[lo]), int(ext[lo])), out, rows


def _wanted(scheme: Scheme):
    """The rows that have a candidate, as (key, chunk, block, flag, id)."""
    def columns(b):
        return (*(b.column(i).to_numpy() for i in (7, 8, 9)), _signatures(b.column(10), scheme))

    def run(batches):
        held: list[tuple] = []
        for new, kind, out, rows in _lists(batches, columns):
            i, j, _ = _candidates(scheme, rows, out, *kind)
            held += [(*new, 0, x) for x in out[0][np.unique(i)].tolist()] + [(*new, 1, x) for x in rows[0][np.unique(j)].tolist()]
            if len(held) > 1 << 15:
                yield batch(_PLACE, *zip(*held))
                held = []
        if held:
            yield batch(_PLACE, *zip(*held))
    return run


def _one_by_one(sets: list[np.ndarray], others: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    return np.array([len(np.intersect1d(sets[a], others[b], assume_unique=True)) for a, b in zip(i.tolist(), j.tolist())], dtype=np.int64)


def _shared_counts(sets: list[np.ndarray], others: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets[i] and others[j]. Similar sets have a
    small vocabulary in common: bitmaps over it are compared if there are many pairs."""
    used = [np.unique(x) for x in (i, j)]
    if len(i) <= 4 * (len(used[0]) + len(used[1])):
        return _one_by_one(sets, others, i, j)
    members = [sets[x] for x in used[0]] + [others[x] for x in used[1]]
    _, at, held = np.unique(np.concatenate(members), return_inverse=True, return_counts=True)
    both = held > 1  # what one set alone has is in no intersection
    width = max(1, -(-int(both.sum()) // 64))
    if len(members) * width * 8 > BITMAP_BYTES:
        return _one_by_one(sets, others, i, j)
    row = np.repeat(np.arange(len(members)), [len(m) for m in members])[both[at]]
    at = (np.cumsum(both) - 1)[at[both[at]]]
    packed = np.zeros((len(members), width), dtype=np.uint64)
    np.bitwise_or.at(packed, (row, at >> 6), np.uint64(1) << (at & 63).astype(np.uint64))
    a, b = np.searchsorted(used[0], i), len(used[0]) + np.searchsorted(used[1], j)
    step = max(1, (1 << 20) // width)
    return np.concatenate([np.bitwise_count(packed[a[k:k + step]] & packed[b[k:k + step]]).sum(axis=1, dtype=np.int64)
                           for k in range(0, len(a), step)])


def _compare(scheme: Scheme):
    """Links between the rows that meet, by their full sets: those that bring
    components together which earlier ones here have not."""
    def columns(b):
        return (*(b.column(i).to_numpy() for i in (7, 8, 9)), _signatures(b.column(10), scheme), scheme.sets(texts_of(b.column(11))))

    def run(batches):
        links, parent = [], {}

        def root(x):
            while (p := parent.get(x, x)) != x:
                x = p
            return x

        for new, kind, out, rows in _lists(batches, columns):
            i, j, _ = _candidates(scheme, rows[:4], out[:4], *kind)
            x, y = (np.array([len(s) for s in sets], dtype=np.int64)[at] for sets, at in ((out[4], i), (rows[4], j)))
            able = 100 * np.minimum(x, y) >= scheme.percent * np.maximum(x, y)
            i, j, size = i[able], j[able], (x + y)[able]
            if not len(i):
                continue
            both = _shared_counts(out[4], rows[4], i, j)
            similar = 100 * both >= scheme.percent * (size - both)
            for a, b in zip(i[similar].tolist(), j[similar].tolist()):
                x, y = root(out[1][a]), root(rows[1][b])
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    links.append((out[0][a], rows[0][b]))
            if len(links) > 1 << 14:
                yield batch(_PAIRS, *zip(*links))
                links = []
        if links:
            yield batch(_PAIRS, *zip(*links))
    return run


def _confirm(scheme: Scheme):
    """Sorted rows: a pivot's text (flag 0), then the texts to compare it with."""
    def run(batches):
        pivot = None
        for b in small(batches):
            sets = scheme.sets(texts_of(b.column(4)))
            out = []
            for p, flag, q, s in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), sets):
                if flag == 0:
                    pivot = s
                elif 100 * min(len(pivot), len(s)) >= scheme.percent * max(len(pivot), len(s)):
                    both = len(np.intersect1d(pivot, s, assume_unique=True))
                    if 100 * both >= scheme.percent * (len(pivot) + len(s) - both):
                        out.append((p, q))
            if out:
                yield batch(_PAIRS, *zip(*out))
    return run


def _first_lists(posts: DataFrame) -> DataFrame:
    """``_listed`` for first keys: most are an item's alone, so counting them in the map
    tasks saves nothing, and one shuffle of the 16-byte posts does for count and members."""
    return posts.withColumn("n", F.count("*").over(Window.partitionBy("key"))).where("n > 1")


def _listed(posts: DataFrame) -> DataFrame:
    """Posts under keys that several items share, with the number of items."""
    shared = posts.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    return posts.join(shared, "key")


def _with_pivots(lists: DataFrame, items: DataFrame, texts: DataFrame, scheme: Scheme) -> DataFrame:
    """Stored links (a, b) of the members of each list with its pivot."""
    score = F.sum("n").over(Window.partitionBy("id"))  # of an item's few lists
    pivots = (lists.withColumn("score", score).groupBy("key")
              .agg(F.max(F.struct("score", (-F.col("id")).alias("neg"))).alias("top")).select("key", (-F.col("top.neg")).alias("p")))
    pairs = lists.join(pivots, "key").where("id <> p").select("p", F.col("id").alias("q")).distinct()
    sides = [items.select(F.col("id").alias(c), F.col("size").alias(f"size_{c}"), F.col("sig").alias(f"sig_{c}")) for c in "pq"]
    pairs = stored(pairs.join(sides[0], "p").join(sides[1], "q").select("p", "q", "size_p", "size_q", "sig_p", "sig_q")
                   .mapInArrow(_close(scheme), _ddl(_PAIRS)), "pairs")
    counts = pairs.groupBy("p").agg(F.count("*").alias("n"))
    chunk = F.pmod(F.xxhash64("q"), F.ceil(F.col("n") / 512)).cast("int")
    rows = pairs.join(counts, "p").select("p", chunk.alias("chunk"), "q")
    others = rows.join(texts, rows.q == texts.id).select("p", "chunk", F.lit(1).alias("flag"), "q", "text")
    pivots = rows.select("p", "chunk").distinct()
    pivots = pivots.join(texts, pivots.p == texts.id).select("p", "chunk", F.lit(0).alias("flag"), F.col("p").alias("q"), "text")
    links = stored(pivots.union(others).repartition("p", "chunk").sortWithinPartitions("p", "chunk", "flag")
                   .mapInArrow(_confirm(scheme), _ddl(_PAIRS)), "links")
    drop(pairs)
    return links.toDF("a", "b")


def _open_lists(lists: DataFrame, comps: DataFrame, least: int) -> DataFrame:
    """Members of the lists of ``least`` or more that hold several components, with comp,
    the list's size ``n``, the number ``n_out`` outside its largest component, and ``out``."""
    rows = lists.drop("n").join(comps.withColumnRenamed("node", "id"), "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    per = (rows.groupBy("key", "comp").agg(F.count("*").alias("c")).groupBy("key")
           .agg(F.sum("c").alias("n"), F.max(F.struct("c", "comp")).alias("top")).withColumn("n_out", F.col("n") - F.col("top.c")))
    return (rows.join(per.where((F.col("n_out") > 0) & (F.col("n") >= least)), "key")
            .select("key", "base", "last", "ext", "id", "comp", "n", "n_out", (F.col("comp") != F.col("top.comp")).alias("out")))


def _links_across(rows: DataFrame, items: DataFrame, texts: DataFrame, scheme: Scheme) -> DataFrame:
    """Stored links (a, b) between the components of open lists."""
    rows = rows.join(items, "id")
    chunks, blocks = F.ceil(F.col("n") / CHUNK).cast("int"), F.ceil(F.col("n_out") / BLOCK).cast("int")
    own = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    place, tail = ["key", "chunk", "block", "flag"], ["base", "last", "ext", "id", "comp", "size", "sig"]
    outside = rows.where("out").select("key", every(chunks).alias("chunk"), own(blocks, 1).alias("block"), F.lit(0).alias("flag"), *tail)
    members = rows.select("key", own(chunks, 2).alias("chunk"), every(blocks).alias("block"), F.lit(1).alias("flag"), *tail)
    met = outside.union(members)
    sorted_ = lambda df: df.repartition(*place[:3]).sortWithinPartitions(*place)
    wanted = stored(sorted_(met).mapInArrow(_wanted(scheme), _ddl(_PLACE)).distinct(), "wanted")
    kinds = rows.select("key", "base", "last", "ext", "id", "comp", "size", "sig")
    full = wanted.join(kinds, ["key", "id"]).join(texts, "id").select(*place, *tail, "text")
    links = stored(sorted_(full).mapInArrow(_compare(scheme), _ddl(_PAIRS)), "links")
    drop(wanted)
    return links.toDF("a", "b")


def linked(items: DataFrame, texts: Callable[[DataFrame], DataFrame], scheme: Scheme) -> DataFrame:
    """Components of similar items: node, comp (see ``components``).

    ``items``: stored table of id, size (distinct shingles, equal for all if not
    known), sig and any other columns; ``texts``: gives the texts (id, text) of a
    table of ids, which has those other columns too."""
    if len(scheme.coordinates) > BASES:
        raise ValueError(f"more than {BASES} first keys")
    posts = items.select("id", "sig").mapInArrow(_post(scheme), _ddl(_FIRST))
    base = F.col("key").bitwiseAND(F.lit(BASES - 1)).cast("int")
    lists = stored(_first_lists(posts).select("key", base.alias("base"), F.lit(-1).alias("last"), F.lit(0).alias("ext"), "id", "n"), "lists")
    # most items share no key: later joins read the members of lists only
    members = stored(items.join(lists.select("id").hint("shuffle_hash"), "id", "left_semi"), "members")
    bodies = stored(texts(members.drop("size", "sig")).select("id", "text"), "bodies")
    items = members.select("id", "size", "sig")
    links = _with_pivots(lists, items, bodies, scheme)
    comps = components(links)
    drop(links)
    hot = F.col("n_out") > OUTSIDE
    for depth in range(DEPTH + 1):
        least = 2 if depth else 3  # first lists of two were compared with their pivot, longer keys have none
        rows = stored(_open_lists(lists, comps, least), "open")
        drop(lists)
        now = rows if depth == DEPTH else rows.where(~hot)
        links = _links_across(now, items, bodies, scheme)
        if not links.isEmpty():
            before, both = comps, stored(comps.toDF("a", "b").union(links), "links")
            comps = components(both)
            drop(before)
            drop(both)
        drop(links)
        if depth == DEPTH or rows.where(hot).isEmpty():
            break
        longer = rows.where(hot).join(items.select("id", "sig"), "id").select("key", "base", "last", "ext", "id", "sig")
        lists = stored(_listed(longer.mapInArrow(_post_anew(scheme), _ddl(_POSTS))), "lists")
        drop(rows)
    drop(rows)
    drop(bodies)
    drop(members)
    return comps
