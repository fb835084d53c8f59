"""Substring dedup: words covered by repeated windows go.

A window is ``window`` consecutive words of one text. Pass 1 builds count-min
sketches, one set per task, that are merged by adding; their counters stop at
two, as only "once" or "repeated" matters. Pass 2 takes only the windows that
the merged sketch estimates as repeated and groups them exactly. A sketch never
underestimates, so no repeated window is lost; what it overestimates, the exact
grouping finds to occur once.

To keep the sketch small it counts one anchor per window: of the ``gram``-word
runs inside, the one with the smallest hash. Neighbouring windows mostly share
it, so there are about ten times fewer anchors than windows. Each place of a
window has its own place of the anchor, so the anchor's count is never below
the window's. The sketch is as wide as the input asks for. One of ``max_cells``
a row at most is broadcast. A wider one stays dealt out by ranges of its cells,
and the anchors go to it: a few bytes each, and only those that their own task
has not counted twice already, so that a passage in very many texts asks little.

Exact grouping compares two 64-bit hashes of the windows' words, each over word
hashes of its own. It collapses
repeats before the shuffle, so a passage that a third of all texts share is a
row per task. Only windows that occur once go back to their texts, keyed by the
text's digest; equal texts have none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import batch, extended, mix, ragged, runs, small, stored, texts_of, window_hashes, word_hashes

WINDOW = 35
GRAM = 16
SKETCH_ROWS = 2
SEGMENT = 1 << 16  # cells of a row that are merged together; an anchor has its cells in one segment
CELL_BYTES = 12  # of text for each cell of a row: a few in a hundred anchors are overestimated
MAX_CELLS = 1 << 28  # of a row, if broadcast: SKETCH_ROWS * MAX_CELLS / 8 bytes at most
FLUSH = 1 << 21


def _anchors(words: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of the words: hash and place of its leftmost smallest gram."""
    best = window_hashes(words, gram, 3)
    place = np.arange(len(best))
    span, have = window - gram + 1, 1
    while have < span:
        step = min(have, span - have)
        left = best[:-step] <= best[step:]
        best, place = np.where(left, best[:-step], best[step:]), np.where(left, place[:-step], place[step:])
        have += step
    return best, place


def _valid(counts: np.ndarray, window: int) -> np.ndarray:
    """Places of the windows that lie within one text."""
    return ragged(np.cumsum(counts) - counts, np.maximum(counts - window + 1, 0))


def _segments(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (mix(hashes) >> np.uint64(1) >> np.uint64(79 - bits)).astype(np.int64)


def _cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    """A row's cell of each anchor: its segment, the same in all rows, and a place in it."""
    inside = mix(hashes ^ np.uint64((row + 1) * 0x51_7CC1_B727_220A_95)) & np.uint64(SEGMENT - 1)
    return _segments(hashes, bits) * SEGMENT + inside.astype(np.int64)


_PART = pa.schema([("r", pa.int32()), ("segment", pa.int64()), ("once", pa.binary()), ("more", pa.binary())])
_BITS = pa.schema([("r", pa.int32()), ("segment", pa.int64()), ("bits", pa.binary())])


def _partial(hashes: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """One task's sketch, sparse: per segment the cells hit once and more often."""
    for r in range(SKETCH_ROWS):
        cells, n = np.unique(_cells(hashes, r, bits), return_counts=True)
        first = np.flatnonzero(np.concatenate(([True], np.diff(cells >> 16) != 0)))
        low, lists = (cells & 0xFFFF).astype(np.uint16), []
        for chosen in (n == 1, n > 1):
            ends = np.concatenate(([0], np.cumsum(chosen)))[np.append(first, len(cells))] * 2
            lists.append(pa.BinaryArray.from_buffers(pa.binary(), len(first), [
                None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(low[chosen].tobytes())]))
        yield batch(_PART, np.full(len(first), r, np.int32), cells[first] >> 16, *lists)


def _merge(batches):
    """Sum the sorted partial sketches of each segment; a bit per repeated cell."""
    at, sums = None, np.zeros(SEGMENT, dtype=np.uint8)
    full = lambda: batch(_BITS, [at[0]], [at[1]], [np.packbits(sums >= 2, bitorder="little").tobytes()])
    for b in batches:
        for r, segment, once, more in zip(*(c.to_pylist() for c in b.columns)):
            if (r, segment) != at:
                if at is not None:
                    yield full()
                at, sums[:] = (r, segment), 0
            for cells, add in ((once, 1), (more, 2)):
                cells = np.frombuffer(cells, dtype=np.uint16)
                sums[cells] = np.minimum(sums[cells] + add, 2)
    if at is not None:
        yield full()


def _heads(words: np.ndarray, counts: np.ndarray, window: int, gram: int):
    """The windows within a text and, of each run of them that shares its anchor:
    where it starts among them, the anchor's hash, text and place in the text."""
    valid = _valid(counts, window)
    if not len(valid):
        return (valid,) * 5
    best, place = _anchors(words, window, gram)
    best, place = best[valid], place[valid]
    head = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    first = np.cumsum(counts) - counts
    doc = np.searchsorted(first, valid[head], side="right") - 1
    return valid, head, best[head], doc, place[head] - first[doc]


def sketch_bits(texts: DataFrame) -> int:
    """Width of the sketch of a binary ``text`` column: it follows the input."""
    size = texts.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    return max(16, (size // CELL_BYTES).bit_length())


def repeated_sketch(texts: DataFrame, window: int, gram: int, bits: int) -> DataFrame:
    """The merged sketch of a binary ``text`` column: r, segment and a bit per cell
    of the segment that counts two or more."""
    def run(batches):
        held, n = [], 0
        for b in small(batches):
            values = texts_of(b.column(0))
            for lo, hi in runs(values):
                _, _, counts, (words,) = word_hashes(values[lo:hi])
                _, _, hashes, _, _ = _heads(words, counts, window, gram)
                if not len(hashes):
                    continue
                held.append(hashes)
                n += len(hashes)
                if n >= FLUSH:
                    yield from _partial(np.concatenate(held), bits)
                    held, n = [], 0
        if n:
            yield from _partial(np.concatenate(held), bits)

    return (texts.select("text").mapInArrow(run, "r int, segment long, once binary, more binary")
            .repartition("r", "segment").sortWithinPartitions("r", "segment")
            .mapInArrow(_merge, "r int, segment long, bits binary"))


def _whole_sketch(merged: DataFrame, bits: int) -> np.ndarray:
    """A sketch of MAX_CELLS cells a row at most, in the driver."""
    sketch = np.zeros((SKETCH_ROWS, (1 << bits) // 8), dtype=np.uint8)
    for r, segment, cells in merged.toLocalIterator():
        sketch[r, segment * SEGMENT // 8:(segment + 1) * SEGMENT // 8] = np.frombuffer(cells, dtype=np.uint8)
    return sketch


def _in_sketch(sketch: np.ndarray, bits: int):
    def passes(hashes, doc, place):
        hit = np.ones(len(hashes), dtype=bool)
        for r in range(SKETCH_ROWS):
            cells = _cells(hashes, r, bits)
            hit &= (sketch[r, cells >> 3] >> (cells & 7).astype(np.uint8) & 1).astype(bool)
        return hit
    return passes


def _in_lists(places: list[list[int] | None]):
    """Passes the anchors whose places are listed, text by text."""
    listed = [np.array(p, dtype=np.int64) + (i << 32) for i, p in enumerate(places) if p]

    def passes(hashes, doc, place):
        return np.isin((doc.astype(np.int64) << 32) + place, np.concatenate(listed)) if listed else np.zeros(len(hashes), dtype=bool)
    return passes


_ASKED = pa.schema([("segment", pa.int64()), ("flag", pa.int32()), ("cells", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()),
                    ("place", pa.int32()), ("bits", pa.binary())])
KNOWN = SKETCH_ROWS + 1  # flag of anchors that their own task has seen twice; the sketch's rows and the asking come before


def _ask(window: int, gram: int, bits: int):
    """The anchors of texts (text, k1, k2) as questions to their segments; a text
    that a task meets again asks nothing."""
    def asked(held):
        hashes, k1, k2, place, fresh = map(np.concatenate, zip(*held))
        _, at, n = np.unique(hashes, return_inverse=True, return_counts=True)
        known = n[at] > 1
        hashes, k1, k2, place, known = (x[fresh] for x in (hashes, k1, k2, place, known))
        cells = _cells(hashes, 0, bits) & (SEGMENT - 1)
        for r in range(1, SKETCH_ROWS):
            cells = cells << 16 | _cells(hashes, r, bits) & (SEGMENT - 1)
        segment = np.where(known, mix(k1.view(np.uint64)).view(np.int64) >> 16, _segments(hashes, bits))
        for lo in range(0, len(hashes), 1 << 18):
            part = slice(lo, lo + (1 << 18))
            flag = np.where(known[part], KNOWN, SKETCH_ROWS).astype(np.int32)
            yield batch(_ASKED, *map(pa.array, (segment[part], flag, cells[part], k1[part], k2[part], place[part].astype(np.int32))),
                        pa.nulls(len(flag), pa.binary()))

    def run(batches):
        held, n, met = [], 0, set()
        for b in small(batches):
            values, k1, k2 = texts_of(b.column(0)), b.column(1).to_numpy(), b.column(2).to_numpy()
            for lo, hi in runs(values):
                _, _, counts, (words,) = word_hashes(values[lo:hi])
                _, _, hashes, doc, place = _heads(words, counts, window, gram)
                if not len(hashes):
                    continue
                fresh = np.zeros(hi - lo, dtype=bool)
                for i, key in enumerate(zip(k1[lo:hi].tolist(), k2[lo:hi].tolist())):
                    if key not in met:
                        met.add(key)
                        fresh[i] = True
                held.append((hashes, k1[lo:hi][doc], k2[lo:hi][doc], place, fresh[doc]))
                n += len(hashes)
                if n >= FLUSH:
                    yield from asked(held)
                    held, n, met = [], 0, set()
        if held:
            yield from asked(held)
    return run


def _answer(batches):
    """The anchors that pass, from sorted rows: a segment's bits, then who asks it."""
    schema, at, sketch = pa.schema([_ASKED.field(i) for i in (3, 4, 5)]), None, {}
    for b in batches:
        if not b.num_rows:
            continue
        segment, flag, cells = (b.column(i).to_numpy() for i in range(3))
        keep = flag == KNOWN
        cuts = np.flatnonzero((np.diff(segment) != 0) | (np.diff(flag) != 0)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
            if flag[lo] < SKETCH_ROWS:
                if segment[lo] != at:
                    at, sketch = segment[lo], {}
                sketch[int(flag[lo])] = np.frombuffer(b.column(6)[lo].as_py(), dtype=np.uint8)
            elif flag[lo] == SKETCH_ROWS:
                if segment[lo] != at:
                    raise ValueError("texts changed while they were read")
                hit = np.ones(hi - lo, dtype=bool)
                for r in range(SKETCH_ROWS):
                    inside = cells[lo:hi] >> 16 * (SKETCH_ROWS - 1 - r) & (SEGMENT - 1)
                    hit &= (sketch[r][inside >> 3] >> (inside & 7).astype(np.uint8) & 1).astype(bool)
                keep[lo:hi] = hit
        yield pa.RecordBatch.from_arrays([b.column(i) for i in (3, 4, 5)], schema=schema).filter(pa.array(keep))


def passing_anchors(texts: DataFrame, merged: DataFrame, window: int, gram: int, bits: int) -> DataFrame:
    """k1, k2 of each text (text, k1, k2) and the places of its anchors that the
    sketch estimates as repeated; the sketch stays dealt out by segments."""
    kinds = "segment long, flag int, cells long, k1 long, k2 long, place int, bits binary"
    asked = texts.select("text", "k1", "k2").mapInArrow(_ask(window, gram, bits), kinds)
    none = F.lit(None)
    sketch = merged.select("segment", F.col("r").alias("flag"), F.lit(0).cast("long").alias("cells"), none.cast("long").alias("k1"),
                           none.cast("long").alias("k2"), none.cast("int").alias("place"), "bits")
    found = (asked.union(sketch).repartition("segment").sortWithinPartitions("segment", "flag")
             .mapInArrow(_answer, "k1 long, k2 long, place int"))
    return found.groupBy("k1", "k2").agg(F.collect_set("place").alias("heads"))  # at most the words of one text


def _suspects(words: np.ndarray, counts: np.ndarray, window: int, gram: int, passes) -> np.ndarray:
    """Places of the windows whose anchor passes, as estimated to be repeated."""
    valid, head, *anchors = _heads(words, counts, window, gram)
    return valid[np.repeat(passes(*anchors), np.diff(np.append(head, len(valid))))] if len(valid) else valid


def _data():
    return F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")


def suspected_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, max_cells: int = MAX_CELLS):
    """``docs`` with keys of each text (__k1, __k2) and __heads; the windows that
    the sketch estimates as repeated (h1, h2, k1, k2, place); and what tells the
    anchors that pass from __heads."""
    spark, gram = docs.sparkSession, min(gram, window)
    data = _data()
    digest = F.sha2(data, 256)  # 120 bits of it, as numbers: cheap to group by
    keys = [F.conv(F.substring(digest, i, 15), 16, 10).cast("long") for i in (1, 16)]
    docs = docs.withColumn("__k1", keys[0]).withColumn("__k2", keys[1])
    texts = docs.select(data.alias("text"), F.col("__k1").alias("k1"), F.col("__k2").alias("k2"))
    bits = sketch_bits(texts)
    merged = repeated_sketch(texts, window, gram, bits)
    if 1 << bits <= max_cells:
        whole = spark.sparkContext.broadcast(_whole_sketch(merged, bits))  # bounded: see MAX_CELLS
        docs = docs.withColumn("__heads", F.lit(None).cast("array<int>"))
    else:
        whole = None
        heads = passing_anchors(texts, merged, window, gram, bits).toDF("__k1", "__k2", "__heads")
        docs = stored(docs.join(heads, ["__k1", "__k2"], "left"), "substring-texts")

    def passes(places):
        return _in_lists(places) if whole is None else _in_sketch(whole.value, bits)

    hits = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()),
                      ("place", pa.int32())])

    def emit(batches):
        for b in small(batches):
            values, places = texts_of(b.column(0)), b.column(3).to_pylist()
            for lo, hi in runs(values):
                _, _, counts, (words, others) = word_hashes(values[lo:hi], (1, 2))
                at = _suspects(words, counts, window, gram, passes(places[lo:hi]))
                if not len(at):
                    continue
                first = np.cumsum(counts) - counts
                doc = np.searchsorted(first, at, side="right") - 1
                h1, h2 = window_hashes(words, window, 5)[at], window_hashes(others, window, 6)[at]
                for k in range(0, len(at), 1 << 18):
                    part = slice(k, k + (1 << 18))
                    text = pa.array(doc[part] + lo)
                    yield batch(hits, pa.array(h1[part].view(np.int64)), pa.array(h2[part].view(np.int64)),
                                b.column(1).take(text), b.column(2).take(text),
                                pa.array((at - first[doc])[part].astype(np.int32)))

    windows = (docs.select(data.alias("text"), "__k1", "__k2", "__heads")
               .mapInArrow(emit, "h1 long, h2 long, k1 long, k2 long, place int"))
    return docs, windows, passes


def mark_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, max_cells: int = MAX_CELLS) -> DataFrame:
    """Add to ``docs`` (any columns, one called text) n_words, n_removed and
    kept_text: the kept words joined by one space.

    Words are runs of bytes other than ASCII white space; a null text has none.
    A word goes if some window that covers it has the same words as a window
    that starts anywhere else, in the same text too, judged on the input.
    Columns of those names are replaced; an empty table gives an empty result."""
    gram = min(gram, window)
    mine = ("n_words", "n_removed", "kept_text", "__k1", "__k2", "__once", "__heads")
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in mine])
    names = docs.columns
    docs, windows, passes = suspected_windows(docs, window, gram, max_cells)
    once = (windows.groupBy("h1", "h2")
            .agg(F.count("*").alias("n"), *[F.min(c).alias(c) for c in ("k1", "k2", "place")]).where("n = 1")
            .groupBy(F.col("k1").alias("__k1"), F.col("k2").alias("__k2"))
            .agg(F.collect_list("place").alias("__once")))  # at most the words of one text
    joined = (docs.join(once, ["__k1", "__k2"], "left")
              .select(*[F.col(f"`{c}`") for c in names], _data().alias("__data"), "__once", "__heads"))

    def finish(batches):
        for b in small(batches):
            values, single = texts_of(b.column(len(names))), b.column(len(names) + 1).to_pylist()
            places = b.column(len(names) + 2).to_pylist()
            n_words, n_removed, kept = [], [], []
            for lo, hi in runs(values):
                _, _, counts, (words,) = word_hashes(values[lo:hi])
                at = _suspects(words, counts, window, gram, passes(places[lo:hi]))
                first = np.cumsum(counts) - counts
                alone = [first[i] + np.array(single[lo + i], dtype=np.int64) for i in range(hi - lo) if single[lo + i]]
                if alone:
                    at = np.setdiff1d(at, np.concatenate(alone), assume_unique=True)
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                edge[at] += 1
                edge[at + window] -= 1
                gone = np.cumsum(edge[:-1]) > 0
                for i in range(hi - lo):
                    part = gone[first[i]:first[i] + counts[i]]
                    found = values[lo + i].split()
                    if part.any():
                        found = [w for w, g in zip(found, part.tolist()) if not g]
                    n_words.append(len(part))
                    n_removed.append(len(part) - len(found))
                    kept.append(b" ".join(found))
            text = pa.array(kept, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[:len(names)], pa.array(n_words, pa.int64()),
                                              pa.array(n_removed, pa.int64()), text],
                                             names=[*names, "n_words", "n_removed", "kept_text"])

    return joined.mapInArrow(finish, extended(docs.select(*[F.col(f"`{c}`") for c in names]), n_words="long", n_removed="long", kept_text="string"))
