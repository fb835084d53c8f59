"""Fuzzy line dedup by MinHash.

Lines are compared in lower case (A-Z) with white space collapsed. Equal lines
are one item. The signature hashes each character shingle once: the shingle's
bin is a coordinate, the bin's least value its MinHash, and empty bins borrow
from the next full one. Bands of three coordinates make the keys; at a
similarity of 0.85 a pair shares none of nine bands with a probability of 2e-4.
In short lines few shingles fill many bins, and one that differs changes all
coordinates borrowed from it; such lines are marked and become candidates with
a band and as many more agreements as longer keys need (``similar.DEPTH``).
Candidates are confirmed on exact shingle sets, and of each component of lines
the first one stays.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import batch, mix, ragged, runs, small, stored, texts_of
from .similar import DEPTH, Scheme, linked

SHINGLE = 8  # characters
BANDS = 9
BAND = 3
MATCHES = 13  # of 27; fewer at similarity 0.85 have a probability of 1e-6
SIGNED_BYTES = 1 << 17  # of lines signed at a time: work arrays stay in the cache
BORROWED = 8  # a line that borrows more than one in so many coordinates is marked
PERCENT = 85


def plain_line(line: bytes) -> bytes:
    return b" ".join(line.lower().split())


def plain_lines(text: bytes) -> list[bytes]:
    """``plain_line`` of each line of the text."""
    lines = text.lower().split(b"\n")
    if any(x in text for x in (b"  ", b"\t", b"\r", b"\v", b"\f")):
        return [b" ".join(x.split()) for x in lines]
    return [x.strip() for x in lines]  # single spaces only


@lru_cache(maxsize=1)
def _code_values() -> np.ndarray:
    return np.random.default_rng(8).integers(1, 2**64, 65536, dtype=np.uint64)


def char_shingles(lines: list[bytes], n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-character runs of all lines, and their number by line; a
    shorter line that is not empty is one shingle."""
    pad = n - 1  # code 0 behind each line, so that short lines have a run too
    joined = (b"\0" * pad).join(lines) + b"\0" * pad
    if joined.isascii():
        codes, texts = np.frombuffer(joined, dtype=np.uint8), lines
        h = _code_values()[codes]
    else:
        texts = [x.decode("utf-8", "replace") for x in lines]
        joined = ("\0" * pad).join(texts) + "\0" * pad
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        h = _code_values()[codes & 0xFFFF]
        if len(codes) and codes.max() > 0xFFFF:
            h = np.where(codes > 0xFFFF, mix(codes.astype(np.uint64)), h)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    power, have = 0x9FB21C651E98DF25, 1
    while have < n:  # n is a power of two
        longer = h[:len(h) - have] * np.uint64(power)
        longer += h[have:]
        h, power, have = longer, power * power % 2**64, 2 * have
    counts = np.where(lengths > 0, np.maximum(lengths - n + 1, 1), 0)
    ends, beyond = np.cumsum(lengths + pad), lengths + pad - counts
    own = np.ones(len(codes), dtype=bool)
    own[ragged(ends - beyond, beyond)] = False  # runs that begin behind the last of their line
    return h[own[:len(h)]], counts


def signatures(hashes: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """One-permutation MinHash of each line that has shingles: k 16-bit values,
    and 1 if many of them are borrowed, else 0."""
    n = len(counts)
    value = hashes >> np.uint64(29)  # in place from here: these arrays are as long as the text
    value ^= hashes
    value *= np.uint64(0xBF58476D1CE4E5B9)
    bins = value >> np.uint64(32)
    bins *= np.uint64(k)
    bins >>= np.uint64(32)
    at = bins.view(np.int64)
    at += np.repeat(np.arange(n) * k, counts)
    value >>= np.uint64(16)
    value &= np.uint64(0xFFFFFFFF)
    least = np.full(n * k, 1 << 32, dtype=np.uint64)  # above any value
    np.minimum.at(least, at, value)
    least = least.reshape(n, k)
    full = least < np.uint64(1 << 32)
    least = np.minimum(least, 0xFFFFFFFF).astype(np.uint32)
    borrow = np.flatnonzero(~full.all(axis=1) & (counts > 0))
    twice = np.where(np.tile(full[borrow], 2), np.arange(2 * k), 2 * k)  # the bins once more behind the last
    source = np.minimum.accumulate(twice[:, ::-1], axis=1)[:, :k - 1:-1]  # of each bin the next full one
    distance = source - np.arange(k)
    least[borrow] = least[borrow[:, None], source % k] + (distance * 0x9E3779B1 & 0xFFFFFFFF).astype(np.uint32)
    out = (mix(least.astype(np.uint64)) & np.uint64(0xFFFF)).astype(np.uint16)
    return np.column_stack((out, ((~full).sum(axis=1) > k // BORROWED).astype(np.uint16)))


def shingle_sets(lines: list[bytes]) -> list[np.ndarray]:
    out = []
    for lo, hi in runs(lines, SIGNED_BYTES):
        hashes, counts = char_shingles(lines[lo:hi])
        ends = np.cumsum(counts)
        starts = ends - counts
        for a, b in zip(starts.tolist(), ends.tolist()):
            hashes[a:b].sort()
        new = np.ones(len(hashes), dtype=bool)
        new[1:] = hashes[1:] != hashes[:-1]
        new[starts[counts > 0]] = True
        hashes, at = hashes[new], np.concatenate(([0], np.cumsum(new)))
        out += [hashes[a:b] for a, b in zip(at[starts].tolist(), at[ends].tolist())]
    return out


def _key(line: bytes) -> bytes:
    return hashlib.blake2b(line, digest_size=16).digest()


def _split(k: int):
    """Each line with words: where it stands, its key and its signature."""
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("number", pa.int32()), ("key", pa.binary()), ("sig", pa.binary())])

    def run(batches):
        for b in small(batches):
            out, size = ([], [], [], [], []), 0
            for row, doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts_of(b.column(2))):
                for number, line in enumerate(plain_lines(text)):
                    if line:
                        for column, value in zip(out, (row, doc_id, number, _key(line), line)):
                            column.append(value)
                        size += len(line)
                if size > 1 << 21:
                    yield signed(out)
                    out, size = ([], [], [], [], []), 0
            if out[0]:
                yield signed(out)

    def signed(out):
        lines = out[4]
        sigs = np.concatenate([signatures(*char_shingles(lines[lo:hi]), k) for lo, hi in runs(lines, SIGNED_BYTES)])
        return batch(schema, *out[:4], [s.tobytes() for s in sigs])

    return run


def _picked(batches):
    """The lines of each text whose numbers and ids are listed."""
    schema = pa.schema([("id", pa.int64()), ("text", pa.binary())])
    for b in small(batches):
        ids, lines = [], []
        for text, wanted in zip(texts_of(b.column(0)), b.column(1).to_pylist()):
            found = text.split(b"\n")
            ids += [w["id"] for w in wanted]
            lines += [plain_line(found[w["number"]]) for w in wanted]
        yield batch(schema, ids, lines)


def kept_lines(docs: DataFrame, percent: int = PERCENT, bands: int = BANDS, band: int = BAND, matches: int = MATCHES) -> DataFrame:
    """The line of each component that stays: row, doc_id, number (from 0).

    ``docs`` has row (its number, the same each time it is read), doc_id and
    text. Of a component the line that comes first by (doc_id, row, number)
    stays, null doc_ids last."""
    k = bands * band
    plain = docs.select("row", F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text"))
    lines = plain.mapInArrow(_split(k), "row long, doc_id long, number int, key binary, sig binary")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "number")
    items = stored(lines.groupBy("key").agg(F.min(place).alias("place"), F.first("sig").alias("sig"))
                   .withColumn("id", F.monotonically_increasing_id()).withColumn("size", F.lit(1)), "lines")

    def texts(ids: DataFrame) -> DataFrame:
        wanted = ids.groupBy("place.row").agg(F.collect_list(F.struct("place.number", "id")).alias("wanted"))  # at most a text's lines
        return plain.join(wanted.hint("shuffle_hash"), "row").select("text", "wanted").mapInArrow(_picked, "id long, text binary")

    bands_of = tuple(tuple(range(i * band, (i + 1) * band)) for i in range(bands))
    comps = linked(items, texts, Scheme(k, matches, percent, np.uint16, bands_of, shingle_sets, min(matches, band + DEPTH)))
    # most lines are in no component: only the others are grouped
    known = comps.select(F.col("node").alias("id"), "comp").union(comps.select(F.col("comp").alias("id"), "comp").distinct())
    places = items.select("id", "place")
    alone = places.join(known.select("id").hint("shuffle_hash"), "id", "left_anti").select("place")
    first = places.join(known.hint("shuffle_hash"), "id").groupBy("comp").agg(F.min("place").alias("place")).select("place")
    return alone.union(first).select("place.row", "place.doc_id", "place.number")


def _with_rows(docs: DataFrame) -> DataFrame:
    """Stored, as a later scan may be split otherwise and number other rows so."""
    return stored(docs.withColumn("__row", F.monotonically_increasing_id()), "line-documents")


def _kept_by_row(docs: DataFrame, **options) -> DataFrame:
    kept = kept_lines(docs.select(F.col("__row").alias("row"), "doc_id", "text"), **options)
    return kept.groupBy(F.col("row").alias("__row")).agg(F.sort_array(F.collect_list("number")).alias("__kept"))


def dedup_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` (doc_id, text, any other columns) without fuzzy repeats of lines.

    Lines end at a line feed. A line stays if it has no words, or if it is the
    first of its component by (doc_id, row, line). Lines compare without case
    (A-Z) and by 8-character shingles. A null text stays null, and no row goes,
    even if nothing of its text is left. Bytes that are not UTF-8 stay as they
    are. Columns called __row or __kept are left out. ``docs`` is read once and stored with its row numbers."""
    names = [c for c in docs.columns if c not in ("__row", "__kept")]
    docs = _with_rows(docs.select(*[F.col(f"`{c}`") for c in names]))
    at = names.index("text")

    def run(batches):
        for b in small(batches):
            out = []
            for text, kept in zip(b.column(at).cast(pa.binary()).to_pylist(), b.column(len(names)).to_pylist()):
                if text is not None:
                    stay = set(kept or ())
                    text = b"\n".join(x for i, x in enumerate(text.split(b"\n")) if i in stay or not plain_line(x))
                out.append(text)
            columns = list(b.columns[:len(names)])
            columns[at] = pa.array(out, pa.binary()).cast(pa.string(), safe=False)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.join(_kept_by_row(docs, **options), "__row", "left").select(*[F.col(f"`{c}`") for c in names], "__kept")
    return rows.mapInArrow(run, docs.drop("__row").schema)


def line_report(docs: DataFrame, **options) -> DataFrame:
    """Per row of ``docs``: doc_id, n_lines (with words), n_kept and kept, the
    numbers of the lines that stay (see ``dedup_lines``), from 0."""
    counted = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]"))))
    docs = _with_rows(docs.select("doc_id", "text", counted.cast("long").alias("n_lines")))  # so the texts need no further scan
    rows = docs.select("__row", "doc_id", "n_lines")
    kept = F.coalesce("__kept", F.array().cast("array<int>"))
    return (rows.join(_kept_by_row(docs, **options), "__row", "left")
            .select("doc_id", "n_lines", F.size(kept).cast("long").alias("n_kept"), kept.alias("kept")))
