"""Near duplicates by a signature-coordinate inverted join.

A document's set holds the hashes of its distinct word shingles. Its MinHash
signature has ``COORDINATES`` values. Documents are posted under each
(coordinate, value) of a prefix of the signature: two signatures that agree in
``MATCHES`` coordinates agree in at least one of any COORDINATES - MATCHES + 1.
Collisions of candidates are counted over whole signatures, pairs below the
match threshold or out of reach by size are skipped, and the rest is confirmed
on the full sets. At similarity 0.85 a pair has fewer than 12 of 24 agreements
with a probability of 8e-6.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import batch, mix, runs, small, stored, texts_of, window_hashes, word_hashes
from .similar import Scheme, linked

SHINGLE = 5
COORDINATES = 24
MATCHES = 12
PERCENT = 85

_ROWS = "row long, doc_id long, n_shingles long, digest binary, sig binary, text_key binary"


def word_shingles(values: list[bytes], n: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's n-word runs, A-Z lower-cased; with
    fewer words, of all words as one; without words none."""
    out = []
    for lo, hi in runs(values):
        _, _, counts, (words,) = word_hashes([v.lower() for v in values[lo:hi]])
        windows = window_hashes(words, n)
        first = np.cumsum(counts) - counts
        for f, c in zip(first.tolist(), counts.tolist()):
            out.append(np.unique(windows[f:f + c - n + 1]) if c >= n else window_hashes(words[f:f + c], c) if c else words[:0])
    return out


def signatures(sets: list[np.ndarray], k: int = COORDINATES) -> np.ndarray:
    """MinHash values of non-empty sets, one row of k 32-bit values each."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    rng = np.random.default_rng(10)
    odd, add = rng.integers(0, 2**63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**64, k, dtype=np.uint64)
    out = np.empty((len(sets), k), dtype=np.uint32)
    for j in range(k):
        out[:, j] = mix(np.minimum.reduceat(flat * odd[j] + add[j], starts)) >> np.uint64(32)
    return out


def scheme(percent: int = PERCENT, k: int = COORDINATES, matches: int = MATCHES) -> Scheme:
    return Scheme(k, matches, percent, np.uint32, tuple((c,) for c in range(k - matches + 1)), word_shingles)


def _key(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _mark(batches):
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()),
                        ("sig", pa.binary()), ("text_key", pa.binary())])
    for b in small(batches):
        values = texts_of(b.column(2))
        for lo, hi in runs(values):
            sets = word_shingles(values[lo:hi])
            full = [i for i, s in enumerate(sets) if len(s)]
            sigs: list[bytes | None] = [None] * len(sets)
            if full:
                for i, s in zip(full, signatures([sets[i] for i in full])):
                    sigs[i] = s.tobytes()
            yield batch(schema, b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), [len(s) for s in sets],
                        [_key(s.tobytes()) if len(s) else None for s in sets], sigs, map(_key, values[lo:hi]))


def _keyed(batches):
    schema = pa.schema([("text_key", pa.binary()), ("text", pa.binary())])
    for b in small(batches):
        values = texts_of(b.column(0))
        yield batch(schema, map(_key, values), values)


def _grouped(docs: DataFrame, percent: int, k: int, matches: int) -> DataFrame:
    """row, doc_id, n_shingles, comp (null without words) and the component's
    ``least`` doc_id and ``first`` row; ``docs`` has row, doc_id and text."""
    plain = docs.select("row", F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text"))
    marked = stored(plain.mapInArrow(_mark, _ROWS), "marked")
    items = stored(marked.where("digest is not null").groupBy("digest")
                   .agg(F.first("n_shingles").alias("size"), F.first("sig").alias("sig"), F.first("text_key").alias("text_key"))
                   .withColumn("id", F.monotonically_increasing_id()), "items")

    def texts(ids: DataFrame) -> DataFrame:
        found = plain.select("text").mapInArrow(_keyed, "text_key binary, text binary").join(ids.select("id", "text_key"), "text_key")
        return found.groupBy("id").agg(F.first("text").alias("text"))  # one of equal texts

    comps = linked(items, texts, scheme(percent, k, matches))
    comp = (items.select("id", "digest").join(comps.withColumnRenamed("node", "id"), "id", "left")
            .select("digest", F.coalesce("comp", "id").alias("comp")))
    rows = marked.select("row", "doc_id", "n_shingles", "digest").join(comp, "digest", "left").drop("digest")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    least = (rows.where("comp is not null").groupBy("comp").agg(first.alias("first"))
             .select("comp", F.col("first.doc_id").alias("least"), F.col("first.row").alias("first")))
    return rows.join(least, "comp", "left")


def near_dedup(docs: DataFrame, percent: int = PERCENT, k: int = COORDINATES, matches: int = MATCHES) -> DataFrame:
    """Groups of near-duplicate documents of ``docs`` (doc_id, text).

    Two documents are linked if 100 * intersection >= percent * union of their
    shingle sets. Returns one row per input row: doc_id, n_shingles,
    component_id (the smallest doc_id of the group, null ones left out) and
    kept (doc_id is the component's). A document without words (null text too)
    is a group of its own. Equal sets are one item, whatever their number. Of a
    group whose doc_ids are all null, all rows are kept, as are repeated rows of
    the smallest doc_id. Other columns are ignored; an empty table gives an
    empty result."""
    rows = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    component = F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return (_grouped(rows, percent, k, matches).withColumn("component_id", component)
            .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))


def one_per_group(docs: DataFrame, percent: int = PERCENT, k: int = COORDINATES, matches: int = MATCHES) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, with all columns: the
    first by doc_id (null last). Rows without words all stay. ``docs`` is read
    once and stored with its row numbers; a column called __row is left out."""
    names = [c for c in docs.columns if c != "__row"]
    docs = docs.select(*[F.col(f"`{c}`") for c in names]).withColumn("__row", F.monotonically_increasing_id())
    docs = stored(docs, "near-documents")  # a later scan may be split otherwise and number other rows so
    found = _grouped(docs.select(F.col("__row").alias("row"), "doc_id", "text"), percent, k, matches)
    stay = found.where("comp is null or row = first").select(F.col("row").alias("__row"))
    return docs.join(stay, "__row", "left_semi").select(*[F.col(f"`{c}`") for c in names])
