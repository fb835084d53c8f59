"""Helpers of the operators: shared storage, Arrow batches, word hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, StructType

# Fixed by the contracts: words are runs of bytes other than these.
WHITE_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
SEGMENT_BYTES = 1 << 16


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only a local session without that setting gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="inboxlens-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends
    there, so a lost executor costs a re-read and row ids given once stay."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    # Spark deletes shuffle files once the driver's JVM finds them unused. Those of the step
    # before are by now; right after a step, its events still hold them.
    spark.sparkContext._jvm.System.gc()
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(table: DataFrame) -> None:
    """Delete a table that ``stored`` wrote, once no later step reads it."""
    spark = table.sparkSession
    for name in table.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(name).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def extended(df: DataFrame, **columns: str) -> StructType:
    """The schema of ``df`` with further columns."""
    schema = StructType(list(df.schema.fields))
    for name, kind in columns.items():
        schema = schema.add(name, DataType.fromDDL(kind))
    return schema


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each value; null counts as empty."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def small(batches: Iterable[pa.RecordBatch], budget: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``budget`` bytes (or one row), so that what
    is made of them in Python stays small."""
    todo = []
    for b in batches:
        todo.append(b)
        while todo:
            part = todo.pop()
            if part.nbytes > budget and part.num_rows > 1:
                half = part.num_rows // 2
                todo += [part.slice(half), part.slice(0, half)]
            else:
                yield part


def runs(values: list[bytes], budget: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Split values into index ranges of about ``budget`` bytes."""
    lo = size = 0
    for i, v in enumerate(values):
        size += len(v) + 1
        if size >= budget:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(values):
        yield lo, len(values)


def batch(schema: pa.Schema, *columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)],
        schema=schema)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=8)
def _tables(seed: int) -> tuple[np.ndarray, np.ndarray, np.uint64]:
    """Random value of each byte, powers of a random odd base, and the base."""
    rng = np.random.default_rng(seed)
    values = rng.integers(1, 2**64, 256, dtype=np.uint64)
    base = np.uint64(int(rng.integers(1, 2**62, dtype=np.uint64)) * 2 + 1)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(65536, base, dtype=np.uint64))
    return values, powers, base


def _space_flags() -> np.ndarray:
    flags = np.zeros(256, dtype=bool)
    flags[list(WHITE_SPACE)] = True
    return flags


def word_hashes(values: list[bytes], seeds: tuple[int, ...] = (1,)) -> tuple[bytes, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Words of several texts at once.

    Returns the texts joined by a space, the byte offset at which each word
    starts, the number of words of each text, and for each seed a 64-bit hash
    of every word. Work arrays are bounded by ``SEGMENT_BYTES`` (or the longest
    word) whatever the length of a text."""
    joined = b" ".join(values)
    buf = np.frombuffer(joined, dtype=np.uint8)
    space = _space_flags()[buf]
    word = ~space
    word[1:] &= space[:-1]
    starts = np.flatnonzero(word)
    lengths = np.fromiter(map(len, values), dtype=np.int64, count=len(values))
    offsets = np.concatenate(([0], np.cumsum(lengths + 1)))
    counts = np.diff(np.searchsorted(starts, offsets))
    hashes = [np.empty(len(starts), dtype=np.uint64) for _ in seeds]
    cuts = np.unique(np.concatenate((np.searchsorted(starts, np.arange(0, len(buf), SEGMENT_BYTES)), [len(starts)])))
    for a, b in zip(cuts[:-1], cuts[1:]):
        lo, hi = starts[a], starts[b] if b < len(starts) else len(buf)
        first = starts[a:b] - lo
        at = np.arange(hi - lo) - np.repeat(first, np.diff(np.append(first, hi - lo)))
        part, blank = buf[lo:hi], space[lo:hi]
        for seed, out in zip(seeds, hashes):
            byte, powers, base = _tables(seed)
            terms = byte[part] * powers[at & 0xFFFF]
            if hi - lo > 65536 and at.max() > 0xFFFF:
                terms = mix(terms ^ ((at >> 16).astype(np.uint64) * GOLDEN))
            terms[blank] = 0
            out[a:b] = mix(np.add.reduceat(terms, first))
    return joined, starts, counts, hashes


def window_hashes(words: np.ndarray, n: int, seed: int = 1) -> np.ndarray:
    """Hash of each run of ``n`` word hashes, by doubling; empty if too short."""
    if len(words) < n:
        return np.empty(0, dtype=np.uint64)
    _, powers, base = _tables(seed)
    power = lambda k: np.uint64(pow(int(base), k, 2**64))
    out, have, block, size = None, 0, words, 1
    while True:
        if n & size:
            if out is None:
                out, have = block, size
            else:
                m = len(block) - have
                out, have = out[:m] + block[have:have + m] * power(have), have + size
        if size * 2 > n:
            return mix(out[:len(words) - n + 1] + np.uint64(n * int(GOLDEN) % 2**64))
        block = block[:-size] + block[size:] * power(size)
        size *= 2


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each run, one run after another."""
    total = int(counts.sum())
    if not total:
        return np.empty(0, dtype=np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)
