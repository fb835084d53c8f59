"""Exact duplicates by deterministic block naming.

A text without white space is cut into blocks of a fixed number of bytes. All
blocks of all texts are range-sorted by content, and equal blocks get the same
integer name (their dense rank). Then adjacent names are paired and the pairs
are named the same way, again and again, until each text has a single name.
Names are ranks of contents, never hashes, so two texts share a name only if
they are equal.

The sort is by (two hashes, content, row): the hashes only order the blocks, so
that the bounds of the ranges are small. A content that a third of all rows
hold is split over many partitions by row; a partition only names what it has
seen, and its first and last key are compared with its neighbours' afterwards
(a table with one row per partition). Should two contents share both hashes,
the sort could interleave them; that is noticed and reported, never misnamed.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import WHITE_SPACE, batch, small, stored, texts_of

BLOCK_BYTES = 4096
BATCH_BYTES = 8 << 20

_BLOCKS = pa.schema([("row", pa.int64()), ("pos", pa.int32()), ("n", pa.int32()), ("key", pa.binary()),
                     ("doc_id", pa.int64()), ("code_points", pa.int64()), ("text_sha256", pa.string())])
_NAMED = pa.schema([("row", pa.int64()), ("pos", pa.int32()), ("n", pa.int32()), ("part", pa.int32()),
                    ("local", pa.int64()), ("edge", pa.binary()), ("doc_id", pa.int64()),
                    ("code_points", pa.int64()), ("text_sha256", pa.string())])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary", pa.string(): "string"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def _cut(block_bytes: int):
    def run(batches):
        for b in small(batches):
            out, size = [], 0
            for row, doc_id, text in zip(b["row"].to_pylist(), b["doc_id"].to_pylist(), texts_of(b["text"])):
                bare = text.translate(None, WHITE_SPACE)
                points, sha = len(text.decode("utf-8", "replace")), hashlib.sha256(bare).hexdigest()
                n = max(1, -(-len(bare) // block_bytes))
                for pos in range(n):
                    key = bare[pos * block_bytes:(pos + 1) * block_bytes]
                    out.append((row, pos, n, key, doc_id, points, sha) if pos == 0 else (row, pos, n, key, None, None, None))
                    size += len(key) + 100
                    if size > BATCH_BYTES:
                        yield batch(_BLOCKS, *zip(*out))
                        out, size = [], 0
            if out:
                yield batch(_BLOCKS, *zip(*out))
    return run


def _name(batches):
    """Dense rank of the key within one sorted partition.

    The rows that hold the partition's first and last key keep it as ``edge``,
    once each (first row, last row)."""
    part, local, last_key, last_hash = TaskContext.get().partitionId(), -1, None, None
    held = None  # one row is held back: the last one of all keeps its key
    for b in small(batches):
        keys = b["key"].to_pylist()
        names, edges = [], []
        for k, *h in zip(keys, b["h1"].to_pylist(), b["h2"].to_pylist()):
            first = last_key is None
            if first or k != last_key:
                if h == last_hash:
                    raise ValueError("two blocks share both order hashes; choose another block size")
                local, last_key, last_hash = local + 1, k, h
            names.append(local)
            edges.append(k if first else None)
        if not keys:
            continue
        out = pa.RecordBatch.from_arrays(
            [b["row"], b["pos"], b["n"], pa.array([part] * len(keys), pa.int32()), pa.array(names, pa.int64()),
             pa.array(edges, pa.binary()), b["doc_id"], b["code_points"], b["text_sha256"]], schema=_NAMED)
        if held is not None:
            yield held
        if out.num_rows > 1:
            yield out.slice(0, out.num_rows - 1)
        held = out.slice(out.num_rows - 1)
    if held is not None:
        at = held.schema.get_field_index("edge")
        yield held.set_column(at, "edge", pa.array([last_key], pa.binary()))


def _ranked(keyed: DataFrame, partitions: int, label: str) -> DataFrame:
    """Replace ``key`` by ``name``, its dense rank over all rows."""
    keyed = keyed.withColumns({"h1": F.xxhash64("key"), "h2": F.xxhash64(F.lit(1), "key")})
    local = stored(keyed.repartitionByRange(partitions, "h1", "h2", "row", "pos")
                   .sortWithinPartitions("h1", "h2", "key", "row", "pos")
                   .mapInArrow(_name, _ddl(_NAMED)), label)
    # One row per partition: its number of names, first and last key.
    first, last = F.min(F.struct("local", "edge"))["edge"], F.max(F.struct("local", "edge"))["edge"]
    parts = (local.where("edge is not null").groupBy("part")
             .agg((F.max("local") + 1).alias("names"), first.alias("low"), last.alias("high")))
    order = Window.orderBy("part")
    shared = F.coalesce((F.lag("high").over(order) == F.col("low")).cast("long"), F.lit(0))
    shift = (parts.withColumn("new", F.col("names") - shared)
             .select("part", (F.sum("new").over(order) - F.col("names")).alias("shift")))
    return (local.join(F.broadcast(shift), "part")  # one small row per partition of the sort
            .selectExpr("row", "pos", "n", "local + shift as name", "doc_id", "code_points", "text_sha256"))


def named_texts(docs: DataFrame, block_bytes: int = BLOCK_BYTES, partitions: int | None = None) -> DataFrame:
    """One row per row of ``docs``: its identity (``n`` blocks, ``name``),
    ``doc_id``, ``code_points`` of the original text and ``text_sha256``."""
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"),
                       F.col("text").cast("binary").alias("text"))
    named = _ranked(rows.mapInArrow(_cut(block_bytes), _ddl(_BLOCKS)), partitions, "names-0")
    finished = named.where("n = 1").drop("pos").withColumn("level", F.lit(0))
    rest = named.where("n > 1")
    for level in itertools.count(1):
        most = rest.agg(F.max("n")).head()[0]
        if most is None:
            return finished
        # A text of m names goes on with ceil(m / 2) pairs; its single name is final.
        side = lambda k: F.max(F.when(F.col("pos") % 2 == k, F.col("name")))
        half = (F.col("pos") / 2).cast("int")
        pairs = (rest.groupBy("row", half.alias("pos"), F.ceil(F.col("n") / 2).cast("int").alias("n"))
                 .agg(side(0).alias("a"), F.coalesce(side(1), F.lit(-1)).alias("b"),
                      *[F.max(c).alias(c) for c in ("doc_id", "code_points", "text_sha256")]))
        key = F.concat(F.unhex(F.lpad(F.hex("a"), 16, "0")), F.unhex(F.lpad(F.hex("b"), 16, "0")))
        named = _ranked(pairs.select("row", "pos", "n", key.alias("key"), "doc_id", "code_points", "text_sha256"),
                        partitions, f"names-{level}")
        finished = finished.unionByName(named.where("n = 1").drop("pos").withColumn("level", F.lit(level)))
        rest = named.where("n > 1")


def exact_dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES, partitions: int | None = None) -> DataFrame:
    """Which rows of ``docs`` (doc_id, text) hold equal texts, and which stays.

    Texts are equal when identical after deleting space, tab, line feed,
    vertical tab, form feed and carriage return; null counts as empty. Of
    equal texts the row with the most code points stays, then the smallest
    doc_id (null last), then one of the identical rows. Returns one row per
    input row: doc_id, keep_id, group_size, kept, text_sha256. Other columns
    are ignored; an empty table gives an empty result."""
    named = named_texts(docs, block_bytes, partitions)
    # min of the struct: most code points, then smallest doc_id (null last), then the first row.
    best = F.min(F.struct((-F.col("code_points")).alias("p"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    groups = named.groupBy("level", "name").agg(best.alias("best"), F.count("*").alias("group_size"))
    return (named.join(groups, ["level", "name"])
            .select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
                    (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256"))
