"""Mixing sources to target weights.

Each row gets a hash-random key. Rows are range-sorted by that key within their
source; prefix sums of the token counts then give each row its place, and each
source is cut at its exact budget. A budget above the source's size takes whole
epochs first and the cut falls into the last one.

The key range is split into even buckets, so a source with a third of all rows
spreads over all of them: prefix sums run inside (source, bucket), and the
buckets' own sums are accumulated per source (one row per bucket).
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType
from pyspark.sql.window import Window

from .shared import WORD, stored

KEY_BITS = 60
ROWS_PER_BUCKET = 1 << 14


def source_targets(sized: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5,
                   epochs: float = 2.0) -> DataFrame:
    """source, source_size and target of each source (one row each).

    Sources by code point (null last) get the weights in turn and share
    ``share`` of all sizes. No target exceeds ``epochs`` times its source's
    size: sources are filled in the order of that limit per unit of weight, so
    what a full source leaves goes to the others by weight. Works on one row
    per source."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(float(epochs)))
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    # Level at which this source and all later ones share what the earlier full ones leave.
    level = (total * F.lit(float(share)) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    per = per.withColumn("level", level)
    # The first source that its level does not fill: from there on the level holds.
    reached = F.first(F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("level")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, 0))
    return per.select("source", "source_size",
                      F.coalesce(F.least("limit", reached * F.col("weight")), "limit").alias("target"))


@F.pandas_udf(BinaryType())
def first_words(text: pd.Series, words: pd.Series) -> pd.Series:
    """Each text (bytes) up to the end of its n-th word; null stays null."""
    def cut(t, n):
        if t is None:
            return t
        m = next(itertools.islice(re.finditer(WORD.encode(), t), n - 1, None), None)
        return t[:m.end()] if m else t
    return pd.Series([cut(t, int(n)) for t, n in zip(text, words)], dtype=object)


def _numbered(docs: DataFrame) -> DataFrame:
    return docs.withColumn("__row", F.monotonically_increasing_id())


def _taken(docs: DataFrame, weights: Sequence[float], share: float, epochs: float, seed: str) -> DataFrame:
    """Numbers of each row of ``docs`` (__row, doc_id, source, text), without texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string"), text).cast("binary")),
                             1, KEY_BITS // 4), 16, 10).cast("long")
    slim = stored(docs.select("__row", "doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
                              key.alias("key")), "mix-sizes")
    targets = source_targets(slim, weights, share, epochs)
    buckets = max(1, slim.count() // ROWS_PER_BUCKET)
    bits = min(30, (buckets - 1).bit_length())
    slim = slim.withColumn("bucket", F.shiftright("key", KEY_BITS - bits))
    sums = slim.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    start = F.sum("words").over(Window.partitionBy("source").orderBy("bucket")) - F.col("words")
    placed = (sums.withColumn("start", start).alias("s")
              .join(targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")))
              .select("s.source", "bucket", "start", "source_size", "target"))
    local = (Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size", "__row")
             .rowsBetween(Window.unboundedPreceding, 0))
    rows = slim.withColumn("inner", F.sum("size").over(local) - F.col("size")).alias("r").join(
        placed.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")) & (F.col("r.bucket") == F.col("p.bucket")))
    budget = F.floor("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.expr("cast(floor(target) as bigint) div source_size")).otherwise(F.lit(0))
    left = budget - whole * F.col("source_size") - F.col("start") - F.col("inner")
    taken = whole * F.col("size") + F.greatest(F.lit(0), F.least("size", left))
    return rows.select("__row", "r.doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mix_sources(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, epochs: float = 2.0,
                seed: str = "mix") -> DataFrame:
    """How many words the mix takes of each row of ``docs`` (doc_id, source, text).

    Returns doc_id, size (words of the text, null: 0), source_size and target
    (of the row's source) and taken, one row per input row. Per source the sum
    of taken is the whole part of its target, and no row gives more than
    ``epochs`` times its size (rounded up). The order is random by a hash of
    seed, doc_id and text: reruns agree, and repeated identical rows are
    interchangeable. Null doc_ids and sources are values of their own; other
    columns are ignored; an empty table gives an empty result."""
    return _taken(_numbered(docs.select("doc_id", "source", "text")), weights, share, epochs, seed).drop("__row")


def mixed_documents(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, epochs: float = 2.0,
                    seed: str = "mix") -> DataFrame:
    """The mix itself: ``docs`` with each row repeated once per epoch that takes
    it, the text of a partly taken one cut behind its last taken word. Rows of
    which no word is taken go, those without words too. Bytes that are not UTF-8
    stay as they are. Keeps all columns but one called __row."""
    names = [c for c in docs.columns if c != "__row"]
    docs = stored(_numbered(docs.select(*[F.col(f"`{c}`") for c in names])), "mix-documents")
    plan = (_taken(docs, weights, share, epochs, seed).where("taken > 0")
            .select("__row", F.col("size").alias("__size"), F.col("taken").alias("__taken")))
    passes = F.explode(F.sequence(F.lit(1), F.ceil(F.col("__taken") / F.col("__size")).cast("int"))).alias("__pass")
    rest = F.col("__taken") - F.col("__size") * (F.col("__pass") - 1)
    out = docs.join(plan, "__row").select("*", passes)
    partly = rest < F.col("__size")
    # only the texts that are cut, one a source at most, go to Python
    cut = first_words(F.when(partly, F.col("text").cast("binary")), rest).cast("string")
    text = F.when(partly, cut).otherwise(F.col("text"))
    return out.select(*[(text if c == "text" else F.col(f"`{c}`")).alias(c) for c in names])
