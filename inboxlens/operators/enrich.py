"""Left joins that attach looked-up columns or metrics to a base table.

Every join is an equi LEFT join on the entity key plus ``source_relation``
(left out only when a single connection is read, where it is constant), so
rows of different connections never meet.  No broadcast hint is given:
the planner broadcasts a side only when its size is under
``spark.sql.autoBroadcastJoinThreshold``, estimated from file statistics
when planning (scaled by ``spark.sql.sources.fileCompressionFactor``; a
filter never lowers the estimate) and measured
by AQE on the materialised shuffle at run time; otherwise the join stays a
shuffled join (AQE splits skewed partitions of it)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sql import alias, lit, q

SR = "source_relation"


def attach(base: DataFrame, other: DataFrame, on: Sequence[tuple[str, str]],
           columns: Sequence[tuple[str, str]], fill: dict[str, object] | None = None,
           by_source: bool = True) -> DataFrame:
    """``base LEFT JOIN other ON base.l = other.r AND ... AND source_relation``.

    ``on`` lists (base column, other column) pairs; ``columns`` lists
    (output name, other column) pairs appended after the base columns;
    ``fill`` maps output names to the value used when it is NULL
    (``coalesce``).  Output keeps base's columns and order.  ``by_source``
    False leaves ``source_relation`` out of the condition (one connection).
    """
    fill = fill or {}
    pairs = ([(SR, SR)] if by_source else []) + [p for p in on if p != (SR, SR)]
    # Right side: keys and values renamed so that every name in the join
    # condition and the output resolves to exactly one side.
    right = other.selectExpr(*[alias(q(r), f"__k{i}") for i, (_, r) in enumerate(pairs)],
                             *[alias(q(src), f"__v_{out}") for out, src in columns])
    cond = " AND ".join(f"{q(left)} = __k{i}" for i, (left, _) in enumerate(pairs))
    joined = base.join(right, F.expr(cond), "left")
    out_cols = [q(c) for c in base.columns]
    for out, _ in columns:
        v = q(f"__v_{out}")
        out_cols.append(alias(f"coalesce({v}, {lit(fill[out])})" if out in fill else v, out))
    return joined.selectExpr(*out_cols)


def attach_metrics(base: DataFrame, metrics: DataFrame, keys: Sequence[str],
                   names: Sequence[str], prefix: str = "", fill: object = 0,
                   by_source: bool = True) -> DataFrame:
    """Attach metric columns ``names`` of ``metrics`` as ``prefix + name``,
    NULL (no row for the key) replaced by ``fill``."""
    cols = [(prefix + n, n) for n in names]
    return attach(base, metrics, [(k, k) for k in keys], cols,
                  fill={out: fill for out, _ in cols}, by_source=by_source)
