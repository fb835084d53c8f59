"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .sql import lit, q

# The text that stands in for NULL inside a key and the
# separator between parts; keys must equal those built by the SQL packages
# that produced earlier builds.
NULL_PLACEHOLDER = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key_sql(*cols: str) -> str:
    """SQL text of ``surrogate_key`` over column names."""
    parts = ", ".join(f"coalesce(cast({q(c)} as string), {lit(NULL_PLACEHOLDER)})" for c in cols)
    return f"md5(concat_ws({lit(SEPARATOR)}, {parts}))"


def surrogate_key(*cols: str | Column) -> Column:
    """md5 hex of the parts cast to string, NULL parts replaced by a
    placeholder, joined by '-'.  Two NULL parts in the same position give the
    same key (so joins on the key match NULLs)."""
    if all(isinstance(c, str) for c in cols):
        return F.expr(surrogate_key_sql(*cols))
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"),
                        F.lit(NULL_PLACEHOLDER)) for c in cols]
    return F.md5(F.concat_ws(SEPARATOR, *parts))
