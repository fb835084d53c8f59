"""SQL text helpers for projections built as ``selectExpr`` strings (one call
into the JVM per projection instead of one per column)."""

from __future__ import annotations


def q(name: str) -> str:
    """Quoted identifier."""
    return "`" + name.replace("`", "``") + "`"


def lit(value: object) -> str:
    """SQL literal for None, bool, int, float or str."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float)):
        return repr(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def alias(expr: str, name: str) -> str:
    return f"{expr} AS {q(name)}"
