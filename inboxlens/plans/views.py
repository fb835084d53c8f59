"""Expose a build to SQL: every model as a temporary view."""

from __future__ import annotations

from pyspark.sql import DataFrame


def register_views(models: dict[str, DataFrame], prefix: str = "",
                   global_views: bool = False) -> list[str]:
    """Register each model as ``<prefix><name>`` (session temp view, or in
    ``global_temp`` when ``global_views``).  The views are the lazy plans:
    a SQL query over them is optimised together with the build."""
    names = []
    for name, df in models.items():
        view = f"{prefix}{name}"
        if global_views:
            df.createOrReplaceGlobalTempView(view)
        else:
            df.createOrReplaceTempView(view)
        names.append(view)
    return names
