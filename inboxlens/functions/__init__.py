from .dates import boundary_diff, utc_sql
from .keys import surrogate_key

__all__ = ["boundary_diff", "surrogate_key", "utc_sql"]
