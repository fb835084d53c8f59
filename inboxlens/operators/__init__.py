from .enrich import attach, attach_metrics
from .rollups import count_rows, engagement_counts, recipient_rollup
from .staging import STAGING, stage_all

__all__ = ["attach", "attach_metrics", "count_rows", "engagement_counts",
           "recipient_rollup", "STAGING", "stage_all"]
