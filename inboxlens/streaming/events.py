"""Event enrichment on a stream.

New campaign / automation events arriving as a Structured Streaming source
are staged and enriched exactly like the batch outputs (send time and time
since send; owning automation and segment) through a stream-static LEFT
join against the current dimension tables.  The step is stateless, so no
watermark or state store is involved and the output can be appended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.staging import stg_automation_activities, stg_campaign_activities
from ..options import Options
from ..plans import automation, campaign
from ..session import checkpoint_dir
from ..sources.connections import union_connections


def campaign_event_stream(streams: list[tuple[str, DataFrame]], stg_campaigns: DataFrame,
                          options: Options = Options()) -> DataFrame:
    """Campaign events of one or more connections' streams, enriched like the
    batch ``campaign_activities`` output."""
    raw = union_connections(streams, options)
    return campaign.campaign_activities(stg_campaign_activities(raw, options), stg_campaigns)


def automation_event_stream(streams: list[tuple[str, DataFrame]], stg_automation_emails: DataFrame,
                            stg_automations: DataFrame, options: Options = Options()) -> DataFrame:
    """Automation events enriched like the batch ``automation_activities`` output."""
    raw = union_connections(streams, options)
    owner = automation.email_owner(stg_automation_emails, stg_automations)
    return automation.automation_activities(stg_automation_activities(raw, options), owner)


def append_to(spark: SparkSession, df: DataFrame, path: str, name: str, fmt: str = "parquet",
              available_now: bool = False, checkpoint: str | None = None) -> StreamingQuery:
    """Append the stream to ``path``.  Progress is kept under the session's
    shared checkpoint folder (``spark.checkpoint.dir``/streams/<name>) unless
    ``checkpoint`` is given, so a restarted query resumes exactly once."""
    location = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    w = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", location) \
        .option("path", path).queryName(name)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()
