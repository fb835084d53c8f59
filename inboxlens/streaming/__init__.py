from .events import append_to, automation_event_stream, campaign_event_stream

__all__ = ["append_to", "automation_event_stream", "campaign_event_stream"]
