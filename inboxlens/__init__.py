"""Email-engagement analytics on Spark DataFrames."""

from .options import Options, PassThrough
from .plans import OUTPUTS, build, checkpointed, current_build, read_build, register_views
from .plans.write import write_build
from .sources import ABSENT, Connection, read_sources

__all__ = ["ABSENT", "Connection", "OUTPUTS", "Options", "PassThrough", "build", "checkpointed",
           "current_build", "read_build", "read_sources", "register_views", "write_build"]
