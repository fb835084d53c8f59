from .build import HUBS, OUTPUTS, build, checkpointed
from .publish import current_build, read_build
from .views import register_views

__all__ = ["HUBS", "OUTPUTS", "build", "checkpointed", "current_build", "read_build", "register_views"]
