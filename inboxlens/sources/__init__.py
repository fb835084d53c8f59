from .connections import (ABSENT, Connection, conform, read_partitioned_sources, read_sources,
                          union_connections)

__all__ = ["ABSENT", "Connection", "conform", "read_partitioned_sources", "read_sources",
           "union_connections"]
