"""Whether rows of several connections meet in one build."""

from __future__ import annotations

from dataclasses import dataclass

from ..operators.enrich import SR


@dataclass(frozen=True)
class Scope:
    """``by_source`` True: ``source_relation`` is part of every group and
    join key.  False (one connection, the column is constant): keys are the
    entity keys alone and ``source_relation`` is carried through aggregates,
    so an aggregate is partitioned exactly on the key it is joined on and
    no extra shuffle is planned around the constant."""

    by_source: bool = True

    def keys(self, *keys: str) -> list[str]:
        return ([SR] if self.by_source else []) + list(keys)

    @property
    def carry(self) -> list[str]:
        return [] if self.by_source else [SR]
