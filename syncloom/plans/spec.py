"""What a synchronisation or a topic run is asked to do. Immutable and validated when made."""

from __future__ import annotations

import dataclasses
from collections.abc import Sequence
from dataclasses import dataclass, field

from ..operators.keys import bad_names


@dataclass(frozen=True)
class SyncSpec:
    """A source-to-target synchronisation.

    compare: None (columns), "sha256" or "md5". scope: column whose source bounds limit deletion; None deletes nothing.
    on_duplicate: "error", "latest" (by order) or "allow".
    """

    keys: Sequence[str]
    scope: str | None = None
    compare: str | None = None
    null_safe: bool = True
    unique_keys: Sequence[Sequence[str]] = field(default_factory=tuple)
    nulls_conflict: bool = True
    insert_only: bool = False
    on_duplicate: str = "error"
    order: Sequence[str] = field(default_factory=tuple)

    def __post_init__(self) -> None:
        if not self.keys:
            raise ValueError("keys are needed")
        if self.insert_only and self.scope:
            raise ValueError("insert_only and deletion of missing rows exclude each other")
        if self.compare not in (None, "sha256", "md5"):
            raise ValueError(f"unknown compare: {self.compare!r}")
        if self.on_duplicate not in ("error", "latest", "allow"):
            raise ValueError(f"unknown on_duplicate: {self.on_duplicate!r}")
        if self.on_duplicate == "latest" and not self.order:
            raise ValueError("on_duplicate='latest' needs an order")
        if bad := bad_names([*self.keys, *([self.scope] if self.scope else []), *self.order, *(c for u in self.unique_keys for c in u)]):
            raise ValueError(f"not identifiers: {bad}")

    def replace(self, **changes) -> SyncSpec:
        return dataclasses.replace(self, **changes)


@dataclass(frozen=True)
class TopicSpec:
    """A run over a topic's messages into a keyed table.

    include and exclude: columns of a message's row, exclude first. guard: column that must not go down (a replayed older message is skipped); the table
    needs it, so it is kept even if it is excluded or not included. max_messages: a run reads so many messages at most, the next goes on from there.
    buckets: the table's base is dealt into so many buckets by its keys, which then may not be NULL, so that a merge doesn't shuffle it.
    """

    keys: Sequence[str]
    schema: str
    exclude: Sequence[str] = ("version_id",)
    include: Sequence[str] | None = None
    mode: str = "failfast"
    guard: str | None = None
    max_per_trigger: int | None = None
    buckets: int | None = None
    max_messages: int | None = None

    @property
    def excluded(self) -> list[str]:
        return [c for c in self.exclude if c != self.guard]

    @property
    def included(self) -> list[str] | None:
        return None if self.include is None else [*self.include, *([self.guard] if self.guard and self.guard not in self.include else [])]

    def __post_init__(self) -> None:
        if self.max_messages is not None and self.max_messages < 1:
            raise ValueError("max_messages must be positive")
        if self.mode not in ("failfast", "quarantine"):
            raise ValueError(f"unknown mode: {self.mode!r}")
        if not self.keys:
            raise ValueError("keys are needed")
