"""Declared dataset schemas: the keep-list, label, renames and row filters."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class DatasetSpec:
    """What a pipeline expects from an input table.

    ``columns`` is the keep-list with target types (applied after the read by
    projection + cast, so Parquet/ORC column pruning still applies).
    ``rename`` maps source names to the neutral names used downstream; absent
    keys are ignored. ``filters`` are SQL predicate fragments that are ANDed
    together and pushed to the scan. ``fill`` replaces NULLs in numeric columns
    (None: leave them).
    """

    columns: T.StructType
    label: str | None = None
    rename: dict[str, str] = field(default_factory=dict)
    filters: tuple[str, ...] = ()
    fill: float | None = None

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.columns.fields]

    @property
    def features(self) -> list[str]:
        return [n for n in self.names if n != self.label]

    def ddl(self) -> str:
        return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.columns.fields)
