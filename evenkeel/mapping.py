"""Column mappings between a source and a target table (driver-side metadata)."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass
from pathlib import Path

# Declared types a mapping may use, and the kind each one is handled as.
KINDS = {
    "numeric": "numeric",
    "integer": "integer",
    "int": "integer",
    "long": "integer",
    "bigint": "integer",
    "float": "double",
    "double": "double",
    "boolean": "boolean",
    "date": "date",
    "timestamp": "timestamp",
    "string": "string",
}

# Spark type each kind is compared as.
SPARK_TYPES = {
    "numeric": "decimal(38,10)",
    "integer": "bigint",
    "double": "double",
    "boolean": "boolean",
    "date": "date",
    "timestamp": "timestamp",
    "string": "string",
}


class MappingError(ValueError):
    """A mapping document that cannot be used."""


@dataclass(frozen=True)
class ColumnMap:
    source: str | None
    target: str | None
    data_type: str = "string"
    date_format: str | None = None

    @property
    def kind(self) -> str:
        return KINDS.get(self.data_type, "string")

    @property
    def spark_type(self) -> str:
        return SPARK_TYPES[self.kind]

    def on(self, side: str) -> str:
        return self.source if side == "source" else self.target


@dataclass(frozen=True)
class Mapping:
    """``names`` says whose column names the compared frames and reports carry.

    ``unfit`` says how compared values that do not fit their declared type are taken: ``equal`` to a blank
    and to each other, or ``distinct``, each as its own text. Keys that do not fit are always distinct.
    """

    keys: tuple[ColumnMap, ...]
    compare: tuple[ColumnMap, ...]
    gaps: tuple[ColumnMap, ...] = ()
    names: str = "source"
    unfit: str = "equal"

    @property
    def columns(self) -> tuple[ColumnMap, ...]:
        return self.keys + self.compare

    def name(self, column: ColumnMap) -> str:
        return column.on(self.names)

    @property
    def key_names(self) -> list[str]:
        return [self.name(c) for c in self.keys]

    @property
    def compare_names(self) -> list[str]:
        return [self.name(c) for c in self.compare]

    @classmethod
    def of(
        cls,
        keys: Iterable[str],
        columns: Iterable[ColumnMap],
        *,
        names: str = "source",
        require_formats: bool = False,
        unfit: str = "equal",
    ) -> Mapping:
        """Build a mapping; ``keys`` are source column names.

        Entries without a source or a target cannot be compared and end up in ``gaps``.
        """
        keys, columns = list(keys), list(columns)
        if names not in ("source", "target"):
            raise MappingError(f"names must be 'source' or 'target', not {names!r}")
        if unfit not in ("equal", "distinct"):
            raise MappingError(f"unfit must be 'equal' or 'distinct', not {unfit!r}")
        if not keys:
            raise MappingError("a mapping needs at least one primary key")
        if not columns:
            raise MappingError("a mapping needs at least one column")
        pairs = [c for c in columns if c.source and c.target]
        whole = {c.source: c for c in pairs}
        if len(whole) < len(pairs):
            raise MappingError("a source column is mapped to several targets")
        if lost := [k for k in keys if k not in whole]:
            raise MappingError(f"primary keys are not among the mapped columns: {lost}")
        for c in whole.values():
            if require_formats:
                if c.data_type not in KINDS:
                    raise MappingError(f"unknown data type {c.data_type!r} of column {c.source}")
                if c.kind in ("date", "timestamp") and not c.date_format:
                    raise MappingError(f"column {c.source} is a {c.data_type} without date_format")
        return cls(
            keys=tuple(whole[k] for k in keys),
            compare=tuple(c for c in whole.values() if c.source not in keys),
            gaps=tuple(c for c in columns if not (c.source and c.target)),
            names=names,
            unfit=unfit,
        )

    @classmethod
    def from_json(cls, document: str | dict | Path, **options) -> Mapping:
        """Read ``{"primary_keys": [...], "column_mappings": [...]}``; keys may sit below ``common``."""
        if isinstance(document, Path):
            document = document.read_text(encoding="utf-8")
        if isinstance(document, str):
            document = json.loads(document)
        pairs = document.get("common", {}).get("primary_keys") or document.get("primary_keys") or []
        columns = [
            ColumnMap(
                m.get("source_column"),
                m.get("target_column"),
                (m.get("data_type") or "string").strip().lower(),
                m.get("date_format"),
            )
            for m in document.get("column_mappings") or []
        ]
        known = {(c.source, c.target) for c in columns}
        for pair in pairs:
            if (pair["source_column"], pair["target_column"]) not in known:
                raise MappingError(f"primary key {pair} is not among the mapped columns")
        return cls.of([p["source_column"] for p in pairs], columns, **options)
