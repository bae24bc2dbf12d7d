"""Compare a source table with a target table, repair the target, and report on the runs."""

from .mapping import ColumnMap, Mapping

__all__ = ["ColumnMap", "Mapping"]
