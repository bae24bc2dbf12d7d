"""Every operator as a query over the given tables, with the SQL its result is checked against."""

from __future__ import annotations

from . import auditing, checking, comparing, digesting, drifting, filing, history, matching, preparing, repairing, typing

_PARTS = (typing, comparing, digesting, checking, repairing, drifting, matching, history, preparing, filing, auditing)


def registered() -> dict[str, tuple]:
    """name -> (query, SQL text or None)."""
    found: dict[str, tuple] = {}
    for part in _PARTS:
        if twice := found.keys() & part.QUERIES.keys():
            raise ValueError(f"queries registered twice: {sorted(twice)}")
        found |= part.QUERIES
    return found
