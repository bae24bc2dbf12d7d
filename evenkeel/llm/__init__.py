"""Operations on training corpora, as queries over the given tables. Nothing else imports this package."""

from __future__ import annotations


def registered() -> dict[str, tuple]:
    """name -> (query, SQL text or None)."""
    from .queries import QUERIES

    return dict(QUERIES)
