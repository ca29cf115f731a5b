"""Window clauses as SQL text."""

from __future__ import annotations

from collections.abc import Sequence

from starmart.functions.predicates import quoted


def over(
    partition_by: Sequence[str],
    order_by: Sequence[str],
    descending: bool = False,
    rows: tuple[str, str] | None = None,
) -> str:
    """``OVER (...)``; ``rows`` are the two ends of a ROWS frame."""
    parts = []
    if partition_by:
        parts.append("PARTITION BY " + ", ".join(map(quoted, partition_by)))
    direction = " DESC" if descending else ""
    parts.append("ORDER BY " + ", ".join(quoted(c) + direction for c in order_by))
    if rows:
        parts.append("ROWS BETWEEN {} AND {}".format(*rows))
    return f"OVER ({' '.join(parts)})"
