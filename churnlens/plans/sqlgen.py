"""Small SQL text helpers for the oracle queries."""

from __future__ import annotations

from collections.abc import Sequence


def stack_sql(table: str, columns: Sequence[str], keep: Sequence[str] = (), cast: str = "VARCHAR", where: str = "") -> str:
    """UNION ALL unpivot of ``columns`` to ``(keep..., feature, value)``."""
    k = "".join(f"{c}, " for c in keep)
    w = f" WHERE {where}" if where else ""
    return "\nUNION ALL ".join(
        f"SELECT {k}'{c}' AS feature, CAST({c} AS {cast}) AS value FROM {table}{w}" for c in columns
    )
