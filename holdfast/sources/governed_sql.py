"""Read-only SQL over registered views with a row cap."""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

# Words that make a statement unsafe (``replace`` also refuses the function of that name).
BLOCKED_WORDS = frozenset({
    "alter", "analyze", "call", "copy", "create", "delete", "drop", "execute", "grant", "insert", "merge", "refresh",
    "reindex", "replace", "revoke", "truncate", "update", "vacuum",
})


@dataclass(frozen=True)
class CappedResult:
    """A lazily capped result; :meth:`counted` runs it once for the row count."""

    dataframe: DataFrame
    sql: str
    limit: int
    probe: DataFrame

    def counted(self) -> tuple[int, bool]:
        """(row_count, truncated); truncated only if a row beyond the cap exists."""
        rows = self.probe.count()
        return min(rows, self.limit), rows > self.limit


def check_read_only(sql: str) -> None:
    text = sql.lower()
    if text.split(maxsplit=1)[:1] not in (["select"], ["with"]):
        raise ValueError("Only SELECT or WITH queries are accepted.")
    blocked = sorted(BLOCKED_WORDS & set(re.findall(r"\b[a-z_]+\b", text)))
    if blocked:
        raise ValueError(f"Unsafe SQL keyword detected: {', '.join(blocked)}")
    if ";" in sql.rstrip(";"):
        raise ValueError("Only one SQL statement is accepted at a time.")


def query(spark: SparkSession, sql: str, params: dict[str, Any] | None = None, *, limit: int) -> CappedResult:
    """Validate and plan a query of at most ``limit`` rows, a positive number. The cap is always outside, so an inner LIMIT cannot exceed it."""
    text = sql.strip().rstrip(";").strip()
    check_read_only(text)
    if limit < 1:
        raise ValueError("The row cap must be positive.")
    rows = spark.sql(text, args=params) if params else spark.sql(text)
    return CappedResult(rows.limit(limit), text, limit, rows.limit(limit + 1))
