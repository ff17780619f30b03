"""K-08: refuse to build models on top of an empty raw table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ledgerlake.operators.quality import table_counts


def load_counts(raw: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` of every raw table, in one job."""
    return table_counts(raw)


def validate_load(raw: Mapping[str, DataFrame]) -> dict[str, int]:
    """Raise ``ValueError`` naming every empty raw table; return the counts otherwise.

    Only one count per table reaches the driver.
    """
    counts = {r["table_name"]: int(r["row_count"]) for r in load_counts(raw).collect()}
    empty = sorted(t for t, n in counts.items() if n == 0)
    if empty:
        raise ValueError(f"empty raw table(s): {', '.join(empty)}")
    return counts
