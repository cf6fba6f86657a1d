"""Column names that a caller's table does not have."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, each with as many underscores behind it as keep it
    apart from the table's columns, whatever their case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
