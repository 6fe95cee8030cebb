"""Where rows go when a table is too large for the session's number of partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, slices: int | None, *keys: str) -> DataFrame:
    """Rows dealt by the keys over this many partitions, so that a task does not grow with the table; None leaves it to Spark."""
    return df if slices is None else df.repartition(slices, *keys)
